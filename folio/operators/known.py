"""A filter of known keys for the HTML pass: which pages need not be compiled.

A Bloom filter, set by a distributed aggregate (one bitmap per 32,768 bits, combined map-side) and
sent to the tasks. "No" is certain, "yes" may be wrong for a few keys, so the exact join
on the ledger still decides and what was left out wrongly is compiled after it. Its size is
bounded: beyond ``MOST_BITS`` it says "yes" more often, which costs time and no rows."""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits a key (5 of 10,000 unknown keys pass), probes a key (the four words of an MD5), and the
#: filter's bounds in bits (128 kB, 64 MB).
BITS_PER_KEY, PROBES, LEAST_BITS, MOST_BITS = 24, 4, 1 << 20, 1 << 29
_BUCKET = 32_768


class KeyFilter:
    """Asked in tasks: may this key be known?"""

    def __init__(self, bits: int, shared):
        self.bits, self.shared = bits, shared

    def __call__(self, key: str | None) -> bool:
        if not key:
            return False
        bitmap = self.shared.value
        return all(bitmap[(p % self.bits) >> 3] >> ((p % self.bits) & 7) & 1 for p in struct.unpack(">4I", hashlib.md5(key.encode(), usedforsecurity=False).digest()))


def key_filter(keys: DataFrame, column: str) -> KeyFilter:
    """The filter of the distinct non-null strings in ``column``."""
    key = F.col(column).cast("string")
    rows = keys.filter(key.isNotNull()).select(F.md5(key).alias("m"))
    bits = LEAST_BITS
    n = rows.agg(F.approx_count_distinct("m")).first()[0]
    while bits < min(n * BITS_PER_KEY, MOST_BITS):
        bits *= 2
    at = F.explode(F.array(*(F.conv(F.substring("m", 8 * i + 1, 8), 16, 10).cast("long") % bits + 1 for i in range(PROBES)))).alias("at")
    maps = rows.select(at).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect()
    whole = bytearray(bits // 8)
    for r in maps:
        start = (r.b - 1) * _BUCKET // 8
        whole[start:start + len(r.m)] = r.m
    return KeyFilter(bits, keys.sparkSession.sparkContext.broadcast(bytes(whole)))
