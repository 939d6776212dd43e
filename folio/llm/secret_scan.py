"""Secret scan with multipart credential linking.

One pass over the texts finds the parts: the strong ones of three base kinds, and weak
candidates (account names, short or unlabelled secrets, endpoints). A weak candidate
is reported only when complementary parts stand in its scope, at most ``SCOPE`` code points
between the nearer ends: an account name needs a secret, a weak secret needs an access identifier or
account name, an endpoint needs both. The linking is an interval join of the parts of a
document: in order of starts, the farthest end before a part and the first start after it
decide, so no pair is ever built.

Results for odd input: a null or empty text has no parts (counts 0, the hash of the
empty string); a null id is kept; repeated rows and equal ids stay separate rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import narrow

SCOPE = 240

#: Base kinds in the order in which equal starts are listed, then the method's own kinds.
KINDS = ("assign", "access", "hex", "account", "shortsecret", "longkey", "endpoint")
BASE = KINDS[:3]

_I = re.IGNORECASE  # on bytes: ASCII letters only
ASSIGN = re.compile(rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
ACCOUNT = re.compile(rb"\b(user_?name|user|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._+-]{3,})", _I)
LONGKEY = re.compile(rb"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(rb"\b[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]+|\b(?:host|server|endpoint)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9.-]{4,})(?::[0-9]{2,5})?", _I)

#: What a part is to the others: an identifier, a secret or a place.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "account": "id", "shortsecret": "secret", "longkey": "secret", "endpoint": "place"}

PART = "array<struct<kind:int,start:bigint,end:bigint>>"


def parts_of(raw: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes; a weak candidate inside a strong part is none."""
    found = []
    lower = raw.lower()
    if any(k in lower for k in (b"passw", b"secret", b"token", b"api")):
        for m in ASSIGN.finditer(raw):
            long = m.end(2) - m.start(2) >= 12
            found.append((0 if long else 4, m.start(), m.end()))
    if b"AKIA" in raw:
        found += [(1, *m.span()) for m in ACCESS.finditer(raw)]
    found += [(2, *m.span()) for m in HEX.finditer(raw)]
    strong = _Spans(x[1:] for x in found if x[0] < 3)
    weak = [(3, *m.span()) for m in ACCOUNT.finditer(raw)] + [(6, *m.span()) for m in ENDPOINT.finditer(raw)] if b"=" in raw or b":" in raw else []
    if found or weak:  # a long key alone links to nothing
        weak += [(5, *m.span()) for m in LONGKEY.finditer(raw)]
    found = [x for x in found if x[0] < 3] + [x for x in weak + [x for x in found if x[0] == 4] if not strong.touch(*x[1:])]
    return sorted(found, key=lambda x: (x[1], x[0]))


class _Spans:
    """Spans by their starts, with the farthest end up to each: one binary search a question."""

    def __init__(self, spans):
        spans = sorted(spans)
        self.starts = [a for a, _ in spans]
        self.ends = list(accumulate((b for _, b in spans), max))

    def touch(self, start: int, end: int) -> bool:
        """Does either end of the span lie in one of these?"""
        return self._reaches(bisect_right(self.starts, start), start + 1) or self._reaches(bisect_left(self.starts, end), end)

    def _reaches(self, n: int, place: int) -> bool:
        return n > 0 and self.ends[n - 1] >= place


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        rows = []
        for text in batch.column(2).cast(pa.large_binary()):
            raw = text.as_py() or b""
            found = parts_of(raw)
            if found and not raw.isascii():
                found = _code_points(raw, found)
            rows.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, type=kind)], names=["rid", "doc_id", "parts"])


def _code_points(raw: bytes, found: list) -> list:
    at, chars, last = {}, 0, 0
    for p in sorted({x for _, a, b in found for x in (a, b)}):
        chars += len(raw[last:p].decode("utf-8", "replace"))
        at[p], last = chars, p
    return [(k, at[a], at[b]) for k, a, b in found]


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its reported spans.

    Columns: doc_id; n_assign, n_access, n_hex; base_sha256; spans (all, with the linked
    weak candidates); n_linked."""
    rows = narrow(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    found = rows.mapInArrow(_scan, f"rid bigint, doc_id bigint, parts {PART}")
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind") + 1)
    parts = found.select("rid", "doc_id", F.explode_outer("parts").alias("p")).select("rid", "doc_id", "p.*").withColumn("role", role)

    def near(what: str):
        """Is the gap between a part of a role and this part within the scope?"""
        # of the parts that start no later the one that ends last is the nearest, of the
        # others the one that starts first
        before = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
        after = Window.partitionBy("rid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
        is_it = F.col("role") == what
        return F.coalesce(F.max(F.when(is_it, F.col("end"))).over(before) >= F.col("start") - SCOPE, F.lit(False)) \
            | F.coalesce(F.min(F.when(is_it, F.col("start"))).over(after) <= F.col("end") + SCOPE, F.lit(False))

    parts = parts.select("*", near("id").alias("has_id"), near("secret").alias("has_secret"))
    needs_id = F.col("role").isin("secret", "place")
    needs_secret = F.col("role").isin("id", "place")
    strong = F.col("kind") < len(BASE)
    linked = (~needs_id | F.col("has_id")) & (~needs_secret | F.col("has_secret"))
    parts = parts.withColumn("strong", strong).withColumn("shown", strong | linked)
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", "kind", F.concat_ws(":", name, F.col("start"), F.col("end")).alias("said"), "strong")
    docs_out = parts.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(len(BASE))],
        F.count(F.when(F.col("shown") & ~F.col("strong"), 1)).alias("n_linked"),
        F.sort_array(F.collect_list(F.when(F.col("shown"), span))).alias("all"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: s["said"]), ",")
    base = F.filter("all", lambda s: s["strong"])
    return docs_out.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("all")).alias("spans"), "n_linked")
