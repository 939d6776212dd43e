"""Two rounds of compact hash exchange between ranges of documents.

Finding repeats needs every document's fingerprints beside those of all others, which
as rows would be many times the text. Here documents are dealt once by *chunk*, a range
of ids, so that a smaller chunk holds only smaller ids. Per round a chunk sends each
bucket of the hash space its distinct fingerprints, sorted, as a few packed arrays, and
gets one bit for each back (for the same order, which it rebuilds). A fingerprint goes
out once a chunk however many copies it has, so hot passages and groups of copies cost
no more than others, and no pair of documents is ever built.

The text is shuffled once: all three passes over it read the same exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple, Protocol

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import partitions

CHUNKS_PER_PARTITION = 2
#: Ranges of the hash space that one task answers one after the other: it holds the packed
#: entries of all of them, but unpacks and sorts those of one.
BUCKETS_PER_PARTITION = 1


class Entries(NamedTuple):
    """Distinct fingerprints of a chunk: ascending keys, and arrays sent along with them."""

    key: np.ndarray
    ship: list[np.ndarray]


class Finder(Protocol):
    """What a repeat finder does on a chunk and in a bucket. ``answer_*`` get the keys, the
    shipped arrays and the chunk of every entry of a bucket, and return bits (uint8)."""

    key_bits: int

    def load(self, table: pa.Table) -> Any: ...
    def first(self, state: Any) -> Entries: ...
    def answer_first(self, key: np.ndarray, ship: list[np.ndarray], chunk: np.ndarray) -> np.ndarray: ...
    def second(self, state: Any, bits: np.ndarray) -> Entries: ...
    def answer_second(self, key: np.ndarray, ship: list[np.ndarray], chunk: np.ndarray) -> np.ndarray: ...
    def finish(self, state: Any, bits: np.ndarray) -> pa.Table: ...


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """Buckets are ranges of the key, so ascending keys are ascending buckets."""
    return ((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as compressed byte planes; the first is ascending and stored as gaps."""
    out = [np.uint32(len(arrays)).tobytes()]
    squeeze = zstandard.ZstdCompressor(level=1)
    for i, a in enumerate(arrays):
        if i == 0 and len(a):
            a = np.concatenate([a[:1], a[1:] - a[:-1]])
        kind = a.dtype.str.encode().ljust(8)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
        for plane in planes:
            raw = squeeze.compress(np.ascontiguousarray(plane).tobytes())
            out += [kind, np.uint32(len(a)).tobytes(), np.uint32(len(raw)).tobytes(), raw]
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    view, at, arrays = memoryview(raw), 4, []
    number = int(np.frombuffer(raw, np.uint32, 1)[0])
    expand = zstandard.ZstdDecompressor()
    for i in range(number):
        plane, planes, itemsize = 0, None, 1
        while plane < itemsize:
            kind = np.dtype(bytes(view[at:at + 8]).decode().strip())
            n, size = np.frombuffer(raw, np.uint32, 2, at + 8)
            itemsize = kind.itemsize
            if planes is None:
                planes = np.empty((int(n), itemsize), np.uint8)
            planes[:, plane] = np.frombuffer(expand.decompress(view[at + 16:at + 16 + int(size)], max_output_size=max(1, int(n))), np.uint8)
            at, plane = at + 16 + int(size), plane + 1
        a = planes.reshape(-1).view(kind)
        arrays.append(np.cumsum(a, dtype=a.dtype) if i == 0 else a)
    return arrays


def truncated(key: np.ndarray, bits: int) -> np.ndarray:
    return key >> np.uint64(64 - bits) if bits < 64 else key


_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary())])
_SENT_DDL = "bucket int, chunk int, payload binary"
_REPLY = pa.schema([("chunk", pa.int32()), ("turn", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
_REPLY_DDL = "chunk int, turn int, bucket int, payload binary"


def _send(entries: Entries, chunk: int, n: int, bits: int) -> pa.Table:
    ends = np.searchsorted(bucket_of(entries.key, n), np.arange(n + 1))
    rows = [(b, pack([truncated(entries.key[lo:hi], bits), *[a[lo:hi] for a in entries.ship]]))
            for b, (lo, hi) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if lo < hi]
    return pa.table([pa.array([b for b, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int32()), pa.array([p for _, p in rows], pa.binary())], schema=_SENT)


def _answers(answer, turn: int):
    """Bits back to each chunk. A partition holds a few neighbouring buckets, packed; one
    bucket's entries are unpacked, answered and let go before the next one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for batch in batches:
            for b, c, p in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                by.setdefault(b, []).append((c, p))
        for b in sorted(by):
            rows = by.pop(b)
            chunks = [c for c, _ in rows]
            parts = [unpack(p) for _, p in rows]
            rows.clear()
            sizes = [len(x[0]) for x in parts]
            joined = []
            for i in range(len(parts[0])):
                joined.append(np.concatenate([x[i] for x in parts]))
                for x in parts:
                    x[i] = None
            bits = answer(joined[0], joined[1:], np.repeat(np.array(chunks, np.int32), sizes)).astype(np.uint8)
            del joined, parts
            squeeze = zstandard.ZstdCompressor(level=1)
            made = [(c, squeeze.compress(part.tobytes())) for c, part in zip(chunks, np.split(bits, np.cumsum(sizes)[:-1]), strict=True) if part.any()]
            del bits
            for lo in range(0, len(made), 1000):
                some = made[lo:lo + 1000]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in some], pa.int32()), pa.array([turn] * len(some), pa.int32()),
                                                  pa.array([b] * len(some), pa.int32()), pa.array([p for _, p in some], pa.binary())], schema=_REPLY)

    return run


def _bits(entries: Entries, replies: pa.Table, turn: int, n: int) -> np.ndarray:
    """The bits of all entries of a chunk; a bucket without a reply has none set."""
    ends = np.searchsorted(bucket_of(entries.key, n), np.arange(n + 1))
    out = np.zeros(len(entries.key), np.uint8)
    expand = zstandard.ZstdDecompressor()
    for t, b, p in zip(*(replies.column(c).to_pylist() for c in ("turn", "bucket", "payload")), strict=True):
        if t == turn:
            out[ends[b]:ends[b + 1]] = np.frombuffer(expand.decompress(p), np.uint8)
    return out


def by_chunk(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text and ``chunk``: the range of ids (from sampled quantiles) it falls in."""
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], max(1e-5, 0.1 / n)))) if n > 1 else []
    if not cuts:
        return docs.select("doc_id", "text", F.lit(0).alias("chunk"))
    at = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="at", outputCol="range")
    cut = at.transform(docs.select("doc_id", "text", F.col("doc_id").cast("double").alias("at")))
    return cut.select("doc_id", "text", F.col("range").cast("int").alias("chunk"))


def run(docs: DataFrame, finder: Finder, result: str) -> DataFrame:
    """Rows of ``finder.finish`` for all documents with an id (columns doc_id, text)."""
    spark = docs.sparkSession
    n = partitions(spark)
    m = BUCKETS_PER_PARTITION * n
    dealt = by_chunk(docs.filter("doc_id is not null"), CHUNKS_PER_PARTITION * n).repartition(n, "chunk")

    def send_first(table: pa.Table) -> pa.Table:
        return _send(finder.first(finder.load(table)), table["chunk"][0].as_py(), m, finder.key_bits)

    def send_second(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return _SENT.empty_table()
        state = finder.load(table)
        return _send(finder.second(state, _bits(finder.first(state), replies, 1, m)), table["chunk"][0].as_py(), m, 64)

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return finder.finish(None, np.zeros(0, np.uint8))
        state = finder.load(table)
        second = finder.second(state, _bits(finder.first(state), replies, 1, m))
        return finder.finish(state, _bits(second, replies, 2, m))

    first = dealt.groupBy("chunk").applyInArrow(send_first, _SENT_DDL)
    answered_in = (F.col("bucket") / BUCKETS_PER_PARTITION).cast("int")
    first = first.repartitionById(n, answered_in).mapInArrow(_answers(finder.answer_first, 1), _REPLY_DDL).repartition(n, "chunk")
    second = dealt.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(send_second, _SENT_DDL)
    second = second.repartitionById(n, answered_in).mapInArrow(_answers(finder.answer_second, 2), _REPLY_DDL)
    return dealt.groupBy("chunk").cogroup(first.unionByName(second).groupBy("chunk")).applyInArrow(finish, result)


def groups(key: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): an order that brings equal tuples together, and where each begins.

    ``key`` decides the order; the others are looked at only where it repeats."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    if more and len(k):
        sorted_more = [m[order] for m in more]
        mixed = np.zeros(len(k) - 1, dtype=bool)
        for m in sorted_more:
            mixed |= (m[1:] != m[:-1]) & ~new[1:]
        if mixed.any():
            order = np.lexsort((*more[::-1], key))
            new[1:] = False
            for m in (key, *more):
                m = m[order]
                new[1:] |= m[1:] != m[:-1]
    return order, new
