"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots: of ``PIVOTS`` sampled vectors
the ``PREFIX`` nearest, nearest first. Each block of rows keeps an inverted file, a pivot's
list of the rows that have it among their nearest and at which place. A query reads the
lists of its own nearest pivots, which adds up, row by row, the footrule distance of the two
orders (a pivot missing in one of them counts as if it stood behind the last place); the
rows of least distance are scored exactly. Lists of rows in blocks, so a block's answer is
bounded and the blocks' answers merge by score.

Nearness is the largest inner product in double precision. Vectors of unequal length are
made comparable by one more component, sqrt(longest^2 - |v|^2), zero for queries: the
inner product with a query is unchanged and all rows are equally long, so the order of the
pivots is the order of the angles and large inner products mean small ones.

Results for odd input: rows with a null id take no part, and neither do vectors that are
null, empty, zero or hold a null or non-finite component; a shorter vector counts as
filled up with zeros; every row of a repeated id is a candidate and, where asked for, a
query of its own, without itself as a candidate; equal scores go to the smaller id; an
empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import materialize
from folio.llm.vector_grid import bounded_sample, finite, in_cells, matrix, padded

#: Pivots and places of an order that are posted. The pivots are drawn from ``DRAWN`` times as
#: many sampled vectors (the bounded sample on which the index is fitted), no two of them
#: closer than this cosine while others are left: near copies as pivots order nothing.
PIVOTS, PREFIX, DRAWN, APART = 256, 64, 4, 0.7
#: Share of a block's rows that is scored exactly, and the least number of them.
SHARE, LEAST = 0.12, 500
#: Rows whose agreement with the query is this share of the greatest possible one are scored
#: whatever their number: among many near copies the order of pivots tells too little.
ALIKE = 0.6
#: Queries whose distances to a block are held at once.
AT_ONCE = 128

_FOUND = pa.schema([("q_rid", pa.int64()), ("query_id", pa.int64()), ("found", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def _usable(rows: DataFrame, vec_id: str, vec: str) -> DataFrame:
    x = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"))
    x = x.filter(F.col("vec_id").isNotNull() & finite("vec"))
    return x.filter(F.exists("vec", lambda v: v != 0))


def places(order: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverted file of some orders: where each pivot's list starts (n + 1 numbers), the
    rows in the lists, and each row's weight there, the more the nearer the pivot."""
    length = order.shape[1]
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=n))])
    return starts, by // length, (length - by % length).astype(np.int16)


def agreement(queries: np.ndarray, postings: tuple[np.ndarray, np.ndarray, np.ndarray], n_rows: int, n: int) -> np.ndarray:
    """Queries x rows: the sum over shared pivots of L - max(place in one, place in other).
    The footrule distance of two orders is L * (L + 1) less twice this number."""
    out = np.zeros((len(queries), n_rows), dtype=np.int16)
    q_starts, q_rows, q_weight = places(queries, n)
    starts, rows, weight = postings
    for p in range(n):
        a, b, c, d = q_starts[p], q_starts[p + 1], starts[p], starts[p + 1]
        if a < b and c < d:
            out[np.ix_(q_rows[a:b], rows[c:d])] += np.minimum.outer(q_weight[a:b], weight[c:d])
    return out


def chosen(sample: np.ndarray, n: int) -> np.ndarray:
    """n rows of the sample, or all: the first ones that are apart, then the first others."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    apart: list[int] = []
    for i in range(len(unit)):
        if len(apart) < n and (not apart or (unit[apart] @ unit[i]).max() < APART):
            apart.append(i)
    rest = [i for i in range(len(unit)) if i not in set(apart)]
    return sample[(apart + rest)[:n]]


def _best(vecs: np.ndarray, ids: np.ndarray, query: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k largest inner products among rows ``at``."""
    rough = vecs[at] @ query
    if len(at) > k:
        least = np.partition(rough, len(at) - k)[len(at) - k]
        at = at[rough >= least - 1e-9 * (abs(least) + np.abs(rough).max())]
    score = (vecs[at] * query).sum(axis=1)  # summed alike for every row, so copies tie
    by = np.lexsort((ids[at], -score))[:k]
    return ids[at][by], score[by]


def search_block(queries: dict, rows: dict, n: int, k: int, share: float, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the ids and scores of its k best rows of the block."""
    size = len(rows["rid"])
    take = min(size, max(least, -int(-share * size // 1)))
    postings = places(rows["order"], n)
    length = rows["order"].shape[1]
    alike = int(ALIKE * length * (length + 1) / 2)
    out = []
    for s in range(0, len(queries["rid"]), AT_ONCE):
        near = agreement(queries["order"][s:s + AT_ONCE], postings, size, n)
        for q, own in enumerate(near):
            own[rows["rid"] == queries["rid"][s + q]] = -1
            bar = min(alike, max(0, np.partition(own, size - take)[size - take]))  # with all rows that tie at the bar
            out.append(_best(rows["vec"], rows["id"], queries["vec"][s + q], np.flatnonzero(own >= bar), k))
    return out


def _unpacked(t: pa.Table, dim: int, length: int) -> dict:
    return {"rid": t["rid"].to_numpy(), "id": t["vec_id"].to_numpy(), "vec": matrix(t["vec"], "<f8", dim), "order": matrix(t["near"], "<u2", length).astype(np.int64)}


def neighbours(rows: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vec: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX,
               share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of every row for which
    ``is_query`` holds (a condition on the column ``vec_id``).

    Driver: four figures of the table and ``DRAWN * pivots`` sampled vectors. Tasks: one cell."""
    usable = _usable(rows, vec_id, vec)
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, n_queries, dim, longest = usable.agg(F.count(F.lit(1)), F.count_if(is_query), F.coalesce(F.max(F.size("vec")), F.lit(1)), F.coalesce(F.max(square), F.lit(0.0))).first()
    sample = [r.vec for r in bounded_sample(usable.withColumn("h", F.xxhash64("vec")), "h", DRAWN * pivots, "vec")]
    pivot = chosen(np.array([v + [0.0] * (dim - len(v)) for v in sample]), pivots) if sample else np.zeros((1, dim))
    lift = np.sqrt(np.maximum(longest - (pivot**2).sum(axis=1), 0))
    count, length = len(pivot), min(prefix, len(pivot))

    def encode(batches):
        for b in batches:
            x = padded(b.column("vec"), dim)
            up = np.where(b.column("is_query").to_numpy(zero_copy_only=False), 0, np.sqrt(np.maximum(longest - (x**2).sum(axis=1), 0)))
            near = np.argsort(-(x @ pivot.T + up[:, None] * lift), axis=1, kind="stable")[:, :length].astype("<u2")
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("vec_id"), b.column("is_query"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in near], pa.binary())],
                                             ["rid", "vec_id", "is_query", "vec", "near"])

    # a row stands in the index, and once more among the queries if it is one
    sides = usable.withColumn("rid", F.monotonically_increasing_id()).withColumn("is_query", F.explode(F.when(F.coalesce(is_query, F.lit(False)), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    coded = materialize(sides.select("rid", "vec_id", "is_query", "vec").mapInArrow(encode, "rid long, vec_id long, is_query boolean, vec binary, near binary"), "permutations")

    def search(q: pa.Table, r: pa.Table) -> pa.Table:
        if not len(q) or not len(r):
            return _FOUND.empty_table()
        queries = _unpacked(q, dim, length)
        found = search_block(queries, _unpacked(r, dim, length), count, k, share, least)
        return pa.table([queries["rid"], queries["id"], pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], schema=_FOUND)

    got = in_cells(coded.filter("is_query").drop("is_query"), coded.filter("not is_query").drop("is_query"), n_queries, n, search, "q_rid long, query_id long, found array<long>, scores array<double>")
    each = got.select("q_rid", "query_id", F.explode(F.arrays_zip(F.col("found").alias("vec_id"), F.col("scores").alias("score"))).alias("f")).select("q_rid", "query_id", "f.vec_id", "f.score")
    order = Window.partitionBy("q_rid").orderBy(F.col("score").desc(), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
