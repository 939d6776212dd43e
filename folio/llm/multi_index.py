"""Hard-negative mining with an inverted multi-index.

Vectors are cut into halves, each half with a codebook of its own; the pairs of codewords
form cells, and a block of rows is posted by cell. For an anchor, a half's codeword can at
most reach the half-score of its centre plus the anchor half's length times the radius of
the rows coded by it. The multi-sequence heap visits cells by the sum of the two bounds,
best first, without ever listing all cells; it stops when the next bound is below what every
window still needs, so the answers are certified, whatever the codebooks are like.

Two passes over the grid of anchor blocks and row blocks: the first finds an anchor's
positives, the second, with the windows that they set, its negatives. Scores are exact integers.

Results for odd input: rows with a null id, label or vector or with a null or non-finite
component take no part, nor do rows with a component of 2^19 or more (scores would leave
64 bits); an empty or shorter vector counts as filled up with zeros; each row of a repeated
id stands for itself, and is no positive or negative of itself; equal scores go to the
smaller id; an anchor without positives, a positive without negatives and an empty table
give no rows; extra columns are ignored."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import materialize
from folio.llm.vector_grid import bounded_sample, in_cells, matrix, padded

#: Codewords of a half, vectors on which they are fitted (distinct ones, by hash) and rounds of fitting.
WORDS, SAMPLE, ROUNDS = 16, 4096, 8
#: Rows that are scored together, so that a small cell does not cost a call of its own.
TOGETHER = 512
SCALE, LIMIT = 256, 2.0**19

_TOPS = pa.schema([("rid", pa.int64()), ("window", pa.int32()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.int64()))])
_TOPS_DDL = "rid long, window int, ids array<long>, scores array<long>"


def codebook(x: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Centres of k-means, started from the first distinct rows."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    _, first = np.unique(x, axis=0, return_index=True)
    centre = x[np.sort(first)[:words]].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centre)
        for c in range(len(centre)):
            if (own == c).any():
                centre[c] = x[own == c].mean(axis=0)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre**2).sum(axis=1) - 2 * (x @ centre.T), axis=1)


class Cells:
    """A block of rows posted by cell, with the radius of each codeword in this block."""

    def __init__(self, vec: np.ndarray, code: np.ndarray, books: list[np.ndarray]):
        self.books, self.cut = books, books[0].shape[1]
        self.wide = len(books[1])
        by = np.argsort(code[:, 0].astype(np.int64) * self.wide + code[:, 1], kind="stable")
        self.order, key = by, (code[:, 0].astype(np.int64) * self.wide + code[:, 1])[by]
        cells, at = np.unique(key, return_index=True)
        self.spans = dict(zip(cells.tolist(), zip(at.tolist(), [*at[1:].tolist(), len(key)], strict=True), strict=True))
        self.radius = []
        for h, half in enumerate((vec[:, :self.cut], vec[:, self.cut:])):
            off = np.sqrt(((half - books[h][code[:, h]]) ** 2).sum(axis=1))
            radius = np.full(len(books[h]), -1.0)
            np.maximum.at(radius, code[:, h], off)
            self.radius.append(radius)

    def visits(self, query: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(bound, rows) of the filled cells, by falling bound: no row of this cell or a
        later one scores above the bound."""
        lists = []
        for h, half in enumerate((query[:self.cut], query[self.cut:])):
            length = np.sqrt((half**2).sum())
            bound = np.where(self.radius[h] >= 0, self.books[h] @ half + length * self.radius[h], -np.inf)
            by = np.argsort(-bound, kind="stable")[:int((self.radius[h] >= 0).sum())]
            lists.append(list(zip(bound[by].tolist(), by.tolist(), strict=True)))
        first, second = lists
        if not first or not second:
            return
        slack = 1e-9 * (abs(first[0][0]) + abs(second[0][0]) + 1) + 0.01  # rounding; scores are whole numbers
        heap, reached = [(-(first[0][0] + second[0][0]), 0, 0)], {(0, 0)}
        while heap:
            bound, a, b = heapq.heappop(heap)
            if span := self.spans.get(first[a][1] * self.wide + second[b][1]):
                yield slack - bound, self.order[span[0]:span[1]]
            for x, y in ((a + 1, b), (a, b + 1)):
                if x < len(first) and y < len(second) and (x, y) not in reached:
                    reached.add((x, y))
                    heapq.heappush(heap, (-(first[x][0] + second[y][0]), x, y))


def scores(vec: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Whole-number inner products: by floating point where that is exact, else by integers."""
    if exact:
        return (vec @ query).astype(np.int64)
    return vec.astype(np.int64) @ query.astype(np.int64)


def certified(cells: Cells, rows: dict, query: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int, exact: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window (least, greatest score; None: open) the k first allowed rows inside it, by
    falling score and rising id."""
    tops = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    low = [-np.inf if lo is None else lo for lo, _ in windows]

    def take(parts: list[np.ndarray]) -> None:
        at = np.concatenate(parts)
        at = at[allowed[at]]
        if not len(at):
            return
        got = scores(rows["vec"][at], query, exact)
        for w, (lo, hi) in enumerate(windows):
            inside = np.ones(len(at), bool)
            if lo is not None:
                inside &= got >= lo
            if hi is not None:
                inside &= got <= hi
            if inside.any():
                ids, best = np.concatenate([tops[w][0], rows["id"][at[inside]]]), np.concatenate([tops[w][1], got[inside]])
                by = np.lexsort((ids, -best))[:k]
                tops[w] = ids[by], best[by]

    def needed() -> float:
        """The least score that could still enter some window."""
        return min((max(low[w], best[-1]) if len(best) == k else low[w] for w, (_, best) in enumerate(tops)), default=np.inf)

    held, n, bar = [], 0, needed()
    for bound, part in cells.visits(query):
        if bound < bar:
            break
        held.append(part)
        n += len(part)
        if n >= TOGETHER:
            take(held)
            held, n, bar = [], 0, needed()
    if held:
        take(held)
    return tops


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative of a positive with this score."""
    return -(-30 * positive // 100), 90 * positive // 100


def mine(rows: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, vec_id: str = "vec_id", vec: str = "embedding",
         words: int = WORDS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows
    for which ``is_anchor`` holds (a condition on ``vec_id``); ``label``: default the column
    ``label``.

    Driver: three figures of the table and ``SAMPLE`` vectors. Tasks: one cell of the grid."""
    x = rows.select(F.col(vec_id).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), F.col(vec).cast("array<double>").alias("vec"))
    x = x.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
    x = x.filter(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LIMIT))).withColumn("vec", F.transform("vec", lambda v: F.floor(v * SCALE).cast("double")))
    n, n_anchors, dim, most = x.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.greatest(F.coalesce(F.max(F.size("vec")), F.lit(0)), F.lit(2)), F.max(F.array_max(F.transform("vec", F.abs)))).first()
    cut, exact = dim // 2, dim * (most or 0.0) ** 2 < 2**53
    sample = np.zeros((0, dim))
    if got := bounded_sample(x.withColumn("h", F.xxhash64("vec")), "h", SAMPLE, "vec"):
        sample = np.array([r.vec + [0.0] * (dim - len(r.vec)) for r in got])
    books = [codebook(sample[:, :cut], words), codebook(sample[:, cut:], words)]

    def encode(batches):
        for b in batches:
            v = padded(b.column("vec"), dim)
            code = np.stack([nearest(v[:, :cut], books[0]), nearest(v[:, cut:], books[1])], axis=1).astype("<u2")
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("vec_id"), b.column("label"), b.column("is_anchor"), pa.array([r.tobytes() for r in v.astype("<i4")], pa.binary()),
                                              pa.array([r.tobytes() for r in code], pa.binary())], ["rid", "vec_id", "label", "is_anchor", "vec", "code"])

    x = x.withColumn("rid", F.monotonically_increasing_id()).withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))).select("rid", "vec_id", "label", "is_anchor", "vec")
    coded = materialize(x.mapInArrow(encode, "rid long, vec_id long, label long, is_anchor boolean, vec binary, code binary"), "multi-index")
    index, anchors = coded.drop("is_anchor"), coded.filter("is_anchor").select("rid", "vec_id", "label", "vec")

    def search(same: bool, k: int):
        def run(q: pa.Table, r: pa.Table) -> pa.Table:
            if not len(q) or not len(r):
                return _TOPS.empty_table()
            block = {"rid": r["rid"].to_numpy(), "id": r["vec_id"].to_numpy(), "vec": matrix(r["vec"], "<i4", dim).astype(np.float64)}
            labels, cells = r["label"].to_numpy(), Cells(block["vec"], matrix(r["code"], "<u2", 2), books)
            query = matrix(q["vec"], "<i4", dim).astype(np.float64)
            out: list[list] = [[], [], [], []]
            for i, (rid, own, *rest) in enumerate(zip(*(q[c].to_pylist() for c in (["rid", "label"] if same else ["rid", "label", "positive"])), strict=True)):
                allowed = (labels == own) & (block["rid"] != rid) if same else labels != own
                numbers, windows = ([0], [(None, None)]) if same else zip(*((p["window"], window(p["score"])) for p in rest[0]), strict=True)
                for w, (ids, best) in zip(numbers, certified(cells, block, query[i], allowed, list(windows), k, exact), strict=True):
                    if len(ids):
                        for column, value in zip(out, (rid, w, ids, best), strict=True):
                            column.append(value)
            return pa.table([pa.array(c, f.type) for c, f in zip(out, _TOPS, strict=True)], schema=_TOPS)
        return run

    def first(tops: DataFrame, k: int) -> DataFrame:
        each = tops.select("rid", "window", F.explode(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"))).alias("t")).select("rid", "window", "t.id", "t.score")
        return each.withColumn("rank", F.row_number().over(Window.partitionBy("rid", "window").orderBy(F.col("score").desc(), "id"))).filter(F.col("rank") <= k)

    found = materialize(first(in_cells(anchors, index, n_anchors, n, search(True, positives), _TOPS_DDL), positives).select("rid", F.col("rank").alias("window"), F.col("id").alias("positive_id"), "score"), "positives")
    asked = found.filter("score >= 0").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("window", "score"))).alias("positive"))  # at most ``positives`` each
    anchors_asked = anchors.join(asked, "rid")
    chosen = first(in_cells(anchors_asked, index, n_anchors, n, search(False, negatives), _TOPS_DDL), negatives)
    named = found.join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    return chosen.withColumnRenamed("score", "negative_score").join(named, ["rid", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("score").alias("positive_score"), "negative_score")
