"""Mixing sources to target weights by subset-sum budget fitting.

1. Count documents by (source, exact length in words).
2. Targets: sources share the total of all words by weight; a target stops at
   ``max_repeats`` times its source's size and the excess is shared again by weight.
   All capped sources have the least caps per weight, so the fixed point is found
   from prefix sums over the sources ordered by that ratio.
3. Per source: whole passes over all documents, then for the remaining budget a
   proportional number of documents of each length, and bounded-knapsack dynamic
   programming over the lengths for what is left.
4. Within a (source, length) the documents are taken in the order of a seeded hash.
   Only documents in the hash cell where the count runs out need ranking, so a hot
   (source, length) never meets in one task.

Results for odd input: null and empty texts have size 0 and are taken 0 times; null
sources form one source, ordered last; repeated rows count each; with equal ids the
order of equal hashes falls back to a row number; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import fresh, materialize

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20
CELLS = 256
#: The dynamic programme fits budgets up to this many words; more is filled greedily.
DP_WORDS = 1 << 16

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source, size in words and the seeded position of each document."""
    seeded = F.xxhash64(F.lit(SEED), F.col(doc_id))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), seeded.alias("seeded"))


def targets(histogram: DataFrame) -> DataFrame:
    """source, source_size and target of each source (few rows, one per source)."""
    by = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (turn + 1).cast("int")))
    cap = F.lit(float(MAX_REPEATS)) * F.col("source_size")
    by = by.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    on = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    by = by.select("*", F.coalesce(F.sum("cap").over(up), F.lit(0.0)).alias("capped"), F.sum("weight").over(on).alias("open_weight"),
                   F.sum("source_size").over(everything).alias("total"))
    # The level if the sources before this one are capped rises until a source can bear it and
    # falls from there on, so the fixed point is the largest.
    by = by.withColumn("level", F.max((F.col("total") - F.col("capped")) / F.col("open_weight")).over(everything))
    target = F.least("cap", F.col("level") * F.col("weight"))
    return by.select("source", "source_size", target.alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come near ``budget``."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), dtype=np.int64)
    usable = lengths > 0
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return np.where(usable, counts, 0)
    take[usable] = [int(c) * budget // total for c in counts[usable]]
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):  # longest first down to what the programme can hold
        if not usable[i] or left <= DP_WORDS:
            continue
        more = min(int(counts[i] - take[i]), (left - DP_WORDS // 2) // int(lengths[i]))
        if more > 0:
            take[i] += more
            left -= more * int(lengths[i])
    take += knapsack(lengths, np.where(usable, counts - take, 0), left)
    # one document more where that comes nearer from above
    left = budget - int((take * lengths).sum())
    spare = np.flatnonzero(usable & (take < counts))
    if left and len(spare):
        best = spare[np.abs(lengths[spare] - left).argmin()]
        take[best] += abs(int(lengths[best]) - left) < left
    return take


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack by dynamic programming over the budgets 0..budget: a count of each
    length whose sum is the largest reachable one.

    Per length, budgets are laid out in rows of ``length``: going down a column adds one
    document, so the rows since the last reached one are the copies needed."""
    by, copies = np.full(budget + 1, -1, dtype=np.int64), np.zeros(budget + 1, dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        if reached[budget]:
            break
        if count <= 0 or not 0 < length <= budget:
            continue
        rows = -(-(budget + 1) // length)
        grid = np.zeros(rows * length, dtype=bool)
        grid[:budget + 1] = reached
        grid = grid.reshape(rows, length)
        at = np.arange(rows)[:, None]
        since = at - np.maximum.accumulate(np.where(grid, at, -count - 1), axis=0)
        new = ((since > 0) & (since <= count)).reshape(-1)[:budget + 1]
        by[new], copies[new] = i, since.reshape(-1)[:budget + 1][new]
        reached |= new
    take = np.zeros(len(lengths), dtype=np.int64)
    w = int(np.flatnonzero(reached)[-1])
    while w:
        i = by[w]
        take[i] += copies[w]
        w -= int(copies[w] * lengths[i])
    return take


def _plan_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size", ignore_index=True)
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    passes = min(MAX_REPEATS, int(target // size)) if size else 0
    left = round(target) - passes * size if passes < MAX_REPEATS else 0
    take = fit(rows["size"].to_numpy(), rows["n"].to_numpy(), left)
    return rows.assign(passes=np.int64(passes), extra=take)[["source", "size", "n", "source_size", "target", "passes", "extra"]]


def plan(histogram: DataFrame) -> DataFrame:
    """Per (source, length): whole passes and how many documents are taken once more.

    A group holds one row per distinct length of a source, never its documents."""
    t = targets(histogram)
    rows = histogram.alias("h").join(t.alias("t"), F.col("h.source").eqNullSafe(F.col("t.source"))).select("h.source", "size", "n", "source_size", "target")
    return rows.groupBy("source").applyInPandas(_plan_source, "source string, size long, n long, source_size long, target double, passes long, extra long")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source, size, source_size, target, repeats and taken of every document."""
    base = materialize(sizes(docs, doc_id, source, text), "mix-sizes")
    histogram = base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    plans = materialize(plan(histogram), "mix-plan")

    # cell of the seeded order, and in which cell of its (source, length) the count runs out
    cell = F.pmod(F.shiftrightunsigned("seeded", 40), F.lit(CELLS)).cast("int")
    partial = plans.filter("extra > 0 and extra < n").select(F.col("source").alias("ps"), F.col("size").alias("pz"), F.col("extra").alias("px"))
    same = F.col("source").eqNullSafe(F.col("ps")) & (F.col("size") == F.col("pz"))
    cells = (base.join(partial, same).groupBy("source", "size", "px", cell.alias("cell")).agg(F.count(F.lit(1)).alias("in_cell")))
    before = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("in_cell").over(before), F.lit(0)))
    last = cells.filter("before < px and before + in_cell >= px").select(
        F.col("source").alias("cs"), F.col("size").alias("cz"), F.col("cell").alias("last_cell"), (F.col("px") - F.col("before")).alias("in_last"))

    p = plans.join(last, F.col("source").eqNullSafe(F.col("cs")) & (F.col("size") == F.col("cz")), "left")
    p = p.select(F.col("source").alias("ps"), F.col("size").alias("pz"), "n", "source_size", "target", "passes", "extra", "last_cell", "in_last")
    rows = base.join(p, same).withColumn("cell", cell)
    at_edge = F.col("cell") == F.col("last_cell")
    rank = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("seeded", "doc_id"))
    edge = rows.filter(at_edge).withColumn("more", (rank <= F.col("in_last")).cast("int"))
    rest = rows.filter(~F.coalesce(at_edge, F.lit(False))).withColumn("more", F.when(F.col("extra") >= F.col("n"), 1).when(F.col("extra") <= 0, 0).otherwise((F.col("cell") < F.col("last_cell")).cast("int")))
    out = rest.unionByName(edge)
    repeats = F.when(F.col("size") > 0, F.col("passes") + F.col("more")).otherwise(F.lit(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken.

    Rows that repeat id, source and size are taken as often as the one taken most."""
    key, source, size, n = fresh(docs, "mix_id", "mix_source", "mix_size", "mix_repeats")
    m = mix(docs).filter("repeats > 0").groupBy(F.col("doc_id").alias(key), F.col("source").alias(source), F.col("size").alias(size)).agg(F.max("repeats").cast("int").alias(n))
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    same = docs["doc_id"].eqNullSafe(m[key]) & docs["source"].eqNullSafe(m[source]) & (words == m[size])
    copies = F.explode(F.sequence(F.lit(1), F.col(n)))
    return docs.join(m, same).select(*[docs[c] for c in docs.columns], copies.alias(n)).drop(n)
