"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most keys that can be hot at a time, and the counters of the sketch that finds them.
MOST_HOT, COUNTERS = 256, 8192


def lookup(df: DataFrame) -> DataFrame:
    """A lookup side of a join, its rows distinct.

    No hint: the planner broadcasts it by its size in bytes
    (``spark.sql.autoBroadcastJoinThreshold``, at run time by AQE) and otherwise shuffles,
    splitting skewed partitions. No job runs while the plan is built."""
    return df.distinct()


def heavy_hitters(key: str) -> Column:
    """Aggregate: the ``MOST_HOT`` most frequent values of a column with their counts, by a
    mergeable frequent-items sketch (bounded state in each task, a few kB to merge), and the
    number of rows that they are frequent among. Every value above one row in a few thousand
    is found, whatever the number of values."""
    return F.struct(F.expr(f"approx_top_k({key}, {MOST_HOT}, {COUNTERS})").alias("top"), F.count(key).alias("n"))


def hot_keys(found, partitions: int) -> list:
    """From a row of ``heavy_hitters``: the values that alone fill a quarter of an even shuffle
    partition or more; at most four a partition and ``MOST_HOT`` in all."""
    if found is None or not found["n"]:
        return []
    least = max(2, found["n"] / (4 * partitions))
    return [t["item"] for t in found["top"] if t["item"] is not None and t["count"] >= least]


def semi_join_hot(left: DataFrame, key: str, right: DataFrame, hot: list) -> DataFrame:
    """Left rows whose key stands in ``right`` (one column, distinct), for a left side of which
    single keys may hold any share.

    Rows of a hot key are not shuffled: which of the hot keys stand in ``right`` is a table of
    at most ``MOST_HOT`` rows and is broadcast. The other rows, none of a key that could fill a
    partition, meet ``right`` as the planner sees fit."""
    (name,) = right.columns
    right = right.select(F.col(name).alias("_key"))
    if not hot:
        return left.join(right, F.col(key) == F.col("_key"), "left_semi")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    some = F.broadcast(right.filter(F.col("_key").isin(hot)))
    rest = right.filter(~F.col("_key").isin(hot))
    return left.filter(is_hot).join(some, F.col(key) == F.col("_key"), "left_semi") \
        .unionByName(left.filter(~is_hot).join(rest, F.col(key) == F.col("_key"), "left_semi"))
