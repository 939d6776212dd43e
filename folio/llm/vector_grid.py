"""What the two vector operators share: rows fit to take part, bounded samples for fitting,
and a grid of cells in which blocks of queries meet blocks of indexed rows.

A block holds a bounded number of rows, dealt by a hash of the row id, so no key, label or
group of copies can fill one. A cell is one block of queries against one block of rows; a
task holds one cell at a time. The grid moves each block once per block of the other side;
nothing is broadcast and no pair of rows leaves a cell."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one indexed block, and of one block of queries.
BLOCK_ROWS, QUERY_ROWS = 8192, 1024


def finite(vec: str) -> Column:
    """The vector is there, not empty, and all its components are finite numbers."""
    x = F.col(vec)
    return x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def bounded_sample(rows: DataFrame, by: str, n: int, *columns: str) -> list:
    """The rows of the ``n`` smallest distinct hashes ``by`` (of the content, so copies count
    once), one row a hash, ordered by hash: a sample that depends on neither order nor copies."""
    least = rows.select(by).distinct().orderBy(by).limit(n)
    return sorted(rows.join(F.broadcast(least), by, "left_semi").groupBy(by).agg(*(F.min(c).alias(c) for c in columns)).collect(), key=lambda r: r[by])


def matrix(column: pa.ChunkedArray | pa.Array, dtype: str, width: int) -> np.ndarray:
    """Rows of packed binaries as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


def padded(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of doubles; what a shorter row lacks is zero."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    at = np.repeat(np.arange(len(column)), size)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def blocks(n: int, rows: int) -> int:
    return max(1, -(-n // rows))


def in_cells(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
             rid: str = "rid") -> DataFrame:
    """``search`` (a block of queries, a block of rows) over all cells of the grid."""
    nq, nr = blocks(n_queries, QUERY_ROWS), blocks(n_rows, BLOCK_ROWS)

    def dealt(side: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        side = side.select(*(F.col(c).alias(c) for c in side.columns))  # both sides may stem from one table
        return side.withColumn(own, F.pmod(F.xxhash64(rid), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    left = dealt(queries, "cell_q", nq, "cell_r", nr).groupBy("cell_q", "cell_r")
    return left.cogroup(dealt(rows, "cell_r", nr, "cell_q", nq).groupBy("cell_q", "cell_r")).applyInArrow(search, schema)
