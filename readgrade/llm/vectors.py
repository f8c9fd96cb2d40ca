"""Integer vectors and the grid of cells in which a query set meets all rows.

Rows are dealt by hash to shards and queries to blocks, both of bounded size, and a shard meets a block in one cell. A cell
is all that a task holds, however many rows or queries there are; copies of one vector spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from readgrade.llm.common import ship, stored

SCALE, SHARD_ROWS, BLOCK_ROWS = 256, 8192, 512
#: A missing id comes after every other one.
NO_ID = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def integer_rows(df: DataFrame, id: str, vector: str, scale: int = SCALE, **more: Column) -> DataFrame:
    """Stored (row, id, v, further columns): usable vectors as floor(scale * x); ``row`` tells rows of one id apart."""
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = df.where(usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"), whole.alias("v"),
        *[c.alias(n) for n, c in more.items()])
    return stored(rows, "integer-vectors")


def parts(df: DataFrame, size: int) -> int:
    return max(1, -(-df.count() // size))


def part_of(parts: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")


def in_cells(rows: DataFrame, shards: list[int], queries: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``run(rows of a shard, queries of a block)`` for each shard of ``shards`` (column ``shard`` of rows) and each block."""
    ship(rows.sparkSession)
    blocks = parts(queries, block_rows)
    left = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("block", part_of(blocks)).withColumn("shard", F.explode(F.array(*map(F.lit, shards))))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, schema)


def numbers(column: pa.ChunkedArray, missing: int = NO_ID) -> np.ndarray:
    return column.combine_chunks().fill_null(missing).to_numpy(zero_copy_only=False).astype(np.int64)


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def both(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of both sides, equally wide, as doubles where all their products are exact in them."""
    x, q = matrix(left["v"]), matrix(right["v"])
    width = max(x.shape[1], q.shape[1])
    x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, q))
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1)
    return (x.astype(np.float64), q.astype(np.float64)) if most < 2 ** 52 else (x, q)
