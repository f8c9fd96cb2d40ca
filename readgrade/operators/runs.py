"""Rows of a document that lie together become one row before anything is shuffled.

A document is cut up inside its own row, so its tokens are neighbours in their task. ``groupBy`` doesn't know that: with lists
among its aggregates it holds a few documents at once, then sorts all further tokens of the task and spills them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType


def _folded(rows: DataFrame, key: str, sums: list[str], ors: list[str], lists: list[str]) -> DataFrame:
    """One row per run of one key within an Arrow batch: numbers added up, bits joined, other values listed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = pc.run_end_encode(batch.column(key)).run_ends.to_numpy()
            starts = np.concatenate(([0], ends[:-1]))
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            numbers = [(f, c) for f, names in ((np.add, sums), (np.bitwise_or, ors)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(starts)),
                 *[pa.array(f.reduceat(batch.column(c).to_numpy(zero_copy_only=False), starts)) for f, c in numbers],
                 *[pa.ListArray.from_arrays(offsets, batch.column(c)) for c in lists]], [key, *sums, *ors, *lists])

    fields = [rows.schema[key], *[StructField(c, rows.schema[c].dataType) for c in sums + ors],
              *[StructField(c, ArrayType(rows.schema[c].dataType)) for c in lists]]
    return rows.mapInArrow(run, StructType(fields))


def per_key(rows: DataFrame, key: str, sums: dict[str, Column], ors: dict[str, Column] = {}, lists: dict[str, Column] = {},
            made: dict[str, Column] = {}) -> DataFrame:
    """Sums of numbers (a flag counts as 0 or 1), joined bits of whole numbers and lists of what is not null, per key.

    ``made`` replaces a list by what its name should hold, before and after the parts of a key are brought together, as a shorter
    list. Any order of the rows gives the same; rows of a key that lie together cost one shuffled row per Arrow batch.
    """
    plain = rows.select(key, *[v.alias(c) for c, v in (sums | ors | lists).items()])
    kinds = {c: "double" if isinstance(plain.schema[c].dataType, DoubleType) else "bigint" for c in sums | ors}
    numbers = [F.coalesce(F.col(c).cast(kind), F.lit(0).cast(kind)).alias(c) for c, kind in kinds.items()]
    parts = _folded(plain.select(key, *numbers, *lists), key, [*sums], [*ors], [*lists])
    compact = [F.array_compact(c).alias(c) for c in lists]
    shorter = [made[c].alias(c) if c in made else F.col(c) for c in lists]
    whole = (parts.select(key, *sums, *ors, *compact).select(key, *sums, *ors, *shorter).groupBy(key)
             .agg(*[F.sum(c).alias(c) for c in sums], *[F.bit_or(c).alias(c) for c in ors],
                  *[F.flatten(F.collect_list(c)).alias(c) for c in lists]))
    return whole.select(key, *sums, *ors, *shorter)
