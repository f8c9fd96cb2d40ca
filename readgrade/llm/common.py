"""Small helpers of the operators: stored steps, checked broadcasts, whole texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from readgrade.plans.storage import materialise

#: A side of a join is broadcast while it has at most so many rows of fixed width; beyond, Spark shuffles.
BROADCAST_ROWS = 1_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back."""
    return materialise(df, name)


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table of narrow rows, with a broadcast hint only if its counted rows stay in the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def bucket_of(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; null ids count as the empty string."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4


def held_out(column: str = "doc_id") -> Column:
    return bucket_of(column) == 2


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_columns(docs: DataFrame, text: str | None, schema: str, start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """``docs`` with columns made from whole texts, in Arrow batches; the names in ``schema`` must be new.

    With ``text`` None the last column is the text, and is left out of the result.

    ``start()`` runs once a task and gives a function from a list of texts (UTF-8 bytes, None for null) to the
    columns of ``schema``. A batch is handed on in slices of about 1 MB of text, so long texts don't add up.
    """
    ship(docs.sparkSession)
    field, out = (docs.columns.index(text), len(docs.columns)) if text else (len(docs.columns) - 1,) * 2
    names = [*docs.columns[:out], *(x.split()[0] for x in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            column = batch.column(field).cast(pa.large_binary())
            for begin, end in slices(column):
                new = make(column.slice(begin, end - begin).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(begin, end - begin).columns[:out], *(x if isinstance(x, pa.Array) else pa.array(x) for x in new)], names=names)

    made = StructType.fromDDL(schema)
    return docs.mapInArrow(run, StructType([StructField(f.name, f.dataType) for f in [*docs.schema[:out], *made]]))


def per_text(docs: DataFrame, id: str, text: str, schema: str, start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """(id, the columns of ``schema``): one row per document from its whole text, see :func:`with_columns`."""
    return with_columns(docs.select(F.col(id), F.col(text).cast("string").alias(fresh("whole_text", docs))), None, schema, start)


def slices(column: pa.Array, size: int = 1 << 20, rows: int = 2000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text has a range of its own."""
    import numpy as np

    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + size, side="right")) - 1
        end = min(max(end, begin + 1), begin + rows, n)
        yield begin, end
        begin = end


_shipped: set = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application, as any job ships its Python files."""
    import os
    import tempfile
    import zipfile

    import readgrade

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(readgrade.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="readgrade-"), "readgrade.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, id: str, text: str, rows_per_class: int,
                    class_bytes: int) -> tuple[DataFrame, dict[int, int]]:
    """(id, text, label) of a bounded sample outside the held-out quarter, and how many labelled rows each class has there.

    Of each class the first rows in the order of a hash of the id, ``rows_per_class`` at most, as long as their texts come to
    ``class_bytes`` at most together; texts are whole, and only one that is larger than a whole sample can't be in it.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id)).select(
        F.col(id).alias("i"), F.col(label).cast("int").alias("y")).distinct().withColumn("h", F.xxhash64("i"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    wanted = 1.02 * rows_per_class + 10 * rows_per_class ** 0.5 + 100

    def first(y: int) -> DataFrame:
        """A threshold from the count leaves little more than what is wanted to be put in order."""
        own, total = known.where(F.col("y") == y), counts.get(y, 0)
        if wanted < total:
            own = own.where(F.col("h") <= int((wanted / total - 0.5) * 2 ** 64))
        return own.orderBy("h", "i").limit(rows_per_class)

    chosen = stored(first(0).unionByName(first(1)), "sample-ids")  # 2 * rows_per_class rows
    sizes = docs.where(F.col(text).isNotNull()).select(F.col(id).alias("i"), F.octet_length(F.col(text).cast("string")).alias("bytes")).join(
        F.broadcast(chosen), "i").groupBy("i", "y", "h").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= class_bytes)
    so_far = F.sum("bytes").over(Window.partitionBy("y").orderBy("h", "i").rowsBetween(Window.unboundedPreceding, 0))
    kept = stored(sizes.withColumn("so_far", so_far).where(F.col("so_far") <= class_bytes).select("i", "y"), "sample")
    rows = docs.where(F.col(text).isNotNull()).select(id, text)
    return rows.join(F.broadcast(kept), F.col(id) == F.col("i")).select(id, text, F.col("y").alias(label)), counts
