"""Labelled training data (ML1-ML4, ML6, ML7, ML9)."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readgrade import fixed as C
from readgrade.functions import text as X

TEXT_NUMBER = r"text[_\s-]?([0-9]+)"


def text_id(name: Column) -> Column:
    """File name without extension, lower case; ``text N`` in any spelling becomes ``text_N``."""
    base = F.lower(X.strip(F.regexp_replace(name, r"^(.+)\.[^.]*$", "$1")))
    number = F.regexp_extract(base, TEXT_NUMBER, 1)
    return F.when(number != "", F.concat(F.lit("text_"), number)).otherwise(base)


def name_column(base: DataFrame) -> str | None:
    """Column that names the text: by a known heading, else the first whose values look like ``Text_N``."""
    by_lower = {c.lower(): c for c in base.columns}
    for known in C.TEXT_ID_COLUMN_NAMES:
        if known in by_lower:
            return by_lower[known]
    found = base.agg(*[F.max(F.lower(F.col(c).cast("string")).rlike(TEXT_NUMBER)).alias(c)
                       for c in base.columns]).first()
    return next((c for c in base.columns if found[c]), None)


def label_map(base: DataFrame, order: str = "seq") -> DataFrame:
    """(text_id, predict_level) of the base table; the last row by ``order`` wins, nulls are dropped."""
    name = name_column(base.drop(order))
    if name is None or "predict_level" not in base.columns:
        raise ValueError("the base table has no text names or no predict_level")
    return (base.select(F.col(name).cast("string").alias("name"), "predict_level", order).na.drop()
            .groupBy(text_id(F.col("name")).alias("text_id"))
            .agg(F.max_by("predict_level", order).alias("predict_level")))


def labelled_texts(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with a label, before any of them is tokenised; ``texts`` has a ``filename``."""
    return texts.withColumn("text_id", text_id(F.col("filename"))).join(labels, "text_id").drop("text_id")


def merge_training(base: DataFrame, new: DataFrame, order: str = "seq") -> DataFrame:
    """Union of both; of rows with one ``filename`` a base row wins, the earliest by ``order`` first.

    An aggregate per name instead of a window: rows are combined before the
    shuffle, so a name that fills a third of the table stays harmless.
    """
    both = (base.withColumn("origin", F.lit(0))
            .unionByName(new.withColumn("origin", F.lit(1)), allowMissingColumns=True))
    if "filename" not in base.columns or "filename" not in new.columns:
        return both.drop("origin", order)
    columns = [c for c in both.columns if c not in ("filename", "origin", order)]
    rank = F.struct("origin", order)
    best = both.groupBy("filename").agg(F.min_by(F.struct(*columns), rank).alias("best"))
    return best.select("filename", *[F.col(f"best.{c}").alias(c) for c in columns])


def training_columns(merged: DataFrame) -> DataFrame:
    """The stored column order; columns that are missing become null."""
    wanted = [("filename", "string"), *[(m, "double") for m in C.METRICS], ("predict_level", "string")]
    return merged.select(*[(F.col(c) if c in merged.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted])


def class_counts(labelled: DataFrame, label: str = "predict_level") -> DataFrame:
    """Rows per class and whether the rarest class is large enough to stratify."""
    counts = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    rarest = counts.agg(F.min("n").alias("m")).scalar()
    return counts.select(label, "n", (rarest >= 2).alias("stratify"))


def numbered(rows: DataFrame, label: str = "predict_level", key: str = "doc_id") -> DataFrame:
    """Add ``rn``, the row number within the class in hash order, and ``n_class``.

    A window per class would sort a whole class in one task. Here each class is
    cut into 65,536 hash ranges: their counts give offsets, and the window only
    orders the rows inside one range.
    """
    hashed = rows.withColumn("hash", F.md5(F.col(key).cast("string"))).withColumn("range", F.substring("hash", 1, 4))
    sizes = hashed.groupBy(label, "range").agg(F.count(F.lit(1)).alias("n_range"))
    before = W.partitionBy(label).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(label, "range", F.coalesce(F.sum("n_range").over(before), F.lit(0)).alias("offset"),
                           F.sum("n_range").over(W.partitionBy(label)).alias("n_class"))
    inside = F.row_number().over(W.partitionBy(label, "range").orderBy("hash", key))
    return (hashed.join(offsets, [label, "range"]).withColumn("rn", (F.col("offset") + inside).cast("bigint"))
            .drop("hash", "range", "offset"))


def split(rows: DataFrame, share: float = 0.2, label: str = "predict_level", key: str = "doc_id", stratify: bool = True) -> DataFrame:
    """Repeatable split: the first ``ceil(share * n)`` rows in hash order are the test part, of each class or, where a class
    is too small for that, of all rows. At least one row of what is split stays for training."""
    test = F.col("rn") <= F.least(F.ceil(F.lit(share) * F.col("n_class")), F.col("n_class") - 1)
    if stratify:
        return numbered(rows, label, key).withColumn("is_test", test)
    return numbered(rows.withColumn("all_rows", F.lit(1)), "all_rows", key).withColumn("is_test", test).drop("all_rows")


def class_weights(labelled: DataFrame, label: str = "predict_level") -> DataFrame:
    """``n / (k * n_class)`` per class."""
    counts = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    total = counts.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k")).select(
        (F.col("n") / F.col("k")).alias("share")).scalar()
    return counts.select(label, "n_class", (total / F.col("n_class")).alias("weight"))
