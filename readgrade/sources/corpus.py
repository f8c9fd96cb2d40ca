"""Scans of document tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def dealt(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The scan as it is, or dealt out to ``partitions`` where the caller asks for it.

    Only for a small file of one row group, which no setting can split; it shuffles the texts.
    """
    return df if partitions is None else df.repartition(partitions)


def documents(spark: SparkSession, path: str, lang: str | None = None, partitions: int | None = None) -> DataFrame:
    """(doc_id, text) of one language or of all; language filter and column choice reach the scan."""
    docs = spark.read.parquet(path)
    if lang is not None:
        docs = docs.where(F.col("lang") == lang)
    return dealt(docs.select("doc_id", "text"), partitions)
