"""Reports over a result table (R1-R8).

Results have ``target_level, topic, predicted_level, confidence, success,
word_count, attempts, text``.
"""

from pyspark.sql import Column, DataFrame, functions as F

from readgrade import fixed as C
from readgrade.functions.numbers import fixed, ratio

PREVIEW = 200
TOPIC_WIDTH = 30


def _hits() -> Column:
    return F.sum(F.col("success").cast("bigint"))


def run_totals(results: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return results.agg(n.alias("n"), ratio(_hits(), n).alias("success_rate"), F.avg("confidence").alias("confidence"),
                       F.avg("word_count").alias("word_count"), F.avg("attempts").alias("attempts"))


def by_level_means(results: DataFrame) -> DataFrame:
    return results.groupBy("target_level").agg(
        fixed(ratio(_hits(), F.count(F.lit(1))), 3).alias("success"),
        *[fixed(F.avg(c), 3).alias(c) for c in ("confidence", "attempts", "word_count")])


def by_level_counts(results: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (results.groupBy("target_level").agg(
        n.alias("total"), _hits().alias("successes"), (ratio(_hits(), n) * 100.0).alias("success_percent"),
        F.avg("confidence").alias("confidence")).orderBy("target_level"))


def by_topic(results: DataFrame) -> DataFrame:
    """Success per topic, topics cut to 30 characters."""
    n = F.count(F.lit(1))
    return results.groupBy(F.substring("topic", 1, TOPIC_WIDTH).alias("topic")).agg(
        n.alias("n"), (ratio(_hits(), n) * 100.0).alias("success_percent"))


def accepted(results: DataFrame) -> DataFrame:
    return results.where("success")


def flat_results(results: DataFrame, stamp: str) -> DataFrame:
    """One flat row per result: base columns, ``feature_*`` with 0 for what is missing, preview and text."""
    preview = F.when(F.length("text") > PREVIEW, F.concat(F.substring("text", 1, PREVIEW), F.lit("..."))).otherwise(F.col("text"))
    return results.select(
        F.lit(stamp).alias("timestamp"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("target_level", "topic", "predicted_level")],
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("success", F.lit(False)).alias("success"),
        F.coalesce("word_count", F.lit(0)).cast("bigint").alias("word_count"),
        F.coalesce("attempts", F.lit(1)).cast("bigint").alias("attempts"),
        preview.alias("text_preview"), F.col("text").alias("full_text"),
        *[F.coalesce(F.col(f"features.{m}"), F.lit(0.0)).alias(f"feature_{m}") for m in C.METRICS])


def both_types(results: DataFrame, key: str, order: str) -> DataFrame:
    """The texts of one ``key`` and level as a record with a map from text type to text.

    Of several texts of one type the last by ``order`` stays, on a tie the one that is last by its own content.
    """
    text = F.struct("topic", "text", "word_count")
    kept = results.groupBy(key, "level", "display").agg(*[
        F.max_by(text, F.when(F.col("text_type") == kind, F.struct(order, "topic", "text", "word_count"))).alias(kind) for kind in C.TEXT_TYPES])
    entries = F.array(*[F.struct(F.lit(kind).alias("key"), F.col(kind).alias("value")) for kind in C.TEXT_TYPES])
    return kept.select(key, "level", "display", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("texts"))
