"""Exact dedup: group by a 128-bit content hash, keep the smallest stable id, compare bytes inside groups.

Only hashes and ids of all rows are shuffled, combined before the exchange. Texts
travel only for rows whose hash occurs more than once, and one copy a task at most, as the text
is itself a grouping key there: rows of one hash but other bytes fall into groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from readgrade.llm.common import checked_broadcast, stored, table

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def content_hash(sha256: Column) -> Column:
    """The first 128 bits of SHA-256."""
    return F.unhex(F.substring(sha256, 1, 32))


def copy_groups(docs: DataFrame, id: str, text: str, hashed: Callable[[Column], Column] = content_hash):
    """(keys, groups, clashes): stored hashes of all rows; groups of copies by hash; hashes shared by other bytes.

    ``groups`` has (h, keep_id, group_size) of hashes that stand for one text,
    ``clashes`` (h, t, keep_id, group_size) of hashes with several texts. Texts that occur once
    are in neither unless their hash clashes.
    """
    sha = F.sha2(normalised(F.col(text)), 256)
    keys = stored(docs.select(F.col(id).alias("id"), sha.alias("sha")).select("id", hashed(F.col("sha")).alias("h"), "sha"),
                  "content-hashes")
    repeated = stored(keys.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-hashes")
    rows = docs.select(F.col(id).alias("id"), normalised(F.col(text)).alias("t")).select(
        "id", "t", hashed(F.sha2("t", 256)).alias("h"))
    same = stored(rows.join(checked_broadcast(repeated), "h", "left_semi")
                  .groupBy("h", "t").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")), "equal-bytes")
    groups = stored(same.groupBy("h").agg(F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"),
                                          F.min("group_size").alias("group_size")), "copy-groups")
    clashes = same.join(checked_broadcast(groups.where("texts > 1").select("h")), "h", "left_semi")
    return keys, groups.where("texts = 1").drop("texts"), clashes


def with_groups(rows: DataFrame, groups: DataFrame, clashes: DataFrame) -> DataFrame:
    """``rows`` (.., id, h, t) with keep_id and group_size; ``t`` is read only where a hash clashes."""
    joined = rows.join(checked_broadcast(groups), "h", "left")
    if clashes.isEmpty():
        return joined
    exact = clashes.withColumnRenamed("keep_id", "k2").withColumnRenamed("group_size", "n2")
    hot = clashes.select("h").distinct()
    first = joined.join(hot, "h", "left_anti")
    second = joined.join(hot, "h", "left_semi").join(exact, ["h", "t"], "left").withColumns(
        {"keep_id": F.col("k2"), "group_size": F.col("n2")}).select(*first.columns)
    return first.unionByName(second)


def repeated_ids(keys: DataFrame) -> DataFrame:
    """(id, h) of rows that share both: of these, one row must be chosen by position."""
    return stored(keys.groupBy("h", "id").agg(F.count("*").alias("n")).where("n > 1").select("h", "id"), "repeated-ids")


def decided(rows: DataFrame, keys: DataFrame, groups: DataFrame, clashes: DataFrame) -> DataFrame:
    """``rows`` (.., id, h, t) with keep_id, group_size and kept."""
    out = with_groups(rows, groups, clashes).select(
        "*", F.coalesce("group_size", F.lit(1).cast("long")).alias("size"),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("first"))
    out = out.withColumns({"keep_id": F.col("first"), "group_size": F.col("size")}).drop("first", "size")
    out = out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    ties = repeated_ids(keys)
    if ties.isEmpty():
        return out
    tied = ties.select("h", F.col("id").alias("i2"), F.lit(True).alias("tied"))
    out = out.join(tied, (out["h"] == tied["h"]) & out["id"].eqNullSafe(tied["i2"]), "left").drop(tied["h"]).drop("i2")
    single, several = out.where("tied is null").drop("tied"), out.where("tied").drop("tied")
    order = Window.partitionBy("h", "id", "t").orderBy(F.lit(1))
    several = several.withColumn("kept", F.col("kept") & (F.row_number().over(order) == 1))
    return single.unionByName(several)


def mark_copies(docs: DataFrame, id: str = "doc_id", text: str = "text",
                hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when identical after every run of white space became one space.
    Null text counts as empty. A null id is larger than any other. Of rows with one id and one text
    exactly one is kept. An empty table gives none. Other columns are not looked at.
    """
    keys, groups, clashes = copy_groups(docs, id, text, hashed)
    if clashes.isEmpty():  # no text is needed any more: the stored hashes serve
        rows = keys.withColumn("t", F.lit(""))
    else:
        t = normalised(F.col(text))
        rows = docs.select(F.col(id).alias("id"), t.alias("t")).select("id", F.sha2("t", 256).alias("sha"), "t").select(
            "id", hashed(F.col("sha")).alias("h"), "sha", "t")
    return decided(rows, keys, groups, clashes).select(
        F.col("id").alias(id), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text",
                hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that :func:`mark_copies` keeps, all columns as they are."""
    keys, groups, clashes = copy_groups(docs, id, text, hashed)
    t = normalised(F.col(text))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id).alias("id"), t.alias("t"))
    rows = rows.withColumn("h", hashed(F.sha2("t", 256)))
    return decided(rows, keys, groups, clashes).where("kept").select("row.*")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
