"""Mixing sources to target weights: temperature, then budgeted block permutations.

Shares of tokens are raised to an exponent between 0 (all sources alike) and 1 (as they are). The exponent is bisected: the
largest that reaches a wanted entropy, then raised where a source would be repeated more often than allowed. Each
source gets its weight of the budget: whole passes over its documents, and one partial pass that takes
blocks of documents in a seeded order until the next document would go beyond the budget. A hot source is
split into 4,096 blocks, so no window holds more than the blocks of a source or the documents of one block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from readgrade.llm.common import checked_broadcast, fresh, stored, table

SEED = "mix"
#: Wanted entropy as a share of the largest possible; passes over a source at most; budget as a multiple of all tokens.
ENTROPY, REPEATS, BUDGET = 0.97, 4.0, 1.0
#: Bisection: levels of the tree that one pass over the sources evaluates, and passes.
LEVELS, PASSES = 5, 6


@dataclass(frozen=True)
class Mixture:
    exponent: float
    budget: float
    total: float
    scale: float  # sum of the raised shares


def words(text: Column) -> Column:
    """Tokens: runs of anything but ASCII white space."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _digest(*parts) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *parts))


def _keyed(docs: DataFrame, id: str, source: str, tokens: Column) -> DataFrame:
    """The row with its source (null: empty), id as text, tokens and block."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id).cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("src"), key.alias("key"),
                       tokens.alias("n"), F.substring(_digest(F.lit("block"), key), 1, 3).alias("block"))


def _sums(sources: DataFrame, total: float, points: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: sum of p^a, sum of p^a ln p, largest p^(a-1)."""
    p = F.col("tokens") / F.lit(float(total))
    row = sources.agg(*[f for a in points for f in (
        F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)), F.max(F.pow(p, F.lit(a)) / p))]).first()
    return [tuple(row[3 * k:3 * k + 3]) for k in range(len(points))]


def _bisect(sources: DataFrame, total: float, holds) -> float:
    """The largest exponent in [0, 1] for which ``holds``, true below some point, is true; 0 if it never is."""
    low, high = 0.0, 1.0
    if holds(1.0, *_sums(sources, total, [1.0])[0]):
        return 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * k / 2 ** LEVELS for k in range(1, 2 ** LEVELS)]
        good = [holds(a, *x) for a, x in zip(points, _sums(sources, total, points), strict=True)]
        low_k, high_k = 0, 2 ** LEVELS
        while high_k - low_k > 1:
            middle = (low_k + high_k) // 2
            low_k, high_k = (middle, high_k) if good[middle - 1] else (low_k, middle)
        low, high = low + (high - low) * low_k / 2 ** LEVELS, low + (high - low) * high_k / 2 ** LEVELS
    return low


def fit(sources: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float = BUDGET) -> Mixture:
    """``sources``: a stored table (src, tokens) of sources with tokens."""
    n, total = sources.agg(F.count("*"), F.sum("tokens")).first()
    if not n:
        return Mixture(1.0, 0.0, 0.0, 1.0)
    spent = min(budget, repeats) * total
    wanted = entropy * math.log(n)
    flat = _bisect(sources, total, lambda a, z, zl, _: math.log(z) - a * zl / z >= wanted) if n > 1 else 1.0
    # repetition of a source: p^a / Z * spent / (p total); it falls as the exponent rises
    over = _bisect(sources, total, lambda a, z, _, top: top / z * spent / total > repeats * (1 + 1e-9)) if n > 1 else 0.0
    least = round(over + 1e-6, 6) if over > 0 else 0.0
    exponent = min(max(round(flat, 6), least), 1.0)
    return Mixture(exponent, float(spent), float(total), _sums(sources, total, [exponent])[0][0])


def plan(sized: DataFrame, sources: DataFrame, mixture: Mixture) -> DataFrame:
    """(src, block, epoch, block_rank, upto, repeats) of all blocks that are used: docs of a block whose key of the epoch is at most ``upto``
    are taken, all if it is null.

    ``sized``: a stored table (src, key, n, block).
    """
    share = F.pow(F.col("tokens") / F.lit(mixture.total or 1.0), F.lit(mixture.exponent)) / F.lit(mixture.scale)
    wanted = sources.select("src", "tokens", F.floor(share * F.lit(mixture.budget) + F.lit(1e-6)).alias("wanted"))
    wanted = wanted.select("src", F.floor(F.col("wanted") / F.col("tokens")).alias("whole"),
                           (F.col("wanted") % F.col("tokens")).alias("rest"))
    blocks = sized.groupBy("src", "block").agg(F.sum("n").alias("size"))
    blocks = blocks.join(wanted, "src").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))).alias("epoch"))
    in_order = Window.partitionBy("src", "epoch").orderBy(_digest(F.col("src"), F.col("epoch").cast("string"), F.col("block")), "block")
    ranked = stored(blocks.select(
        "*", (F.row_number().over(in_order) - 1).alias("block_rank"),
        F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("behind")), "mixing-blocks")
    partial = F.col("epoch") == F.col("whole")
    all_in = ranked.where(~partial | (F.col("behind") <= F.col("rest"))).select(
        "src", "block", "epoch", "block_rank", F.lit(None).cast("string").alias("upto"))
    edge = ranked.where(partial & (F.col("behind") > F.col("rest")) & (F.col("behind") - F.col("size") <= F.col("rest")) & (F.col("rest") > 0)
                        & (F.col("size") > 0))
    epoch_key = _digest(F.lit("doc"), F.col("epoch").cast("string"), F.col("key"))
    docs = sized.join(F.broadcast(edge) if edge.limit(10_001).count() <= 10_000 else edge, ["src", "block"]).select(
        "src", "block", "epoch", "block_rank", "n", (F.col("rest") - F.col("behind") + F.col("size")).alias("room"), epoch_key.alias("k"))
    so_far = F.sum("n").over(Window.partitionBy("src", "block", "epoch").orderBy("k"))  # equal keys go together
    last = docs.withColumn("used", so_far).where("used <= room").groupBy("src", "block", "epoch", "block_rank").agg(F.max("k").alias("upto"))
    return stored(all_in.unionByName(last.select(*all_in.columns)), "mixing-plan")


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", entropy: float = ENTROPY,
        repeats: float = REPEATS, budget: float = BUDGET, tokens: str | None = None) -> DataFrame:
    """The rows of ``docs`` as often as the mixture uses them, with ``epoch`` and ``block_rank``: in a source, reading by
    epoch and then by block is the seeded order.

    Null sources are one source; a source without tokens is not used; documents without tokens follow their
    block. Rows of one source and id are taken or left together. An empty table gives an empty mixture. The two
    new columns get a leading underscore where ``docs`` has their names. ``tokens`` names a column to use instead of counting words.
    """
    rows = _keyed(docs, id, source, words(F.col(text)) if tokens is None else F.coalesce(F.col(tokens).cast("long"), F.lit(0)))
    sized = stored(rows.select("src", "key", "n", "block"), "mixing-sizes")
    sources = stored(sized.groupBy("src").agg(F.sum("n").alias("tokens")).where("tokens > 0"), "mixing-sources")
    planned = plan(sized, sources, fit(sources, entropy, repeats, budget))
    # one row for each block of a source, so that a document is met once and then multiplied
    takes = stored(planned.groupBy("src", "block").agg(F.collect_list(F.struct("epoch", "block_rank", "upto")).alias("takes")), "mixing-takes")
    used = rows.drop("n").join(checked_broadcast(takes, 200_000), ["src", "block"])
    used = used.select("row", "key", F.explode("takes").alias("take")).where(
        "take.upto is null or " + "md5(concat_ws(':', '" + SEED + "', 'doc', cast(take.epoch as string), key)) <= take.upto")
    return used.select("row.*", F.col("take.epoch").alias(fresh("epoch", docs)), F.col("take.block_rank").alias(fresh("block_rank", docs)))


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, epoch, block_rank): the uses of each document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "epoch", F.col("block_rank").cast("long").alias("block_rank"))


OP5_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT coalesce(source, '') AS src, source, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n,
         substr(md5('mix:block:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3) AS block
  FROM documents
), sources AS (
  SELECT src, CAST(sum(n) AS BIGINT) AS tokens FROM sized GROUP BY src HAVING sum(n) > 0
), whole AS (
  SELECT count(*) AS n, CAST(sum(tokens) AS DOUBLE) AS total, sum(tokens) * 1.0 AS spent FROM sources
), flat(i, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(2 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN h >= 0.97 * ln(n) THEN (low + high) / 2 ELSE low END,
                CASE WHEN h >= 0.97 * ln(n) THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT f.i, f.low, f.high, any_value(w.n) AS n,
           ln(sum(pow(s.tokens / w.total, (f.low + f.high) / 2)))
           - (f.low + f.high) / 2 * sum(pow(s.tokens / w.total, (f.low + f.high) / 2) * ln(s.tokens / w.total))
             / sum(pow(s.tokens / w.total, (f.low + f.high) / 2)) AS h
    FROM flat f, sources s, whole w WHERE f.i < 31 AND NOT (f.i = 1 AND f.low = 1) GROUP BY f.i, f.low, f.high
  )
), over(i, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(2 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN r > 4 * (1 + 1e-9) THEN (low + high) / 2 ELSE low END,
                CASE WHEN r > 4 * (1 + 1e-9) THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT f.i, f.low, f.high,
           max(pow(s.tokens / w.total, (f.low + f.high) / 2) / (s.tokens / w.total))
           / sum(pow(s.tokens / w.total, (f.low + f.high) / 2)) AS r
    FROM over f, sources s, whole w WHERE f.i < 31 AND NOT (f.i = 1 AND f.low = 1) GROUP BY f.i, f.low, f.high
  )
), chosen AS (
  SELECT least(greatest(round((SELECT arg_max(low, i) FROM flat), 6),
                        CASE WHEN (SELECT arg_max(low, i) FROM over) > 0
                             THEN round((SELECT arg_max(low, i) FROM over) + 1e-6, 6) ELSE 0 END), 1.0) AS a
), raised AS (
  SELECT src, tokens, pow(tokens / total, a) AS w, total FROM sources, whole, chosen
), wanted AS (
  SELECT src, tokens, CAST(floor(w / (SELECT sum(w) FROM raised) * total + 1e-6) AS BIGINT) AS wanted FROM raised
), passes AS (
  SELECT src, wanted // tokens AS whole, wanted % tokens AS rest FROM wanted
), blocks AS (
  SELECT b.src, b.block, b.size, p.whole, p.rest, unnest(range(0, p.whole + 1)) AS epoch
  FROM (SELECT src, block, CAST(sum(n) AS BIGINT) AS size FROM sized GROUP BY src, block) b JOIN passes p USING (src)
), ranked AS (
  SELECT *, row_number() OVER o - 1 AS block_rank, CAST(sum(size) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) AS behind
  FROM blocks WINDOW o AS (PARTITION BY src, epoch ORDER BY md5('mix:' || src || ':' || epoch || ':' || block), block)
), uses AS (
  SELECT s.doc_id, s.source, s.n, s.key, r.*,
         sum(s.n) OVER (PARTITION BY r.src, r.block, r.epoch ORDER BY md5('mix:doc:' || r.epoch || ':' || s.key)) AS used
  FROM ranked r JOIN sized s USING (src, block)
)
SELECT doc_id, source, epoch, block_rank FROM uses
WHERE epoch < whole OR behind <= rest OR (behind - size <= rest AND rest > 0 AND size > 0 AND used <= rest - behind + size)
"""
