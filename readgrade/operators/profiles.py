"""Level profiles and scoring against them (P1-P12)."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.numbers import digits2
from readgrade.functions.tables import fixed_table

TINY = 1e-6


# ---- levels ------------------------------------------------------------------------

def group_levels(labelled: DataFrame) -> DataFrame:
    """Add the level group of ``predict_level``; rows with another label are dropped."""
    groups = fixed_table(labelled.sparkSession, ["predict_level", "level", "display"], C.LEVEL_GROUPS)
    return labelled.join(F.broadcast(groups.drop("display")), "predict_level")


def resolve_levels(requests: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected) requests: ``requested_level`` by name or alias among the profiled levels."""
    known = profiles.select("level").distinct()
    alias = (fixed_table(requests.sparkSession, ["requested_level", "level", "display"], C.LEVEL_ALIASES)
             .join(known, "level", "left_semi"))
    found = requests.join(F.broadcast(alias), "requested_level", "left")
    return (found.where(F.col("level").isNotNull()),
            found.where(F.col("level").isNull()).drop("level", "display"))


def display_name(level: Column) -> Column:
    """Display name of a level group; an unknown level shows as it is."""
    expr = None
    for name, display in {g: d for _, g, d in C.LEVEL_GROUPS}.items():
        expr = F.when(level == name, display) if expr is None else expr.when(level == name, display)
    return expr.otherwise(level)


def label(level: Column, text_type: Column) -> Column:
    return X.literal_fill(F.lit(C.LABEL_FORMAT), {"display": display_name(level), "type": F.initcap(text_type)})


# ---- profiles -------------------------------------------------------------------------

def level_profiles(grouped: DataFrame) -> DataFrame:
    """(level, metric, mean, std, min, max, sample_count); metrics that the table lacks are skipped.

    The statistics are taken in one wide aggregate and turned into rows
    afterwards, so the features are not multiplied by the number of metrics.
    """
    present = [m for m in C.METRICS if m in grouped.columns]
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = grouped.groupBy("level").agg(
        F.count(F.lit(1)).alias("sample_count"),
        *[f(m).alias(f"{s}_{m}") for m in present for s, f in stats.items()])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(f"{s}_{m}").alias(s) for s in stats])
                     for m in present])
    return wide.select("level", "sample_count", F.inline(rows))


def target_means(profiles: DataFrame) -> DataFrame:
    """One row per level with ``target_<metric>``: at most as many rows as there are level groups."""
    return profiles.groupBy("level").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("mean"))).alias(f"target_{m}") for m in C.METRICS])


def deltas(scored: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add ``target_*`` and ``delta_*`` of the row's ``level``; null where the level has no such mean.

    The targets are broadcast: a profile table has one row per level group and
    metric, and there are seven groups.
    """
    joined = scored.join(F.broadcast(target_means(profiles)), "level", "left")
    return joined.select("*", *[(F.col(m) - F.col(f"target_{m}")).alias(f"delta_{m}") for m in C.METRICS])


def distance() -> Column:
    """Mean of ``abs(delta) / scale`` over the shared metrics; infinite without one."""
    total, shared = F.lit(0.0), F.lit(0)
    for m in C.REPORT_METRICS:
        target, delta = F.abs(F.col(f"target_{m}")), F.abs(F.col(f"delta_{m}"))
        total = total + F.coalesce(delta / F.when(target > TINY, target).otherwise(1.0), F.lit(0.0))
        shared = shared + F.col(f"delta_{m}").isNotNull().cast("int")
    return F.when(shared > 0, total / F.greatest(shared, F.lit(1))).otherwise(F.lit(float("inf")))


# ---- wordings ---------------------------------------------------------------------------

def _lines(items: list[Column], separator: str) -> Column:
    """Join the items that are present."""
    return F.concat_ws(separator, *items)


def advice() -> Column:
    """What to change, one line per metric that is off by its threshold or more."""
    items = []
    for metric, threshold, high, low in C.ADVICE:
        delta, target = F.col(f"delta_{metric}"), F.col(f"target_{metric}")
        filled = X.literal_fill(F.when(delta > 0, high).otherwise(low),
                                {"target": digits2(target), "diff": digits2(delta)})
        items.append(F.when(F.abs(delta) >= threshold, F.concat(F.lit("- "), filled)))
    text = _lines(items, "\n")
    return F.when(text == "", F.lit("- " + C.ADVICE_NONE)).otherwise(text)


def snapshot() -> Column:
    """Current value and target of every shared metric, one line each."""
    return _lines([F.when(F.col(f"target_{m}").isNotNull(), F.concat(
        F.lit(f"- {m}: current "), digits2(F.col(m)), F.lit(", target "), digits2(F.col(f"target_{m}"))))
        for m in C.REPORT_METRICS], "\n")


def target_lines(profiles: DataFrame) -> DataFrame:
    """Per level the quantitative targets as text: mean, spread if known, hint."""
    spread = F.when(F.col("std").isNotNull() & (F.col("std") != 0.0),
                    F.concat(F.lit(" (±"), digits2(F.col("std")), F.lit(")"))).otherwise("")
    lines = []
    for metric, hint in C.METRIC_HINTS:
        line = F.concat(F.lit(f"- {metric}: ≈ "), digits2(F.col("mean")), spread, F.lit(f". {hint}"))
        lines.append(F.max(F.when(F.col("metric") == metric, line)))
    return profiles.groupBy("level").agg(_lines(lines, "\n        ").alias("targets"))


def metric_report(scored: DataFrame, shown: int = 10) -> DataFrame:
    """Long form: metric, current, target, delta; out-of-band count and its first examples."""
    rows = F.array(*[F.struct(F.lit(i).alias("line"), F.lit(m).alias("metric"), F.col(m).alias("current"),
                              F.col(f"target_{m}").alias("target"), F.col(f"delta_{m}").alias("delta"))
                     for i, m in enumerate(C.REPORT_METRICS, 1)])
    return scored.select("doc_id", "level", "out_of_band_count",
                         F.array_join(F.slice("out_of_band_tokens", 1, shown), ", ").alias("examples"), F.inline(rows))


def convergence(history: DataFrame, max_iterations: int = C.MAX_ITERATIONS) -> DataFrame:
    """Refinement ends at the first distance below the threshold or after ``max_iterations`` scored texts.

    Without convergence the result is the text of the last refinement, which has the number ``max_iterations``
    and is not scored any more. One aggregate, combined before the exchange.
    """
    scored = F.col("iteration") < max_iterations
    close = scored & (F.col("distance") < C.CONVERGED_DISTANCE)
    whole = history.where(F.col("iteration") <= max_iterations).groupBy("request_id").agg(
        F.min(F.when(close, F.col("iteration"))).alias("stop"), F.min_by("text", F.when(close, F.col("iteration"))).alias("reached"),
        F.max_by("text", "iteration").alias("last"), F.count_if(scored).alias("n"),
        F.collect_set(F.when(scored, F.col("iteration"))).alias("done"))
    return whole.select(
        "request_id", F.when(F.col("stop").isNull(), F.col("last")).otherwise(F.col("reached")).alias("final_text"),
        F.when(F.col("stop").isNull(), F.col("n")).otherwise(F.size(F.filter("done", lambda i: i <= F.col("stop")))).cast("bigint").alias("iterations"),
        F.col("stop").isNotNull().alias("converged"))


def boundary_levels(measured: DataFrame) -> DataFrame:
    """Levels whose ARI range and word-count range both hold the text: a range join with the fixed boundaries."""
    bounds = fixed_table(measured.sparkSession, ["level", "ari_low", "ari_high", "words_low", "words_high"],
                         C.LEVEL_BOUNDARIES)
    return measured.join(F.broadcast(bounds), F.col("ARI").between(F.col("ari_low"), F.col("ari_high")) &
                         F.col("word_count").between(F.col("words_low"), F.col("words_high")))
