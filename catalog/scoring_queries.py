"""Profiles and scoring (P)."""

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.fixtures import label_by_number
from catalog.registry import query
from catalog.text_queries import rounded
from readgrade import fixed as C
from readgrade.functions.numbers import fixed
from readgrade.operators import metrics as M, profiles as P

DELTAS = [f"delta_{m}" for m in C.METRICS]


def _advice_sql() -> str:
    items = []
    for metric, threshold, high, low in C.ADVICE:
        slots = {"target": Q.d2(f"target_{metric}"), "diff": Q.d2(f"delta_{metric}")}
        items.append(f"CASE WHEN abs(delta_{metric})>={threshold!r} THEN '- '||CASE WHEN delta_{metric}>0 "
                     f"THEN {Q.fill(high, slots)} ELSE {Q.fill(low, slots)} END END")
    return f"coalesce(nullif(concat_ws(chr(10),{','.join(items)}),''),{Q.q('- ' + C.ADVICE_NONE)})"


def _snapshot_sql() -> str:
    items = [f"CASE WHEN target_{m} IS NOT NULL THEN '- {m}: current '||{Q.d2(m)}||', target '||{Q.d2(f'target_{m}')} END"
             for m in C.REPORT_METRICS]
    return f"concat_ws(chr(10),{','.join(items)})"


ADVICE, SNAPSHOT = _advice_sql(), _snapshot_sql()
_hints = Q.values("hints", ["place", "metric", "hint"], [(i, m, h) for i, (m, h) in enumerate(C.METRIC_HINTS)])
TARGET_LINES = f"""SELECT level, string_agg('- '||metric||': ≈ '||{Q.d2('mean')}||
      CASE WHEN std IS NOT NULL AND std<>0 THEN ' (±'||{Q.d2('std')}||')' ELSE '' END||'. '||hint,
      chr(10)||'        ' ORDER BY place) AS targets FROM profiles JOIN ({_hints}) USING (metric) GROUP BY level"""


@query("p1_level_groups", "SELECT doc_id, predict_level, level FROM grouped", "grouped")
def p1(d):
    return d.grouped.select("doc_id", "predict_level", "level")


@query("p2_level_profiles", f"""SELECT level, metric, {Q.fx('mean', 3)} AS mean, {Q.fx('std', 3)} AS std,
       {Q.fx('min', 3)} AS min, {Q.fx('max', 3)} AS max, sample_count FROM profiles""", "profiles")
def p2(d):
    return rounded(d.profiles, "mean", "std", "min", "max", digits=3)


_asked = f"CASE doc_id%12 WHEN 9 THEN 'A1' WHEN 10 THEN 'C1+' WHEN 11 THEN 'D7' ELSE {Q.label_by_number('doc_id%12')} END"
_alias = Q.values("alias", ["requested_level", "level", "display"], C.LEVEL_ALIASES)


def _requests(d):
    """Nine labels, two group names and an unknown level."""
    number = F.col("doc_id") % 12
    asked = (F.when(number == 9, "A1").when(number == 10, "C1+").when(number == 11, "D7")
             .otherwise(label_by_number(number)))
    kind = F.when(F.col("doc_id") % 2 == 0, "narrative").otherwise("expository")
    return d.docs.select("doc_id", asked.alias("requested_level"), kind.alias("text_type"))


@query("p3_resolve_levels", f"""SELECT doc_id, requested_level, level, level IS NOT NULL AS resolved FROM (
       SELECT doc_id, {_asked} AS requested_level FROM docs_en) LEFT JOIN (SELECT requested_level, level FROM ({_alias})
       WHERE level IN (SELECT level FROM profiles)) USING (requested_level)""", "docs_en", "profiles")
def p3(d):
    resolved, rejected = P.resolve_levels(_requests(d), d.profiles)
    return (resolved.select("doc_id", "requested_level", "level", F.lit(True).alias("resolved"))
            .unionByName(rejected.select("doc_id", "requested_level", F.lit(None).cast("string").alias("level"),
                                         F.lit(False).alias("resolved"))))


DISPLAY = Q.case("level", list({g: n for _, g, n in C.LEVEL_GROUPS}.items()), "=", None).replace("ELSE NULL", "ELSE level")


@query("p4_labels", f"""SELECT doc_id, {DISPLAY} AS display, {Q.fill(C.LABEL_FORMAT, {
    'display': DISPLAY, 'type': "CASE WHEN doc_id%2=0 THEN 'Narrative' ELSE 'Expository' END"})} AS label
       FROM (SELECT doc_id, {_asked} AS requested_level FROM docs_en) JOIN ({_alias}) USING (requested_level)""", "docs_en")
def p4(d):
    resolved, _ = P.resolve_levels(_requests(d), d.profiles)
    return resolved.select("doc_id", P.display_name(F.col("level")).alias("display"),
                           P.label(F.col("level"), F.col("text_type")).alias("label"))


@query("p5_deltas", "SELECT doc_id, level, " + ", ".join(f"{Q.fx(c, 3)} AS {c}" for c in DELTAS) + " FROM scored", "scored")
def p5(d):
    return rounded(d.scored.select("doc_id", "level", *DELTAS), *DELTAS, digits=3)


@query("p6_distance", f"SELECT doc_id, level, {Q.fx('distance', 3)} AS distance FROM distances", "distances")
def p6(d):
    return rounded(d.scored.select("doc_id", "level", "distance"), "distance", digits=3)


@query("p6_unknown_level", f"""SELECT doc_id, coalesce({Q.fx('raw_distance', 3)},{Q.INF}) AS distance
       FROM (SELECT s.doc_id, CASE WHEN s.doc_id%4<>0 THEN raw_distance END AS raw_distance FROM scored s)""", "scored")
def p6_unknown(d):
    """Every fourth attempt asks for a level without a profile."""
    asked = d.attempts.withColumnRenamed("target_level", "predict_level")
    rows = P.group_levels(asked).join(d.metrics("profile"), "doc_id").withColumn(
        "level", F.when(F.col("doc_id") % 4 != 0, F.col("level")).otherwise("none"))
    scored = P.deltas(rows, d.profiles).select("doc_id", P.distance().alias("distance"))
    endless = F.col("distance") == float("inf")
    return scored.select("doc_id", F.when(endless, F.col("distance")).otherwise(fixed(F.col("distance"), 3)).alias("distance"))


@query("p7_advice", f"SELECT doc_id, level, {ADVICE} AS advice FROM scored", "scored")
def p7(d):
    return d.scored.select("doc_id", "level", P.advice().alias("advice"))


@query("p8_target_lines", TARGET_LINES, "profiles")
def p8(d):
    return P.target_lines(d.profiles)


@query("p9_snapshot", f"SELECT doc_id, level, {SNAPSHOT} AS snapshot FROM scored", "scored")
def p9(d):
    return d.scored.select("doc_id", "level", P.snapshot().alias("snapshot"))


@query("p10_metric_report", " UNION ALL ".join(
    f"""SELECT s.doc_id, s.level, {i}::BIGINT AS line, '{m}' AS metric, {Q.fx(m, 3)} AS current,
        {Q.fx(f'target_{m}', 3)} AS target, {Q.fx(f'delta_{m}', 3)} AS delta, l.out_of_band_count,
        coalesce(array_to_string(l.words[1:10],', '),'') AS examples FROM scored s JOIN lexical l USING (doc_id)"""
    for i, m in enumerate(C.REPORT_METRICS, 1)), "scored", "lexical")
def p10(d):
    rows = P.metric_report(d.scored.join(d.lexical, "doc_id"))
    return rounded(rows.withColumn("line", F.col("line").cast("bigint")), "current", "target", "delta", digits=3)


# history: the attempts of a request as iterations, distances scaled so that some requests converge
@query("p11_convergence", """SELECT request_id, arg_max(text,iteration) AS final_text, count(*) FILTER (iteration<2) AS iterations,
       bool_or(stop IS NOT NULL) AS converged FROM (SELECT *, min(iteration) FILTER (distance<0.1 AND iteration<2) OVER
       (PARTITION BY request_id) AS stop FROM (SELECT request_id, attempt-1 AS iteration, text,
         abs(ARI-7e0)/8e0 AS distance FROM scored)) WHERE iteration<=2 AND (stop IS NULL OR iteration<=stop)
       GROUP BY request_id""", "scored")
def p11(d):
    measured = d.attempts.join(M.readability(d.docs), "doc_id")
    return P.convergence(measured.select("request_id", (F.col("attempt") - 1).alias("iteration"), "text",
                                         (F.abs(F.col("ARI") - 7.0) / 8.0).alias("distance")), max_iterations=2)


@query("p12_boundary_levels", f"""SELECT doc_id, level FROM metrics_profile JOIN ({Q.values(
    'bounds', ['level', 'a', 'b', 'c', 'd'], C.LEVEL_BOUNDARIES)}) ON ARI BETWEEN a AND b AND word_count BETWEEN c AND d""",
       "metrics_profile")
def p12(d):
    return P.boundary_levels(d.metrics("profile")).select("doc_id", "level")
