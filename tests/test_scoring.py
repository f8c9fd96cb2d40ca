"""Profiles, distance, wordings, convergence."""

import pytest
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.functions.numbers import digits2
from readgrade.operators import profiles as P


def feature_rows(spark, rows):
    """Rows of (level, value): every metric has the value."""
    return spark.createDataFrame([(lv, *[float(v)] * 8) for lv, v in rows],
                                 "predict_level string, " + ", ".join(f"{m} double" for m in C.METRICS))


@pytest.fixture(scope="module")
def profiles(spark):
    rows = feature_rows(spark, [("A1.1", 1), ("A1.2", 3), ("C2", 5), ("B1.1", 0), ("zz", 9)])
    return P.level_profiles(P.group_levels(rows))


def test_profiles_merge_levels(profiles):
    got = {(r["level"], r["metric"]): r for r in profiles.collect()}
    assert got[("A1", "ARI")]["mean"] == 2.0 and got[("A1", "ARI")]["sample_count"] == 2
    assert got[("A1", "ARI")]["std"] == pytest.approx(2 ** 0.5)
    assert got[("C1+", "LenNP")]["std"] is None
    assert len(got) == 3 * 8


def test_missing_metrics_are_skipped(spark):
    rows = feature_rows(spark, [("A1.1", 1)]).drop("LenNP")
    assert P.level_profiles(P.group_levels(rows)).count() == 7


def test_distance(spark, profiles):
    rows = feature_rows(spark, [("A1", 2), ("A1", 3), ("B1.1", 1), ("none", 1)]).withColumnRenamed("predict_level", "level")
    got = [(r["level"], r["d"]) for r in P.deltas(rows, profiles).select("level", P.distance().alias("d")).collect()]
    assert sorted(got) == [("A1", 0.0), ("A1", 0.5), ("B1.1", 1.0), ("none", float("inf"))]


def test_resolve(spark, profiles):
    asked = spark.createDataFrame([("A1.2",), ("A1",), ("B2.1",), ("C1",), ("X",)], "requested_level string")
    good, bad = P.resolve_levels(asked, profiles)
    assert {r["requested_level"]: r["level"] for r in good.collect()} == {"A1.2": "A1", "A1": "A1", "C1": "C1+"}
    assert {r["requested_level"] for r in bad.collect()} == {"B2.1", "X"}


def test_labels(spark):
    row = spark.range(1).select(P.label(F.lit("C1+"), F.lit("narrative")), P.display_name(F.lit("odd"))).first()
    assert row[0] == "CEFR-J Level: C1+ (C1–C2) (Narrative)" and row[1] == "odd"


def test_advice_and_snapshot(spark, profiles):
    rows = feature_rows(spark, [("A1", 2), ("A1", 2.6)]).withColumnRenamed("predict_level", "level")
    even, off = [r for r in P.deltas(rows, profiles).orderBy("ARI").select(P.advice(), P.snapshot()).collect()]
    assert even[0] == "- Metrics already align; focus on fluency and naturalness within the level."
    assert "drops toward 2.00 (currently +0.60)" in off[0] and "frequency rank" not in off[0]
    assert off[1].splitlines()[0] == "- AvrDiff: current 2.60, target 2.00" and len(off[1].splitlines()) == 8


def test_target_lines_leave_out_an_unknown_spread(profiles):
    got = {r["level"]: r["targets"] for r in P.target_lines(profiles).collect()}
    assert got["A1"].startswith("- AvrDiff: ≈ 2.00 (±1.41). Average") and "±" not in got["C1+"]


def test_digits(spark):
    rows = spark.sql("SELECT * FROM VALUES (2.675D, '2.68'), (-0.001D, '0.00'), (-1.5D, '-1.50'), (10D, '10.00') AS t(x, s)")
    assert rows.where(digits2(F.col("x")) != F.col("s")).count() == 0


def test_convergence(spark):
    rows = [(1, 0, "a", 0.5), (1, 1, "b", 0.05), (1, 2, "c", 0.01), (2, 0, "d", 0.3), (2, 1, "e", 0.2),
            *[(3, i, str(i), 1.0 if i < 6 else 0.0) for i in range(8)]]
    got = {r["request_id"]: r for r in P.convergence(
        spark.createDataFrame(rows, "request_id int, iteration int, text string, distance double")).collect()}
    assert (got[1]["final_text"], got[1]["iterations"], got[1]["converged"]) == ("b", 2, True)
    assert (got[2]["final_text"], got[2]["iterations"], got[2]["converged"]) == ("e", 2, False)
    assert (got[3]["iterations"], got[3]["final_text"], got[3]["converged"]) == (5, "5", False)
    few = P.convergence(spark.createDataFrame([(1, 0, "a", 0.5), (1, 1, "b", 0.05)], "request_id int, iteration int, text string, distance double"), 1)
    assert tuple(few.first()) == (1, "b", 1, False)


def test_boundaries_overlap_at_the_edge(spark):
    rows = spark.createDataFrame([(2.0, 100), (9.0, 100)], "ARI double, word_count int")
    assert {r["level"] for r in P.boundary_levels(rows).collect()} == {"A1.1", "A1.2"}
