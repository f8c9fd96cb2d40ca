"""Passes over the rows that fits make, and the results that they must not change."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.operators import classifier as CL


@pytest.fixture(scope="module")
def rows(spark):
    level = F.element_at(F.array(*[F.lit(v) for v in ("A1.1", "B1.1", "C2")]), (F.col("id") % 3 + 1).cast("int"))
    noise = [((F.col("id") % 3) * 1.0 + F.pmod(F.xxhash64("id", F.lit(m)), F.lit(1000)) / 300.0).alias(m) for m in C.METRICS]
    table = spark.range(400).where("id % 5 <> 2 or id < 200").select(F.col("id").alias("doc_id"), level.alias("predict_level"), *noise)
    return table.withColumn("POStypes", F.lit(4.0)).persist()


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    monkeypatch.setattr(CL, "TREES", 9)


def jobs(spark, name, call) -> int:
    spark.sparkContext.setJobGroup(name, name)
    try:
        call()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_coefficients_are_those_of_spark(rows):
    """Same loss, class weights, penalty on standardised slopes, a constant column among them."""
    ready = CL.weighted(CL.dealt(rows)).persist()
    n = ready.count()
    spark_own = OneVsRest(classifier=LogisticRegression(maxIter=500, tol=1e-12, regParam=CL.PENALTY / n), weightCol="weight")
    want = Pipeline(stages=[CL.indexer(), *CL._features(C.METRICS), spark_own]).fit(ready).stages[-1].models
    got = CL.pipeline("logistic", n).fit(ready).stages[-1].models
    assert len(got) == len(want) == 3
    for a, b in zip(got, want):
        np.testing.assert_allclose(a.coefficients.toArray(), b.coefficients.toArray(), rtol=1e-4, atol=1e-5)
        assert a.intercept == pytest.approx(b.intercept, rel=1e-4)


def test_one_class_alone(rows):
    one = rows.where("predict_level = 'C2'")
    assert {r["predicted_level"] for r in CL.predict(CL.fit(one, "logistic"), one).collect()} == {"C2"}
    assert {r["predicted_level"] for r in CL.predict(CL.fit(one), one).collect()} == {"C2"}


def test_passes_of_a_regression_do_not_grow_with_the_classes(rows, spark):
    """One model at a time took a job for each step of each class."""
    assert jobs(spark, "logistic", lambda: CL.fit(rows, "logistic")) < 60


def test_passes_of_a_forest_do_not_grow_with_its_depth(rows, spark, monkeypatch):
    made = []
    for depth in (2, 10):
        monkeypatch.setattr(CL, "DEEPEST", depth)
        made.append(jobs(spark, f"depth {depth}", lambda: CL.fit(rows)))
    assert made[0] == made[1]


def test_each_candidate_is_fitted_once_a_fold(rows, monkeypatch):
    fits, plain = [], CL.Pipeline.fit
    monkeypatch.setattr(CL.Pipeline, "fit", lambda self, table, params=None: fits.append(1) or plain(self, table, params))
    ranked = CL.choose(rows)
    assert len(fits) == 2 * CL.MOST_FOLDS and all(0.5 < a <= 1 for _, a in ranked)


def test_curves_pass_over_the_scores_once(rows, monkeypatch):
    """The bins of all classes come from one aggregate; each curve rises from no to full certainty of its own level."""
    model = CL.calibrate(rows)
    assert [c.getFeaturesCol() for c in model.curves] == ["s0", "s1", "s2"]
    for curve in model.curves:
        steps = curve.predictions.toArray()
        assert (np.diff(steps) >= 0).all() and 0 <= steps[0] and steps[-1] <= 1
    assert CL.accuracy(CL.predict(model, rows)).first()["accuracy"] > 0.8
