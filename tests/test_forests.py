"""Forests whose trees are grown in the tasks: cuts against brute force, the same trees for any layout of the rows, no node in the driver."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.operators import classifier as CL, trees as T
from readgrade.operators.forests import Forest, RegressionForest


def impurity(y, w, classes):
    if classes:
        shares = np.bincount(y.astype(int), w, classes) / w.sum()
        return 1 - (shares ** 2).sum()
    return np.average((y - np.average(y, weights=w)) ** 2, weights=w)


@pytest.mark.parametrize("classes", [3, 0])
def test_first_cut_is_the_best_of_all(classes):
    draw = np.random.default_rng(5)
    for k in range(20):
        bins = draw.integers(0, 6, (40, 3)).astype(np.uint8)
        y = draw.integers(0, 3, 40).astype(float) if classes else draw.normal(size=40) + bins[:, 1]
        w = draw.choice([0.5, 1.0, 2.5], 40)
        tree = T.grow(bins, y, w, np.random.default_rng(k), classes, 6, 1, 3)
        times = np.random.default_rng(k).poisson(1.0, 40)
        b, v, u = bins[times > 0], y[times > 0], (w * times)[times > 0]
        gains = {}
        for f in range(3):
            for c in range(5):
                left = b[:, f] <= c
                if left.any() and not left.all():
                    parts = sum(u[s].sum() / u.sum() * impurity(v[s], u[s], classes) for s in (left, ~left))
                    gains[f, c] = impurity(v, u, classes) - parts
        best = max(gains.values())
        if len(tree["feature"]) == 1:  # one answer on both sides
            continue
        assert gains[tree["feature"][0], tree["cut"][0]] == pytest.approx(best)
        assert tree["brought"].sum() == pytest.approx(best * u.sum())


def test_a_full_tree_knows_the_rows_it_saw():
    draw = np.random.default_rng(1)
    bins = np.unique(draw.integers(0, 12, (400, 4)).astype(np.uint8), axis=0)
    y = draw.integers(0, 4, len(bins)).astype(float)
    tree = T.grow(bins, y, np.ones(len(y)), np.random.default_rng(9), 4, 12, 30, 4)
    seen = np.random.default_rng(9).poisson(1.0, len(y)) > 0
    answers = T.votes([T.unpacked(T.packed(tree), 4)], bins, 4)
    assert (answers.argmax(1) == y)[seen].all() and answers.sum(1) == pytest.approx(1.0)


def test_cuts_and_bins():
    values = np.array([3.0, 1.0, 2.0, 2.0])
    assert T.cuts_of(values, np.ones(4), 32) == [1.5, 2.5]
    assert T.bins_of(np.array([[1.5], [1.6], [9.0], [np.nan]]), [[1.5, 2.5]])[:, 0].tolist() == [0, 1, 2, 2]
    many = np.arange(1000.0)
    assert len(T.cuts_of(many, np.ones(1000), 32)) == 31
    # weight, not number: half of it lies on the first ten values
    heavy = T.cuts_of(many, np.where(many < 10, 99.0, 1.0), 32)
    assert sum(c < 10 for c in heavy) >= 9


@pytest.fixture(scope="module")
def rows(spark):
    level = F.element_at(F.array(*[F.lit(v) for v in ("A1.1", "B1.1", "C2")]), (F.col("id") % 3 + 1).cast("int"))
    noise = [((F.col("id") % 3) * 2.0 + F.pmod(F.xxhash64("id", F.lit(m)), F.lit(1000)) / 300.0).alias(m) for m in C.METRICS]
    return spark.range(600).select(F.col("id").alias("doc_id"), level.alias("predict_level"), *noise).persist()


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    monkeypatch.setattr(CL, "TREES", 9)


def test_same_trees_for_any_layout(rows):
    made = [CL.fit(part).stages[-1].toDebugString.split("\n", 1)[1] for part in (rows.coalesce(1), rows.orderBy(F.desc("ARI")).repartition(7))]
    assert made[0] == made[1] and made[0].count("  Tree ") == 9


def test_the_driver_gets_no_nodes(rows, monkeypatch):
    """A fit brings sums and cuts to the driver; trees stay rows of a table."""
    model = CL.fit(rows).stages[-1]
    assert model._trees.count() == 9 and model._trees.inputFiles() and model._sent is None
    assert not hasattr(model, "_java_obj") and len(str(model._about)) < 10_000
    assert model.totalNumNodes == sum(len(r["left"]) // 4 for r in model._trees.collect())


def test_trees_are_sent_in_blocks(rows, monkeypatch):
    import readgrade.operators.forests as FO

    model = CL.fit(rows)
    whole = [tuple(r) for r in CL.predict(model, rows).select("doc_id", "predicted_level", "confidence").orderBy("doc_id").collect()]
    monkeypatch.setattr(FO, "SHIPPED_BYTES", 1)
    model.stages[-1]._sent = None
    assert whole == [tuple(r) for r in CL.predict(model, rows).select("doc_id", "predicted_level", "confidence").orderBy("doc_id").collect()]
    assert len(model.stages[-1]._blocks()) == 9


def test_numbers_and_missing_values(spark):
    """A step in one feature; a missing number lies above all others."""
    table = spark.range(300).select(array_to_vector(F.array(
        F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("id").cast("double")))).alias("features"),
        F.when((F.col("id") % 10 == 0) | (F.col("id") > 150), 5.0).otherwise(1.0).alias("label"))
    model = RegressionForest(numTrees=15, maxDepth=4, seed=3).fit(table)
    off = model.transform(table).select(F.abs(F.col("prediction") - F.col("label")).alias("d")).agg(F.avg("d")).first()[0]
    assert off < 0.15 and model.featureImportances[0] == 1.0
    with pytest.raises(ValueError):
        Forest().fit(table.limit(0))
