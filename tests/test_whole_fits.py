"""Fits use every labelled row, however many there are."""

import pytest
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.operators import classifier as CL

ROWS = 100_450


@pytest.fixture(scope="module")
def many(spark):
    """More rows than a fit used to take; three levels that the first metric tells apart."""
    level = F.element_at(F.array(*[F.lit(v) for v in ("A1.1", "B1.1", "C2")]), (F.col("id") % 3 + 1).cast("int"))
    noise = [(F.col("id") % 3 * 2.0 + F.pmod(F.xxhash64("id", F.lit(m)), F.lit(1000)) / 600.0).alias(m) for m in dict.fromkeys(C.METRICS + CL.SURFACE)]
    return spark.range(ROWS).select(F.col("id").alias("doc_id"), level.alias("predict_level"), *noise).persist()


class Seen(Exception):
    pass


def seen_by(monkeypatch, call) -> list[int]:
    """Row counts of the tables that a pipeline is fitted to; the fit itself is left out."""
    seen = []

    def fit(self, table, params=None):
        seen.append(table.count())
        raise Seen

    monkeypatch.setattr(CL.Pipeline, "fit", fit)
    with pytest.raises(Seen):
        call()
    return seen


@pytest.mark.parametrize("call", [lambda t: CL.fit(t, "forest"), lambda t: CL.fit(t, "logistic"), lambda t: CL.calibrate(t),
                                  lambda t: CL.fit_regressor(t)], ids=["forest", "logistic", "calibrated", "regressor"])
def test_all_rows_are_fitted(call, many, monkeypatch):
    assert max(seen_by(monkeypatch, lambda: call(many))) == ROWS


def test_all_rows_are_validated(many, monkeypatch):
    """Four of five folds of all rows at a time."""
    assert seen_by(monkeypatch, lambda: CL.choose(many))[0] == pytest.approx(0.8 * ROWS, abs=10)


def test_the_flow_learns_from_the_whole_training_part(many, monkeypatch, tmp_path):
    sizes = []
    monkeypatch.setattr(CL, "choose", lambda train: sizes.append(train.count()) or [("logistic", 1.0)])
    seen_by(monkeypatch, lambda: CL.train_and_save(many.unionByName(many.withColumn("doc_id", F.col("doc_id") + ROWS)), str(tmp_path)))
    assert sizes[0] == pytest.approx(0.8 * 2 * ROWS, abs=10)


def test_partitions_grow_with_the_rows(many):
    assert CL.dealt(many).rdd.getNumPartitions() == -(-ROWS // CL.PARTITION_ROWS) > CL.FIT_PARTITIONS
    assert CL.dealt(many.limit(100)).rdd.getNumPartitions() == CL.FIT_PARTITIONS
