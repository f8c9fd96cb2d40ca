"""One-vs-rest logistic regression by Newton's method, all classes in each pass.

The penalised loss is that of Spark's ``LogisticRegression`` and has one minimum. Spark nears it by its gradient, class by class,
with a job for every step; here a pass brings the gradient and the curvature of all classes, and about ten passes reach it.
"""

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel, OneVsRest, OneVsRestModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import DataFrame, functions as F

# a class is done when a step promises less than this share of its loss
ENOUGH = 1e-12
# a step must bring this share of what its slope promises, or is halved, so many times at most
ARMIJO, HALVINGS = 1e-4, 30


def _added(rows: DataFrame, per_batch, sizes: list[int]) -> list[np.ndarray]:
    """Sums over all rows of the arrays that ``per_batch(x, y, w)`` gives: a row per partition reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(sizes))
        for batch in batches:
            if batch.num_rows:
                y, w = (batch.column(c).to_numpy() for c in ("y", "w"))
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                total += np.concatenate([np.ravel(v) for v in per_batch(x, y, w)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = rows.mapInArrow(run, "sums binary").collect()
    return np.split(np.sum([np.frombuffer(r["sums"]) for r in parts], axis=0), np.cumsum(sizes)[:-1])


def _pass(points: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    """Loss, gradient and curvature of each class at its point (slopes, then the constant)."""
    classes, width = points.shape

    def per_batch(x, y, w):
        z = np.concatenate(((x - mean) * scale, np.ones((len(x), 1))), axis=1)
        score = z @ points.T
        own = y[:, None] == np.arange(classes)
        p = 1 / (1 + np.exp(-np.clip(score, -700, 700)))
        loss = w @ np.logaddexp(0, np.where(own, -score, score))
        bend = w[:, None] * p * (1 - p)
        return loss, ((p - own) * w[:, None]).T @ z, np.stack([(z * bend[:, [k]]).T @ z for k in range(classes)])

    return per_batch, [classes, classes * width, classes * width * width]


def _solve(rows: DataFrame, penalty: float, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes, features) coefficients and constants."""
    top = rows.agg(F.max("y").alias("y"), F.first(F.size("x")).alias("n")).first()
    if top["y"] is None:
        raise ValueError("a regression needs at least one row")
    classes, n = int(top["y"]) + 1, top["n"]
    own, w2, sums = _added(rows, lambda x, y, w: (np.bincount(y.astype(int), w, classes), (w * w).sum(), w @ x), [classes, 1, n])
    total = own.sum()
    mean = sums / total
    [squares] = _added(rows, lambda x, y, w: (w @ (x - mean) ** 2,), [n])
    # the penalty is on coefficients of features of unit deviation, as in Spark; a constant feature has none
    rest = total - w2[0] / total
    spread = np.sqrt(squares / rest) if rest > 0 else np.zeros(n)
    scale = np.divide(1.0, spread, out=np.zeros(n), where=spread != 0)
    ridge = np.append(np.full(n, penalty), 0.0)
    # a constant feature has no curvature but the penalty's; without one it would leave the system open
    open_ends = np.diag(np.append((scale == 0) * 1.0, 0.0))

    points = np.zeros((classes, n + 1))
    with np.errstate(divide="ignore"):
        points[:, -1] = np.log(own) - np.log(total - own)
    live = np.isfinite(points[:, -1]) & np.isfinite(scale).all()
    at, step, size = points.copy(), np.zeros_like(points), np.ones(classes)
    best, slope, halved = np.full(classes, np.inf), np.zeros(classes), np.zeros(classes, int)
    for _ in range(passes):
        if not live.any():
            break
        trial = np.where(live[:, None], at + size[:, None] * step, 0.0)
        loss, gradient, bend = _added(rows, *_pass(trial, mean, scale))
        loss = loss / total + (ridge * trial ** 2).sum(1) / 2
        gradient = gradient.reshape(trial.shape) / total + ridge * trial
        bend = bend.reshape(classes, n + 1, n + 1) / total + np.diag(ridge) + open_ends
        for k in np.flatnonzero(live):
            if not np.isfinite(loss[k]) or loss[k] > best[k] + ARMIJO * size[k] * slope[k]:
                size[k], halved[k] = size[k] / 2, halved[k] + 1
                live[k] = halved[k] < HALVINGS
                continue
            at[k], best[k], size[k], halved[k] = trial[k], loss[k], 1.0, 0
            step[k] = -np.linalg.lstsq(bend[k], gradient[k], rcond=None)[0]
            slope[k] = gradient[k] @ step[k]
            if -slope[k] <= ENOUGH * max(loss[k], 1e-300):
                live[k] = False
    slopes = at[:, :-1] * scale
    return slopes, at[:, -1] - slopes @ np.where(np.isfinite(mean), mean, 0.0)


class NewtonOneVsRest(OneVsRest):
    """Spark's estimator and model; only the way to the minimum differs."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        one = self.getClassifier()
        weight = F.col(self.getWeightCol()) if self.isDefined(self.weightCol) else F.lit(1.0)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"),
                              weight.cast("double").alias("w")).persist()
        coefficients, constants = _solve(rows, one.getRegParam(), one.getMaxIter())
        rows.unpersist()
        context, models = dataset.sparkSession.sparkContext, []
        for slopes, constant in zip(coefficients, constants):
            made = JavaParams._new_java_obj("org.apache.spark.ml.classification.LogisticRegressionModel", f"LogisticRegression_{uuid4().hex[:12]}",
                                            _py2java(context, DenseVector(slopes)), float(constant))
            models.append(one._copyValues(LogisticRegressionModel(made), {one.featuresCol: self.getFeaturesCol(), one.predictionCol: self.getPredictionCol()}))
        return self._copyValues(OneVsRestModel(models=models))
