"""Level classifier on the eight metrics with Spark ML (ML5, ML8, ML10-ML18).

Fitting passes over all rows of a training table; what reaches the driver is the
model and the class list, never the rows.
"""

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from readgrade import fixed as C
from readgrade.operators import training as TR
from readgrade.operators.forests import Forest, RegressionForest
from readgrade.operators.logistic import NewtonOneVsRest
from readgrade.plans.storage import discard, materialise
from readgrade.sources.tables import missing_columns

# fixed values: settings of the two candidate models
TREES, DEEPEST, SEED = 300, 30, 42
ITERATIONS = 2000
PENALTY = 1.0
REGRESSION_TREES = 100
MOST_FOLDS = 5
CALIBRATION_FOLDS = (2, 3)
SURFACE = ["flesch", "ARI", "coleman_liau", "n_ws_words", "n_dot_pieces"]
# a fit uses all labelled rows, in this many partitions or more, so that none holds more than the second number on average. They
# are dealt by a hash of their values, so a fit does not depend on how the table was partitioned.
FIT_PARTITIONS, PARTITION_ROWS = 4, 25_000
FITS_AT_A_TIME = 2
# scores are added up in so many bins before a curve is fitted to them
CURVE_BINS = 1000


# ---- preparation -----------------------------------------------------------------

def indexer() -> StringIndexer:
    return StringIndexer(inputCol="predict_level", outputCol="label", stringOrderType="alphabetAsc")


def _features(columns: list[str]) -> list:
    return [VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]


def scaler(train: DataFrame, columns: list[str] = C.METRICS) -> PipelineModel:
    """Standardisation learnt from the training part only."""
    return Pipeline(stages=_features(columns)).fit(train)


def weighted(train: DataFrame) -> DataFrame:
    """Add balanced class weights; the weight table has one row per class."""
    return train.join(F.broadcast(TR.class_weights(train).drop("n_class")), "predict_level")


def _node_ids() -> bool:
    """Whether passes over the rows may build on each other: only with a checkpoint folder that ends the chain. Trees that are grown in
    tasks make no such passes and are the same either way."""
    return SparkSession.active().sparkContext.getCheckpointDir() is not None


def forest(rows: int) -> Forest:
    return Forest(numTrees=TREES, maxDepth=DEEPEST, seed=SEED, weightCol="weight", cacheNodeIds=_node_ids())


def logistic(rows: int) -> NewtonOneVsRest:
    """One model per class, all in the same passes; penalty ``PENALTY / rows`` on the mean loss is a unit penalty on its sum."""
    one = LogisticRegression(maxIter=ITERATIONS, regParam=PENALTY / max(rows, 1))
    return NewtonOneVsRest(classifier=one, weightCol="weight")


CANDIDATES = {"forest": forest, "logistic": logistic}


def pipeline(kind: str, rows: int) -> Pipeline:
    return Pipeline(stages=[indexer(), *_features(C.METRICS), CANDIDATES[kind](rows)])


# ---- fitting and choice ----------------------------------------------------------------

def dealt(train: DataFrame, partitions: int | None = None) -> DataFrame:
    """All rows, dealt by a hash of their values and ordered by it, so that a repeated fit sees the same partitions."""
    columns = sorted(c for c, kind in train.dtypes if kind in ("double", "string", "bigint", "int"))
    if partitions is None:
        partitions = max(FIT_PARTITIONS, -(-train.count() // PARTITION_ROWS))
    keyed = train.withColumn("fit_key", F.xxhash64(*columns))
    return keyed.repartition(partitions, "fit_key").sortWithinPartitions("fit_key", *columns).drop("fit_key")


def fit(train: DataFrame, kind: str = "forest", partitions: int | None = None) -> PipelineModel:
    ready = weighted(dealt(train, partitions)).persist()
    model = pipeline(kind, ready.count()).fit(ready)
    ready.unpersist()
    return model


def rarest(train: DataFrame) -> int:
    return train.groupBy("predict_level").count().agg(F.min("count")).first()[0] or 0


def with_folds(train: DataFrame, k: int) -> DataFrame:
    """Stratified folds: the row number within the class modulo ``k``."""
    base = train.drop("rn", "n_class", "is_test")
    return TR.numbered(base).withColumn("fold", (F.col("rn") % k).cast("int")).drop("rn", "n_class")


def _side_by_side(spark: SparkSession, calls: list[tuple]) -> list:
    """Results of calls that fit models, a few at a time, as a fit of a small table leaves cores idle."""
    with ThreadPool(FITS_AT_A_TIME) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda call: call[0](*call[1:])), calls, chunksize=1)


def choose(train: DataFrame) -> list[tuple[str, float]]:
    """Candidates with their cross-validated accuracy, best first; the forest wins a tie.

    With fewer than two rows in the rarest class there is no validation and the forest is taken.
    """
    k = min(MOST_FOLDS, rarest(train))
    if k < 2:
        return [("forest", float("nan"))]
    # stored, as every job of the fits carries the plan of its table
    stored = materialise(with_folds(train, k), "folded")
    folded = weighted(dealt(stored)).persist()
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    n = folded.count()

    def validated(kind: str, fold: int) -> float:
        model = pipeline(kind, n).fit(folded.where(F.col("fold") != fold))
        return accuracy.evaluate(model.transform(folded.where(F.col("fold") == fold)))

    shares = _side_by_side(folded.sparkSession, [(validated, kind, i) for kind in CANDIDATES for i in range(k)])
    folded.unpersist()
    discard(stored)
    scores = [(kind, sum(shares[i * k:(i + 1) * k]) / k) for i, kind in enumerate(CANDIDATES)]
    return sorted(scores, key=lambda s: -s[1])


def importances(model: PipelineModel, spark, top: int = 5) -> DataFrame:
    """The most important metrics of the forest, which is the base model under any calibration."""
    weights = model.stages[-1].featureImportances
    rows = sorted(((m, float(weights[i])) for i, m in enumerate(C.METRICS)), key=lambda r: -r[1])[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


# ---- prediction ---------------------------------------------------------------------------

def class_scores(predicted: DataFrame) -> Column:
    """Scores per class that sum to 1, as an array."""
    if "probability" in predicted.columns:
        return vector_to_array("probability")
    raw = F.transform(vector_to_array("rawPrediction"), lambda v: 1.0 / (1.0 + F.exp(-v)))
    return F.transform(raw, lambda v: v / F.aggregate(raw, F.lit(0.0), lambda a, b: a + b))


def labels_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def _transform(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Apply a fitted pipeline to unlabelled rows; a missing metric, the whole column or a value, counts as 0."""
    filled = rows.withColumns({m: F.lit(0.0) for m in C.METRICS if m not in rows.columns}).na.fill(0.0, C.METRICS)
    return PipelineModel(model.stages[1:]).transform(filled.drop("label"))


def _level(scores: Column, labels: list[str]) -> tuple[Column, Column]:
    top = F.array_max(scores)
    return F.element_at(F.array(*[F.lit(v) for v in labels]), F.array_position(scores, top).cast("int")), top


def predict(model: "PipelineModel | Calibrated | None", rows: DataFrame) -> DataFrame:
    """Add ``predicted_level`` and ``confidence``; without a model the fixed answer for untrained systems."""
    if model is None:
        level, confidence = C.UNTRAINED_ANSWER
        return rows.select("*", F.lit(level).alias("predicted_level"), F.lit(confidence).alias("confidence"))
    if isinstance(model, Calibrated):
        scored, labels = model.scores(rows), model.labels
    else:
        predicted, labels = _transform(model, rows), labels_of(model)
        scored = predicted.select(*rows.columns, class_scores(predicted).alias("scores"))
    level, confidence = _level(F.col("scores"), labels)
    return scored.select(*rows.columns, "scores", level.alias("predicted_level"), confidence.alias("confidence"))


def accuracy(predicted: DataFrame, label: str = "predict_level") -> DataFrame:
    hit = (F.col("predicted_level") == F.col(label)).cast("bigint")
    return predicted.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


# ---- calibration ------------------------------------------------------------------------------

class Calibrated:
    """A base model with one isotonic curve per class (Zadrozny & Elkan 2002)."""

    def __init__(self, base: PipelineModel, curves: list[IsotonicRegressionModel]):
        self.base, self.curves, self.labels = base, curves, labels_of(base)

    def scores(self, rows: DataFrame) -> DataFrame:
        predicted = _transform(self.base, rows)
        spread = predicted.select(*rows.columns, class_scores(predicted).alias("s"))
        spread = spread.select(*rows.columns, *[F.get("s", F.lit(i)).alias(f"s{i}") for i in range(len(self.labels))])
        spread = reduce(lambda df, curve: curve.transform(df), self.curves, spread)
        outs = [F.col(f"c{i}") for i in range(len(self.labels))]
        total = sum(outs[1:], outs[0])
        even = F.lit(1.0 / len(outs))
        return spread.select(*rows.columns, F.array(*[F.when(total > 0, c / total).otherwise(even) for c in outs]).alias("scores"))

    def save(self, path: str) -> None:
        self.base.write().overwrite().save(f"{path}/base")
        for i, curve in enumerate(self.curves):
            curve.write().overwrite().save(f"{path}/curve-{i}")

    @staticmethod
    def load(path: str) -> "Calibrated":
        base = PipelineModel.load(f"{path}/base")
        return Calibrated(base, [IsotonicRegressionModel.load(f"{path}/curve-{i}") for i in range(len(labels_of(base)))])


def calibrate(train: DataFrame, kind: str = "forest") -> "Calibrated | PipelineModel":
    """Isotonic curves on out-of-fold scores; the raw model when a class is too small to be in every fold."""
    smallest = rarest(train)
    low, high = CALIBRATION_FOLDS
    k = max(low, min(high, smallest))
    if smallest < k:
        return fit(train, kind)
    folded = materialise(with_folds(train, k), "folded")
    base, *others = _side_by_side(train.sparkSession, [(fit, folded, kind), *[(fit, folded.where(F.col("fold") != i), kind) for i in range(k)]])
    parts = []
    for i, model in enumerate(others):
        predicted = _transform(model, folded.where(F.col("fold") == i))
        parts.append(predicted.select("predict_level", class_scores(predicted).alias("s")))
    labels = labels_of(base)
    right = F.col("predict_level") == F.get(F.array(*[F.lit(v) for v in labels]), F.col("i"))
    points = reduce(DataFrame.unionByName, parts).select("predict_level", F.posexplode("s").alias("i", "score")).groupBy(
        "i", F.floor(F.col("score") * CURVE_BINS).alias("bin")).agg(
        F.avg("score").alias("score"), F.avg(right.cast("double")).alias("hit"), F.count(F.lit(1)).cast("double").alias("n")).persist()
    points.count()

    def curve(i: int) -> IsotonicRegressionModel:
        own = points.where(F.col("i") == i).select(F.col("score").alias(f"s{i}"), "hit", "n").coalesce(1)
        return IsotonicRegression(featuresCol=f"s{i}", labelCol="hit", predictionCol=f"c{i}", weightCol="n").fit(own)

    curves = _side_by_side(train.sparkSession, [(curve, i) for i in range(len(labels))])
    points.unpersist()
    discard(folded)
    return Calibrated(base, curves)


def train_and_save(labelled: DataFrame, path: str) -> "tuple[Calibrated | PipelineModel, DataFrame] | None":
    """The whole flow: skip a table that lacks columns, split (by class if every class has two rows), choose, calibrate, save.

    Gives the model and the test part with its predictions, or None if columns are missing.
    """
    if missing_columns(labelled):
        return None
    stratify = rarest(labelled) >= 2
    parts = materialise(TR.split(labelled, stratify=stratify), "parts")
    train = parts.where("NOT is_test")
    model = calibrate(train, choose(train)[0][0])
    model.save(path) if isinstance(model, Calibrated) else model.write().overwrite().save(path)
    return model, predict(model, parts.where("is_test"))


# ---- regression on surface features --------------------------------------------------------------

def fit_regressor(train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Forest that predicts the encoded level from the five surface features."""
    ready = dealt(train.select("predict_level", *SURFACE), partitions).persist()
    model = Pipeline(stages=[
        indexer(), VectorAssembler(inputCols=SURFACE, outputCol="features"),
        RegressionForest(numTrees=REGRESSION_TREES, maxDepth=DEEPEST, seed=SEED, cacheNodeIds=_node_ids())]).fit(ready)
    ready.unpersist()
    return model
