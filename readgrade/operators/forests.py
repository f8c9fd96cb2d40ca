"""Random forests whose trees are grown in the tasks.

Spark's own forest keeps the nodes of all trees, with their statistics, in the driver, and passes over the rows for a group of nodes at
a time. Here a tree is grown in one task from the bins of all rows (16 bytes a row and one for each feature), and trees are stored as
rows of a table. The driver sees the cuts of the bins, sums, and, before a prediction, the bytes of some trees at a time.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from readgrade.operators import trees as T
from readgrade.plans.storage import materialise

# tasks need no copy of this package
cloudpickle.register_pickle_by_value(T)

# a column is cut by so many of its quantiles, of each class apart, and each is right to this share of the rows
QUANTILES, ACCURACY = 1000, 10_000
# sets of trees per core, each grown by one task; bytes of trees that pass through the driver at a time
SETS_PER_CORE, SHIPPED_BYTES = 2, 16 << 20
# what a task holds of a row, followed by a byte for each feature
ROW = [("y", "<f8"), ("w", "<f8")]
TREE = "tree int, feature binary, cut binary, left binary, answers binary, brought array<double>"


def _cuts(rows: DataFrame, features: int, bins: int, by_class: bool) -> tuple[list[list[float]], int]:
    """Cuts of each feature over all rows by weight, and the number of classes."""
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    value = [F.get("x", F.lit(j)) for j in range(features)]
    found = rows.groupBy((F.col("y") if by_class else F.lit(0.0)).alias("y")).agg(
        F.sum("w").alias("w"), *[F.percentile_approx(F.when(~F.isnan(v), v), shares, ACCURACY).alias(f"x{j}") for j, v in enumerate(value)]
    ).collect()  # a row per class
    if not found:
        raise ValueError("a forest needs at least one row")
    found.sort(key=lambda r: r["y"])
    cuts = []
    for j in range(features):
        known = [(r[f"x{j}"], r["w"]) for r in found if r[f"x{j}"]]
        cuts.append(T.cuts_of(np.concatenate([v for v, _ in known]), np.concatenate([np.full(len(v), w / len(v)) for v, w in known]), bins) if known else [])
    return cuts, int(found[-1]["y"]) + 1 if by_class else 0


def _grown(rows: DataFrame, cuts: list[list[float]], classes: int, trees: int, depth: int, tries: int, seed: int) -> DataFrame:
    """A row per tree. Every set of trees gets the bins of all rows, in an order of their own, so that the trees do not depend on where
    the rows came from."""
    kind = np.dtype([*ROW, ("bins", "u1", (len(cuts),))])
    n_bins = max(map(len, cuts)) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = np.empty(batch.num_rows, kind)
                out["y"], out["w"] = (batch.column(c).to_numpy() for c in ("y", "w"))
                out["bins"] = T.bins_of(batch.column("x").flatten().to_numpy().reshape(-1, len(cuts)), cuts)
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["rows"])

    sets = min(trees, SETS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = None, []
        for batch in batches:
            for own, part in zip(batch.column("own").to_pylist(), batch.column("rows")):
                number = own
                parts.append(np.frombuffer(part.as_buffer(), kind))
        if number is None:
            return
        all_rows = np.concatenate(parts)
        order = np.lexsort((all_rows["w"], all_rows["y"], *all_rows["bins"].T))
        bins, y, w = (np.ascontiguousarray(all_rows[c][order]) for c in ("bins", "y", "w"))
        for tree in range(number, trees, sets):
            made = T.grow(bins, y, w, np.random.default_rng([seed, tree]), classes, n_bins, depth, tries)
            columns = [[tree], *([v] for v in T.packed(made).values()), [made["brought"].tolist()]]
            kinds = (pa.int32(), *[pa.binary()] * len(T.PACKED), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], ["tree", *T.PACKED, "brought"])

    packed = rows.mapInArrow(pack, "rows binary")
    dealt = packed.select(F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("own"), "rows").repartitionById(sets, F.col("own"))
    return dealt.mapInArrow(grow, TREE)


def _fit(estimator, table: DataFrame, classifies: bool) -> "GrownForest":
    given = estimator.getOrDefault
    weight = F.col(given("weightCol")) if estimator.isSet("weightCol") else F.lit(1.0)
    rows = table.select(vector_to_array(given("featuresCol")).alias("x"), F.col(given("labelCol")).cast("double").alias("y"), weight.cast("double").alias("w"))
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("a forest needs at least one row")
    features = first[0]
    cuts, classes = _cuts(rows, features, given("maxBins"), classifies)
    # as Spark's "auto": the square root of the features for classes, a third of them for numbers
    tries = int(np.ceil(np.sqrt(features) if classifies else features / 3))
    trees = materialise(_grown(rows, cuts, classes, given("numTrees"), given("maxDepth"), tries, given("seed")), "trees")
    size = F.octet_length("left") / 4
    brought = F.array(*[F.get("brought", F.lit(j)) for j in range(features)])
    total = F.aggregate(brought, F.lit(0.0), lambda a, b: a + b)
    about = trees.agg(F.sum(size).cast("bigint").alias("nodes"), *[
        F.sum(F.when(total > 0, F.get("brought", F.lit(j)) / total).otherwise(0.0)).alias(f"b{j}") for j in range(features)]).first()
    shares = np.array([about[f"b{j}"] for j in range(features)])
    return GrownForest(trees, {"classes": classes, "cuts": cuts, "trees": given("numTrees"), "nodes": about["nodes"],
                               "importances": (shares / shares.sum() if shares.sum() > 0 else shares).tolist(),
                               **{c: given(c) for c in ("featuresCol", "predictionCol") + (("rawPredictionCol", "probabilityCol") if classes else ())}})


class Forest(RandomForestClassifier):
    """Spark's parameters and rules; its settings of memory and node ids mean nothing to trees that are grown in tasks."""

    def _fit(self, dataset: DataFrame) -> "GrownForest":
        return _fit(self, dataset, True)


class RegressionForest(RandomForestRegressor):
    def _fit(self, dataset: DataFrame) -> "GrownForest":
        return _fit(self, dataset, False)


class GrownForest(Model, MLWritable, MLReadable):
    """A table of trees, and what all of them share."""

    def __init__(self, trees: DataFrame | None = None, about: dict | None = None):
        super().__init__()
        self._trees, self._about, self._sent = trees, about, None

    numClasses = property(lambda self: self._about["classes"])
    totalNumNodes = property(lambda self: self._about["nodes"])
    getNumTrees = property(lambda self: self._about["trees"])
    featureImportances = property(lambda self: DenseVector(self._about["importances"]))

    @property
    def toDebugString(self) -> str:
        """All nodes as text, which is as long as the forest is large; cuts are rounded."""
        lines = [f"{type(self).__name__} (uid={self.uid}): {self.getNumTrees} trees, {self.totalNumNodes} nodes"]
        for row in self._trees.orderBy("tree").toLocalIterator():
            lines.append(f"  Tree {row['tree']}")
            feature, cut, left, answers = T.unpacked(row, max(self.numClasses, 1))
            lines += [f"    {i}: answer {answers[to].tolist()}" if f == T.LEAF else f"    {i}: feature {f} <= {self._about['cuts'][f][c]:.9g} to {to}, else {to + 1}"
                      for i, (f, c, to) in enumerate(zip(feature.tolist(), cut.tolist(), left.tolist()))]
        return "\n".join(lines)

    def _blocks(self) -> list:
        """The trees as broadcasts, sent once; the driver holds the bytes of a few trees at a time."""
        if self._sent is None:
            context, sent, block, size = self._trees.sparkSession.sparkContext, [], [], 0
            for row in self._trees.select("tree", *T.PACKED).toLocalIterator():
                block.append({name: bytes(row[name]) for name in T.PACKED} | {"tree": row["tree"]})
                size += sum(len(row[name]) for name in T.PACKED)
                if size >= SHIPPED_BYTES:
                    sent.append(context.broadcast(block))
                    block, size = [], 0
            self._sent = [*sent, context.broadcast(block)] if block else sent
        return self._sent

    def _transform(self, dataset: DataFrame) -> DataFrame:
        blocks, cuts, width = self._blocks(), self._about["cuts"], max(self.numClasses, 1)

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = [T.unpacked(tree, width) for tree in sorted((t for b in blocks for t in b.value), key=lambda t: t["tree"])]
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("forest_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    out = T.votes(trees, T.bins_of(x, cuts), width)
                    found = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, width), pa.int32()), pa.array(out.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], [*batch.schema.names[:-1], "forest_votes"])

        # vectors go through Arrow as arrays
        vectors = [f.name for f in dataset.schema if isinstance(f.dataType, VectorUDT)]
        plain = dataset.withColumns({c: vector_to_array(c) for c in vectors} | {"forest_x": vector_to_array(self._about["featuresCol"])})
        fields = [*plain.schema.fields[:-1], StructField("forest_votes", ArrayType(DoubleType()))]
        raw, total = F.col("forest_votes"), F.lit(float(self.getNumTrees))
        asked = plain.mapInArrow(ask, StructType(fields)).withColumns({c: array_to_vector(c) for c in vectors})
        if not self.numClasses:
            made = {self._about["predictionCol"]: F.get(raw, F.lit(0)) / total}
        else:
            made = {self._about["rawPredictionCol"]: array_to_vector(raw), self._about["probabilityCol"]: array_to_vector(F.transform(raw, lambda v: v / total)),
                    self._about["predictionCol"]: (F.array_position(raw, F.array_max(raw)) - 1).cast("double")}
        return asked.withColumns(made).drop("forest_votes")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: GrownForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, extraMetadata={"forest": self.forest._about})
        self.forest._trees.write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> GrownForest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        forest = GrownForest(self.sparkSession.read.schema(TREE).parquet(f"{path}/trees"), metadata["forest"])
        return forest._resetUid(metadata["uid"])
