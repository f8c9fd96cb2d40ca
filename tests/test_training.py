"""Training data and a small classifier."""

import pytest
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.operators import classifier as CL, training as TR
from readgrade.sources import tables


def test_text_ids(spark):
    rows = spark.createDataFrame([("Text_7.txt", "text_7"), (" TEXT-07.v2.md", "text_07"), ("my text 3", "text_3"), ("Essay.txt", "essay")],
                                 "name string, want string")
    assert rows.where(TR.text_id(F.col("name")) != F.col("want")).count() == 0


def test_label_map_by_values(spark):
    base = spark.createDataFrame([(1, "x", "Text 1", "A1.1"), (2, "y", "text_1", "B1.1"), (3, "z", "other", None)],
                                 "seq int, note string, Material string, predict_level string")
    assert TR.name_column(base.drop("seq")) == "Material"
    assert {r["text_id"]: r["predict_level"] for r in TR.label_map(base).collect()} == {"text_1": "B1.1"}


def test_merge_prefers_the_base(spark):
    base = spark.createDataFrame([(1, "a", 1.0, "A1.1"), (2, None, 2.0, "C1")], "seq int, filename string, ARI double, predict_level string")
    new = spark.createDataFrame([(0, "a", 9.0, "C2"), (0, "b", 3.0, "C2")], "seq int, filename string, ARI double, predict_level string")
    got = {r["filename"]: r["ARI"] for r in TR.merge_training(base, new).collect()}
    assert got == {"a": 1.0, None: 2.0, "b": 3.0}
    assert TR.merge_training(base.drop("filename"), new).count() == 4
    assert TR.training_columns(base).columns == ["filename", *C.METRICS, "predict_level"]


def test_split_matches_a_plain_window(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("L"), (F.col("id") % 3).cast("string")).alias("predict_level"))
    rows = rows.unionByName(spark.createDataFrame([(1000, "single")], "doc_id bigint, predict_level string"))
    got = {r["doc_id"]: (r["rn"], r["is_test"]) for r in TR.split(rows).collect()}
    import hashlib
    for level in ("L0", "L1", "L2", "single"):
        ids = sorted((r["doc_id"] for r in rows.where(F.col("predict_level") == level).collect()),
                     key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        want = min(-(-len(ids) // 5), len(ids) - 1)
        assert [got[i] for i in ids] == [(n, n <= want) for n in range(1, len(ids) + 1)]


def test_split_without_classes(spark):
    rows = spark.range(10).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("predict_level"))
    got = TR.split(rows, stratify=False)
    assert got.where("is_test").count() == 2 and "all_rows" not in got.columns


def test_tolerant_list(spark):
    table = spark.createDataFrame([(1, "cat", "A1"), (2, None, "A2")], "seq int, `見出し語` string, Level string")
    assert [tuple(r) for r in tables.tolerant_wordlist(table).collect()] == [(1, "cat", "A1")]
    with pytest.raises(ValueError):
        tables.tolerant_wordlist(table.drop("Level"))
    assert tables.missing_columns(table) == C.METRICS + ["predict_level"]


@pytest.fixture(scope="module")
def labelled(spark):
    level = F.element_at(F.array(*[F.lit(v) for v in ("A1.1", "B1.1", "C2")]), (F.col("id") % 3 + 1).cast("int"))
    noise = [((F.col("id") % 3) * 2.0 + (F.hash("id", F.lit(m)) % 100) / 80.0).alias(m) for m in C.METRICS]
    return spark.range(90).select(F.col("id").alias("doc_id"), level.alias("predict_level"), *noise)


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    monkeypatch.setattr(CL, "TREES", 12)
    monkeypatch.setattr(CL, "DEEPEST", 5)


def check(predicted, n):
    rows = predicted.collect()
    assert len(rows) == n
    for r in rows:
        assert r["predicted_level"] in ("A1.1", "B1.1", "C2") and 1 / 3 - 1e-9 <= r["confidence"] <= 1 + 1e-9
        assert sum(r["scores"]) == pytest.approx(1.0)
    return sorted((r["doc_id"], r["predicted_level"], r["confidence"]) for r in rows)


def test_predictions(labelled, tmp_path):
    model = CL.fit(labelled)
    first = check(CL.predict(model, labelled), 90)
    assert first == check(CL.predict(CL.fit(labelled), labelled), 90)
    model.write().overwrite().save(str(tmp_path / "m"))
    assert first == check(CL.predict(CL.PipelineModel.load(str(tmp_path / "m")), labelled), 90)
    holes = labelled.withColumn("ARI", F.lit(None).cast("double"))
    check(CL.predict(model, holes), 90)
    assert CL.accuracy(CL.predict(model, labelled)).first()["accuracy"] > 0.8
    assert CL.importances(model, labelled.sparkSession).count() == 5


def test_logistic_and_choice(labelled):
    check(CL.predict(CL.fit(labelled, "logistic"), labelled), 90)
    ranked = CL.choose(labelled)
    assert {k for k, _ in ranked} == {"forest", "logistic"} and ranked[0][1] >= ranked[1][1]
    few = labelled.where("doc_id < 3")
    assert CL.choose(few)[0][0] == "forest" and isinstance(CL.calibrate(few), CL.PipelineModel)


def test_calibration(labelled, tmp_path):
    model = CL.calibrate(labelled)
    first = check(CL.predict(model, labelled), 90)
    model.save(str(tmp_path / "c"))
    assert first == check(CL.predict(CL.Calibrated.load(str(tmp_path / "c")), labelled), 90)


def test_untrained(labelled):
    row = CL.predict(None, labelled).first()
    assert (row["predicted_level"], row["confidence"]) == ("B1.1", 0.5)


def test_flow_from_table_to_saved_model(labelled, tmp_path):
    assert CL.train_and_save(labelled.drop("ARI"), str(tmp_path / "none")) is None
    model, predicted = CL.train_and_save(labelled, str(tmp_path / "flow"))
    first = check(predicted, 18)
    loaded = CL.Calibrated.load(str(tmp_path / "flow")) if isinstance(model, CL.Calibrated) else CL.PipelineModel.load(str(tmp_path / "flow"))
    assert first == check(CL.predict(loaded, predicted.drop("scores", "predicted_level", "confidence")), 18)


def test_rows_keep_their_node_where_the_chain_can_end(labelled, monkeypatch):
    """Same trees either way; without a checkpoint folder the chain of passes would grow."""
    trees = []
    for kept in (False, True):
        monkeypatch.setattr(CL, "_node_ids", lambda kept=kept: kept)
        assert CL.forest(90).getCacheNodeIds() is kept
        trees.append(CL.fit(labelled).stages[-1].toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1]
