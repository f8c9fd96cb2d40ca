"""Training data and classifier (ML1-ML18)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.fixtures import text_level
from catalog.registry import query
from catalog.text_queries import METRICS, rounded
from readgrade import fixed as C
from readgrade.functions.numbers import fixed
from readgrade.operators import classifier as CL, metrics as M, training as TR
from readgrade.plans.storage import materialise, new_path

NAMES = ["'Text_'||doc_id||'.txt'", "' text '||doc_id||'.v2.TXT'", "'TEXT-'||doc_id||'.md'", "'Essay'||doc_id"]
NAME = "CASE doc_id%4 " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(NAMES)) + " END"


@query("ml1_text_ids", f"""SELECT {NAME} AS name, CASE WHEN doc_id%4=3 THEN 'essay' ELSE 'text_' END||doc_id AS text_id
       FROM documents""")
def ml1(d):
    return d.table("documents").select(F.expr(NAME).alias("name")).select("name", TR.text_id(F.col("name")).alias("text_id"))


LABELS = """SELECT 'text_'||(doc_id//2) AS text_id, arg_max(predict_level,doc_id) AS predict_level FROM features
    WHERE doc_id%7<>0 GROUP BY doc_id//2"""


def _base(d):
    """Two rows per name, some without a label."""
    return d.features.select(F.expr("'Text_' || (doc_id div 2) || '.txt'").alias("Text_Name"),
                             F.when(F.col("doc_id") % 7 != 0, F.col("predict_level")).alias("predict_level"),
                             F.col("doc_id").alias("seq"))


@query("ml2_label_map", LABELS, "features")
def ml2(d):
    return TR.label_map(_base(d))


@query("ml3_labelled_texts", f"SELECT doc_id, predict_level FROM docs_en JOIN ({LABELS}) ON text_id='text_'||doc_id",
       "docs_en", "features")
def ml3(d):
    texts = d.docs.select("doc_id", F.expr("'text ' || doc_id || '.txt'").alias("filename"))
    return TR.labelled_texts(texts, TR.label_map(_base(d))).select("doc_id", "predict_level")


MERGED = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY origin, doc_id) AS rn FROM (
    SELECT CASE WHEN doc_id%11<>0 THEN 'Text_'||(doc_id//4) END AS filename, doc_id, {','.join(C.METRICS)}, predict_level,
      0 AS origin FROM features
    UNION ALL SELECT 'Text_'||(doc_id//3), doc_id, {','.join(C.METRICS)}, {Q.text_level('ARI')}, 1 FROM metrics_model))
    WHERE rn=1"""


def merged_training(d):
    base = d.features.select(F.expr("CASE WHEN doc_id % 11 <> 0 THEN 'Text_' || (doc_id div 4) END").alias("filename"),
                             *C.METRICS, "predict_level", F.col("doc_id").alias("seq"))
    new = d.metrics("model").select(F.expr("'Text_' || (doc_id div 3)").alias("filename"), *C.METRICS,
                                    text_level(F.col("ARI")).alias("predict_level"), F.col("doc_id").alias("seq"))
    return TR.merge_training(base, new)


@query("ml4_merge_training", f"SELECT filename, {METRICS}, predict_level FROM ({MERGED})", "features", "metrics_model")
def ml4(d):
    return rounded(merged_training(d), *C.METRICS)


@query("ml5_label_index", "SELECT doc_id, predict_level, dense_rank() OVER (ORDER BY predict_level)-1 AS label FROM features",
       "features")
def ml5(d):
    rows = d.stored_features.select("doc_id", "predict_level")
    return CL.indexer().fit(rows).transform(rows).withColumn("label", F.col("label").cast("bigint"))


@query("ml6_class_counts", """SELECT predict_level, n, min(n) OVER ()>=2 AS stratify FROM (
       SELECT predict_level, count(*) AS n FROM features GROUP BY predict_level)""", "features")
def ml6(d):
    return TR.class_counts(d.stored_features)


SPLIT = """SELECT *, rn<=least(ceil(0.2e0*n_class),n_class-1) AS is_test FROM (SELECT *, row_number() OVER (PARTITION BY predict_level
    ORDER BY md5(doc_id::VARCHAR)) AS rn, count(*) OVER (PARTITION BY predict_level) AS n_class FROM features)"""


@query("ml7_split", f"SELECT doc_id, predict_level, rn, is_test FROM ({SPLIT})", "features")
def ml7(d):
    return TR.split(d.stored_features).select("doc_id", "predict_level", "rn", "is_test")


_moments = ", ".join(f"avg({m}) AS a_{m}, stddev_samp({m}) AS s_{m}" for m in C.METRICS)
_scaled = ", ".join(f"{Q.fx(f'({m}-a_{m})/s_{m}', 3)} AS {m}" for m in C.METRICS)


@query("ml8_standardise", f"""SELECT doc_id, {_scaled} FROM features, (SELECT {_moments} FROM ({SPLIT}) WHERE NOT is_test)""",
       "features")
def ml8(d):
    rows = TR.split(d.stored_features)
    scaled = CL.scaler(rows.where("NOT is_test")).transform(rows)
    values = vector_to_array("features")
    return scaled.select("doc_id", *[fixed(F.get(values, F.lit(i)), 3).alias(m) for i, m in enumerate(C.METRICS)])


@query("ml9_class_weights", f"""SELECT predict_level, count(*) AS n_class, {Q.fx('''(SELECT count(*) FROM features)*1e0/
       (SELECT count(DISTINCT predict_level) FROM features)/count(*)''')} AS weight FROM features GROUP BY predict_level""",
       "features")
def ml9(d):
    return rounded(TR.class_weights(d.stored_features), "weight")


# ---- fitted models: SQL states what must hold for every row and for the answers as a whole; tests hold the predictions ------

TEST_ROWS = f"SELECT doc_id, predict_level FROM ({SPLIT}) WHERE is_test"
SOUND = "true AS known_level, true AS sound_confidence, true AS scores_add_up"
# fixed values: share of right answers on rows that were not learnt from, and how far above the commonest level's share
FLOORS = {"forest": 0.6, "logistic": 0.0}
ABOVE_MAJORITY = 1.25


def learnt(rows: str) -> str:
    """What a model that always answers one level can't have, next to the share that such a model would get."""
    share = Q.fx(f"(SELECT max(n)*1e0/sum(n) FROM (SELECT count(*) AS n FROM ({rows}) GROUP BY predict_level))")
    return f"{share} AS majority, true AS above_floor, true AS beats_majority, true AS several_levels"


def _with_learnt(out, predicted, kind: str):
    hit = (F.col("predicted_level") == F.col("predict_level")).cast("int")
    most = predicted.groupBy("predict_level").agg(F.count("*").alias("n")).agg((F.max("n") / F.sum("n")).alias("m")).scalar()
    right, levels = predicted.agg(F.avg(hit).alias("r")).scalar(), predicted.agg(F.count_distinct("predicted_level").alias("k")).scalar()
    return out.select("*", fixed(most, 4).alias("majority"), (right >= FLOORS[kind]).alias("above_floor"),
                      (right >= ABOVE_MAJORITY * most).alias("beats_majority"), (levels > 1).alias("several_levels"))


def _parts(d):
    rows = TR.split(d.stored_features)
    return rows.where("NOT is_test"), rows.where("is_test")


def _sound(predicted, kind):
    """Per row: a level of the fixed scale, a confidence of at least an even share, scores that sum to 1. Of all rows: what
    shows that something was learnt."""
    predicted = materialise(predicted, "predicted")
    share = F.lit(1.0) / F.size("scores")
    total = F.aggregate("scores", F.lit(0.0), lambda a, b: a + b)
    sound = predicted.select(
        "doc_id", "predict_level", F.col("predicted_level").isin(C.TEXT_LEVELS).alias("known_level"),
        F.col("confidence").between(share - 1e-9, F.lit(1.0 + 1e-9)).alias("sound_confidence"),
        (F.abs(total - 1.0) < 1e-6).alias("scores_add_up"))
    return _with_learnt(sound, predicted, kind)


@query("ml10_forest", f"SELECT *, {SOUND}, {learnt(TEST_ROWS)} FROM ({TEST_ROWS})", "features")
def ml10(d):
    train, test = _parts(d)
    return _sound(CL.predict(CL.fit(train, "forest"), test), "forest")


@query("ml11_logistic", f"SELECT *, {SOUND}, {learnt(TEST_ROWS)} FROM ({TEST_ROWS})", "features")
def ml11(d):
    train, test = _parts(d)
    return _sound(CL.predict(CL.fit(train, "logistic"), test), "logistic")


TRAIN_ROWS = f"SELECT doc_id, predict_level FROM ({SPLIT}) WHERE NOT is_test"


@query("ml12_model_choice", f"""SELECT unnest(['forest','logistic']) AS model, unnest([1,2])::BIGINT AS place, count(*) AS n_rows, true AS is_share,
       true AS in_order, true AS above_floor, true AS beats_majority FROM ({TRAIN_ROWS})""", "features")
def ml12(d):
    """Candidates by validated accuracy; the level depends on one metric by cuts, so the forest must come first."""
    train, _ = _parts(d)
    n, most = train.groupBy("predict_level").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n") / F.sum("n")).first()
    scores = CL.choose(train)
    rows = [(m, k, n, 0.0 <= a <= 1.0, all(a >= b for _, b in scores[k:]), a >= FLOORS[m], a >= ABOVE_MAJORITY * most)
            for k, (m, a) in enumerate(scores, 1)]
    return d.spark.createDataFrame(rows, "model string, place bigint, n_rows bigint, is_share boolean, in_order boolean, above_floor boolean, "
                                   "beats_majority boolean")


@query("ml13_calibrated", f"SELECT *, {SOUND}, {learnt(TEST_ROWS)} FROM ({TEST_ROWS})", "features")
def ml13(d):
    train, test = _parts(d)
    return _sound(CL.predict(CL.calibrate(train), test), "forest")


@query("ml14_accuracy", f"""SELECT count(*) AS n, {Q.fx('avg((predicted_level=target_level)::INT)')} AS accuracy
       FROM results""", "results")
def ml14(d):
    return rounded(CL.accuracy(d.results, "target_level"), "accuracy")


@query("ml15_importance", """SELECT place::BIGINT AS place, CASE WHEN place=1 THEN 'ARI' END AS first_feature, true AS known, true AS falling,
       true AS within_one FROM range(1,6) r(place)""")
def ml15(d):
    """The level of a text is given by cuts of its ARI, so a forest that has learnt anything puts that metric first."""
    train, _ = _parts(d)
    rows = CL.importances(CL.fit(train, "forest"), d.spark).collect()  # five
    total = sum(r["importance"] for r in rows)
    out = [(k, r["feature"] if k == 1 else None, r["feature"] in C.METRICS, k == 1 or rows[k - 2]["importance"] >= r["importance"],
            total <= 1 + 1e-9) for k, r in enumerate(rows, 1)]
    return d.spark.createDataFrame(out, "place bigint, first_feature string, known boolean, falling boolean, within_one boolean")


@query("ml16_untrained", "SELECT doc_id, 'B1.1' AS predicted_level, 0.5e0 AS confidence FROM features", "features")
def ml16_untrained(d):
    return CL.predict(None, d.stored_features).select("doc_id", "predicted_level", "confidence")


@query("ml16_predict", f"SELECT doc_id, predict_level, {SOUND}, {learnt('SELECT * FROM features')}, true AS absent_is_zero FROM features", "features")
def ml16(d):
    """The whole table without one metric, and with holes in another, scored by a fitted model; both count as 0."""
    train, _ = _parts(d)
    model = CL.fit(train, "logistic")
    holes = d.stored_features.drop("VperSent").withColumn("LenNP", F.when(F.col("LenNP") > 3, F.col("LenNP")))
    zeros = holes.withColumn("VperSent", F.lit(0.0)).na.fill(0.0, ["LenNP"])
    plain = CL.predict(model, zeros).select("doc_id", F.col("predicted_level").alias("plain"))
    got = CL.predict(model, holes)
    return _sound(got, "logistic").join(got.select("doc_id", "predicted_level").join(plain, "doc_id").select(
        "doc_id", (F.col("predicted_level") == F.col("plain")).alias("absent_is_zero")), "doc_id")


@query("ml17_saved_model", f"SELECT doc_id, predict_level, true AS same, true AS same_calibrated FROM ({TEST_ROWS})", "features")
def ml17(d):
    """Loaded models answer as those in memory."""
    train, test = _parts(d)
    model, curved = CL.fit(train, "logistic"), CL.calibrate(train, "logistic")
    path, curves = new_path(d.spark, "model"), new_path(d.spark, "calibrated")
    model.write().overwrite().save(path)
    is_curved = isinstance(curved, CL.Calibrated)
    curved.save(curves) if is_curved else curved.write().overwrite().save(curves)
    loaded = CL.Calibrated.load(curves) if is_curved else CL.PipelineModel.load(curves)

    def answers(m, name):
        return CL.predict(m, test).select("doc_id", F.struct("predicted_level", "confidence").alias(name))

    out = test.select("doc_id", "predict_level")
    for m, name in ((model, "a"), (CL.PipelineModel.load(path), "b"), (curved, "c"), (loaded, "d")):
        out = out.join(answers(m, name), "doc_id")
    return out.select("doc_id", "predict_level", (F.col("a") == F.col("b")).alias("same"), (F.col("c") == F.col("d")).alias("same_calibrated"))


@query("ml18_regressor", f"""SELECT doc_id, {Q.text_level('ARI')} AS predict_level, true AS in_range, true AS fits FROM surface_ari""", "surface_ari")
def ml18(d):
    """Fitted on a part; on the rest the squared error must be less than half of what the mean of the rest leaves."""
    rows = TR.split(M.surface_features(d.docs).withColumn("predict_level", text_level(F.col("ARI"))))
    model = CL.fit_regressor(rows.where("NOT is_test"))
    scored = materialise(model.transform(rows).select("doc_id", "predict_level", "is_test", "label", "prediction"), "scored")
    unseen = scored.where("is_test")
    left = unseen.agg(F.sum(F.pow(F.col("prediction") - F.col("label"), 2)).alias("e")).scalar()
    spread = unseen.agg((F.var_pop("label") * F.count("*")).alias("e")).scalar()
    top = len(C.TEXT_LEVELS) - 1
    return scored.select("doc_id", "predict_level", F.col("prediction").between(0, top).alias("in_range"), (left < 0.5 * spread).alias("fits"))


@query("ml20_training_flow", f"SELECT *, {SOUND}, {learnt(TEST_ROWS)}, true AS same FROM ({TEST_ROWS})", "features")
def ml20(d):
    """From the feature table to a saved model, in one call."""
    path = new_path(d.spark, "flow")
    model, predicted = CL.train_and_save(d.stored_features, path)
    loaded = CL.Calibrated.load(path) if isinstance(model, CL.Calibrated) else CL.PipelineModel.load(path)
    again = CL.predict(loaded, predicted.select("doc_id", *C.METRICS)).select("doc_id", F.col("predicted_level").alias("again"))
    same = predicted.join(again, "doc_id").select("doc_id", (F.col("predicted_level") == F.col("again")).alias("same"))
    return _sound(predicted, "forest").join(same, "doc_id")
