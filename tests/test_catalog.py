"""Registered queries against their SQL counterparts, and the shape of the plans."""

import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
FITTED = {"ml10_forest", "ml11_logistic", "ml12_model_choice", "ml13_calibrated", "ml15_importance", "ml16_predict",
          "ml17_saved_model", "ml18_regressor"}
# full-size forests, fitted many times over: test_training covers them with small settings, tools/check.py as they are
SLOW = {"ml12_model_choice", "ml13_calibrated", "ml17_saved_model"}


@pytest.fixture(scope="module")
def engine(sf):
    duckdb = pytest.importorskip("duckdb")
    import check
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_has_a_counterpart():
    own = {n for n in QUERIES if not n.startswith("op") and n != "pipeline"}
    assert own <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(n for n in set(ORACLES) - SLOW if n.split("_")[0].rstrip("0123456789") != "op"))
def test_same_rows(name, spark, sf, engine):
    import check
    assert check.compare(QUERIES[name](spark, sf), engine.execute(ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - FITTED - {"ml5_label_index", "ml8_standardise", "pipeline"}
                                        if n.split("_")[0].rstrip("0123456789") != "op"))
def test_plans_stay_in_the_jvm_and_cross_nothing(name, spark, sf):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert word not in plan
    if name != "p12_boundary_levels":       # its range join has three rows on the broadcast side
        assert "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_they_need(spark, sf):
    plan = QUERIES["m5_ari"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan


def test_stored_counts_spare_the_text(spark, sf):
    """Metrics read no text once counts are stored, the lexical profile reads it once, and no scan is dealt out unasked."""
    from catalog.data import data
    asked = spark.conf.get("spark.readgrade.partitions")
    spark.conf.unset("spark.readgrade.partitions")
    try:
        tables = data(spark, sf)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        text = lambda df: sum("documents.parquet" in x and "text:string" in x for x in plan(df).splitlines())
        assert all(text(QUERIES[n](spark, sf)) == 0 for n in ("m9_metrics_profile", "p6_distance", "p7_advice", "q13_evaluate", "l8_flat_lookup"))
        assert text(tables.lexical) == 1
        assert "RoundRobin" not in plan(tables.docs) + plan(tables.lexical) + plan(tables.tokens)
    finally:
        spark.conf.set("spark.readgrade.partitions", asked)


def test_nothing_is_left_behind(spark, tmp_path, monkeypatch):
    from readgrade.plans import storage
    monkeypatch.setattr(storage, "_home", lambda _: str(tmp_path / "own"))
    assert storage.materialise(spark.range(3), "x").count() == 3
    assert (tmp_path / "own").exists()
    first, second = (storage.materialise(spark.range(n), f"r{n}") for n in (2, 0))
    storage.discard(first, second)
    assert [p.name[0] for p in (tmp_path / "own").iterdir()] == ["x"]
    storage.release(spark)
    assert not (tmp_path / "own").exists()


def test_entry(spark, sf):
    assert entry.entry(spark).count() > 0
