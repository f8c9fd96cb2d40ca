import re

import corpus_pipeline
from conftest import SCHEMA, prose

from readgrade.llm.queries import ORACLES, QUERIES


def test_stages_in_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "decontamination", "mixture"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_stages_take_out_what_is_planted(spark, tmp_path, rng, monkeypatch):
    from readgrade.llm import byte_cnn
    monkeypatch.setattr(byte_cnn.fit, "__defaults__", (7, 60, 32, 4e-3))
    items = [(k, prose(rng, 30)) for k in range(5)]
    rows, labels = [], []
    for i in range(200):
        words = prose(rng, 60).split()
        good = i % 4 != 0
        t = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((i, t, "en", f"s{i % 3}", len(t), "x", 0.1, "y", 1))
        labels.append((i, int(good), 0))
    add = lambda i, t: rows.append((i, t, "en", "s0", len(t), "x", 0.1, "y", 1))
    add(1001, rows[1][1].replace(" ", "  "))
    near = prose(rng, 9000).split()
    add(1002, " ".join(near))
    near[100] = "other"
    add(1003, " ".join(near))
    add(1004, prose(rng, 20) + " " + items[3][1] + " " + prose(rng, 20))
    rows += [(None, None, None, None, None, None, None, None, None), (1005, "", "en", None, 0, "x", 0.1, "y", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == SCHEMA.replace(",", "").split()[::2]
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    good, exact, near, clean = kept
    assert {1, 2, 3, 1001, 1002, 1003, 1004} <= good and len(good & set(range(0, 200, 4))) <= 5
    assert good - exact <= {1001, 1005, None} and 1001 not in exact
    assert exact - near == {1003}
    assert near - clean == {1004}
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"epoch", "block_rank"} <= {c.strip("_") for c in out.columns} and out.count() > 0
    assert 1004 not in {r["doc_id"] for r in out.select("doc_id").collect()}


def test_an_empty_corpus_goes_through(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
