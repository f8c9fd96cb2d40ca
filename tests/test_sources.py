"""Files as bytes, and tables with malformed lines."""

import pytest
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.sources import tables


def test_text_files_by_name_and_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Plain. Two\nlines é".encode())
    (tmp_path / "b.txt").write_bytes(b"bro\xffken \xc3( \xed\xa0\x80end")
    (tmp_path / "c.txt").write_bytes("own � kept".encode() + b"\xfe")
    (tmp_path / "d.txt").write_bytes(b"")
    found = {r["filename"]: r["text"] for r in tables.text_files(spark, str(tmp_path)).collect()}
    assert found == {p.name: p.read_bytes().decode("utf-8", "ignore") for p in tmp_path.iterdir() if p.name != "d.txt"}
    assert found["c.txt"] == "own � kept" and found["b.txt"] == "broken ( end"
    replaced = {r["filename"]: r["text"] for r in tables.text_files(spark, str(tmp_path), "replace").collect()}
    assert replaced["a.txt"] == found["a.txt"] and replaced["c.txt"] == "own � kept�" and "�" in replaced["b.txt"]
    with pytest.raises(ValueError):
        tables.text_files(spark, str(tmp_path), "strict")


def test_malformed_lines_are_rejects(spark, tmp_path):
    names = ["filename", *C.METRICS, "predict_level"]
    good = ["a," + ",".join(["1.5"] * 8) + ",A1.1", '"b, c",' + ",".join(["2"] * 8) + ",B1.1", "d,,,,,,,,,"]
    bad = ["e,x" + ",1" * 7 + ",A1.1", "f,1,2", "g" + ",1" * 8 + ",A1.1,more"]
    (tmp_path / "t.csv").write_text("\n".join([",".join(names), *good, *bad]) + "\n")
    rows, rejects = tables.features_csv(spark, str(tmp_path / "t.csv"))
    assert sorted(r["filename"] for r in rows.collect()) == ["a", "b, c", "d"]
    assert sorted((r["file"], r["record"]) for r in rejects.collect()) == [("t.csv", b) for b in bad]
    assert rows.where(F.col("filename") == "d").first()["ARI"] is None
    assert rows.select("filename").count() == 3 and rejects.count() == 3  # whatever columns are asked for
