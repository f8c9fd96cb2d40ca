"""Plans, prompts, answers, gates."""

import pytest
from pyspark.sql import functions as F

from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.operators import reports as R, requests as RQ, responses as RS, sinks as K


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_word_bounds_round_half_to_even(spark):
    rows = spark.createDataFrame([(125,), (200,), (75,)], "w int").select(*RQ.word_bounds(F.col("w"))).collect()
    assert [tuple(r) for r in rows] == [(112, 138), (180, 220), (68, 82)]


def test_topics(spark):
    def both(**given):
        topics = F.create_map(*[F.lit(v) for kv in given.items() for v in kv]) if given else F.create_map().cast("map<string,string>")
        return one(spark, RQ.topics_by_type(topics))[0]

    assert both(narrative="n", expository="e") == {"narrative": "n", "expository": "e"}
    assert both(expository="e", poem="p") == {"narrative": "e", "expository": "e"}
    assert both(poem="p") == both() == {"narrative": "Daily life", "expository": "Daily life"}


def test_templates(spark):
    asked = spark.createDataFrame([("A1", "narrative", "bees"), ("B1.1", "narrative", "bees")], "level string, text_type string, topic string")
    filled, rejected = RQ.fill_templates(asked.withColumn("content", RQ.default_content(F.col("topic"))))
    text = filled.first()["text"]
    assert text.startswith("This is Sora. Sora lives in a small town.") and text.endswith("feels calm.") and "{" not in text
    assert [r["level"] for r in rejected.collect()] == ["B1.1"]


def test_level_prompt(spark):
    asked = spark.createDataFrame([("B2.1", "art", 100, 3), ("X1", "art", 100, 1)], "target_level string, topic string, word_count int, attempt int")
    strict, fallback = [r["prompt"] for r in RQ.level_prompts(asked).orderBy("target_level").collect()]
    assert "STRICTLY Requirements for B2.1" in strict and "between 90 and 110 words" in strict
    assert "common vocabulary with some less frequent words" in fallback and "STRICTLY" not in fallback


def test_costs(spark):
    usage = spark.createDataFrame([("gpt-4", 1000, 500), ("other", 10, 10)], "model string, input_tokens int, output_tokens int")
    assert sorted(r["cost"] for r in RQ.request_costs(usage).collect()) == [0.0, pytest.approx(0.06)]


RAW = [
    ('{"text": "A b.", "question1": "x"}', "A b.", ["x"]),
    ('```json\n{"text": "A"}\n```', "A", []),
    ('```\n\n```python\n{"text": "last"}```', 'python\n{"text": "last"}', None),
    ('{"text": "A", "questions": ["a", "", "b", "c"], "question1": "z"}', "A", ["a", "b"]),
    ('{"text": "A", "questions": []}', "A", []),
    ("plain text", "plain text", []),
    ('[1, 2]', "[1, 2]", []),
    ('{"question2": "only"}', "", ["only"]),
    ('{"text": broken', '{"text": broken', []),
]


@pytest.mark.parametrize("raw, text, questions", RAW)
def test_parse(spark, raw, text, questions):
    row = RS.parse_answers(spark.createDataFrame([(1, raw)], "request_id int, raw string")).first()
    if questions is None:       # no json tag: the last block, which is no object, so the raw text is the passage
        assert row["questions"] == [] and "last" in row["text"]
    else:
        assert (row["text"], row["questions"]) == (text, questions)


def test_sanitise(spark):
    text = "Passage:\n  One line  \n\n\n\n1. Questions\ntext: no\n\ttwo\n\n"
    assert one(spark, RS.sanitise(F.lit(text)))[0] == "One line\n\ntwo"


def test_questions(spark):
    def pair(asked, topic="bees", kind="narrative"):
        given = F.array(*[F.lit(q) for q in asked]).cast("array<string>")
        return one(spark, RS.two_questions(given, F.lit(topic), F.lit(kind)))[0]

    assert pair(["Why。", "How 50語程度"]) == ["Why。50語程度で答えてください。", "How 50語程度"]
    assert pair([])[0].startswith("bees に関して本文で起きた") and pair([], "", "expository")[1].startswith("本文 に関する")
    assert len(pair(["a", "b", "c"])) == 2


def attempts(spark, rows):
    return spark.createDataFrame(rows, "request_id int, attempt int, success boolean, distance double")


def test_best_attempt(spark):
    inf = float("inf")
    got = {r["request_id"]: r["attempt"] for r in RS.best_attempts(attempts(spark, [
        (1, 1, False, 0.0), (1, 2, True, 0.0), (1, 3, True, 0.0),   # first success after a nearer failure
        (2, 1, False, 2.0), (2, 2, False, 1.0), (2, 3, False, 1.0),  # tie goes to the earliest
        (3, 1, False, inf), (3, 2, False, inf),                      # nothing usable
    ])).collect()}
    assert got == {1: 2, 2: 2}


def test_window_gate(spark):
    rows = spark.createDataFrame([(1, 1, 100), (1, 2, 200), (1, 3, 210), (2, 1, 100), (2, 2, 300), (2, 4, 200)],
                                 "request_id int, attempt int, word_count int")
    assert {r["request_id"]: r["attempt"] for r in RS.pick_in_window(rows).collect()} == {1: 2, 2: 2}


def test_quota(spark):
    rows = spark.createDataFrame([(1, i, 3, i % 2 == 1) for i in range(1, 9)], "group_id int, run int, attempts int, success boolean")
    got = RS.within_quota(rows, wanted=2).collect()
    assert [(r["run"], r["place"]) for r in sorted(got)] == [(1, 1), (3, 2)]
    assert [r["run"] for r in RS.within_quota(rows, wanted=1, attempts_each=1).collect()] == [1]


def test_distance_and_reasons(spark):
    assert one(spark, RS.level_distance(F.lit("A1.1"), F.lit("C2")), RS.level_distance(F.lit("?"), F.lit("C2"))) == (8.0, float("inf"))
    assert one(spark, RS.retry_reasons(F.lit(50), F.lit(100), F.lit("C1"), F.lit("C2")))[0] == "level, word_count"


@pytest.mark.parametrize("raw, level, confidence", [
    ('{"level": "B1.1", "confidence": 0.7}', "B1.1", 0.7), ('{"level": "Z", "confidence": 0.7}', "unknown", 0.7),
    ("no", "unknown", 0.0), ("", "unknown", 0.0), ('{"level": "C2"}', "C2", 0.0)])
def test_judgement(spark, raw, level, confidence):
    row = one(spark, RS.read_judgement(F.lit(raw)))[0]
    assert (row["level"], row["confidence"]) == (level, confidence)


def test_slugs(spark):
    row = one(spark, X.file_slug(F.lit("!!!")), X.file_slug(F.lit("A b--C!")), X.word_slug(F.lit("???")), X.word_slug(F.lit(" B1.1 a__b ")))
    assert tuple(row) == ("text", "a_b_c", "text", "b11_a_b")


RESULT = ("set_index int, band string, level string, target_level string, text_type string, topic string, text string, "
          "word_count int, questions array<string>")


def test_documents(spark, tmp_path):
    rows = spark.createDataFrame([(2, "5K", "B1.2", "B1.2", "narrative", "A trip", " Body\nmore ", 2, ["a"])], RESULT)
    docs = K.text_documents(rows, "2025-01-31 12:00:00", "20250131_120000")
    got = docs.first()
    assert got["name"] == "set2_5K_narrative_a_trip_20250131_120000"
    lines = got["value"].split("\n")
    assert lines[0] == "# Band: 5K" and lines[7] == "-" * 50 and lines[9:12] == ["Body", "more", ""]
    assert lines[12:] == ["[質問]", "Q1: a", ""]
    K.write_documents(docs, str(tmp_path / "docs"))
    back = spark.read.parquet(str(tmp_path / "docs")).where("band = '5K' AND value LIKE '%# Topic: A trip\n%'").collect()
    assert [r["name"] for r in back] == [r["name"] for r in docs.collect()]


def test_reports(spark):
    rows = spark.createDataFrame([("A1.1", "t" * 40, True, 0.5, 10, 1), ("A1.1", "t" * 30, False, 1.0, 20, 3)],
                                 "target_level string, topic string, success boolean, confidence double, word_count int, attempts int")
    assert tuple(R.run_totals(rows).first()) == (2, 0.5, 0.75, 15.0, 2.0)
    assert tuple(R.by_topic(rows).first()) == ("t" * 30, 2, 50.0)
    assert R.run_totals(rows.where("false")).first()["success_rate"] == 0.0
    assert R.accepted(rows).count() == 1
