"""The lexical profile counts a document's words in its one pass, unless counts are stored already."""

from pyspark.sql import functions as F

from catalog.data import Data
from readgrade.operators import lexicon as L, metrics as M, tokens as T

TEXTS = [(1, "The quick zebra ran. The Zebra ran again and again, near 12 quagmires!"), (2, "12 34 ..."), (3, ""), (4, "and the of"),
         (5, "Quagmires abound; quagmires stay."), (6, "We met Anna Karenina there.")]


def test_same_rows_with_and_without_stored_counts(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    limits = spark.createDataFrame([(1, 1), (2, 5), (3, 5), (4, 5), (5, None), (6, 1), (7, 9)], "doc_id bigint, max_rank int")
    wordlist = spark.createDataFrame([(1, "run", "verb", "A1"), (2, "zebra", "noun", "C1")], "seq int, headword string, pos string, cefr string")
    tokens = T.tokens(docs)
    graded = L.grade_forms(L.mark_hot(L.word_forms(tokens)), wordlist)
    rare = graded.withColumn("hot", F.lit(False))
    want = sorted(L.lexical_profile(tokens, graded, limits, M.document_counts(tokens, graded)).collect(), key=lambda r: r["doc_id"])
    assert {r["doc_id"]: r["total_tokens"] for r in want} == {1: 12, 2: 0, 3: 0, 4: 3, 5: 0, 6: 5, 7: 0}
    for g in (graded, rare):
        assert want == sorted(L.lexical_profile(tokens, g, limits).collect(), key=lambda r: r["doc_id"])


def test_lexical_query_needs_no_counts(spark, sf):
    d = Data(spark, sf)
    assert d.lexical.columns and "counts" not in vars(d)
