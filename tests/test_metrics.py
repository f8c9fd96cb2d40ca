"""Hand-computed texts: tokens, tagging and the metrics in both variants."""

import math

import pytest
from pyspark.sql import functions as F

from readgrade.functions import text as X
from readgrade.operators import lexicon as L, metrics as M, tokens as T
from readgrade.plans.corpus import metrics_of

WORDS = [
    (1, "cat", "noun", "A1"), (2, "garden", "noun", "B1"), (3, "walking", "verb", "A2"), (4, "quickly", "adverb", "C1"),
    (5, "cat", "noun", "B2"), (6, "cat", "verb", "C2"), (7, "old", "adjective", "x9"), (8, "paint", "pv", "A1"),
]
TEXTS = [
    (1, "The cat walking quickly. A garden!"),
    (2, "   \n "),
    (3, "...!?"),
    (4, "The cat of the garden"),
    (5, "to the of"),
    (6, "I met Zorro."),
    (7, "zebra"),
    (8, "one two three four"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string").repartition(3)


@pytest.fixture(scope="module")
def wordlist(spark):
    return spark.createDataFrame(WORDS, "seq bigint, headword string, pos string, cefr string")


@pytest.fixture(scope="module")
def scores(docs, wordlist):
    return {v: {r["doc_id"]: r for r in metrics_of(docs, wordlist, v).collect()} for v in M.VARIANTS}


def test_tags_and_chunks(docs):
    rows = {(r["text"], r["pos"], r["lemma"]) for r in T.tokens(docs).where("doc_id = 1").collect()}
    assert {("The", "DET", "the"), ("cat", "NOUN", "cat"), ("walking", "VERB", "walk"), ("quickly", "ADV", "quickly"),
            (".", "PUNCT", "."), ("garden", "NOUN", "garden"), ("A", "DET", "a"), ("!", "PUNCT", "!")} == rows
    for found in (T.noun_chunks(docs), T.chunks_of(T.tokens(docs))):
        chunks = found.where("doc_id in (1, 4)").collect()
        assert sorted((r["doc_id"], r["sent_id"], r["chunk_id"], r["n_alpha"]) for r in chunks) == [
            (1, 0, 0, 2), (1, 1, 0, 2), (4, 0, 0, 2), (4, 0, 1, 2)]


def test_chunks_are_found_inside_the_row(spark, sf):
    """No exchange, and the same chunks as from the token table."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    inside = T.noun_chunks(docs)
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    from_tokens = T.chunks_of(T.tokens(docs)).select([F.col(c).cast("long") for c in inside.columns])
    own = inside.select([F.col(c).cast("long") for c in inside.columns])
    assert own.count() > 1000 and own.exceptAll(from_tokens).isEmpty() and from_tokens.exceptAll(own).isEmpty()


def test_proper_noun_needs_a_place_inside_the_sentence(docs):
    tags = {r["text"]: r["pos"] for r in T.tokens(docs).where("doc_id = 6").collect()}
    assert tags["Zorro"] == "PROPN" and tags["I"] == "PRON" and tags["met"] == "NOUN"


def test_blank_texts_have_zeros(scores):
    for variant in M.VARIANTS:
        for doc in (2, 3):
            row = scores[variant][doc]
            assert all(row[m] == 0 for m in M.C.METRICS) and row["word_count"] == 0


def test_profile_levels(scores):
    # cat A1 (last pos row wins: B2), walking A2, quickly C1, garden B1
    row = scores["profile"][1]
    assert row["AvrDiff"] == pytest.approx((4 + 2 + 5 + 3) / 4)
    assert row["BperA"] == pytest.approx(3 / 1)
    assert row["CVV1"] == pytest.approx(2.0)
    assert row["VperSent"] == 0.5 and row["POStypes"] == 4 and row["LenNP"] == 2.0
    assert row["ARI"] == pytest.approx(4.71 * 27 / 6 + 0.5 * 6 / 2 - 21.43)


def test_model_levels(scores):
    # flat list, last row wins: cat C2; the lemma "walk" is not listed and is dropped
    row = scores["model"][1]
    assert row["AvrDiff"] == pytest.approx((6 + 5 + 3) / 3)
    assert row["BperA"] == 0.0
    assert row["CVV1"] == pytest.approx(1 / math.sqrt(2))
    assert row["POStypes"] == 5 and row["LenNP"] == 2.0


def test_cvv1_variants_differ_by_a_constant(scores):
    for doc, row in scores["profile"].items():
        assert row["CVV1"] == pytest.approx(2 * math.sqrt(2) * scores["model"][doc]["CVV1"])


def test_no_a_word_divides_by_one(scores):
    assert scores["profile"][7]["AvrDiff"] == 5.0 and scores["profile"][7]["BperA"] == 1.0


def test_trim_starts_above_three_tokens(docs, wordlist, spark):
    freq = spark.createDataFrame([("to", 1, 6.0), ("the", 1, 7.0), ("of", 1, 5.0), ("one", 1, 6.0), ("two", 1, 5.0),
                                  ("three", 1, 4.0)], "word string, n bigint, zipf double")
    rows = {r["doc_id"]: r for r in metrics_of(docs, wordlist, "profile", freq=freq).collect()}
    assert rows[5]["AvrFreqRank"] == pytest.approx((10 + 1 + 100) / 3)
    assert rows[8]["AvrFreqRank"] == 10.0     # four, three and two are trimmed; "four" has no frequency
    model = {r["doc_id"]: r for r in metrics_of(docs, wordlist, "model", freq=freq).collect()}
    assert model[8]["AvrFreqRank"] == pytest.approx(4.0)


def test_unlisted_proper_noun_goes_by_frequency(docs, wordlist):
    forms = L.mark_hot(L.word_forms(T.tokens(docs)))
    graded = {(r["lower"], r["pos"]): r["level"] for r in L.grade_forms(forms, wordlist).collect()}
    assert graded[("zorro", "PROPN")] == "A1" and graded[("zebra", "NOUN")] == "C1" and graded[("met", "NOUN")] == "C1"


def test_hot_and_rare_forms_give_the_same_counts(docs, wordlist, monkeypatch):
    def counts():
        tokens = T.tokens(docs)
        graded = L.grade_forms(L.mark_hot(L.word_forms(tokens)), wordlist)
        return sorted(map(tuple, M.metrics(M.document_counts(tokens, graded), "profile").collect()))

    everything_hot = counts()
    for slots in (0, 4, 12):
        monkeypatch.setattr(L, "HOT_FORMS", slots)
        assert counts() == everything_hot


def test_result_does_not_depend_on_partitioning(spark, docs, wordlist, scores):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = {r["doc_id"]: r for r in metrics_of(docs.repartition(7), wordlist, "profile").collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert again == scores["profile"]


def test_list_rules(spark, wordlist):
    listed = L.with_token_pos(L.clean_list(wordlist))
    assert {(r["word"], r["pos"]): r["level"] for r in L.level_by_pos(listed).collect()} == {
        ("cat", "NOUN"): "B2", ("cat", "VERB"): "C2", ("garden", "NOUN"): "B1", ("walking", "VERB"): "A2",
        ("quickly", "ADV"): "C1", ("paint", "VERB"): "A1"}
    assert {r["word"]: r["level"] for r in L.level_by_word(listed).collect()}["cat"] == "A1"
    assert {r["word"]: r["level"] for r in L.flat_levels(wordlist).collect()}["old"] == "X9"


def test_frequency_level_cuts(spark):
    from pyspark.sql import functions as F
    from readgrade.functions import text as X
    rows = spark.sql("SELECT * FROM VALUES (4.5D, 'A1'), (4.49D, 'A2'), (4.0D, 'A2'), (3.5D, 'B1'), (3.0D, 'B2'), "
                     "(2.5D, 'C1'), (2.4D, 'C2'), (0D, 'C2') AS t(z, level)")
    assert rows.where(X.level_from_zipf(F.col("z"), F.lit(0.0)) != F.col("level")).count() == 0
    ranks = [r[0] for r in spark.sql("SELECT * FROM VALUES (7.5D), (7D), (5D), (2D), (1D), (0D) AS t(z)")
             .select(X.rank_from_zipf(F.col("z"))).collect()]
    assert ranks == [1, 1, 100, 100_000, 100_000, 100_000]


def test_lexical_profile_edges(spark, wordlist):
    docs = spark.createDataFrame([(1, "Word here, word again; cat cat"), (2, "Word word")], "doc_id bigint, text string")
    tokens = T.tokens(docs)
    graded = L.grade_forms(L.mark_hot(L.word_forms(tokens)), wordlist)
    limits = spark.createDataFrame([(1, 2000), (2, 0)], "doc_id bigint, max_rank bigint")
    rows = {r["doc_id"]: r for r in L.lexical_profile(tokens, graded, limits, M.document_counts(tokens, graded)).collect()}
    assert rows[1]["total_tokens"] == 6 and rows[1]["content_tokens"] == 4 and rows[1]["out_of_band_count"] == 2
    assert [w.split(" ")[0] for w in rows[1]["out_of_band_tokens"]] == ["Word", "word"]
    assert rows[2]["total_tokens"] == 0 and rows[2]["out_of_band_tokens"] == []


def test_looser_band_flags_no_more(spark, wordlist):
    docs = spark.createDataFrame([(i, "cat garden zebra word walking " * i) for i in range(1, 5)], "doc_id bigint, text string")
    tokens = T.tokens(docs)
    graded = L.grade_forms(L.mark_hot(L.word_forms(tokens)), wordlist)

    def flagged(limit):
        limits = docs.selectExpr("doc_id", f"{limit}L AS max_rank")
        return L.lexical_profile(tokens, graded, limits, M.document_counts(tokens, graded)).agg({"out_of_band_count": "sum"}).first()[0]

    counts = [flagged(limit) for limit in (1, 100, 6000, 8000, 200_000)]
    assert counts == sorted(counts, reverse=True) and counts[-1] == 0


def test_other_scripts_numbers_and_spaces(spark):
    """Literal expectations, written by hand."""
    docs = spark.createDataFrame([
        (1, "Привет мир. Costs 3.14 or 1,000.50 now! They\u00a0go.\u3000Ok?"), (2, "v1.2.3 ends. É Ñandú §")], "doc_id bigint, text string")
    assert [r["sentence"] for r in T.sentences(docs).orderBy("doc_id", "sent_id").collect()] == [
        "Привет мир.", "Costs 3.14 or 1,000.50 now!", "They\u00a0go.", "Ok?", "v1.2.3 ends.", "É Ñandú §"]
    found = T.tokens(docs).orderBy("doc_id", "tok_id").collect()
    assert [(r["text"], r["pos"]) for r in found if r["doc_id"] == 2] == [
        ("v", "NOUN"), ("1.2.3", "NUM"), ("ends", "NOUN"), (".", "PUNCT"), ("É", "NOUN"), ("Ñandú", "PROPN"), ("§", "PUNCT")]
    assert [r["text"] for r in found if r["doc_id"] == 1 and r["is_alpha"]] == ["Привет", "мир", "Costs", "or", "now", "They", "go", "Ok"]
    assert spark.range(1).select(X.strip(F.lit("\u3000 a b\u00a0"))).first()[0] == "a b"


def test_contractions(spark):
    """Literal expectations, written by hand: clitics are tokens with a class of their own, and no content words."""
    docs = spark.createDataFrame([(1, "We'll see it doesn’t hurt."), (2, "I can't've won't SHOULDN'T"), (3, "He's Ann's; rock'n'roll 'tis o'clock"),
                                  (4, "ca wo sha ai n't 's")], "doc_id bigint, text string")
    found = {}
    for r in T.tokens(docs).orderBy("doc_id", "tok_id").collect():
        found.setdefault(r["doc_id"], []).append((r["text"], r["pos"]))
    assert found[1] == [("We", "PRON"), ("'ll", "AUX"), ("see", "NOUN"), ("it", "PRON"), ("does", "AUX"), ("n’t", "PART"), ("hurt", "NOUN"), (".", "PUNCT")]
    assert found[2] == [("I", "PRON"), ("ca", "AUX"), ("n't", "PART"), ("'ve", "AUX"), ("wo", "AUX"), ("n't", "PART"), ("SHOULD", "AUX"), ("N'T", "PART")]
    assert found[3] == [("He", "PRON"), ("'s", "AUX"), ("Ann", "PROPN"), ("'s", "PART"), (";", "PUNCT"), ("rock", "NOUN"), ("'", "PUNCT"), ("n", "NOUN"),
                        ("'", "PUNCT"), ("roll", "NOUN"), ("'", "PUNCT"), ("tis", "NOUN"), ("o", "NOUN"), ("'", "PUNCT"), ("clock", "NOUN")]
    assert [p for _, p in found[4]] == ["NOUN"] * 4 + ["NOUN", "PUNCT", "NOUN", "PUNCT", "NOUN"]
    clitics = T.tokens(docs).where(F.col("lower").isin(list(M.C.CLITICS)))
    assert clitics.where("is_alpha or not is_stop or in_np").isEmpty() and clitics.count() == 8
    assert T.predicates(clitics).where("is_content or is_content_model").isEmpty()


def test_sentence_ends(spark):
    """Literal expectations, written by hand."""
    docs = spark.createDataFrame([
        (1, "Mr. Smith left. Dr. J. R. Who, M.D., came at 5 p.m. and sat."), (2, "It costs $3.50. Tell Prof. Lee, e.g. by mail, etc. or not."),
        (3, "In the U.S. it is so. I came. I saw... No? Yes!"), (4, "He met Mr."), (5, "Mr. 5 x.y Z. Next")], "doc_id bigint, text string")
    found = {}
    for r in T.sentences(docs).orderBy("doc_id", "sent_id").collect():
        found.setdefault(r["doc_id"], []).append(r["sentence"])
    assert found == {
        1: ["Mr. Smith left.", "Dr. J. R. Who, M.D., came at 5 p.m. and sat."], 2: ["It costs $3.50.", "Tell Prof. Lee, e.g. by mail, etc. or not."],
        3: ["In the U.S. it is so.", "I came.", "I saw...", "No?", "Yes!"], 4: ["He met Mr."], 5: ["Mr.", "5 x.y Z. Next"]}


def test_one_ari(spark, sf, wordlist):
    """The counts of the raw text are those of its tokens, decimals, clitics and short forms included."""
    own = [(-1, "It costs 3.14, or 1,000.50! Mr. Smith doesn't say 'tis 2.5.1. We'll v1.2 see."), (-2, "e.g. A.B.C. x. \u00c9t\u00e9 n'y 's"), (-3, "3.14"), (-4, "I'd've")]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(own, "doc_id bigint, text string"))
    surface = {r["doc_id"]: tuple(r)[1:] for r in M.surface_counts(docs).drop("text").collect()}
    counted = {r["doc_id"]: (r["n_letters"], r["n_words"], r["n_sents"]) for r in M.text_counts(T.tokens(docs)).collect()}
    assert len(counted) > 190 and counted == {d: n for d, n in surface.items() if n[1]}
    assert surface[-1] == (50, 15, 3) and surface[-4] == (4, 1, 1)
    ari = {r["doc_id"]: r["ARI"] for r in M.readability(docs).where("doc_id < 0").collect()}
    metric = {r["doc_id"]: r["ARI"] for r in metrics_of(docs.where("doc_id < 0"), wordlist).collect()}
    assert ari == pytest.approx(metric)


LISTED = [(1, "go", "verb", "A1"), (2, "home", "noun", "A1"), (3, "make", "verb", "A1"), (4, "fast", "adverb", "A2"), (5, "make", "noun", "C2"),
          (6, "jogging", "noun", "B1"), (7, "paint", "verb", "B2"), (8, "they", "noun", "C2"), (9, "rapid", "adjective", "B1")]


def test_list_decides_classes_in_the_metrics(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "They go home and we'll make it."), (2, "The rapid jogging home. Paint makes make"), (3, ""),
                                  (4, "Go fast home fast. The old home")], "doc_id bigint, text string")
    words = spark.createDataFrame(LISTED, "seq bigint, headword string, pos string, cefr string")
    plain = {r["doc_id"]: r for r in metrics_of(docs, words).collect()}

    def listed(variant="profile"):
        return {r["doc_id"]: r for r in metrics_of(docs, words, variant, list_tags=True).collect()}

    rows = listed()
    assert plain[1]["VperSent"] == 0 and rows[1]["VperSent"] == 2 and rows[1]["CVV1"] == pytest.approx(2 * 2 / math.sqrt(2))
    assert metrics_of(docs.where("doc_id = 1").selectExpr("doc_id", "'They go home.' AS text"), words, list_tags=True).first()["VperSent"] == 1
    assert rows[1]["AvrDiff"] == pytest.approx(1.0) and rows[1]["LenNP"] == 1.0  # home alone
    # jogging is a noun by the list: the chunk is "The rapid jogging home"; "makes" is no listed word and stays a noun
    assert rows[2]["LenNP"] == pytest.approx((4 + 1) / 2) and rows[2]["VperSent"] == 1.0
    assert rows[4]["LenNP"] == pytest.approx((1 + 3) / 2) and rows[3]["word_count"] == 0
    model = listed("model")
    for slots in (0, 3, 9):
        monkeypatch.setattr(L, "HOT_FORMS", slots)
        assert listed() == rows and listed("model") == model


def test_token_table_with_the_list_can_be_measured(spark, wordlist):
    """Re-tagged tokens are a whole token table; their metrics are those of the vocabulary's way."""
    docs = spark.createDataFrame([(1, "They go home and we'll make it. The rapid jogging home."), (2, "Go fast home fast")], "doc_id bigint, text string")
    words = spark.createDataFrame(LISTED, "seq bigint, headword string, pos string, cefr string")
    tagged = T.retag_with_list(T.tokens(docs), L.first_classes(words))
    assert tagged.columns == T.tokens(docs).columns
    one = metrics_of(docs, words, tokens=tagged).orderBy("doc_id").collect()
    assert one == metrics_of(docs, words, list_tags=True).orderBy("doc_id").collect()


def test_hot_words_do_not_travel_in_the_lexical_profile(spark, wordlist):
    docs = spark.createDataFrame([(i, "cat garden zebra walking quickly zorro " * 3) for i in range(1, 6)], "doc_id bigint, text string")
    tokens = T.tokens(docs)
    graded = L.grade_forms(L.mark_hot(L.word_forms(tokens)), wordlist)
    limits = docs.selectExpr("doc_id", "1000L AS max_rank")
    plan = L.lexical_profile(tokens, graded, limits, M.document_counts(tokens, graded))._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint (strategy=broadcast)" in plan or "rightHint=(strategy=broadcast)" in plan


def test_runs_of_a_key_become_one_row(spark):
    from readgrade.operators.runs import per_key
    rows = spark.createDataFrame([(1, 2, "b"), (1, 3, None), (None, 5, "z"), (2, 1, "a"), (1, 4, "a"), (None, None, "y")],
                                 "doc_id bigint, n int, w string")
    got = per_key(rows.coalesce(1), "doc_id", {"n": F.col("n")}, {"bits": F.col("n")}, {"w": F.col("w")}, {"w": F.array_sort("w")})
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, 9, 7, ["a", "b"]), (2, 1, 1, ["a"]), (None, 5, 5, ["y", "z"])]
    halves = per_key(rows, "doc_id", {"half": F.col("n") / 2.0, "even": F.col("n") % 2 == 0})
    assert sorted(map(tuple, halves.collect()), key=repr) == [(1, 4.5, 2), (2, 0.5, 0), (None, 2.5, 0)]
    none = per_key(rows.where("n > 9"), "doc_id", {"n": F.col("n")}, lists={"w": F.col("w")})
    assert none.collect() == []


def test_tokens_are_folded_before_any_sort(spark):
    """A ``groupBy`` with lists over tokens sorts and spills those of all but a few documents."""
    docs = spark.createDataFrame([(i, "A cat walked home. It slept.") for i in range(5)], "doc_id bigint, text string")
    tokens = T.tokens(docs)
    words = spark.createDataFrame([(1, "cat", "noun", "A1")], "seq bigint, headword string, pos string, cefr string")
    forms = L.mark_hot(L.word_forms(tokens))
    for listed in (False, True):
        graded = L.grade_forms(L.retag_forms(forms, words) if listed else forms, words)
        counts = (M.retagged_counts if listed else M.document_counts)(tokens, graded)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan
        assert {r["n_words"] for r in counts.collect()} == {6}


def test_fast_classes_hold_the_same_characters(spark):
    """Over all characters; the counts of a text go through no negated class of many ranges, which costs a look at each range per letter."""
    char = F.pandas_udf(lambda codes: codes.map(chr), "string")
    chars = spark.range(0x110000).where(f"id NOT BETWEEN {0xD800} AND {0xDFFF}").select(char("id").alias("c"))
    whole = lambda pattern: F.col("c").rlike(f"^(?:{pattern})\\z")
    other = [whole(f"[^{X.SPACE}]") != whole(X.SOLID), whole(f"[{X.LETTERS}]") != whole(X.LETTER),
             whole(X.TOKEN) != whole(X.FAST_TOKEN), whole(X.WORD_OR_NUMBER) != whole(X.FAST_WORD_OR_NUMBER),
             (X.strip(F.col("c")) == "") != whole(f"[{X.SPACE}]"), X.whitespace_words(F.col("c")) != whole(X.SOLID).cast("int"),
             X.letter_total(F.col("c")) != whole(f"[{X.LETTERS}0-9]").cast("int")]
    assert chars.agg(*[F.count_if(o) for o in other]).first() == (0,) * len(other)
    docs = spark.createDataFrame([("a\u3000b' \n c ",)], "text string")
    counted = docs.select(X.whitespace_words(F.col("text")), X.strip(F.col("text")), X.word_total(F.col("text")))
    assert counted.first() == (3, "a\u3000b' \n c", 3)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert r"\x{205F}" not in plan.replace(X.SOLID, "")


def test_tokens_are_not_sorted_to_meet_the_list(spark, tmp_path):
    from catalog import QUERIES
    rows = [(1, "The rapid cat walked home. A cat walked.", "en"), (2, "Cats talked, a cat walked home.", "en"), (3, " ", "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    tagged = QUERIES["t4_tags_with_list"](spark, str(tmp_path))
    assert sorted(map(tuple, tagged.collect())) == [(1, 2, 0, 0), (2, 2, 0, 0)]
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
