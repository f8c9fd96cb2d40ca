"""Word-level tables: graded lists, frequencies, and joins with the tokens (S4, L1-L13).

Levels and ranks are decided once per distinct word form. Tokens meet the form
table in ``operators.metrics``; its frequent part is broadcast (its size is
bounded by construction), its rare part is joined by shuffle.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.tables import fixed_table
from readgrade.operators import tokens as T
from readgrade.operators.runs import per_key

FORM = ["lower", "lemma", "pos"]
# A form that makes up at least 1/HOT_FORMS of all tokens is "hot"; there cannot be more than HOT_FORMS of them.
HOT_FORMS = 50_000
LISTED_POS = C.CONTENT_POS["profile"]


# ---- graded list -------------------------------------------------------------

def clean_list(wordlist: DataFrame) -> DataFrame:
    """Trimmed lower-case words with one of the six levels."""
    return (wordlist.select("seq", F.lower(X.strip(F.col("headword"))).alias("word"),
                            F.lower(X.strip(F.col("pos"))).alias("list_pos"),
                            F.upper(X.strip(F.col("cefr"))).alias("cefr"))
            .where((F.col("word") != "") & F.col("cefr").isin(C.WORD_LEVELS)))


def with_token_pos(cleaned: DataFrame) -> DataFrame:
    """``pos`` of the token table for the part of speech printed in the list; null when unknown."""
    names = fixed_table(cleaned.sparkSession, ["list_pos", "pos"], C.LIST_POS)
    return cleaned.join(F.broadcast(names), "list_pos", "left")


def level_by_pos(listed: DataFrame) -> DataFrame:
    """(word, pos) -> level; the last row of the list wins."""
    return (listed.where(F.col("pos").isNotNull()).groupBy("word", "pos")
            .agg(F.max_by("cefr", "seq").alias("level")))


def level_by_word(listed: DataFrame) -> DataFrame:
    """word -> level; the first row of the list wins."""
    return listed.groupBy("word").agg(F.min_by("cefr", "seq").alias("level"))


def flat_rows(wordlist: DataFrame) -> DataFrame:
    return (wordlist.select("seq", "headword", "cefr").na.drop()
            .select("seq", F.lower(X.strip(F.col("headword"))).alias("word"),
                    X.wordlist_level(F.col("cefr")).alias("level"))
            .where((F.col("word") != "") & (F.col("level") != "")))


def flat_levels(wordlist: DataFrame) -> DataFrame:
    """word -> level of any spelling; the last row of the list wins."""
    return flat_rows(wordlist).groupBy("word").agg(F.max_by("level", "seq").alias("level"))


def graded_words(wordlist: DataFrame) -> DataFrame:
    """All three maps in one row per word: ``first_level``, ``flat_level``, ``level_<pos>``."""
    listed = with_token_pos(clean_list(wordlist)).select(
        "seq", "word", "pos", "cefr", F.lit(None).cast("string").alias("flat"))
    flat = flat_rows(wordlist).select("seq", "word", F.lit(None).cast("string").alias("pos"),
                                      F.lit(None).cast("string").alias("cefr"), F.col("level").alias("flat"))
    by_pos = [F.max_by("cefr", F.when(F.col("pos") == p, F.col("seq"))).alias(f"level_{p}") for p in LISTED_POS]
    return listed.unionByName(flat).groupBy("word").agg(
        F.min_by("cefr", F.when(F.col("cefr").isNotNull(), F.col("seq"))).alias("first_level"),
        F.max_by("flat", F.when(F.col("flat").isNotNull(), F.col("seq"))).alias("flat_level"), *by_pos)


# ---- word forms and frequencies -------------------------------------------------

def word_forms(tokens: DataFrame) -> DataFrame:
    """Distinct alphabetic (lower, lemma, pos) with their number of tokens."""
    return tokens.where("is_alpha").groupBy(*FORM).agg(F.count(F.lit(1)).alias("n"))


def frequencies(forms: DataFrame) -> DataFrame:
    """word, n, zipf over the corpus the forms were counted in."""
    total = forms.agg(F.sum("n").alias("total")).scalar()
    return (forms.groupBy(F.col("lower").alias("word")).agg(F.sum("n").alias("n"))
            .select("word", "n", X.zipf(F.col("n"), total).alias("zipf")))


def first_classes(wordlist: DataFrame) -> DataFrame:
    """word -> class of its first row in the list."""
    return with_token_pos(clean_list(wordlist)).groupBy("word").agg(F.min_by("pos", "seq").alias("list_pos"))


def retag_forms(forms: DataFrame, wordlist: DataFrame) -> DataFrame:
    """Forms with the class and lemma that the list gives to open-class words; ``tag_pos`` and ``tag_lemma`` hold those of the rules.

    The list meets the vocabulary, never the tokens.
    """
    listed = first_classes(wordlist)
    pos = F.when(F.col("pos").isin(list(C.CLOSED_CLASSES) + ["PROPN"]), F.col("pos")).otherwise(F.coalesce("list_pos", "pos"))
    lemma = X.lemma(F.col("lower"), {n: X.tail(F.col("lower"), n) for n in (2, 3, 4)}, F.col("new_pos"))
    return forms.join(listed, F.col("lower") == F.col("word"), "left").select(
        "lower", F.col("lemma").alias("tag_lemma"), F.col("pos").alias("tag_pos"), "n", "hot", pos.alias("new_pos")).select(
        "lower", lemma.alias("lemma"), F.col("new_pos").alias("pos"), "n", "hot", "tag_lemma", "tag_pos")


def grade_forms(forms: DataFrame, wordlist: DataFrame, freq: DataFrame | None = None) -> DataFrame:
    """Level, score and zipf of every form: (lemma, pos), (surface, pos), lemma, surface, then the rule
    for unlisted words. No hint on either side: both grow, so their run-time size decides the join."""
    freq = frequencies(forms) if freq is None else freq
    words = graded_words(wordlist).join(freq.select("word", "zipf"), "word", "full")
    surface = words.select(F.col("word").alias("lower"), F.col("zipf"),
                           *[F.col(c).alias("s_" + c) for c in words.columns if c.startswith("level_")],
                           F.col("first_level").alias("s_first_level"))
    base = words.select(F.col("word").alias("lemma"), F.col("zipf").alias("lemma_zipf"), "first_level", "flat_level",
                        *[c for c in words.columns if c.startswith("level_")])

    def of_pos(prefix: str) -> Column:
        return reduce(lambda expr, p: expr.when(F.col("pos") == p, F.col(f"{prefix}level_{p}")),
                      LISTED_POS[1:], F.when(F.col("pos") == LISTED_POS[0], F.col(f"{prefix}level_{LISTED_POS[0]}")))

    unlisted = F.when(F.col("pos") != "PROPN", "C1").otherwise(
        X.level_from_zipf(F.col("zipf"), F.col("lemma_zipf")))
    level = F.coalesce(of_pos(""), of_pos("s_"), F.col("first_level"), F.col("s_first_level"), unlisted)
    return (forms.join(surface, "lower", "left").join(base, "lemma", "left")
            .select(*FORM, *[c for c in forms.columns if c.startswith("tag_")], "n", "hot", level.alias("level"), "flat_level", F.coalesce("zipf", F.lit(0.0)).alias("zipf")))


def mark_hot(forms: DataFrame) -> DataFrame:
    """Flag the forms that make up at least 1/HOT_FORMS of all tokens."""
    total = forms.agg(F.sum("n").alias("total")).scalar()
    return forms.withColumn("hot", F.col("n") * HOT_FORMS >= total)


def split_hot(graded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hot, rare) forms; hot has at most HOT_FORMS rows whatever the corpus is."""
    return graded.where("hot").drop("hot"), graded.where(~F.col("hot")).drop("hot")


# ---- lexical profile of a text ----------------------------------------------------

def out_of_band(level: Column, rank: Column, max_rank: Column) -> Column:
    advanced = level.isin("C1", "C2") & (max_rank < C.ADVANCED_BAND_RANK)
    return advanced | (rank > max_rank)


def lexical_profile(tokens: DataFrame, graded: DataFrame, limits: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Per document: alphabetic tokens, candidates, distinct spellings outside the band and their list.

    The list keeps first-seen order and is bounded by the document's own words. One pass over the tokens: hot forms get their
    level and rank from a bounded broadcast, the rare words of a document travel as one array and are joined by shuffle behind a
    header entry with a key of its own, so no exchange is keyed by a frequent word. The number of tokens is taken from
    stored ``counts``; without them it is counted in the same pass.
    """
    levels = graded.select(*FORM, "hot", F.struct("level", X.rank_from_zipf(F.col("zipf")).alias("rank")).alias("g"))
    hot, rare = split_hot(levels)
    kept, candidate = (T.is_candidate(), F.lit(True)) if counts is not None else (F.col("is_alpha"), F.col("candidate"))
    flag = [] if counts is not None else [F.coalesce(T.is_candidate(), F.lit(False)).alias("candidate")]
    seen = tokens.where(kept).select("doc_id", "text", "tok_id", *FORM, *flag).join(F.broadcast(hot), FORM, "left")
    known = F.struct("text", "tok_id", F.col("g.rank").alias("rank"), F.col("g.level").alias("level"))
    sums = {"content_tokens": candidate} | ({} if counts is not None else {"total_tokens": F.lit(1)})
    per_doc = per_key(seen, "doc_id", sums, lists={
        "known": F.when(candidate & F.col("g").isNotNull(), known),
        "rare_words": F.when(candidate & F.col("g").isNull(), F.struct(*FORM, "text", "tok_id"))})

    def flagged(level, rank):
        return (F.col("max_rank") > 0) & out_of_band(level, rank, F.col("max_rank"))

    hits = F.transform(F.filter("known", lambda w: flagged(w["level"], w["rank"])), lambda w: w.dropFields("level"))
    asked = limits.join(per_doc, "doc_id", "left")
    if counts is not None:
        asked = asked.join(counts.select("doc_id", F.col("n_alpha").alias("total_tokens")), "doc_id", "left")
    asked = asked.select(
        "doc_id", F.struct("max_rank", "total_tokens", "content_tokens", hits.alias("hits")).alias("base"), "rare_words")
    header = F.struct(F.lit("").alias("lower"), F.col("doc_id").cast("string").alias("lemma"), F.lit("").alias("pos"),
                      F.lit("").alias("text"), F.lit(None).cast("bigint").alias("tok_id"))
    entries = F.concat(F.array(F.struct(header.alias("w"), F.col("base").alias("base"))), F.transform(
        F.coalesce("rare_words", F.array().cast(per_doc.schema["rare_words"].dataType)),
        lambda w: F.struct(w.alias("w"), F.when(F.lit(False), F.col("base")).alias("base"))))
    # the limit of a document is needed at its rare words
    spread = asked.select("doc_id", F.col("base.max_rank").alias("max_rank"), F.inline(entries)).select("doc_id", "max_rank", "base", "w.*")
    joined = spread.join(rare, FORM, "left")
    hit = F.struct("text", "tok_id", F.col("g.rank").alias("rank"))
    both = joined.groupBy("doc_id").agg(
        F.first("base", ignorenulls=True).alias("base"),
        F.collect_list(F.when(flagged(F.col("g.level"), F.col("g.rank")), hit)).alias("more"))
    # one spelling can have several forms and places: it counts once, at its first flagged place
    found = F.sort_array(F.concat(F.coalesce("base.hits", F.array().cast(both.schema["more"].dataType)), "more"))
    first = F.filter("found", lambda w, i: (i == 0) | (w["text"] != F.get(F.col("found"), i - 1)["text"]))
    entry = F.sort_array(F.transform("first", lambda w: F.struct(
        w["tok_id"].alias("tok_id"), F.concat(w["text"], F.lit(" (rank≈"), w["rank"].cast("string"), F.lit(")")).alias("w"))))
    listed = both.select("doc_id", "base", found.alias("found")).select("doc_id", "base", first.alias("first"))
    max_rank = F.col("base.max_rank")

    def number(name):
        return F.when(max_rank > 0, F.coalesce(F.col(f"base.{name}"), F.lit(0))).otherwise(0).cast("bigint").alias(name)

    return listed.select("doc_id", max_rank.alias("max_rank"), number("total_tokens"), number("content_tokens"),
                         F.size("first").cast("bigint").alias("out_of_band_count"),
                         F.transform(entry, lambda w: w["w"]).alias("out_of_band_tokens"))
