"""Readability metrics per document in both variants (M1-M13).

``document_counts`` makes one pass over the tokens and yields the whole numbers
from which both variants are plain column arithmetic.
"""

from pyspark.sql import Column, DataFrame, functions as F

from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.numbers import ratio
from readgrade.operators.lexicon import FORM, split_hot
from readgrade.operators.runs import per_key

WORD_SUMS = ["n_content", "sum_score", "n_a", "n_b", "n_found", "sum_flat", "n_flat_a", "n_flat_b",
             "sum_rank", "sum_inverse"]
TOKEN_SUMS = ["n_words", "n_letters", "n_alpha", "n_sents", "n_verbs", "n_verb_types",
              "n_pos_alpha", "n_pos", "n_np", "n_chunks"]
SURFACE_SUMS = TOKEN_SUMS[:4]
TOP = C.TRIMMED_TOKENS


def form_weights(graded: DataFrame, *more: Column) -> DataFrame:
    """What one token of a form adds to the counts of its document, and further columns."""
    content = F.col("pos").isin(C.CONTENT_POS["profile"])
    listed = F.col("pos").isin(C.CONTENT_POS["model"]) & F.col("flat_level").isNotNull()
    score = X.level_score(F.col("level"), C.UNKNOWN_SCORE["profile"])
    flat = X.level_score(F.col("flat_level"), C.UNKNOWN_SCORE["model"])

    def flag(condition):
        return F.coalesce(condition, F.lit(False)).cast("bigint")

    return graded.select(
        *FORM, "hot", "zipf", flag(content).alias("n_content"), F.when(content, score).otherwise(0).alias("sum_score"),
        flag(content & (score <= 2)).alias("n_a"), flag(content & (score >= 3)).alias("n_b"),
        flag(listed).alias("n_found"), F.when(listed, flat).otherwise(0).alias("sum_flat"),
        flag(listed & F.col("flat_level").startswith("A")).alias("n_flat_a"),
        flag(listed & F.col("flat_level").startswith("B")).alias("n_flat_b"),
        X.rank_from_zipf(F.col("zipf")).alias("sum_rank"), X.inverse_zipf(F.col("zipf")).alias("sum_inverse"), *more)


def _bit(pos: Column) -> Column:
    """One bit per part of speech: counting kinds needs no distinct."""
    place = F.array_position(F.array(*[F.lit(t) for t in C.POS_TAGS]), pos)
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _kinds(bits: Column) -> Column:
    return F.bit_count(F.bit_or(bits)).cast("bigint")


def surface_flags() -> dict[str, Column]:
    """What a token adds to words, letters and sentences as the surface counts of the text have them: clitics belong to their
    word, points and commas to no word."""
    counted = ~F.col("pos").isin("PUNCT", "SPACE")
    letters = F.when(F.col("is_alpha"), F.length("text")).when(counted, F.length(F.translate("text", ".,'’", ""))).otherwise(0)
    return {"n_words": counted & (F.col("is_alpha") | ~F.col("lower").isin(list(C.CLITICS))), "n_letters": letters,
            "n_alpha": F.col("is_alpha"), "n_sents": F.col("pos_in_sent") == 0}


def surface_sums() -> list[Column]:
    return [F.coalesce(F.sum(v.cast("bigint")), F.lit(0)).alias(c) for c, v in surface_flags().items()]


def token_counts() -> list[Column]:
    """Aggregates that need no word list."""
    pos, verb = F.col("pos"), F.col("pos") == "VERB"
    bit = _bit(pos)
    return [
        *surface_sums(),
        F.count_if(verb).alias("n_verbs"),
        F.size(F.collect_set(F.when(verb, F.col("lemma")))).cast("bigint").alias("n_verb_types"),
        _kinds(F.when(F.col("is_alpha"), bit).otherwise(F.lit(0).cast("bigint"))).alias("n_pos_alpha"),
        _kinds(bit).alias("n_pos"),
        F.count_if("in_np").alias("n_np"),
        F.count_if("np_start").alias("n_chunks"),
    ]


def text_counts(tokens: DataFrame) -> DataFrame:
    """Counts per document that need no word list: one map-side combined aggregate."""
    return tokens.groupBy("doc_id").agg(*token_counts())


def document_counts(tokens: DataFrame, graded: DataFrame) -> DataFrame:
    """All counts per document.

    Hot forms are added up next to the tokens from a bounded broadcast; the rare
    words of a document travel as one array and are then joined by shuffle. A
    header entry with a key of its own carries the sums through that join, so
    the token stage runs once and no key collects more than its share of rows.
    """
    hot, rare = split_hot(form_weights(graded))
    seen = tokens.join(F.broadcast(hot), FORM, "left")
    missed = F.col("is_alpha") & F.col("zipf").isNull()
    per_doc = per_key(
        seen, "doc_id", surface_flags() | {"n_verbs": F.col("pos") == "VERB", "n_np": F.col("in_np"), "n_chunks": F.col("np_start")} |
        {c: F.col(c) for c in WORD_SUMS}, {"alpha_bits": F.when(F.col("is_alpha"), _bit(F.col("pos"))), "bits": _bit(F.col("pos"))},
        {"verbs": F.when(F.col("pos") == "VERB", F.col("lemma")), "lows": F.col("zipf"), "rare_words": F.when(missed, F.struct(*FORM))},
        {"verbs": F.array_distinct("verbs"), "lows": F.slice(F.sort_array("lows"), 1, TOP)}).select(
            "doc_id", *SURFACE_SUMS, "n_verbs", F.size("verbs").cast("bigint").alias("n_verb_types"),
            F.bit_count("alpha_bits").cast("bigint").alias("n_pos_alpha"), F.bit_count("bits").cast("bigint").alias("n_pos"),
            "n_np", "n_chunks", *WORD_SUMS, "lows", "rare_words")
    base = F.struct(*TOKEN_SUMS, *WORD_SUMS, "lows")
    header = F.struct(F.lit("").alias("lower"), F.col("doc_id").cast("string").alias("lemma"), F.lit("").alias("pos"),
                      base.alias("base"))
    empty = F.when(F.lit(False), base)
    entries = F.concat(F.array(header), F.transform("rare_words", lambda w: F.struct(
        w["lower"].alias("lower"), w["lemma"].alias("lemma"), w["pos"].alias("pos"), empty.alias("base"))))
    joined = per_doc.select("doc_id", F.inline(entries)).join(rare, FORM, "left")
    both = joined.groupBy("doc_id").agg(
        F.first("base", ignorenulls=True).alias("base"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in WORD_SUMS],
        F.slice(F.sort_array(F.collect_list("zipf")), 1, TOP).alias("lows"))
    return both.select(
        "doc_id", *[F.col(f"base.{c}").alias(c) for c in TOKEN_SUMS],
        *[(F.col(f"base.{c}") + F.col(c)).alias(c) for c in WORD_SUMS],
        F.slice(F.sort_array(F.concat("base.lows", "lows")), 1, TOP).alias("lows"))


def _retagged_weights(graded: DataFrame) -> DataFrame:
    """Weights of the forms as the list tags them, found by the form that the rules gave the token; ``tag`` has what else
    depends on the class."""
    tag = F.struct(F.when(F.col("pos") == "VERB", F.col("lemma")).alias("verb"), _bit(F.col("pos")).alias("bit"),
                   F.when(X.in_chunk(F.col("pos")), "1").otherwise("0").alias("np"))
    weights = form_weights(graded, "tag_lemma", "tag_pos", tag.alias("tag"))
    return weights.select("lower", F.col("tag_lemma").alias("lemma"), F.col("tag_pos").alias("pos"),
                          *[c for c in weights.columns if c not in (*FORM, "tag_lemma", "tag_pos")])


def retagged_counts(tokens: DataFrame, graded: DataFrame) -> DataFrame:
    """:func:`document_counts` with the classes of ``retag_forms``: tokens carry the tags of the rules, ``graded`` the others.

    The same split: hot forms come by a bounded broadcast, rare ones as an array of the document through one join. A document
    keeps a string of its tokens, one for inside a noun chunk, nought for outside, a question mark for a rare word; the
    answers of the join fill the marks in order, and the chunks are the runs of ones, counted inside the row.
    """
    hot, rare = split_hot(_retagged_weights(graded))
    seen = tokens.join(F.broadcast(hot), FORM, "left")
    missed = F.col("is_alpha") & F.col("tag").isNull()
    sign = F.when(F.col("is_alpha"), F.coalesce("tag.np", F.lit("?"))).otherwise(F.when(F.col("in_np"), "1").otherwise("0"))
    mark = F.struct("tok_id", F.concat(F.when(F.col("pos_in_sent") == 0, "|").otherwise(""), sign).alias("m"))
    word_sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in WORD_SUMS]
    lows = F.slice(F.sort_array(F.collect_list("zipf")), 1, TOP).alias("lows")
    none = F.lit(0).cast("bigint")
    verbs = [F.count("tag.verb").alias("n_verbs"), F.collect_set("tag.verb").alias("verbs"),
             F.bit_or(F.coalesce("tag.bit", none)).alias("bits")]
    own = F.struct(*FORM, "tok_id", F.when(F.col("in_np"), "1").otherwise("0").alias("own"))
    per_doc = per_key(
        seen, "doc_id", surface_flags() | {"n_verbs": F.col("tag.verb").isNotNull()} | {c: F.col(c) for c in WORD_SUMS},
        {"bits": F.col("tag.bit"), "other_bits": F.when(F.col("is_alpha"), none).otherwise(_bit(F.col("pos")))},
        {"verbs": F.col("tag.verb"), "marks": mark, "lows": F.col("zipf"), "rare_words": F.when(missed, own)},
        {"verbs": F.array_distinct("verbs"), "marks": F.sort_array("marks"), "lows": F.slice(F.sort_array("lows"), 1, TOP)})
    base = F.struct("n_words", "n_letters", "n_alpha", "n_sents", "n_verbs", "verbs", "bits", "other_bits",
                    F.array_join(F.transform("marks", lambda x: x["m"]), "").alias("marks"), *WORD_SUMS, "lows")
    none_such = F.when(F.lit(False), base)
    header = F.struct(F.lit("").alias("lower"), F.col("doc_id").cast("string").alias("lemma"), F.lit("").alias("pos"),
                      F.lit(None).cast("bigint").alias("tok_id"), F.lit("").alias("own"), base.alias("base"))
    entries = F.concat(F.array(header), F.transform("rare_words", lambda w: F.struct(
        *[w[c].alias(c) for c in (*FORM, "tok_id", "own")], none_such.alias("base"))))
    joined = per_doc.select("doc_id", F.inline(entries)).join(rare, FORM, "left")
    answer = F.struct("tok_id", F.coalesce("tag.np", "own").alias("m"))
    both = joined.groupBy("doc_id").agg(
        F.first("base", ignorenulls=True).alias("base"), *verbs, *word_sums, lows,
        F.sort_array(F.collect_list(F.when(F.col("tok_id").isNotNull(), answer))).alias("answers"))
    filled = F.array_join(F.transform(F.split("base.marks", "[?]"), lambda part, i: F.concat(
        part, F.coalesce(F.get(F.col("answers"), i)["m"], F.lit("")))), "")
    bits, other = F.col("bits").bitwiseOR(F.col("base.bits")), F.col("base.other_bits")
    return both.withColumn("filled", filled).select(
        "doc_id", *[F.col(f"base.{c}").alias(c) for c in ("n_words", "n_letters", "n_alpha", "n_sents")],
        (F.col("base.n_verbs") + F.col("n_verbs")).alias("n_verbs"),
        F.size(F.array_union("base.verbs", "verbs")).cast("bigint").alias("n_verb_types"),
        F.bit_count(bits).cast("bigint").alias("n_pos_alpha"), F.bit_count(bits.bitwiseOR(other)).cast("bigint").alias("n_pos"),
        X.matches(F.col("filled"), "1").alias("n_np"), X.matches(F.col("filled"), "1+").alias("n_chunks"),
        *[(F.col(f"base.{c}") + F.col(c)).alias(c) for c in WORD_SUMS],
        F.slice(F.sort_array(F.concat("base.lows", "lows")), 1, TOP).alias("lows"))


def flat_scores(counts: DataFrame) -> DataFrame:
    """Per document: content tokens found in the flat list and their mean score; unlisted words do not count."""
    return counts.where(F.col("n_found") > 0).select("doc_id", "n_found", F.col("sum_flat").alias("sum_score"),
                         ratio(F.col("sum_flat"), F.col("n_found")).alias("mean_score"))


# ---- the eight metrics as arithmetic over the counts ----------------------------

def _trimmed(total: Column, of_zipf) -> Column:
    """Mean over the alphabetic tokens without the three rarest, if there are more than three."""
    n = F.col("n_alpha")
    rarest = [F.coalesce(of_zipf(F.get("lows", F.lit(i))), F.lit(0)) for i in range(TOP)]
    return F.when(n > TOP, ratio(total - sum(rarest[1:], rarest[0]), n - TOP)).otherwise(ratio(total, n))


def _rank_or_none(zipf: Column) -> Column:
    return F.when(zipf.isNotNull(), X.rank_from_zipf(zipf))


def profile_metrics() -> dict[str, Column]:
    verbs = F.col("n_verbs")
    return {
        "ARI": X.ari(F.col("n_letters"), F.col("n_words"), F.col("n_sents")),
        "AvrDiff": ratio(F.col("sum_score"), F.col("n_content")),
        "BperA": ratio(F.col("n_b"), F.greatest(F.lit(1), F.col("n_a"))),
        "CVV1": F.when(verbs > 0, F.col("n_verb_types") / F.sqrt(verbs) * 2.0).otherwise(0.0),
        "AvrFreqRank": _trimmed(F.col("sum_rank"), _rank_or_none),
        "VperSent": ratio(verbs, F.greatest(F.lit(1), F.col("n_sents"))),
        "POStypes": F.col("n_pos_alpha").cast("double"),
        "LenNP": ratio(F.col("n_np"), F.col("n_chunks")),
    }


def model_metrics() -> dict[str, Column]:
    verbs = F.col("n_verbs")
    return {
        "ARI": X.ari(F.col("n_letters"), F.col("n_words"), F.col("n_sents")),
        "AvrDiff": ratio(F.col("sum_flat"), F.col("n_found")),
        "BperA": ratio(F.col("n_flat_b"), F.col("n_flat_a")),
        "CVV1": F.when(verbs > 0, F.col("n_verb_types") / F.sqrt(2.0 * verbs)).otherwise(0.0),
        "AvrFreqRank": _trimmed(F.col("sum_inverse"), X.inverse_zipf_or_none),
        "VperSent": ratio(verbs, F.col("n_sents")),
        "POStypes": F.col("n_pos").cast("double"),
        "LenNP": ratio(F.col("n_np"), F.col("n_sents")),
    }


VARIANTS = {"profile": profile_metrics, "model": model_metrics}


def metrics(counts: DataFrame, variant: str) -> DataFrame:
    """The eight metrics plus the two counts of M10."""
    return counts.select("doc_id", *[e.alias(name) for name, e in VARIANTS[variant]().items()],
                         F.col("n_alpha").alias("word_count"), F.col("n_sents").alias("sentence_count"))


def with_blank_counts(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts without a letter or digit have no tokens: they get zero counts, so that all their metrics are zero.

    To be done once, before the counts are stored: what reads stored counts never reads the texts again.
    """
    blank = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(f"[{X.LETTERS}0-9]"))
    zeros = [(F.array() if f.dataType.typeName() == "array" else F.lit(0)).cast(f.dataType).alias(f.name)
             for f in counts.schema.fields if f.name != "doc_id"]
    return counts.unionByName(blank.select("doc_id", *zeros))


# ---- metrics straight from the text, no shuffle -----------------------------------

def surface_counts(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select("doc_id", "text", X.letter_total(text).alias("n_letters"), X.word_total(text).alias("n_words"),
                       X.sentence_total(text).alias("n_sents"))


def readability(docs: DataFrame) -> DataFrame:
    """ARI with the counts behind it."""
    return surface_counts(docs).select(
        "doc_id", "n_letters", "n_words", "n_sents",
        X.ari(F.col("n_letters"), F.col("n_words"), F.col("n_sents")).alias("ARI"))


def surface_features(docs: DataFrame) -> DataFrame:
    """Flesch Reading Ease, ARI, Coleman-Liau, words and full-stop pieces."""
    counted = surface_counts(docs).select("*", X.matches(F.col("text"), X.VOWEL_GROUP).alias("n_syll"))
    letters, words, sents = F.col("n_letters"), F.col("n_words"), F.col("n_sents")
    return counted.select(
        "doc_id", X.flesch(words, sents, F.col("n_syll")).alias("flesch"), X.ari(letters, words, sents).alias("ARI"),
        X.coleman_liau(letters, words, sents).alias("coleman_liau"),
        X.whitespace_words(F.col("text")).alias("n_ws_words"), X.full_stop_pieces(F.col("text")).alias("n_dot_pieces"))


def variety(tokens: DataFrame) -> DataFrame:
    """Type/token ratio and mean chunk length."""
    counts = tokens.groupBy("doc_id").agg(
        F.size(F.collect_set(F.when(F.col("is_alpha"), F.col("lower")))).alias("n_types"),
        F.count_if("is_alpha").alias("n_alpha"), F.count_if("in_np").alias("n_np"),
        F.count_if("np_start").alias("n_chunks"))
    return counts.select("doc_id", ratio(F.col("n_types"), F.col("n_alpha")).alias("type_token_ratio"),
                         ratio(F.col("n_np"), F.col("n_chunks")).alias("mean_chunk"))


def sentence_length(docs: DataFrame) -> DataFrame:
    counted = docs.select("doc_id", X.whitespace_words(F.col("text")).alias("word_count"),
                          X.sentence_total(F.col("text")).alias("n_sents"))
    return counted.select("doc_id", "word_count", ratio(F.col("word_count"), F.col("n_sents")).alias("avg_sentence_length"))
