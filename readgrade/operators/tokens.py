"""Documents to sentences, tokens and noun chunks (T1-T8).

Everything here is a narrow transformation: a document is cut up inside its own
row, so no shuffle happens before the word-level joins.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.tables import fixed_table

# tok_id orders the tokens of a document: sentence in the high half, position in the low half
SENTENCE_SHIFT = 32


def sentences(docs: DataFrame) -> DataFrame:
    """One row per sentence that holds a letter or digit."""
    cut = docs.select("doc_id", F.posexplode(X.sentences_in(F.col("text"))))
    return cut.where(F.col("col").rlike(f"[{X.LETTERS}0-9]")).select("doc_id", F.col("pos").alias("sent_id"), X.strip(F.col("col")).alias("sentence"))


def closed_words(spark) -> DataFrame:
    """Closed-class and stop words of English and the clitics: a fixed table of about two hundred rows."""
    tags = {w: tag for tag, listed in reversed(C.CLOSED_CLASSES.items()) for w in listed} | C.CLITICS
    return fixed_table(spark, ["closed_word", "closed_pos", "stop"],
                       [(w, tags.get(w), "y") for w in dict.fromkeys([*C.STOP_WORDS, *C.CLITICS])])


def tokens(docs: DataFrame) -> DataFrame:
    """The token table.

    Each token sees its left neighbour through a zipped array, so the start of
    a noun chunk is known without a window over the sentence. Word classes come
    from a broadcast of the fixed table above: a hash probe per token keeps the
    generated code small enough to be compiled.
    """
    found = F.regexp_extract_all(X.clitics_apart(F.col("sentence")), F.lit(X.FAST_TOKEN), 0)
    shifted = F.concat(F.array(F.lit("")), F.slice("found", 1, F.greatest(F.size("found") - 1, F.lit(0))))
    pairs = F.arrays_zip(F.col("found").alias("text"), shifted.alias("before"))
    # never null, so that joins on these columns add no null checks that repeat the rules below
    rows = (sentences(docs).select("doc_id", "sent_id", found.alias("found"))
            .select("doc_id", "sent_id", F.posexplode(pairs).alias("pos_in_sent", "pair"))
            .select("doc_id", "sent_id", "pos_in_sent", F.coalesce("pair.text", F.lit("")).alias("marked"),
                    F.coalesce("pair.before", F.lit("")).alias("before"))
            .select("*", X.plain(F.col("marked")).alias("text"))
            .select("*", X.plain_lower(F.col("marked"), F.col("text")).alias("lower"), F.lower("before").alias("before_lower")))
    closed = closed_words(docs.sparkSession)
    before = closed.select(F.col("closed_word").alias("before_word"), F.col("closed_pos").alias("before_closed"))
    at, lower, code = F.col("pos_in_sent"), F.col("lower"), F.col("code")
    tails = {n: F.col(f"tail{n}") for n in (2, 3, 4)}
    probed = (rows.join(F.broadcast(closed), lower == F.col("closed_word"), "left")
              .join(F.broadcast(before), F.col("before_lower") == F.col("before_word"), "left")
              .select("doc_id", "sent_id", "pos_in_sent", "text", "lower", "stop", "closed_pos", "before_lower", "before_closed",
                      X.first_code(F.col("marked")).alias("code"),
                      X.is_letter(X.first_code(F.col("marked")), F.col("marked")).alias("letter"),
                      X.is_capital(X.first_code(F.col("text")), F.col("text")).alias("capital"),
                      X.is_letter(X.first_code(F.col("before")), F.col("before")).alias("before_letter"),
                      X.is_capital(X.first_code(F.col("before")), F.col("before")).alias("before_capital"),
                      *[X.tail(lower, n).alias(f"tail{n}") for n in tails]))
    tagged = probed.select(
        "doc_id", "sent_id", "pos_in_sent", "text", "lower", "stop", "letter", *tails.values(),
        X.part_of_speech(code, F.col("letter"), F.col("capital"), lower, tails, at, F.col("closed_pos"), F.col("before_closed")).alias("pos"),
        X.word_in_chunk(F.col("before_letter"), F.col("before_capital"), F.col("before_lower"), at - 1, F.col("before_closed")).alias("before_np"))
    inside = X.in_chunk(F.col("pos"))
    return tagged.select(
        "doc_id", "sent_id", "pos_in_sent",
        (F.shiftleft(F.col("sent_id").cast("bigint"), SENTENCE_SHIFT) + at).alias("tok_id"),
        "text", "lower", X.lemma(lower, tails, F.col("pos")).alias("lemma"), "pos",
        F.col("letter").alias("is_alpha"),
        F.col("stop").isNotNull().alias("is_stop"),
        inside.alias("in_np"),
        (inside & ((at == 0) | ~F.col("before_np"))).alias("np_start"))


def words(tokens_: DataFrame) -> DataFrame:
    """Tokens that are words, clitics or numbers."""
    return tokens_.where(F.col("pos") != "PUNCT")


def open_class() -> Column:
    """Words whose class an ending, or a list, decides."""
    return F.col("is_alpha") & ~F.col("pos").isin(list(C.CLOSED_CLASSES) + ["PROPN"])


def retag_with_list(tokens_: DataFrame, listed: DataFrame) -> DataFrame:
    """The token table with the classes of a graded list ``(word, list_pos)`` for open-class words, chunks and lemmas included.

    For a corpus of any size ``metrics_of(list_tags=True)`` decides once per word form instead. The list side carries no hint: Spark
    broadcasts it while it is small and falls back to a shuffled join, with skew handling, when it is not. The window stays inside
    one sentence.
    """
    joined = tokens_.join(listed, tokens_["lower"] == listed["word"], "left")
    pos = F.when(open_class(), F.coalesce(F.col("list_pos"), F.col("pos"))).otherwise(F.col("pos"))
    order = W.partitionBy("doc_id", "sent_id").orderBy("pos_in_sent")
    tagged = joined.select(
        *[c for c in tokens_.columns if c not in ("pos", "lemma", "in_np", "np_start")], pos.alias("pos"),
        X.lemma(F.col("lower"), {n: X.tail(F.col("lower"), n) for n in (2, 3, 4)}, pos).alias("lemma"),
        X.in_chunk(pos).alias("in_np"))
    return tagged.withColumn("np_start", F.col("in_np") & ~F.lag("in_np", 1, False).over(order)).select(tokens_.columns)


def predicates(tokens_: DataFrame) -> DataFrame:
    return tokens_.select(
        "*",
        (F.col("is_alpha") & F.col("pos").isin(C.CONTENT_POS["profile"])).alias("is_content"),
        (F.col("is_alpha") & F.col("pos").isin(C.CONTENT_POS["model"])).alias("is_content_model"),
        F.col("pos").isin(C.FUNCTION_POS).alias("is_function"))


def is_candidate() -> Column:
    """Alphabetic, neither a stop word nor a proper noun."""
    return F.col("is_alpha") & ~F.col("is_stop") & (F.col("pos") != "PROPN")


def lexical_candidates(tokens_: DataFrame) -> DataFrame:
    return tokens_.where(is_candidate())


def noun_chunks(docs: DataFrame) -> DataFrame:
    """Maximal runs of determiners, adjectives and nouns, found inside the row of a sentence.

    The tokens of a sentence become a string of ones and noughts, whose runs of ones are the chunks.
    """
    tags = {w: tag for tag, listed in reversed(C.CLOSED_CLASSES.items()) for w in listed}
    inside = [w for w, tag in tags.items() if tag in X.CHUNK_POS]

    def flag(word, place):
        code, lower = X.first_code(word), F.lower(word)
        closed = F.when(lower.isin(inside), inside and tags[inside[0]]).when(lower.isin([w for w in tags if w not in inside]) | X.is_stem(code), "X")
        return F.when(X.word_in_chunk(X.is_letter(code, word), X.is_capital(code, word), lower, place, closed), "1").otherwise("0")

    found = F.regexp_extract_all(X.clitics_apart(F.col("sentence")), F.lit(X.FAST_TOKEN), 0)
    runs = F.regexp_extract_all(F.array_join(F.transform("found", flag), ""), F.lit("1+"), 0)
    rows = sentences(docs).select("doc_id", "sent_id", found.alias("found")).select("doc_id", "sent_id", F.posexplode(runs).alias("chunk_id", "run"))
    size = F.length("run").cast("bigint")
    return rows.select("doc_id", "sent_id", "chunk_id", size.alias("n_alpha"), size.alias("n_ws"))


def chunks_of(tokens_: DataFrame) -> DataFrame:
    """The same from a token table, of another annotator for example; the window stays inside one sentence."""
    order = W.partitionBy("doc_id", "sent_id").orderBy("pos_in_sent")
    chunk = F.sum(F.col("np_start").cast("int")).over(order) - 1
    return (tokens_.where("in_np").select("doc_id", "sent_id", chunk.alias("chunk_id"))
            .groupBy("doc_id", "sent_id", "chunk_id")
            .agg(F.count(F.lit(1)).alias("n_alpha"), F.count(F.lit(1)).alias("n_ws")))


def whitespace_counts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", X.whitespace_words(F.col("text")).alias("n_ws_words"),
                       X.full_stop_pieces(F.col("text")).alias("n_dot_pieces"))
