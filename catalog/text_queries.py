"""Sources, tokens, lexicon and metrics (S, T, L, M)."""

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.registry import query
from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.numbers import fixed
from readgrade.operators import lexicon as L, metrics as M, sinks as K, tokens as T
from readgrade.plans.storage import new_path
from readgrade.sources import tables

METRICS = ", ".join(f"{Q.fx(m)} AS {m}" for m in C.METRICS)
LONG = "CAST({} AS BIGINT)".format


def rounded(df, *names, digits=4):
    return df.withColumns({n: fixed(F.col(n), digits) for n in names})


# ---- sources ------------------------------------------------------------------------

@query("s1_labelled_features", f"SELECT filename, {METRICS}, predict_level FROM features", "features")
def s1(d):
    path = new_path(d.spark, "labelled")
    d.features.drop("doc_id", "word_count", "sentence_count").write.parquet(path)
    return rounded(tables.features(d.spark, path), *C.METRICS)


@query("s2_wordlist", "SELECT seq, headword, cefr FROM wordlist", "wordlist")
def s2(d):
    """The list as CSV under other column names, read by the tolerant form."""
    path = new_path(d.spark, "wordlist")
    listed = d.wordlist.select("seq", F.col("headword").alias("Word"), "pos", F.col("cefr").alias("CEFR-J Level"))
    K.write_csv(listed, path)
    return tables.tolerant_wordlist(tables.headed_csv(d.spark, path, listed.schema))


@query("s1_csv_rejects", f"""SELECT CASE WHEN doc_id%9<>0 THEN filename END AS filename, CASE WHEN doc_id%9<>0 THEN {Q.fx('ARI')} END AS ARI,
       CASE doc_id%9 WHEN 0 THEN CASE WHEN doc_id%2=0 THEN filename||',broken' ELSE filename||',1.0,none,1.0,1.0,1.0,1.0,1.0,1.0,A1.1' END END AS record
       FROM features""", "features")
def s1_csv(d):
    """Every ninth line is malformed: too short, or with a word for a number; both frames in one table."""
    path = new_path(d.spark, "labelled-csv")
    doc, name = F.expr("doc_id % 9"), F.col("filename")
    line = F.concat_ws(",", "filename", *[F.col(m).cast("string") for m in C.METRICS], "predict_level")
    bad = F.when(F.col("doc_id") % 2 == 0, F.concat(name, F.lit(",broken"))).otherwise(F.concat(name, F.lit(",1.0,none,1.0,1.0,1.0,1.0,1.0,1.0,A1.1")))
    d.stored_features.select(F.when(doc == 0, bad).otherwise(line).alias("line")).write.text(path)
    rows, rejects = tables.features_csv(d.spark, path, header=False)
    return rounded(rows, *C.METRICS).select("filename", "ARI", F.lit(None).cast("string").alias("record")).unionByName(
        rejects.select(F.lit(None).cast("string").alias("filename"), F.lit(None).cast("double").alias("ARI"), "record"))


@query("s2_explicit_schema", "SELECT seq, headword, pos, cefr FROM wordlist", "wordlist")
def s2_explicit(d):
    """The list in its own column names, with a column that the schema does not know."""
    path = new_path(d.spark, "own-wordlist")
    d.wordlist.withColumn("note", F.lit("x")).write.parquet(path)
    return tables.wordlist(d.spark, path).select("seq", "headword", "pos", "cefr")


@query("s3_text_files", "SELECT item_id, true AS is_text_file, text FROM benchmark")
def s3(d):
    """A folder of files by item, each read back whole next to its name."""
    path = new_path(d.spark, "texts")
    d.table("benchmark").select("item_id", "text").repartition("item_id").write.option("maxRecordsPerFile", 1).partitionBy("item_id").text(path)
    # the writer ends every file with a line feed
    return tables.text_files(d.spark, path).select(
        F.regexp_extract("path", "item_id=([0-9]+)/", 1).cast("bigint").alias("item_id"), F.col("filename").endswith(".txt").alias("is_text_file"),
        F.regexp_replace("text", "\n\\z", "").alias("text"))


@query("s4_word_frequency", f"SELECT word, n, {Q.fx('zipf')} AS zipf FROM freq", "freq")
def s4(d):
    return rounded(L.frequencies(d.forms), "zipf")


# ---- tokens -----------------------------------------------------------------------------

@query("t1_blank_guard", """SELECT d.doc_id, coalesce(n_words,0) AS n_words, coalesce(n_sents,0) AS n_sents,
       coalesce(n_verbs,0) AS n_verbs, coalesce(n_pos,0) AS n_pos FROM docs_all d LEFT JOIN (
         SELECT doc_id, count(*) FILTER (pos<>'PUNCT' AND NOT clitic) AS n_words, count(DISTINCT sent_id) AS n_sents,
         count(*) FILTER (pos='VERB') AS n_verbs, count(DISTINCT pos) AS n_pos FROM tokens_all GROUP BY doc_id)
       USING (doc_id)""", "docs_all", "tokens_all")
def t1(d):
    docs = d.all_docs
    counts = M.text_counts(T.tokens(docs)).select("doc_id", "n_words", "n_sents", "n_verbs", "n_pos")
    return M.with_blank_counts(counts, docs)


@query("t2_tokens", f"""SELECT doc_id, {LONG('sent_id')} AS sent_id, {LONG('pos_in_sent')} AS pos_in_sent, text
       FROM raw_tokens_all WHERE clitic OR regexp_matches(text,{Q.q('^' + Q.ALNUM)})""", "raw_tokens_all")
def t2(d):
    return T.words(T.tokens(d.all_docs)).select(
        "doc_id", F.col("sent_id").cast("bigint"), F.col("pos_in_sent").cast("bigint"), "text")


@query("t3_sentences", f"SELECT doc_id, {LONG('sent_id')} AS sent_id, sentence FROM sents_all", "sents_all")
def t3(d):
    return T.sentences(d.all_docs).select("doc_id", F.col("sent_id").cast("bigint"), "sentence")


@query("t4_tags", f"""SELECT doc_id, {LONG('sent_id')} AS sent_id, {LONG('pos_in_sent')} AS pos_in_sent, lemma, pos
       FROM tokens""", "tokens")
def t4(d):
    return d.tokens.select("doc_id", F.col("sent_id").cast("bigint"), F.col("pos_in_sent").cast("bigint"), "lemma", "pos")


@query("t4_tags_with_list", f"""SELECT doc_id, count(*) FILTER (p='VERB') AS verbs, count(*) FILTER (p='PROPN') AS names,
       count(*) FILTER (p<>pos) AS changed FROM (
         SELECT t.doc_id, t.pos, CASE WHEN t.is_alpha AND closed_pos IS NULL AND t.pos<>'PROPN'
           THEN coalesce(b.pos,t.pos) ELSE t.pos END AS p
         FROM tokens t LEFT JOIN (SELECT word, arg_min(pos,seq) AS pos FROM listed GROUP BY word) b ON b.word=t.lower)
       GROUP BY doc_id""", "tokens", "listed")
def t4_list(d):
    listed = L.with_token_pos(L.clean_list(d.wordlist)).groupBy("word").agg(F.min_by("pos", "seq").alias("list_pos"))
    # a word is in the list once and the list grows with the corpus: hashed, it meets the tokens without a sort of all tokens
    tagged = T.retag_with_list(d.tokens.withColumn("rule_pos", F.col("pos")), listed.hint("shuffle_hash"))
    return tagged.groupBy("doc_id").agg(
        F.count_if(F.col("pos") == "VERB").alias("verbs"), F.count_if(F.col("pos") == "PROPN").alias("names"),
        F.count_if(F.col("pos") != F.col("rule_pos")).alias("changed"))


_sets = {n: "(" + ",".join(Q.q(p) for p in pos) + ")" for n, pos in
         [("a", C.CONTENT_POS["profile"]), ("b", C.CONTENT_POS["model"]), ("c", C.FUNCTION_POS)]}


@query("t5_token_predicates", f"""SELECT doc_id, count(*) FILTER (is_alpha) AS alpha,
       count(*) FILTER (is_alpha AND pos IN {_sets['a']}) AS content,
       count(*) FILTER (is_alpha AND pos IN {_sets['b']}) AS content_model,
       count(*) FILTER (pos IN {_sets['c']}) AS function_words FROM tokens GROUP BY doc_id""", "tokens")
def t5(d):
    return T.predicates(d.tokens).groupBy("doc_id").agg(
        F.count_if("is_alpha").alias("alpha"), F.count_if("is_content").alias("content"),
        F.count_if("is_content_model").alias("content_model"), F.count_if("is_function").alias("function_words"))


@query("t6_stop_filter", f"""SELECT doc_id, {LONG('sent_id')} AS sent_id, {LONG('pos_in_sent')} AS pos_in_sent, text
       FROM tokens WHERE is_alpha AND NOT is_stop AND pos<>'PROPN'""", "tokens")
def t6(d):
    return T.lexical_candidates(d.tokens).select(
        "doc_id", F.col("sent_id").cast("bigint"), F.col("pos_in_sent").cast("bigint"), "text")


@query("t7_noun_chunks", f"""SELECT doc_id, {LONG('sent_id')} AS sent_id,
       row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY min(pos_in_sent)) - 1 AS chunk_id,
       count(*) AS n_alpha, count(*) AS n_ws FROM (
         SELECT doc_id, sent_id, pos_in_sent,
           pos_in_sent - row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY pos_in_sent) AS island
         FROM tokens WHERE in_np) GROUP BY doc_id, sent_id, island""", "tokens")
def t7(d):
    return T.noun_chunks(d.docs).select(
        "doc_id", F.col("sent_id").cast("bigint"), F.col("chunk_id").cast("bigint"), "n_alpha", "n_ws")


@query("t8_whitespace_counts", f"""SELECT doc_id, len(list_filter(string_split_regex(text,'[{X.SPACE}]+'), lambda w: w<>''))::BIGINT
       AS n_ws_words, len(string_split(text,'.'))::BIGINT AS n_dot_pieces FROM docs_all""", "docs_all")
def t8(d):
    return T.whitespace_counts(d.all_docs)


# ---- lexicon -----------------------------------------------------------------------------

@query("l1_clean_list", "SELECT seq, word, list_pos, cefr FROM listed", "listed")
def l1(d):
    """The list with untidy spelling, tidied."""
    untidy = d.wordlist.select("seq", F.concat(F.lit(" "), "headword", F.lit("\t")).alias("headword"),
                               F.concat("pos", F.lit("\n")).alias("pos"), F.lower("cefr").alias("cefr"))
    return L.clean_list(untidy)


@query("l2_list_pos", "SELECT seq, word, list_pos, pos FROM listed", "listed")
def l2(d):
    return L.with_token_pos(L.clean_list(d.wordlist)).select("seq", "word", "list_pos", "pos")


@query("l3_level_by_pos", "SELECT word, pos, level FROM by_pos", "by_pos")
def l3(d):
    return L.level_by_pos(L.with_token_pos(L.clean_list(d.wordlist)))


@query("l4_level_by_word", "SELECT word, level FROM by_word", "by_word")
def l4(d):
    return L.level_by_word(L.clean_list(d.wordlist))


@query("l5_flat_levels", "SELECT word, level FROM flat", "flat")
def l5(d):
    return L.flat_levels(d.wordlist)


@query("l6_level_scores", f"""SELECT word, {Q.score('level', 4)}::BIGINT AS score_profile,
       {Q.score("CASE WHEN length(word)>9 THEN level||'+' ELSE level END", 0)}::BIGINT AS score_model FROM flat""", "flat")
def l6(d):
    flat = L.flat_levels(d.wordlist)
    odd = F.when(F.length("word") > 9, F.concat("level", F.lit("+"))).otherwise(F.col("level"))
    return flat.select("word", X.level_score(F.col("level"), C.UNKNOWN_SCORE["profile"]).alias("score_profile"),
                       X.level_score(odd, C.UNKNOWN_SCORE["model"]).alias("score_model"))


@query("l7_level_cascade", "SELECT lower, lemma, pos, n, level FROM lexicon", "lexicon")
def l7(d):
    return d.lexicon.select("lower", "lemma", "pos", "n", "level")


@query("l8_flat_lookup", f"""SELECT doc_id, count(*) AS n_found, sum(flat_score)::BIGINT AS sum_score,
       {Q.fx('sum(flat_score)/count(*)')} AS mean_score FROM graded_tokens WHERE content_h AND flat_level IS NOT NULL
       GROUP BY doc_id""", "graded_tokens")
def l8(d):
    return rounded(M.flat_scores(d.counts), "mean_score")


@query("l9_level_from_frequency", f"SELECT word, {Q.level_of_zipf('zipf')} AS level FROM freq", "freq")
def l9(d):
    return L.frequencies(d.forms).select("word", X.level_from_zipf(F.col("zipf"), F.lit(0.0)).alias("level"))


@query("l9_level_from_lemma", f"""SELECT f.lower, f.lemma, f.pos, {Q.level_of_zipf('coalesce(z.zipf,0)')} AS level
       FROM forms f LEFT JOIN freq z ON z.word=f.lemma""", "forms", "freq")
def l9_lemma(d):
    """Forms that have no frequency of their own go by that of their lemma."""
    known = L.frequencies(d.forms).select(F.col("word").alias("lemma"), F.col("zipf").alias("lemma_zipf"))
    return d.forms.join(known, "lemma", "left").select(
        "lower", "lemma", "pos", X.level_from_zipf(F.lit(0.0), F.col("lemma_zipf")).alias("level"))


@query("l10_frequency_rank", f"SELECT word, {Q.rank('zipf')} AS rank FROM freq", "freq")
def l10(d):
    return L.frequencies(d.forms).select("word", X.rank_from_zipf(F.col("zipf")).alias("rank"))


@query("l11_inverse_zipf", f"SELECT word, {Q.fx('10e0-zipf')} AS inverse FROM freq", "freq")
def l11(d):
    return L.frequencies(d.forms).select("word", fixed(X.inverse_zipf(F.col("zipf")), 4).alias("inverse"))


@query("l11_without_frequency", f"SELECT doc_id, {Q.fx('greatest(0e0,10e0-ARI)')} AS inverse FROM surface_ari", "surface_ari")
def l11b(d):
    return M.readability(d.docs).select("doc_id", fixed(X.inverse_zipf(None, F.col("ARI")), 4).alias("inverse"))


@query("l12_lexical_profile", "SELECT doc_id, max_rank, total_tokens, content_tokens, out_of_band_count FROM lexical",
       "lexical")
def l12(d):
    return d.lexical.drop("out_of_band_tokens")


@query("l13_out_of_band_words", "SELECT doc_id, coalesce(array_to_string(words,'; '),'') AS words FROM lexical", "lexical")
def l13(d):
    return d.lexical.select("doc_id", F.array_join("out_of_band_tokens", "; ").alias("words"))


# ---- metrics: one query per metric, both variants -------------------------------------------

def _metric(name, column):
    @query(f"{name}_{column.lower()}", f"""SELECT doc_id, {Q.fx('p.' + column)} AS profile, {Q.fx('m.' + column)} AS model
           FROM metrics_profile p JOIN metrics_model m USING (doc_id)""", "metrics_profile", "metrics_model")
    def build(d):
        columns = ["doc_id", *[fixed(M.VARIANTS[v]()[column], 4).alias(v) for v in M.VARIANTS]]
        return d.counts.select(*columns)


for _number, _column in enumerate(["AvrDiff", "BperA", "CVV1", "AvrFreqRank"], 1):
    _metric(f"m{_number}", _column)
for _number, _column in enumerate(["VperSent", "POStypes", "LenNP"], 6):
    _metric(f"m{_number}", _column)

@query("m5_ari", f"SELECT doc_id, n_letters, n_words, n_sents, {Q.fx(Q.ari('n_letters', 'n_words', 'n_sents'))} AS ARI FROM surface", "surface")
def m5(d):
    return rounded(M.readability(d.docs), "ARI")


for _variant in M.VARIANTS:
    @query(f"m9_metrics_{_variant}", f"SELECT doc_id, {METRICS} FROM metrics_{_variant}", f"metrics_{_variant}")
    def m9(d, variant=_variant):
        return rounded(d.metrics(variant).drop("word_count", "sentence_count"), *C.METRICS)


for _variant in M.VARIANTS:
    @query(f"m9_metrics_{_variant}_list_tags" if _variant != "profile" else "m9_metrics_list_tags",
           f"SELECT doc_id, {METRICS}, word_count, sentence_count FROM metrics_{_variant}_listed", f"metrics_{_variant}_listed")
    def m9_listed(d, variant=_variant):
        return rounded(M.metrics(d.listed_counts, variant), *C.METRICS)


@query("m5_equals_m9", """SELECT doc_id, n_letters, n_words, n_sents, true AS same FROM surface""", "surface")
def m5_equals_m9(d):
    """One ARI: the counts taken from the raw text are those of the tokens, for every document."""
    counted = d.counts.select("doc_id", *[F.col(c).alias(f"t_{c}") for c in ("n_letters", "n_words", "n_sents")])
    same = F.lit(True)
    for c in ("n_letters", "n_words", "n_sents"):
        same = same & (F.col(c) == F.col(f"t_{c}"))
    return M.surface_counts(d.docs).join(counted, "doc_id").select("doc_id", "n_letters", "n_words", "n_sents", same.alias("same"))


@query("m10_counts", "SELECT doc_id, word_count, sentence_count FROM metrics_profile", "metrics_profile")
def m10(d):
    return d.metrics("profile").select("doc_id", "word_count", "sentence_count")


@query("m11_surface_features", f"""SELECT doc_id, {Q.fx('''CASE WHEN n_words>0 AND n_sents>0 THEN
       206.835e0-1.015e0*(n_words/n_sents)-84.6e0*(n_syll/n_words) ELSE 0e0 END''')} AS flesch,
       {Q.fx(Q.ari('n_letters', 'n_words', 'n_sents'))} AS ARI,
       {Q.fx('''CASE WHEN n_words>0 THEN 0.0588e0*(n_letters*100e0/n_words)-0.296e0*(n_sents*100e0/n_words)-15.8e0
             ELSE 0e0 END''')} AS coleman_liau,
       {Q.hits('text', f'[^{X.SPACE}]+')} AS n_ws_words, len(string_split(text,'.'))::BIGINT AS n_dot_pieces
       FROM (SELECT *, {Q.hits('text', X.VOWEL_GROUP)} AS n_syll FROM surface)""", "surface")
def m11(d):
    return rounded(M.surface_features(d.docs), "flesch", "ARI", "coleman_liau")


@query("m12_variety", f"""SELECT doc_id, {Q.fx(Q.div('count(DISTINCT lower) FILTER (is_alpha)', 'count(*) FILTER (is_alpha)'))}
       AS type_token_ratio, {Q.fx(Q.div('count(*) FILTER (in_np)', 'count(*) FILTER (np_start)'))} AS mean_chunk
       FROM tokens GROUP BY doc_id""", "tokens")
def m12(d):
    return rounded(M.variety(d.tokens), "type_token_ratio", "mean_chunk")


@query("m13_sentence_length", f"""SELECT doc_id, w AS word_count, {Q.fx(Q.div('w', 'n_sents'))} AS avg_sentence_length FROM (
       SELECT doc_id, {Q.hits('text', f'[^{X.SPACE}]+')} AS w, n_sents FROM surface)""", "surface")
def m13(d):
    return rounded(M.sentence_length(d.docs), "avg_sentence_length")
