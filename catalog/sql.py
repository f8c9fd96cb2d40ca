"""Building blocks of the SQL counterparts: named subqueries in the dialect of the checking engine.

They restate the semantics in plain SQL (windows, keyed joins, row-wise
tokens), not in the shape of the Spark plans they are compared with.
"""

from catalog import fixtures as FX
from readgrade import fixed as C
from readgrade.functions import text as X

LET = X.LETTERS
INF = "'infinity'::double"


def q(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return f"{value!r}"
    return "'" + value.replace("'", "''") + "'"


def values(name: str, columns: list[str], rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS {name}_v({', '.join(columns)})"


def case(column: str, pairs, op: str, default, value=q) -> str:
    arms = " ".join(f"WHEN {column} {op} {q(b)} THEN {value(v)}" for b, v in pairs)
    return f"CASE {arms} ELSE {value(default)} END"


def fx(expr: str, digits: int = 4) -> str:
    scale = f"{10 ** digits}e0"
    return f"floor(({expr})*{scale}+0.5e0)/{scale}"


def d2(x: str) -> str:
    cents = f"CAST(floor(abs({x})*100e0+0.5e0) AS BIGINT)"
    return (f"(CASE WHEN ({x})<0 AND {cents}>0 THEN '-' ELSE '' END || CAST({cents}//100 AS VARCHAR) || '.' || "
            f"lpad(CAST({cents}%100 AS VARCHAR),2,'0'))")


def div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE)/nullif(CAST({b} AS DOUBLE),0),0e0)"


def strip(x: str) -> str:
    return f"regexp_replace({x},'^[{X.SPACE}]+|[{X.SPACE}]+$','','g')"


def apart(x: str) -> str:
    """Private characters before clitics; three turns, as matches that share a character are found one after another."""
    for _ in range(3):
        x = f"regexp_replace({x},{q(f'([{LET}])({X.CLITIC_ENDS})($|[^{LET}])')},{q(f'{chr(92)}1{X.CLITIC}{chr(92)}2{chr(92)}3')},'g')"
    stems = "|".join(C.CLITIC_STEMS)
    return f"regexp_replace({x},{q(f'(?i)(^|[^{LET}])({stems})({X.CLITIC}n[{chr(39)}’]t)')},{q(f'{chr(92)}1{X.STEM}{chr(92)}2{chr(92)}3')},'g')"


def joint(piece: str, following: str) -> str:
    return "(" + " OR ".join(f"(regexp_matches({piece},{q(a)}) AND regexp_matches({following},{q(b)}))" for a, b in X.JOINTS) + ")"


def hits(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x},{q(pattern)}))::BIGINT"


def fill(template: str, slots: dict[str, str]) -> str:
    """Replace ``{name}`` by SQL expressions; the template is text."""
    expr = q(template)
    for name, value in slots.items():
        expr = f"replace({expr},{q('{' + name + '}')},{value})"
    return expr


def rank(z: str) -> str:
    return (f"(CASE WHEN {z}>0 THEN CAST(least(greatest(round_even(pow(10e0,least(greatest(7e0-{z},0e0),7e0)),0),1e0),"
            f"{C.FALLBACK_RANK}e0) AS BIGINT) ELSE {C.FALLBACK_RANK} END)")


def level_of_zipf(z: str) -> str:
    return case(z, C.FREQUENCY_LEVEL_CUTS, ">=", "C2")


def score(level: str, unknown) -> str:
    return case(level, C.LEVEL_SCORES, "=", unknown)


def ari(l: str, w: str, s: str) -> str:
    return f"(CASE WHEN {w}>0 AND {s}>0 THEN 4.71e0*({l}/{w})+0.5e0*({w}/{s})-21.43e0 ELSE 0e0 END)"


def text_level(a: str) -> str:
    return case(a, FX.ARI_CUTS, "<", "C2")


def label_by_number(n: str) -> str:
    return case(n, [(i, v) for i, v in enumerate(C.TEXT_LEVELS)], "=", None)


ALNUM = f"[{LET}0-9]"
LETTER_COUNT = f"length(regexp_replace(text,{q('[^' + LET + '0-9]+')},'','g'))::BIGINT"
_tags = {w: t for t, listed in reversed(C.CLOSED_CLASSES.items()) for w in listed} | C.CLITICS
_suffix = "CASE " + " ".join(
    f"WHEN {' OR '.join(f'suffix(lower,{q(e)})' for e in ends)} THEN {q(t)}" for t, ends in C.OPEN_CLASS_SUFFIXES) + " END"
_content = "(" + ",".join(q(p) for p in C.CONTENT_POS["profile"]) + ")"
_content_h = "(" + ",".join(q(p) for p in C.CONTENT_POS["model"]) + ")"
_np = "(" + ",".join(q(p) for p in X.CHUNK_POS) + ")"


_lemma = f"""CASE
                WHEN pos='VERB' AND length(lower)>={C.MIN_SUFFIX_WORD} THEN
                  CASE WHEN suffix(lower,'ing') THEN left(lower,length(lower)-3)
                       WHEN suffix(lower,'ed') THEN left(lower,length(lower)-2) ELSE lower END
                WHEN pos='NOUN' AND length(lower)>=4 THEN
                  CASE WHEN suffix(lower,'ies') THEN left(lower,length(lower)-3)||'y'
                       WHEN regexp_matches(lower,'(ss|sh|ch|x)es$') THEN left(lower,length(lower)-2)
                       WHEN regexp_matches(lower,'[sui]s$') THEN lower
                       WHEN suffix(lower,'s') THEN left(lower,length(lower)-1) ELSE lower END
                ELSE lower END"""


def _token_ctes(suffix: str, docs: str) -> dict[str, tuple[list[str], str]]:
    return {
        f"pieces{suffix}": ([docs], f"""
            SELECT doc_id, piece, raw, coalesce({joint('raw', 'following')},false) AS joined FROM (
              SELECT *, lead(raw) OVER (PARTITION BY doc_id ORDER BY piece) AS following FROM (
                SELECT doc_id, unnest(seg) AS raw, generate_subscripts(seg,1)-1 AS piece FROM (
                  SELECT doc_id, regexp_extract_all(text,{q(X.SENTENCE)}) AS seg FROM {docs})))"""),
        f"sents{suffix}": ([f"pieces{suffix}"], f"""
            SELECT doc_id, sent_id, {strip('raw')} AS sentence FROM (
              SELECT doc_id, sent_id, string_agg(raw,'' ORDER BY piece) AS raw FROM (
                SELECT *, sum(CASE WHEN before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY piece) - 1 AS sent_id FROM (
                  SELECT *, coalesce(lag(joined) OVER (PARTITION BY doc_id ORDER BY piece),false) AS before FROM pieces{suffix}))
              GROUP BY doc_id, sent_id)
            WHERE regexp_matches(raw,{q(ALNUM)})"""),
        f"n_sents{suffix}": ([docs, f"sents{suffix}"], f"""
            SELECT doc_id, coalesce(n,0)::BIGINT AS n_sents FROM {docs}
            LEFT JOIN (SELECT doc_id, count(*) AS n FROM sents{suffix} GROUP BY doc_id) USING (doc_id)"""),
        f"raw_tokens{suffix}": ([f"sents{suffix}"], f"""
            SELECT doc_id, sent_id, CASE WHEN prefix(marked,{q(X.CLITIC)}) OR prefix(marked,{q(X.STEM)}) THEN substr(marked,2) ELSE marked END AS text,
              prefix(marked,{q(X.CLITIC)}) AS clitic, prefix(marked,{q(X.STEM)}) AS stem, pos_in_sent FROM (
              SELECT doc_id, sent_id, unnest(w) AS marked, generate_subscripts(w,1)-1 AS pos_in_sent FROM (
                SELECT doc_id, sent_id, regexp_extract_all({apart('sentence')},{q(X.TOKEN)}) AS w FROM sents{suffix}))"""),
        f"tokens{suffix}": ([f"raw_tokens{suffix}", "closed"], f"""
            SELECT *, in_np AND NOT coalesce(lag(in_np) OVER (PARTITION BY doc_id, sent_id ORDER BY pos_in_sent), false)
                   AS np_start
            FROM (SELECT *, pos IN {_np} AS in_np, {_lemma} AS lemma
              FROM (SELECT *, CASE WHEN is_alpha THEN coalesce(closed_pos, CASE WHEN stem THEN 'AUX' END,
                        CASE WHEN pos_in_sent>0 AND left(text,1)<>lower(left(text,1)) THEN 'PROPN' END,
                        CASE WHEN length(lower)>={C.MIN_SUFFIX_WORD} THEN {_suffix} END, 'NOUN')
                      WHEN clitic THEN CASE WHEN lower=chr(39)||'s' AND before_closed='PRON' THEN 'AUX' ELSE closed_pos END
                      WHEN regexp_matches(text,'^[0-9]') THEN 'NUM' ELSE 'PUNCT' END AS pos
                    FROM (SELECT *, lag(closed_pos) OVER (PARTITION BY doc_id, sent_id ORDER BY pos_in_sent) AS before_closed
                      FROM (SELECT t.*, closed_pos, word IS NOT NULL AS is_stop FROM (
                        SELECT *, CASE WHEN clitic THEN replace(lower(text),'’',chr(39)) ELSE lower(text) END AS lower,
                          NOT clitic AND regexp_matches(text,'^[{LET}]') AS is_alpha FROM raw_tokens{suffix}) t
                        LEFT JOIN closed ON lower=word))))"""),
    }


def _graded_ctes(suffix: str) -> dict[str, tuple[list[str], str]]:
    return {
        f"lexicon{suffix}": ([f"forms{suffix}", "by_pos", "by_word", "flat", "freq"], f"""
            SELECT f.lower, f.lemma, f.pos, f.n, fl.level AS flat_level, coalesce(z.zipf,0e0) AS zipf,
              coalesce(p1.level,p2.level,w1.level,w2.level, CASE WHEN f.pos<>'PROPN' THEN 'C1'
                ELSE {level_of_zipf('coalesce(nullif(z.zipf,0),zl.zipf,0)')} END) AS level
            FROM forms{suffix} f LEFT JOIN by_pos p1 ON p1.word=f.lemma AND p1.pos=f.pos
              LEFT JOIN by_pos p2 ON p2.word=f.lower AND p2.pos=f.pos
              LEFT JOIN by_word w1 ON w1.word=f.lemma LEFT JOIN by_word w2 ON w2.word=f.lower
              LEFT JOIN flat fl ON fl.word=f.lemma
              LEFT JOIN freq z ON z.word=f.lower LEFT JOIN freq zl ON zl.word=f.lemma"""),
        f"graded_tokens{suffix}": ([f"tokens{suffix}", f"lexicon{suffix}"], f"""
            SELECT t.*, l.level, l.flat_level, l.zipf, {rank('l.zipf')} AS rank,
              t.is_alpha AND t.pos IN {_content} AS content, t.is_alpha AND t.pos IN {_content_h} AS content_h,
              {score('l.level', 4)} AS score, {score('l.flat_level', 0)} AS flat_score,
              row_number() OVER (PARTITION BY t.doc_id, t.is_alpha ORDER BY l.zipf, t.sent_id, t.pos_in_sent) AS place,
              count(*) OVER (PARTITION BY t.doc_id, t.is_alpha) AS n_same
            FROM tokens{suffix} t LEFT JOIN lexicon{suffix} l ON l.lower=t.lower AND l.lemma=t.lemma AND l.pos=t.pos AND t.is_alpha"""),
        f"counts{suffix}": ([f"graded_tokens{suffix}"], f"""SELECT doc_id,
            count(*) FILTER (pos<>'PUNCT' AND NOT clitic) AS n_words,
            sum(length(regexp_replace(text,'[.,{chr(39) * 2}’]','','g'))) FILTER (pos<>'PUNCT')::BIGINT AS n_letters,
            count(*) FILTER (is_alpha) AS n_alpha, count(DISTINCT sent_id) AS n_sents,
            count(*) FILTER (pos='VERB') AS n_verbs, count(DISTINCT lemma) FILTER (pos='VERB') AS n_verb_types,
            count(DISTINCT pos) FILTER (is_alpha) AS n_pos_alpha, count(DISTINCT pos) AS n_pos,
            count(*) FILTER (in_np) AS n_np, count(*) FILTER (np_start) AS n_chunks,
            count(*) FILTER (content) AS n_content, coalesce(sum(score) FILTER (content),0)::BIGINT AS sum_score,
            count(*) FILTER (content AND score<=2) AS n_a, count(*) FILTER (content AND score>=3) AS n_b,
            count(*) FILTER (content_h AND flat_level IS NOT NULL) AS n_found,
            coalesce(sum(flat_score) FILTER (content_h AND flat_level IS NOT NULL),0)::BIGINT AS sum_flat,
            count(*) FILTER (content_h AND prefix(flat_level,'A')) AS n_flat_a,
            count(*) FILTER (content_h AND prefix(flat_level,'B')) AS n_flat_b,
            count(*) FILTER (is_alpha AND (n_same<=3 OR place>3)) AS n_kept,
            coalesce(sum(rank) FILTER (is_alpha AND (n_same<=3 OR place>3)),0)::BIGINT AS kept_rank,
            sum(10e0-zipf) FILTER (is_alpha AND (n_same<=3 OR place>3)) AS kept_inverse
            FROM graded_tokens{suffix} GROUP BY doc_id"""),
    }


def _metric_select(variant: str, counts: str = "counts") -> str:
    if variant == "profile":
        return f"""SELECT doc_id, {ari('n_letters', 'n_words', 'n_sents')} AS ARI,
            {div('sum_score', 'n_content')} AS AvrDiff, {div('n_b', 'greatest(1,n_a)')} AS BperA,
            CASE WHEN n_verbs>0 THEN n_verb_types/sqrt(n_verbs)*2 ELSE 0e0 END AS CVV1,
            {div('kept_rank', 'n_kept')} AS AvrFreqRank, {div('n_verbs', 'greatest(1,n_sents)')} AS VperSent,
            n_pos_alpha::DOUBLE AS POStypes, {div('n_np', 'n_chunks')} AS LenNP,
            n_alpha AS word_count, n_sents AS sentence_count FROM {counts}"""
    return f"""SELECT doc_id, {ari('n_letters', 'n_words', 'n_sents')} AS ARI,
            {div('sum_flat', 'n_found')} AS AvrDiff, {div('n_flat_b', 'n_flat_a')} AS BperA,
            CASE WHEN n_verbs>0 THEN n_verb_types/sqrt(2*n_verbs) ELSE 0e0 END AS CVV1,
            {div('kept_inverse', 'n_kept')} AS AvrFreqRank, {div('n_verbs', 'n_sents')} AS VperSent,
            n_pos::DOUBLE AS POStypes, {div('n_np', 'n_sents')} AS LenNP,
            n_alpha AS word_count, n_sents AS sentence_count FROM {counts}"""


def _with_blanks(name: str) -> str:
    cols = ", ".join(f"coalesce({m},0) AS {m}" for m in C.METRICS + ["word_count", "sentence_count"])
    return f"SELECT d.doc_id, {cols} FROM docs_en d LEFT JOIN {name} USING (doc_id)"


CTES: dict[str, tuple[list[str], str]] = {
    "docs_en": ([], "SELECT doc_id, text FROM documents WHERE lang='en'"),
    "docs_all": ([], "SELECT doc_id, text FROM documents"),
    "closed": ([], values("closed", ["word", "closed_pos"], [(w, _tags.get(w)) for w in dict.fromkeys([*C.STOP_WORDS, *C.CLITICS])])),
    **_token_ctes("", "docs_en"),
    **_token_ctes("_all", "docs_all"),
    "forms": (["tokens"], "SELECT lower, lemma, pos, count(*) AS n FROM tokens WHERE is_alpha GROUP BY ALL"),
    "freq": (["forms"], """SELECT lower AS word, sum(n)::BIGINT AS n,
            log10(sum(n)*1e9/(SELECT sum(n) FROM forms)) AS zipf FROM forms GROUP BY lower"""),
    "graded": (["forms"], f"""SELECT lower AS headword, pos, sum(n) AS n,
            {case('sum(n)', FX.COUNT_CUTS, '>=', 'C2')} AS cefr FROM forms WHERE pos IN {_content}
            GROUP BY lower, pos HAVING sum(n)>={FX.MIN_LISTED}"""),
    "wordlist": (["graded"], f"""
            SELECT {case('pos', [(p, i) for i, (p, _) in enumerate(FX.LIST_POS_NAME, 1)], '=', 0)}::BIGINT AS seq,
              headword, {case('pos', FX.LIST_POS_NAME, '=', None)} AS pos, cefr FROM graded
            UNION ALL SELECT {FX.COPY_SEQ}+{case('pos', [(p, i) for i, (p, _) in enumerate(FX.LIST_POS_NAME, 1)], '=', 0)},
              headword, {case('pos', FX.LIST_POS_NAME, '=', None)}, {q(FX.COPY_LEVEL[1])} FROM graded
            WHERE cefr={q(FX.COPY_LEVEL[0])}"""),
    "listed": (["wordlist"], f"""SELECT seq, lower({strip('headword')}) AS word, lower({strip('pos')}) AS list_pos,
            {case(f"lower({strip('pos')})", C.LIST_POS, '=', None)} AS pos, upper({strip('cefr')}) AS cefr FROM wordlist
            WHERE {strip('headword')}<>'' AND upper({strip('cefr')}) IN ({','.join(q(v) for v in C.WORD_LEVELS)})"""),
    "by_pos": (["listed"], "SELECT word, pos, arg_max(cefr,seq) AS level FROM listed WHERE pos IS NOT NULL GROUP BY ALL"),
    "by_word": (["listed"], "SELECT word, arg_min(cefr,seq) AS level FROM listed GROUP BY word"),
    "flat": (["wordlist"], f"""SELECT word, arg_max(level,seq) AS level FROM (SELECT seq, lower({strip('headword')}) AS word,
              coalesce(nullif(regexp_extract(c,'^([ABC][12])',1),''),c) AS level
              FROM (SELECT *, replace(upper({strip('cefr')}),' ','') AS c FROM wordlist))
            WHERE word<>'' AND level<>'' GROUP BY word"""),
    **_graded_ctes(""),
    **_graded_ctes("_listed"),
    "surface": (["docs_en", "n_sents"], f"""SELECT doc_id, text, n_sents, {LETTER_COUNT} AS n_letters,
            {hits(apart('text'), X.WORD_OR_NUMBER)} AS n_words FROM docs_en JOIN n_sents USING (doc_id)"""),
    "surface_ari": (["surface"], f"SELECT doc_id, {ari('n_letters', 'n_words', 'n_sents')} AS ARI FROM surface"),
    "found_profile": (["counts"], _metric_select("profile")),
    "found_model": (["counts"], _metric_select("model")),
    "tokens_listed": (["tokens", "listed"], f"""
            SELECT *, in_np AND NOT coalesce(lag(in_np) OVER (PARTITION BY doc_id, sent_id ORDER BY pos_in_sent), false) AS np_start
            FROM (SELECT *, {_lemma} AS lemma, pos IN {_np} AS in_np FROM (
              SELECT t.* EXCLUDE (pos, lemma, in_np, np_start), CASE WHEN t.is_alpha AND t.pos NOT IN ({','.join(q(p) for p in [*C.CLOSED_CLASSES, 'PROPN'])})
                THEN coalesce(b.pos,t.pos) ELSE t.pos END AS pos
              FROM tokens t LEFT JOIN (SELECT word, arg_min(pos,seq) AS pos FROM listed GROUP BY word) b ON b.word=t.lower))"""),
    "forms_listed": (["tokens_listed"], "SELECT lower, lemma, pos, count(*) AS n FROM tokens_listed WHERE is_alpha GROUP BY ALL"),
    "found_profile_listed": (["counts_listed"], _metric_select("profile", "counts_listed")),
    "found_model_listed": (["counts_listed"], _metric_select("model", "counts_listed")),
    "metrics_profile_listed": (["docs_en", "found_profile_listed"], _with_blanks("found_profile_listed")),
    "metrics_model_listed": (["docs_en", "found_model_listed"], _with_blanks("found_model_listed")),
    "metrics_profile": (["docs_en", "found_profile"], _with_blanks("found_profile")),
    "metrics_model": (["docs_en", "found_model"], _with_blanks("found_model")),
    "features": (["metrics_profile"], f"""SELECT 'Text_'||doc_id||'.txt' AS filename, *, {text_level('ARI')} AS predict_level
            FROM metrics_profile"""),
    "level_groups": ([], values("level_groups", ["predict_level", "level", "display"], C.LEVEL_GROUPS)),
    "grouped": (["features", "level_groups"], "SELECT f.*, level FROM features f JOIN level_groups USING (predict_level)"),
    "profiles": (["grouped"], " UNION ALL ".join(
        f"SELECT level, '{m}' AS metric, avg({m}) AS mean, stddev_samp({m}) AS std, min({m}) AS min, max({m}) AS max, "
        f"count(*) AS sample_count FROM grouped GROUP BY level" for m in C.METRICS)),
    "targets": (["grouped"], "SELECT level, " + ", ".join(f"avg({m}) AS target_{m}" for m in C.METRICS) +
                " FROM grouped GROUP BY level"),
    "attempts": (["docs_en"], f"""SELECT *, doc_id//3 AS request_id, doc_id%3+1 AS attempt,
            {label_by_number('(doc_id//3)%9')} AS target_level FROM docs_en"""),
    "scored": (["attempts", "metrics_profile", "level_groups", "targets"], "SELECT *, (" + " + ".join(
        f"coalesce(abs(delta_{m})/CASE WHEN abs(target_{m})>1e-6 THEN abs(target_{m}) ELSE 1e0 END,0)"
        for m in C.REPORT_METRICS) + ")/nullif(" + " + ".join(
        f"(delta_{m} IS NOT NULL)::INT" for m in C.REPORT_METRICS) + """,0) AS raw_distance
        FROM (SELECT a.request_id, a.attempt, a.text, a.target_level, g.level, m.*, t.* EXCLUDE (level), """ + ", ".join(
        f"m.{m}-t.target_{m} AS delta_{m}" for m in C.METRICS) + """ FROM attempts a
          JOIN metrics_profile m USING (doc_id) LEFT JOIN level_groups g ON g.predict_level=a.target_level
          LEFT JOIN targets t ON t.level=g.level)"""),
    "distances": (["scored"], f"SELECT *, coalesce(raw_distance,{INF}) AS distance FROM scored"),
    "limits": (["docs_en"], "SELECT doc_id, " + case("doc_id%5", list(enumerate([200, 500, 1000, 2000, 0])), "=", 0) +
               "::BIGINT AS max_rank FROM docs_en"),
    "candidates": (["graded_tokens", "limits"], """SELECT t.*, max_rank, max_rank>0 AND ((level IN ('C1','C2')
              AND max_rank<7000) OR rank>max_rank) AS flagged FROM graded_tokens t JOIN limits USING (doc_id)
            WHERE is_alpha AND NOT is_stop AND pos<>'PROPN'"""),
    "spelled": (["candidates"], """SELECT doc_id, text, max(rank) AS rank,
            min(sent_id*4294967296+pos_in_sent) AS first_tok FROM candidates WHERE flagged GROUP BY doc_id, text"""),
    "lexical": (["limits", "tokens", "candidates", "spelled"], """SELECT doc_id, max_rank,
            CASE WHEN max_rank>0 THEN coalesce(a.n,0) ELSE 0 END AS total_tokens,
            CASE WHEN max_rank>0 THEN coalesce(c.n,0) ELSE 0 END AS content_tokens,
            coalesce(s.n,0) AS out_of_band_count, s.words FROM limits
            LEFT JOIN (SELECT doc_id, count(*) AS n FROM tokens WHERE is_alpha GROUP BY doc_id) a USING (doc_id)
            LEFT JOIN (SELECT doc_id, count(*) AS n FROM candidates GROUP BY doc_id) c USING (doc_id)
            LEFT JOIN (SELECT doc_id, count(*) AS n, list(text||' (rank≈'||rank||')' ORDER BY first_tok) AS words
                       FROM spelled GROUP BY doc_id) s USING (doc_id)"""),
    # light result table over all languages
    "raw_results": (["n_sents_all"], f"""SELECT doc_id, lang, source, text, doc_id//3 AS request_id, doc_id%3+1 AS attempt,
            {label_by_number('(doc_id//3)%9')} AS target_level, 100+25*((doc_id//3)%5) AS wanted_words,
            CASE WHEN doc_id%2=0 THEN 'narrative' ELSE 'expository' END AS text_type,
            lang||' texts collected from the source '||source AS topic, {hits('text', f'[^{X.SPACE}]+')} AS word_count,
            {LETTER_COUNT} AS n_letters, {hits(apart('text'), X.WORD_OR_NUMBER)} AS n_words, n_sents
            FROM documents JOIN n_sents_all USING (doc_id)"""),
    "results": (["raw_results"], f"""SELECT *, {text_level('ARI')} AS predicted_level,
            floor(1e0/(1e0+abs(ARI-7e0))*10000e0+0.5e0)/10000e0 AS confidence, attempt AS attempts,
            {text_level('ARI')}=target_level AND word_count BETWEEN low AND high AS success FROM (
              SELECT *, {ari('n_letters', 'n_words', 'n_sents')} AS ARI,
                round_even(wanted_words*(1e0-0.1e0),0)::BIGINT AS low, round_even(wanted_words*1.1e0,0)::BIGINT AS high
              FROM raw_results)"""),
    "steps": (["results"], f"""SELECT *, coalesce(abs({case('predicted_level', C.LEVEL_ORDER, '=', None)}
            -{case('target_level', C.LEVEL_ORDER, '=', None)})::DOUBLE,{INF}) AS distance FROM results"""),
    "best": (["steps"], f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY success DESC,
              CASE WHEN success THEN 0 ELSE distance END, attempt) AS rn FROM steps WHERE success OR distance<{INF})
            WHERE rn=1"""),
    "result_texts": (["results"], """SELECT *, request_id AS set_index,
            CASE WHEN doc_id%5<>0 THEN attempt::VARCHAR||'K' END AS band,
            CASE WHEN doc_id%3>0 THEN 'What?' END AS question1,
            CASE WHEN doc_id%3=2 THEN 'Why "'||source||'"?' END AS question2 FROM results"""),
    "responses": ([], f"""SELECT doc_id, text_type, topic, {FX.raw_answer_sql(q)} AS raw FROM (
            SELECT doc_id, text, CASE WHEN doc_id%2=0 THEN 'narrative' ELSE 'expository' END AS text_type,
              CASE WHEN doc_id%7=0 THEN '' ELSE source END AS topic, source FROM documents)"""),
    "opened": (["responses"], f"""SELECT *, {strip('raw')} AS clean,
            list_filter(list_transform(string_split({strip('raw')},'```'), lambda b: {strip('b')}), lambda b: b<>'') AS blocks
            FROM responses"""),
    "candidate": (["opened"], f"""SELECT *, CASE WHEN prefix(clean,'```') THEN coalesce(
            {strip("substr(list_filter(blocks, lambda b: prefix(lower(b),'json'))[1],5)")}, blocks[-1], clean)
            ELSE clean END AS body FROM opened"""),
    "answers": (["candidate"], """SELECT *, CASE WHEN prefix(body,'{') THEN TRY_CAST(body AS JSON) END AS j FROM candidate"""),
    "passages": (["answers"], f"""SELECT *, CASE WHEN j IS NULL THEN raw ELSE coalesce(j->>'$.text','') END AS passage,
            CASE WHEN j IS NULL THEN [] ELSE list_transform(list_filter(CASE WHEN json_type(j,'$.questions')='ARRAY'
              THEN CAST(j->'$.questions' AS VARCHAR[]) ELSE [j->>'$.question1', j->>'$.question2'] END,
              lambda v: v IS NOT NULL AND v<>''), lambda v: {strip('v')})[1:2] END AS questions FROM answers"""),
    "parsed": (["passages"], """SELECT doc_id, text_type, topic, raw, questions, j IS NOT NULL AS is_parsed, """ +
               "{sanitised} AS text FROM passages"),
}


def sanitised(x: str) -> str:
    lines = f"list_transform(string_split_regex({x},'\\r\\n|\\n|\\r'), lambda v: {strip('v')})"
    kept = f"list_filter({lines}, lambda v: NOT regexp_matches(lower(v),{q(C.NUMBERED_HEADING + '|' + C.LABEL_HEADING)}))"
    joined = strip(f"array_to_string({kept},chr(10))")
    return f"regexp_replace({joined},'\\n{{3,}}',chr(10)||chr(10),'g')"


CTES["parsed"] = (CTES["parsed"][0], CTES["parsed"][1].replace("{sanitised}", sanitised("passage")))


def select(body: str, *needs: str) -> str:
    """``body`` after the named subqueries it needs, in order of dependence."""
    done: list[str] = []

    def add(name):
        if name not in done:
            for n in CTES[name][0]:
                add(n)
            done.append(name)

    for n in needs:
        add(n)
    head = ", ".join(f"{n} AS ({CTES[n][1]})" for n in done)
    return f"WITH {head} {body}" if head else body
