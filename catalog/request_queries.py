"""Request tables and answers (Q, ML19)."""

from pyspark.sql import functions as F

from catalog import sql as Q
from catalog.fixtures import responses
from catalog.registry import query
from catalog.scoring_queries import ADVICE, DISPLAY, SNAPSHOT, TARGET_LINES
from catalog.text_queries import rounded
from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.numbers import fixed
from readgrade.operators import requests as RQ, responses as RS

TOPICS = "SELECT item_id AS set_index, text AS topic FROM benchmark"
BAND_ROWS = Q.values("bands", ["band", "target_level", "max_rank", "word_count", "text_type", "topic"],
                     [(*b[:4], t, topic) for b in C.BANDS for t, topic in zip(C.TEXT_TYPES, b[4:])])
LEVEL_ROWS = Q.values("levels", ["target_level"], [(v,) for v in C.TEXT_LEVELS])
GROUP_ROWS = Q.values("groups_", ["level"], [(v,) for v in dict.fromkeys(g for _, g, _ in C.LEVEL_GROUPS)])
TYPE_GUIDE = Q.case("text_type", C.TYPE_GUIDES, "=", None)
TYPE_REQUESTS = f"""SELECT set_index, topic, level, CASE WHEN set_index%2=0 THEN 'narrative' ELSE 'expository' END AS text_type
                    FROM ({TOPICS}), ({GROUP_ROWS})"""
LEVEL_REQUESTS = f"""SELECT set_index, topic, target_level, set_index%4+1 AS attempt, 75+25*(set_index%6) AS word_count
                     FROM ({TOPICS}), ({LEVEL_ROWS})"""
SUM_WORDS = Q.hits("text", f"[^{X.SPACE}]+")


@query("q1_plan_sets", f"SELECT set_index, b.* FROM (SELECT item_id AS set_index FROM benchmark), ({BAND_ROWS}) b")
def q1(d):
    return d.planned


@query("q2_plan_levels", f"SELECT set_index, topic, target_level FROM ({TOPICS}), ({LEVEL_ROWS})")
def q2(d):
    return RQ.plan_levels(d.topics)


@query("q3_topics_by_type", f"""SELECT set_index, text_type, CASE set_index%4 WHEN 0 THEN topic
       WHEN 1 THEN CASE WHEN text_type='narrative' THEN topic ELSE 'facts: '||topic END
       WHEN 2 THEN topic ELSE 'Daily life' END AS topic
       FROM ({TOPICS}), (SELECT unnest(['narrative','expository']) AS text_type)""")
def q3(d):
    """By item: one topic, a topic per type, one type only, an unknown type only."""
    topic, number = F.col("topic"), F.col("set_index") % 4
    given = (F.when(number == 0, RQ.one_topic(topic))
             .when(number == 1, F.create_map(F.lit("expository"), F.concat(F.lit("facts: "), topic), F.lit("narrative"), topic))
             .when(number == 2, F.create_map(F.lit("poem"), F.lit("x"), F.lit("expository"), topic))
             .otherwise(F.create_map(F.lit("poem"), topic)))
    return d.topics.select("set_index", F.explode(RQ.topics_by_type(given)).alias("text_type", "topic"))


@query("q4_route", f"""SELECT set_index, level, CASE WHEN level='A1' THEN 'template' WHEN level='C1+' THEN 'prompt'
       ELSE 'iterative' END AS method FROM ({TYPE_REQUESTS})""")
def q4(d):
    return d.type_requests.select("set_index", "level", RQ.route(F.col("level")).alias("method"))


_brief = Q.fill(C.LEXICAL_BRIEF, {"band": "band", "max_rank": "max_rank::VARCHAR"})
_structured = Q.fill(C.STRUCTURED_PROMPT, {
    "display": DISPLAY, "text_type": "text_type", "min_words": "'180'", "max_words": "'220'",
    "word_count": "word_count::VARCHAR", "lexical_brief": _brief, "type_guide": TYPE_GUIDE,
    "targets": f"coalesce(targets,{Q.q(C.HINTS_NONE)})", "level": "level",
    "style_guide": Q.case("level", C.STYLE_GUIDES, "=", C.STYLE_GUIDE_DEFAULT), "question_rules": Q.q(C.QUESTION_RULES),
    "topic": "topic"})


@query("q5_structured_prompts", f"""SELECT set_index, band, text_type, {_structured} AS prompt FROM (
       SELECT item_id AS set_index, target_level AS level, band, max_rank, word_count, text_type, topic
       FROM benchmark, ({BAND_ROWS})) LEFT JOIN ({TARGET_LINES}) USING (level)""", "profiles")
def q5(d):
    asked = d.planned.withColumnRenamed("target_level", "level")
    return RQ.structured_prompts(asked, d.profiles).select("set_index", "band", "text_type", "prompt")


_guide = ["target_level", "vocabulary", "grammar", "sentence_length", "example"]
_fallback = [("any", *g[1:]) for g in C.LEVEL_GUIDES if g[0] == C.LEVEL_GUIDE_DEFAULT]
_guides = Q.values("guides", ["guide_level", *_guide[1:]], C.LEVEL_GUIDES + _fallback)
_level_prompt = Q.fill(C.LEVEL_PROMPT, {
    "word_count": "word_count::VARCHAR", "level": "target_level",
    "emphasis": "CASE WHEN attempt>2 THEN 'STRICTLY' ELSE '' END", **{n: n for n in _guide[1:]},
    "lower": "round_even(word_count*0.9e0,0)::BIGINT::VARCHAR", "upper": "round_even(word_count*1.1e0,0)::BIGINT::VARCHAR",
    "topic": "topic"})


@query("q6_level_prompts", f"""SELECT set_index, target_level, {_level_prompt} AS prompt FROM (
       SELECT * REPLACE (CASE WHEN target_level='C2' AND set_index%2=1 THEN 'D1' ELSE target_level END AS target_level)
       FROM ({LEVEL_REQUESTS})) JOIN ({_guides}) ON guide_level=CASE WHEN target_level='D1' THEN 'any' ELSE target_level END""")
def q6(d):
    """Level prompts; some requests ask for a level without a guide."""
    odd = (F.col("target_level") == "C2") & (F.col("set_index") % 2 == 1)
    asked = d.level_requests.withColumn("target_level", F.when(odd, "D1").otherwise(F.col("target_level")))
    return RQ.level_prompts(asked).select("set_index", "target_level", "prompt")


_basic = Q.fill(C.BASIC_PROMPT, {"word_count": "word_count::VARCHAR", "level": "target_level", "shortest": "'3'",
                                 "longest": "'8'", "vocabulary_size": "'500'", "grammar": "'present simple'", "topic": "topic"})


@query("q6_basic_prompts", f"SELECT set_index, {_basic} AS prompt FROM ({LEVEL_REQUESTS}) WHERE target_level='A1.1'")
def q6_basic(d):
    return RQ.basic_prompts(d.level_requests).select("set_index", "prompt")


_initial = Q.fill(C.INITIAL_PROMPT, {"level": "level", "text_type": "text_type", "type_guide": TYPE_GUIDE, "topic": "topic"})


@query("q7_initial_prompts", f"SELECT set_index, level, {_initial} AS prompt FROM ({TYPE_REQUESTS})")
def q7_initial(d):
    return RQ.initial_prompts(d.type_requests).select("set_index", "level", "prompt")


_refine = Q.fill(C.REFINEMENT_PROMPT, {"level": "level", "type_guide": TYPE_GUIDE, "snapshot": SNAPSHOT,
                                       "adjustments": ADVICE, "text": "text"})


@query("q7_refinement_prompts", f"""SELECT doc_id, {_refine} AS prompt FROM (SELECT *,
       CASE WHEN doc_id%2=0 THEN 'narrative' ELSE 'expository' END AS text_type FROM scored)""", "scored")
def q7_refine(d):
    kind = F.when(F.col("doc_id") % 2 == 0, "narrative").otherwise("expository")
    return RQ.refinement_prompts(d.scored.withColumn("text_type", kind)).select("doc_id", "prompt")


def _template_sql(kind: str) -> str:
    slots = {slot: Q.fill(text, {"topic": "topic"}) for slot, text in C.TEMPLATE_CONTENT}
    return Q.fill(" ".join(t for _, k, _, t in C.TEMPLATES if k == kind), slots)


@query("q8_fill_templates", f"""SELECT set_index, level, CASE WHEN level<>'A1' THEN NULL WHEN text_type='narrative'
       THEN {_template_sql('narrative')} ELSE {_template_sql('expository')} END AS text FROM ({TYPE_REQUESTS})""")
def q8(d):
    asked = d.type_requests.withColumn("content", RQ.default_content(F.col("topic")))
    filled, rejected = RQ.fill_templates(asked)
    return (filled.select("set_index", "level", "text")
            .unionByName(rejected.select("set_index", "level", F.lit(None).cast("string").alias("text"))))


# ---- answers ----------------------------------------------------------------------------

@query("q9_unwrap", "SELECT doc_id, body FROM candidate", "candidate")
def q9(d):
    return responses(d.table("documents")).select("doc_id", RS.unwrap(F.col("raw")).alias("body"))


@query("q10_parse_answers", """SELECT doc_id, is_parsed, text, array_to_string(questions,' | ') AS questions FROM parsed""",
       "parsed")
def q10(d):
    return d.parsed.select("doc_id", "is_parsed", "text", F.array_join("questions", " | ").alias("questions"))


@query("q11_sanitise", f"""SELECT doc_id, {Q.sanitised("'Outline: x'||chr(10)||text||chr(10)||chr(10)||chr(10)||'2. Text'||chr(10)||chr(10)||' end '")}
       AS text FROM documents""")
def q11(d):
    framed = F.concat(F.lit("Outline: x\n"), "text", F.lit("\n\n\n2. Text\n\n end "))
    return d.table("documents").select("doc_id", RS.sanitise(framed).alias("text"))


def _question_sql(i: int) -> str:
    plain = Q.strip(f"questions[{i}]")
    cut = f"CASE WHEN suffix({plain},'。') THEN left({plain},length({plain})-1) ELSE {plain} END"
    named = "CASE WHEN coalesce(topic,'')<>'' THEN topic ELSE '本文' END"
    words = {t: Q.fill(w, {"topic": named}) for t, n, w in C.DEFAULT_QUESTIONS if n == i}
    default = f"CASE WHEN text_type='narrative' THEN {words['narrative']} ELSE {words['expository']} END"
    return (f"CASE WHEN len(questions)>={i} THEN CASE WHEN contains({plain},{Q.q(C.LENGTH_MARK)}) THEN {plain} "
            f"ELSE ({cut})||{Q.q(C.LENGTH_SUFFIX)} END ELSE {default} END")


@query("q12_two_questions", f"SELECT doc_id, {_question_sql(1)} AS question1, {_question_sql(2)} AS question2 FROM parsed",
       "parsed")
def q12(d):
    pair = RS.two_questions(F.col("questions"), F.col("topic"), F.col("text_type"))
    return d.parsed.select("doc_id", pair.alias("pair")).select(
        "doc_id", F.get("pair", F.lit(0)).alias("question1"), F.get("pair", F.lit(1)).alias("question2"))


_eval = ["distance", *C.METRICS, *[f"delta_{m}" for m in C.METRICS]]


@query("q13_evaluate", "SELECT request_id, attempt, level, word_count, sentence_count, " +
       ", ".join(f"{Q.fx(c, 3)} AS {c}" for c in _eval) + " FROM distances", "distances")
def q13(d):
    return rounded(d.scored.select("request_id", "attempt", "level", "word_count", "sentence_count", *_eval), *_eval, digits=3)


@query("q14_pick_in_window", """SELECT request_id, attempt, word_count, ok AS in_window FROM (SELECT *, row_number() OVER (
       PARTITION BY request_id ORDER BY ok DESC, CASE WHEN ok THEN attempt ELSE -attempt END) AS rn FROM (
         SELECT *, word_count BETWEEN 180 AND 220 AS ok FROM results)) WHERE rn=1""", "results")
def q14(d):
    return RS.pick_in_window(d.results)


@query("q15_success", "SELECT doc_id, low, high, word_count, success FROM results", "results")
def q15(d):
    low, high = RQ.word_bounds(F.col("wanted_words"))
    return d.results.select("doc_id", low.alias("low"), high.alias("high"), "word_count", "success")


_odd = "CASE WHEN doc_id%10=0 THEN 'D1' ELSE predicted_level END"


@query("q16_level_distance", f"""SELECT doc_id, coalesce(abs({Q.case(_odd, C.LEVEL_ORDER, '=', None)}
       -{Q.case('target_level', C.LEVEL_ORDER, '=', None)})::DOUBLE,{Q.INF}) AS distance FROM results""", "results")
def q16(d):
    odd = F.when(F.col("doc_id") % 10 == 0, "D1").otherwise(F.col("predicted_level"))
    return d.results.select("doc_id", RS.level_distance(odd, F.col("target_level")).alias("distance"))


@query("q17_best_attempts", "SELECT request_id, attempt, success, distance FROM best", "best")
def q17(d):
    return RS.best_attempts(d.results.select("request_id", "attempt", "success", "distance"))


@query("q18_within_quota", """SELECT group_id, run, place FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY run)
       AS place FROM (SELECT *, coalesce(sum(attempt) OVER (PARTITION BY group_id ORDER BY run ROWS BETWEEN UNBOUNDED
       PRECEDING AND 1 PRECEDING),0) AS spent FROM (SELECT request_id//8 AS group_id, request_id AS run, attempt,
         distance<=1 AS ok FROM best)) WHERE ok AND spent<2*3*2) WHERE place<=2""", "best")
def q18(d):
    """Eight neighbouring requests form a group; a run counts as accepted within one level of its target."""
    best = RS.best_attempts(d.results.select("request_id", "attempt", "success", "distance"))
    runs = best.select(F.expr("request_id div 8").alias("group_id"), F.col("request_id").alias("run"),
                       F.col("attempt").alias("attempts"), (F.col("distance") <= 1).alias("success"))
    return RS.within_quota(runs, wanted=2).select("group_id", "run", "place")


_usage = f"""SELECT conv_id, CASE conv_id%3 WHEN 0 THEN 'gpt-4' WHEN 1 THEN 'gpt-3.5-turbo' ELSE 'other' END AS model,
    coalesce(sum({SUM_WORDS}) FILTER (role<>'assistant'),0)::BIGINT AS input_tokens,
    coalesce(sum({SUM_WORDS}) FILTER (role='assistant'),0)::BIGINT AS output_tokens FROM conversations GROUP BY conv_id"""
_cost = " ".join(f"WHEN {Q.q(m)} THEN input_tokens/1000e0*{i!r}+output_tokens/1000e0*{o!r}" for m, i, o in C.PRICES)
_costs = f"SELECT *, CASE model {_cost} ELSE 0e0 END AS cost FROM ({_usage})"


def _costs_of(d):
    turns = d.table("conversations").select("conv_id", "role", X.whitespace_words(F.col("text")).alias("n"))
    number = F.col("conv_id") % 3
    model = F.when(number == 0, "gpt-4").when(number == 1, "gpt-3.5-turbo").otherwise("other")

    def tokens(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    usage = turns.groupBy("conv_id").agg(tokens(F.col("role") != "assistant").alias("input_tokens"),
                                         tokens(F.col("role") == "assistant").alias("output_tokens"))
    return RQ.request_costs(usage.select("conv_id", model.alias("model"), "input_tokens", "output_tokens"))


@query("q19_request_costs", f"SELECT conv_id, model, input_tokens, output_tokens, {Q.fx('cost', 6)} AS cost FROM ({_costs})")
def q19(d):
    return rounded(_costs_of(d), "cost", digits=6)


@query("q19_run_costs", f"""SELECT conv_id%10 AS run, count(*) AS requests, {Q.fx('sum(cost)', 5)} AS cost
       FROM ({_costs}) GROUP BY ALL""")
def q19_run(d):
    return _costs_of(d).groupBy((F.col("conv_id") % 10).alias("run")).agg(
        F.count(F.lit(1)).alias("requests"), fixed(F.sum("cost"), 5).alias("cost"))


@query("q20_retry_reasons", """SELECT doc_id, concat_ws(', ', CASE WHEN predicted_level<>target_level THEN 'level' END,
       CASE WHEN word_count NOT BETWEEN low AND high THEN 'word_count' END) AS reasons FROM results""", "results")
def q20(d):
    return d.results.select("doc_id", RS.retry_reasons(
        F.col("word_count"), F.col("wanted_words"), F.col("predicted_level"), F.col("target_level")).alias("reasons"))


@query("q21_attach_fields", f"""SELECT doc_id, {Q.fill(C.LABEL_FORMAT, {
    'display': DISPLAY, 'type': "CASE WHEN doc_id%2=0 THEN 'Narrative' ELSE 'Expository' END"})} AS label,
       level AS target_level, CASE WHEN doc_id%6=0 THEN 0 ELSE word_count END AS word_count,
       CASE WHEN doc_id%6=0 THEN {Q.INF} ELSE {Q.fx('distance', 3)} END AS distance_score,
       CASE WHEN doc_id%4=0 THEN 1 ELSE attempt END AS attempts, CASE WHEN doc_id%5<>0 THEN target_level END AS requested_level,
       CASE WHEN doc_id%3=0 THEN 'Q?' ELSE NULL END AS own_question, 2::BIGINT AS n_questions,
       CASE WHEN doc_id%2=0 THEN 500::BIGINT END AS max_rank, CASE WHEN doc_id%2=0 THEN doc_id ELSE 0 END AS out_of_band_count,
       {Q.fx('ARI', 3)} AS feature_ari FROM distances""", "distances")
def q21(d):
    """Some results lack their evaluation, some their iteration count."""
    bare = d.scored.select(
        "doc_id", "level", F.when(F.col("doc_id") % 2 == 0, "narrative").otherwise("expository").alias("text_type"),
        F.when(F.col("doc_id") % 6 != 0, F.col("word_count")).alias("evaluated_words"),
        F.when(F.col("doc_id") % 6 != 0, fixed(F.col("distance"), 3)).alias("evaluated_distance"),
        F.when(F.col("doc_id") % 4 != 0, F.col("attempt")).alias("iterations"),
        F.when(F.col("doc_id") % 5 != 0, F.col("target_level")).alias("target_level"),
        F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("Q?"), F.lit("R?"))).alias("questions"),
        F.when(F.col("doc_id") % 2 == 0, 500).alias("max_rank"), F.col("doc_id").alias("out_of_band_count"), "ARI")
    own = F.get("questions", F.lit(0))
    return RS.attach_fields(bare).select(
        "doc_id", "label", "target_level", "word_count", "distance_score", "attempts", "requested_level",
        F.when(own == "Q?", own).alias("own_question"), F.size("questions").cast("bigint").alias("n_questions"),
        "lexical_profile.max_rank", "lexical_profile.out_of_band_count", fixed(F.col("features.ARI"), 3).alias("feature_ari"))


_judge = """CASE doc_id%5 WHEN 0 THEN '{"level": "'||predicted_level||'", "confidence": 0.75}' WHEN 1
  THEN '{"level": "D1", "confidence": 0.5}' WHEN 2 THEN 'The level is '||predicted_level
  WHEN 3 THEN '{"confidence": 0.25}' ELSE '{"level": "'||predicted_level||'"}' END"""


@query("ml19_read_judgement", """SELECT doc_id, CASE WHEN doc_id%5 IN (0,4) THEN predicted_level ELSE 'unknown' END AS level,
       CASE doc_id%5 WHEN 0 THEN 0.75e0 WHEN 1 THEN 0.5e0 WHEN 3 THEN 0.25e0 ELSE 0e0 END AS confidence FROM results""",
       "results")
def ml19(d):
    return d.results.select("doc_id", RS.read_judgement(F.expr(_judge)).alias("j")).select("doc_id", "j.level", "j.confidence")
