"""Answers of a generation service: parsing, validation, best attempt (Q9-Q18, Q20, Q21, ML19)."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readgrade import fixed as C, schemas as S
from readgrade.functions import text as X
from readgrade.operators import profiles as P
from readgrade.operators.requests import word_bounds

FENCE = "```"


def unwrap(raw: Column) -> Column:
    """Content of a fenced answer: the first block tagged ``json``, else the last block that is not blank."""
    clean = X.strip(raw)
    blocks = F.filter(F.transform(F.split(clean, FENCE), X.strip), lambda b: b != "")
    tagged = F.get(F.filter(blocks, lambda b: F.lower(b).startswith("json")), F.lit(0))
    body = F.coalesce(X.strip(F.substring(tagged, F.lit(5), F.length(tagged))),
                      F.try_element_at(blocks, F.lit(-1)), clean)
    return F.when(clean.startswith(FENCE), body).otherwise(clean)


def sanitise(text: Column) -> Column:
    """Trim lines, drop headings around the passage, keep at most one blank line between paragraphs."""
    lines = F.transform(F.split(text, r"\r\n|\n|\r"), X.strip)
    kept = F.filter(lines, lambda v: ~F.lower(v).rlike(f"{C.NUMBERED_HEADING}|{C.LABEL_HEADING}"))
    return F.regexp_replace(X.strip(F.array_join(kept, "\n")), "\n{3,}", "\n\n")


def is_object(candidate: Column) -> Column:
    """A JSON object; of a key that comes twice the last value counts, as in most readers."""
    return candidate.startswith("{") & candidate.endswith("}") & F.from_json(candidate, "map<string,string>").isNotNull()


def parse_answers(responses: DataFrame) -> DataFrame:
    """Add ``text`` and ``questions`` (at most two); an answer that is no JSON object is the passage itself."""
    opened = responses.withColumn("candidate", unwrap(F.col("raw")))
    good = is_object(F.col("candidate"))
    read = opened.select("*", F.when(good, F.from_json("candidate", S.ANSWER)).alias("answer"))
    numbered = F.array("answer.question1", "answer.question2")
    asked = F.filter(F.coalesce("answer.questions", numbered), lambda q: q.isNotNull() & (q != ""))
    questions = F.slice(F.transform(asked, X.strip), 1, 2)
    parsed = F.col("answer").isNotNull()
    return read.select(
        *responses.columns,
        sanitise(F.when(parsed, F.coalesce("answer.text", F.lit(""))).otherwise(F.col("raw"))).alias("text"),
        F.when(parsed, questions).otherwise(F.array().cast("array<string>")).alias("questions"),
        parsed.alias("is_parsed"))


def default_question(topic: Column, text_type: Column, number: int) -> Column:
    named = F.when(F.coalesce(topic, F.lit("")) != "", topic).otherwise(C.TOPIC_FALLBACK)
    by_type = {t: w for t, n, w in C.DEFAULT_QUESTIONS if n == number}
    first, second = C.TEXT_TYPES
    wording = F.when(text_type == first, by_type[first]).otherwise(by_type[second])
    return X.literal_fill(wording, {"topic": named})


def with_length(question: Column) -> Column:
    """Append the length instruction unless it is there; one final full stop gives way to it."""
    plain = X.strip(question)
    cut = F.when(plain.endswith(C.FULL_STOP), F.substring(plain, F.lit(1), F.length(plain) - 1)).otherwise(plain)
    return F.when(plain.contains(C.LENGTH_MARK), plain).otherwise(F.concat(cut, F.lit(C.LENGTH_SUFFIX)))


def two_questions(questions: Column, topic: Column, text_type: Column) -> Column:
    given = F.transform(F.slice(questions, 1, 2), with_length)
    return F.array(*[F.coalesce(F.get(given, F.lit(i)), default_question(topic, text_type, i + 1)) for i in range(2)])


# ---- gates ---------------------------------------------------------------------------------

def pick_in_window(attempts: DataFrame, low: int = C.WORD_WINDOW[0], high: int = C.WORD_WINDOW[1],
                   most: int = C.ATTEMPTS_PER_PROMPT) -> DataFrame:
    """The first attempt inside the word window, else the last one made.

    An aggregate, so attempts are combined before the shuffle.
    """
    inside = F.col("word_count").between(low, high)
    order = F.struct(~inside, F.when(inside, F.col("attempt")).otherwise(-F.col("attempt")))
    picked = F.min_by(F.struct("attempt", "word_count", inside.alias("in_window")), order)
    return (attempts.where(F.col("attempt") <= most).groupBy("request_id").agg(picked.alias("p"))
            .select("request_id", "p.*"))


def success(words: Column, wanted: Column, predicted: Column, target: Column) -> Column:
    low, high = word_bounds(wanted)
    return (predicted == target) & words.between(low, high)


def _place(level: Column) -> Column:
    expr = None
    for name, place in C.LEVEL_ORDER:
        expr = F.when(level == name, place) if expr is None else expr.when(level == name, place)
    return expr


def level_distance(one: Column, other: Column) -> Column:
    """Steps between two of the nine levels; infinite when one of them is unknown."""
    return F.coalesce(F.abs(_place(one) - _place(other)).cast("double"), F.lit(float("inf")))


def best_attempts(attempts: DataFrame) -> DataFrame:
    """First success, else the nearest level, earliest attempt on ties; nothing when every level is unknown.

    ``attempts`` has ``request_id, attempt, success, distance``.
    """
    usable = F.col("success") | (F.col("distance") < float("inf"))
    # an unusable attempt has no rank and is never picked; no filter, so nothing derived is computed twice
    order = F.when(usable, F.struct(~F.col("success"), F.when(F.col("success"), 0.0).otherwise(F.col("distance")), "attempt"))
    columns = [c for c in attempts.columns if c != "request_id"]
    return (attempts.groupBy("request_id").agg(F.min_by(F.struct(*columns), order).alias("best"))
            .where(F.col("best").isNotNull()).select("request_id", "best.*"))


def within_quota(runs: DataFrame, wanted: int, attempts_each: int = C.ATTEMPTS_PER_BATCH_TEXT) -> DataFrame:
    """The first ``wanted`` accepted runs of each group while the attempts so far stay under the limit.

    ``runs`` has ``group_id, run, attempts, success``; the limit bounds a group.
    """
    # every run spends an attempt, so no later run can count: Spark cuts a group to these before it is shuffled
    spends = F.when(F.col("attempts") >= 1, True).otherwise(F.raise_error(F.lit("attempts must be 1 or more")))
    order = W.partitionBy("group_id").orderBy("run")
    runs = runs.withColumn("at", F.row_number().over(order)).where(F.col("at") <= wanted * attempts_each * 2).drop("at").where(spends)
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("attempts").over(earlier), F.lit(0))
    taken = F.coalesce(F.sum(F.col("success").cast("int")).over(earlier), F.lit(0))
    return (runs.select("*", spent.alias("spent"), taken.alias("taken"))
            .where(F.col("success") & (F.col("spent") < wanted * attempts_each * 2) & (F.col("taken") < wanted))
            .withColumn("place", (F.col("taken") + 1).cast("bigint")).drop("spent", "taken"))


def retry_reasons(words: Column, wanted: Column, predicted: Column, target: Column) -> Column:
    low, high = word_bounds(wanted)
    return F.concat_ws(", ", F.when(predicted != target, "level"), F.when(~words.between(low, high), "word_count"))


LEXICAL = {"total_tokens": "bigint", "content_tokens": "bigint", "out_of_band_count": "bigint", "out_of_band_tokens": "array<string>"}


def attach_fields(results: DataFrame) -> DataFrame:
    """Levels, label, band, counters, questions, features and lexical profile of a result, with the fallbacks for what is missing.

    ``target_level`` of the input is what was asked for and becomes ``requested_level``; in the result it is the level that
    was resolved. Without questions there are the two of the topic and type, without a rank limit an empty profile.
    Columns that the input lacks count as null.
    """
    has = lambda name, kind: F.col(name).cast(kind) if name in results.columns else F.lit(None).cast(kind)
    asked = has("questions", "array<string>")
    usual = F.transform(F.array(*[default_question(has("topic", "string"), F.col("text_type"), n) for n in (1, 2)]), with_length)
    limited = has("max_rank", "bigint") > 0
    empty = {"array<string>": F.array().cast("array<string>"), "bigint": F.lit(0).cast("bigint")}
    profile = [F.when(limited, F.coalesce(has(c, kind), empty[kind])).otherwise(empty[kind]).alias(c) for c, kind in LEXICAL.items()]
    made = {
        "label": P.label(F.col("level"), F.col("text_type")), "requested_level": has("target_level", "string"),
        "target_level": F.col("level"), "band": has("band", "string"),
        "word_count": F.coalesce(has("evaluated_words", "bigint"), F.lit(0).cast("bigint")),
        "distance_score": F.coalesce(has("evaluated_distance", "double"), F.lit(float("inf"))),
        "attempts": F.coalesce(has("iterations", "bigint"), F.lit(1).cast("bigint")),
        "questions": F.when(F.coalesce(F.size(asked), F.lit(0)) > 0, asked).otherwise(usual),
        "features": F.struct(*[has(m, "double").alias(m) for m in C.REPORT_METRICS]),
        "lexical_profile": F.struct(F.when(limited, has("max_rank", "bigint")).alias("max_rank"), *profile),
    }
    return results.select(*[c for c in results.columns if c not in made], *[c.alias(n) for n, c in made.items()])


def read_judgement(raw: Column, allowed: list[str] = C.TEXT_LEVELS) -> Column:
    """struct(level, confidence) of a judge's answer; anything unreadable is ('unknown', 0)."""
    clean = X.strip(raw)
    good = is_object(clean)
    data = F.from_json(clean, S.JUDGEMENT)
    level = F.when(good & data["level"].isin(allowed), data["level"]).otherwise("unknown")
    confidence = F.when(good, F.coalesce(data["confidence"], F.lit(0.0))).otherwise(0.0)
    return F.struct(level.alias("level"), confidence.alias("confidence"))
