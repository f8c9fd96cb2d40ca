"""Request tables: plans, routing, prompts, costs (Q1-Q8, Q19)."""

from pyspark.sql import Column, DataFrame, functions as F

from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.functions.tables import fixed_table
from readgrade.operators import profiles as P


def plan_sets(sets: DataFrame) -> DataFrame:
    """Every set gets each reading band in each text type with its topic: twelve rows by one explode."""
    rows = [F.struct(F.lit(band).alias("band"), F.lit(level).alias("target_level"),
                     F.lit(rank).cast("bigint").alias("max_rank"), F.lit(words).cast("bigint").alias("word_count"),
                     F.lit(kind).alias("text_type"), F.lit(topic).alias("topic"))
            for band, level, rank, words, *topics in C.BANDS for kind, topic in zip(C.TEXT_TYPES, topics)]
    return sets.select("*", F.inline(F.array(*rows)))


def plan_levels(topics: DataFrame, levels: list[str] = C.TEXT_LEVELS) -> DataFrame:
    """Every topic at every level."""
    return topics.select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias("target_level"))


def one_topic(topic: Column) -> Column:
    """A single topic serves both text types."""
    return F.create_map(*[part for t in C.TEXT_TYPES for part in (F.lit(t), topic)])


def topics_by_type(topics: Column) -> Column:
    """Map from text type to topic: other types are dropped, a missing type takes the topic of the other one."""
    def pick(first, second):
        return F.coalesce(F.try_element_at(topics, F.lit(first)), F.try_element_at(topics, F.lit(second)),
                          F.lit(C.DEFAULT_TOPIC))

    a, b = C.TEXT_TYPES
    return F.create_map(F.lit(a), pick(a, b), F.lit(b), pick(b, a))


def route(level: Column) -> Column:
    """How a text of this level group is made."""
    return (F.when(level.isin(C.TEMPLATE_LEVELS), "template")
            .when(level.isin(C.ITERATIVE_LEVELS), "iterative").otherwise("prompt"))


def word_bounds(words: Column, tolerance: float = C.WORD_TOLERANCE) -> tuple[Column, Column]:
    """Half-to-even bounds around the wanted number of words."""
    return (F.bround(words * F.lit(1 - tolerance)).cast("bigint"), F.bround(words * F.lit(1 + tolerance)).cast("bigint"))


def _type_guides(df: DataFrame) -> DataFrame:
    return F.broadcast(fixed_table(df.sparkSession, ["text_type", "type_guide"], C.TYPE_GUIDES))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def structured_prompts(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Prompt with the quantitative targets of the level, the band and the style and type guides.

    ``requests`` has ``level, band, max_rank, word_count, text_type, topic``.
    Every joined table has one row per level group or text type.
    """
    style = F.broadcast(fixed_table(requests.sparkSession, ["level", "style_guide"], C.STYLE_GUIDES))
    targets = F.broadcast(P.target_lines(profiles))
    full = (requests.join(_type_guides(requests), "text_type").join(style, "level", "left")
            .join(targets, "level", "left"))
    brief = X.literal_fill(F.lit(C.LEXICAL_BRIEF), {"band": F.col("band"), "max_rank": _text("max_rank")})
    low, high = C.WORD_WINDOW
    prompt = X.literal_fill(F.lit(C.STRUCTURED_PROMPT), {
        "display": P.display_name(F.col("level")), "text_type": F.col("text_type"),
        "min_words": F.lit(str(low)), "max_words": F.lit(str(high)), "word_count": _text("word_count"),
        "lexical_brief": brief, "type_guide": F.col("type_guide"),
        "targets": F.coalesce("targets", F.lit(C.HINTS_NONE)), "level": F.col("level"),
        "style_guide": F.coalesce("style_guide", F.lit(C.STYLE_GUIDE_DEFAULT)),
        "question_rules": F.lit(C.QUESTION_RULES), "topic": F.col("topic")})
    return full.select(*requests.columns, prompt.alias("prompt"))


def level_prompts(requests: DataFrame) -> DataFrame:
    """Prompt from the level guide; ``requests`` has ``target_level, topic, word_count, attempt``."""
    names = ["guide_level", "vocabulary", "grammar", "sentence_length", "example"]
    guides = fixed_table(requests.sparkSession, names, C.LEVEL_GUIDES)
    known = F.col("target_level").isin([g[0] for g in C.LEVEL_GUIDES])
    asked = requests.withColumn("guide_level", F.when(known, F.col("target_level")).otherwise(C.LEVEL_GUIDE_DEFAULT))
    low, high = word_bounds(F.col("word_count"))
    prompt = X.literal_fill(F.lit(C.LEVEL_PROMPT), {
        "word_count": _text("word_count"), "level": F.col("target_level"),
        "emphasis": F.when(F.col("attempt") > C.STRICT_AFTER_ATTEMPT, "STRICTLY").otherwise(""),
        **{n: F.col(n) for n in names[1:]}, "lower": low.cast("string"), "upper": high.cast("string"),
        "topic": F.col("topic")})
    return asked.join(F.broadcast(guides), "guide_level").select(*requests.columns, prompt.alias("prompt"))


def basic_prompts(requests: DataFrame) -> DataFrame:
    """Short prompt with vocabulary size and sentence length; levels without such a guide drop out."""
    names = ["target_level", "shortest", "longest", "vocabulary_size", "grammar"]
    guides = fixed_table(requests.sparkSession, names, C.BASIC_GUIDES)
    prompt = X.literal_fill(F.lit(C.BASIC_PROMPT), {
        "word_count": _text("word_count"), "level": F.col("target_level"),
        **{n: _text(n) for n in names[1:]}, "topic": F.col("topic")})
    return requests.join(F.broadcast(guides), "target_level").select(*requests.columns, prompt.alias("prompt"))


def initial_prompts(requests: DataFrame) -> DataFrame:
    prompt = X.literal_fill(F.lit(C.INITIAL_PROMPT), {
        "level": F.col("level"), "text_type": F.col("text_type"), "type_guide": F.col("type_guide"),
        "topic": F.col("topic")})
    return requests.join(_type_guides(requests), "text_type").select(*requests.columns, prompt.alias("prompt"))


def refinement_prompts(scored: DataFrame) -> DataFrame:
    """Prompt to revise a text; ``scored`` has the metrics with targets and deltas, ``level, text_type, text``."""
    prompt = X.literal_fill(F.lit(C.REFINEMENT_PROMPT), {
        "level": F.col("level"), "type_guide": F.col("type_guide"), "snapshot": P.snapshot(),
        "adjustments": P.advice(), "text": F.col("text")})
    return scored.join(_type_guides(scored), "text_type").select(*scored.columns, prompt.alias("prompt"))


def default_content(topic: Column) -> Column:
    """Slot -> content for the templates."""
    return F.create_map(*[part for slot, text in C.TEMPLATE_CONTENT
                          for part in (F.lit(slot), X.literal_fill(F.lit(text), {"topic": topic}))])


def fill_templates(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(filled, rejected): texts from the templates of (level, text_type); ``requests`` has a map ``content``.

    The templates of a bundle arrive as one array, so filling is a narrow step.
    """
    rows = fixed_table(requests.sparkSession, ["level", "text_type", "line", "template"], C.TEMPLATES)
    bundles = rows.groupBy("level", "text_type").agg(F.sort_array(F.collect_list(F.struct("line", "template"))).alias("bundle"))
    found = requests.join(F.broadcast(bundles), ["level", "text_type"], "left")

    def fill(template):
        return F.aggregate(F.map_entries("content"), template, lambda text, slot: F.replace(
            text, F.concat(F.lit("{"), slot["key"], F.lit("}")), slot["value"]))

    text = F.array_join(F.transform("bundle", lambda b: fill(b["template"])), " ")
    missing = F.col("bundle").isNull()
    return (found.where(~missing).select(*requests.columns, text.alias("text")),
            found.where(missing).select(*requests.columns))


def request_costs(usage: DataFrame) -> DataFrame:
    """Cost of each request from its token counts; a model without a price costs 0."""
    prices = fixed_table(usage.sparkSession, ["model", "usd_in", "usd_out"], C.PRICES)
    cost = F.col("input_tokens") / 1000.0 * F.col("usd_in") + F.col("output_tokens") / 1000.0 * F.col("usd_out")
    return usage.join(F.broadcast(prices), "model", "left").select(
        *usage.columns, F.coalesce(cost, F.lit(0.0)).alias("cost"))
