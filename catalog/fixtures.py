"""Inputs derived from the given tables, in rules that Spark and SQL both run.

No fixture ranks or numbers the whole corpus in one window: levels come from
fixed cuts, so every derivation is a per-row rule or a keyed aggregate.
"""

from pyspark.sql import Column, DataFrame, functions as F

from readgrade import fixed as C

# fixed values: a listed word occurs at least MIN_LISTED times; level by number of occurrences
MIN_LISTED = 2
COUNT_CUTS = [(128, "A1"), (32, "A2"), (8, "B1"), (4, "B2"), (3, "C1")]
COPY_LEVEL = ("B1", "B2")
COPY_SEQ = 1000
# fixed values: ARI below the cut -> text level, C2 above the last
ARI_CUTS = [(5.0, "A1.1"), (6.0, "A1.2"), (6.6, "A2.2"), (7.1, "B1.1"), (7.5, "B1.2"), (7.9, "B2.1"), (8.4, "B2.2"),
            (9.7, "C1")]
LIST_POS_NAME = [("NOUN", "noun"), ("VERB", "verb"), ("ADJ", "adjective"), ("ADV", "adverb"), ("PROPN", "proper noun")]


def _case(column, pairs, compare, default):
    expr = None
    for bound, value in pairs:
        hit = compare(column, bound)
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return expr.otherwise(default)


def wordlist(forms: DataFrame) -> DataFrame:
    """Graded list from the content words of the corpus; words seen once stay unlisted.

    Words of level B1 get a later second row with the next level, so that
    first-wins and last-wins rules differ.
    """
    content = (forms.where(F.col("pos").isin(C.CONTENT_POS["profile"]))
               .groupBy("lower", "pos").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_LISTED))
    level = _case(F.col("n"), COUNT_CUTS, lambda c, b: c >= b, "C2")
    name = _case(F.col("pos"), LIST_POS_NAME, lambda c, b: c == b, None)
    seq = _case(F.col("pos"), [(p, i) for i, (p, _) in enumerate(LIST_POS_NAME, 1)], lambda c, b: c == b, 0)
    rows = content.select(seq.cast("bigint").alias("seq"), F.col("lower").alias("headword"), name.alias("pos"),
                          level.alias("cefr"))
    entry = F.struct("seq", "headword", "pos", "cefr")
    copy = F.struct((F.col("seq") + COPY_SEQ).alias("seq"), "headword", "pos", F.lit(COPY_LEVEL[1]).alias("cefr"))
    again = F.when(F.col("cefr") == COPY_LEVEL[0], F.array(entry, copy)).otherwise(F.array(entry))
    return rows.select(F.inline(again))


def text_level(ari: Column) -> Column:
    """Label of a text by its ARI."""
    return _case(ari, ARI_CUTS, lambda c, b: c < b, "C2")


def label_by_number(number: Column) -> Column:
    return _case(number, list(enumerate(C.TEXT_LEVELS)), lambda c, b: c == b, None)


def max_ranks(docs: DataFrame) -> DataFrame:
    """A vocabulary limit per document, 0 (no check) included."""
    limit = _case(F.col("doc_id") % 5, list(enumerate([200, 500, 1000, 2000, 0])), lambda c, b: c == b, 0)
    return docs.select("doc_id", limit.cast("bigint").alias("max_rank"))


def attempts(docs: DataFrame) -> DataFrame:
    """Three neighbouring documents are the attempts of one request."""
    request = F.expr("doc_id div 3")
    return docs.select("*", request.alias("request_id"), (F.col("doc_id") % 3 + 1).alias("attempt"),
                       label_by_number(request % 9).alias("target_level"))


# ---- raw answers: JSON in the shapes a service returns ------------------------------

# fixed values: answer shapes by document number; {t} is the escaped text, {s} the source
ANSWER_SHAPES = [
    '{"text": "{t}", "question1": "What about {s}?", "question2": "Explain {s}。"}',
    '```json\n{"text": "Text:\\n  {t}", "questions": ["First {s} 50語程度", "", "Second {s}", "Third {s}"]}\n```',
    'Passage:\n\n\n\n{r}\n1. Questions\n{"text": broken',
    '{"question1": "Only {s}?"}',
    'Sure ```\n{"text": "{t}"}',
]


def raw_answer_sql(quote) -> str:
    """The shapes as one SQL expression over ``doc_id, text, source``, valid in both engines."""
    escaped = "replace(replace(replace(text,{b},{b2}),{d},{b}||{d}),chr(10),{b}||'n')".format(
        b="chr(92)", b2="chr(92)||chr(92)", d="chr(34)")
    parts = []
    for i, shape in enumerate(ANSWER_SHAPES):
        literal = "||chr(92)||".join("||chr(10)||".join(quote(p) for p in piece.split("\n")) for piece in shape.split("\\"))
        parts.append(f"WHEN doc_id%5={i} THEN replace(replace(replace({literal},'{{t}}',{escaped}),'{{r}}',text),'{{s}}',source)")
    return "CASE " + " ".join(parts) + " END"


def responses(documents: DataFrame) -> DataFrame:
    narrative = F.when(F.col("doc_id") % 2 == 0, "narrative").otherwise("expository")
    return documents.select(
        "doc_id", narrative.alias("text_type"), F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("source")).alias("topic"),
        F.expr(raw_answer_sql(lambda s: "'" + s.replace("'", "\\'") + "'")).alias("raw"))
