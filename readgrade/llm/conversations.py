"""Conversation structure repair: faults, cheapest edits and the repaired turns of every conversation.

Three steps. Turns that are alike in conversation, turn number, role and text are one row with a count before anything is
shuffled, without its text (a 128-bit hash stands for it); repeats at other turn numbers are found by an aggregate. These
narrow rows stream through :mod:`survivors` in the order of a conversation. Then texts and edits meet in one sorted stream, which
yields the repaired turns. Nothing gathers a conversation: memory holds the edits on which the survivors still differ, and one
batch. The order of a conversation is sequential by nature, and so is a SHA-256 of it: one task reads a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from readgrade.llm.common import checked_broadcast, ship, stored, table
from readgrade.llm.survivors import NAMES, Survivors

SPACES = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
SUMMARY_NAMES = [x.split()[0] for x in SUMMARY.split(", ")]
FLUSH_ROWS, FLUSH_CHARACTERS = 4096, 1 << 20


def _schema(conv: StructField, rest: str) -> StructType:
    return StructType([StructField("conv", conv.dataType), *StructType.fromDDL(rest)])


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for begin in range(0, batch.num_rows, FLUSH_ROWS):
            part = batch.slice(begin, FLUSH_ROWS)
            yield from zip(*[c.to_pylist() for c in part.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight: Callable[[tuple], int] = lambda row: 0) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if len(held) >= FLUSH_ROWS or size >= FLUSH_CHARACTERS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _streamed(df: DataFrame, run: Callable[[Iterator[tuple]], Iterator[tuple]], schema: StructType, weight=lambda row: 0) -> DataFrame:
    """The sorted rows of each partition through ``run``, a batch at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _batches(run(_rows_of(batches)), arrow, weight), schema)


def _kinds(turns: DataFrame) -> DataFrame:
    """One row for turns alike, with their number ``n`` and their faults; ``repeated``: its role and text come at an earlier turn."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    alike = turns.select("conv", "turn", "role", F.unhex(F.md5("text")).alias("h"), "copies", (trimmed == "").alias("blank"),
                         (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"))
    alike = stored(alike.groupBy("conv", "turn", "role", "h").agg(
        F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")), "turns-alike")
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"))
    again = stored(alike.where("n > 0 and not blank").groupBy("conv", "role", "h").agg(
        F.count("*").alias("times"), F.min(at).alias("first")).where("times > 1").select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("x"), "first"), "turns-again")
    joined = alike.join(checked_broadcast(again), F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("x")), "left")
    return joined.select("conv", "turn", "role", "h", "n", "blank", "truncated",
                         (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(at)).alias("repeated"))


class _Conversation:
    """Counts of one conversation next to its survivors."""

    def __init__(self) -> None:
        self.paths, self.last, self.first_turn, self.turn, self.numbers = Survivors(), None, None, None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, h: bytes, n: int, blank: bool, truncated: bool, repeated: bool) -> Iterator[tuple]:
        if n and turn is not None and (self.turn is None or turn != self.turn):
            self.first_turn, self.turn, self.numbers = turn if self.turn is None else self.first_turn, turn, self.numbers + 1
        initial = role[:1]
        for copy in range(n):
            again = not blank and (repeated or copy > 0)
            cut = truncated and not blank and not again
            self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + again, self.truncated + cut
            self.illegal += self.last is not None and self.last + initial not in LEGAL
            self.last = initial
            yield from self.paths.turn((turn, role, h), initial, blank or again, cut)

    def end(self) -> tuple[list[tuple], str, tuple]:
        rest, new, cost = self.paths.end()
        gaps = 0 if self.turn is None else self.turn - self.first_turn + 1 - self.numbers
        return rest, new, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)


def _edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    now, conv, place = None, None, 0
    for key, *values in _and_end(rows):
        if now is not None and (key is _END or key != conv):
            rest, new, summary = now.end()
            for (turn, role, h), inserted, edit, new_role in rest:
                yield conv, False, turn, role, h, 0, place, inserted, edit, new_role, None, None
                place += 1
            yield conv, True, None, None, None, 0, place, new, None, None, dict(zip(SUMMARY_NAMES, summary)), None
            now = None
        if key is _END:
            return
        if now is None:
            now, conv, place = _Conversation(), key, 0
        for (turn, role, h), inserted, edit, new_role in now.add(*values):
            yield conv, False, turn, role, h, 0, place, inserted, edit, new_role, None, None
            place += 1


_END = object()


def _and_end(rows: Iterator[tuple]) -> Iterator[tuple]:
    yield from rows
    yield (_END,)


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits come before the text that they are for; of texts alike the first one is taken."""
    now, step, waiting = _END, 0, []
    for conv, _, _, role, _, kind, _, inserted, edit, new_role, summary, text in rows:
        if now is _END or conv != now:
            now, step, waiting = conv, 0, []
        if kind == 0 and summary is None:
            waiting.append((inserted, edit, new_role))
            continue
        if summary is not None:
            waiting = [(inserted, None, None)]
        for new, edit, new_role in waiting:
            for c in new:
                yield conv, step, "I", NAMES[c], "", None
                step += 1
            if edit is not None:
                yield conv, step, edit, new_role or role, text, None
                step += 1
        waiting = []
        if summary is not None:
            yield conv, step, None, None, None, summary


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """(conv, step, edit, role, text, summary): the edits of every conversation in order, and a last row with its summary and no edit.

    ``edit`` is K(eep), R(erole), D(elete) or I(nsert), with the role after it and the text; the repaired conversation is the rows
    that are not deleted. The rows of a conversation lie in one partition, in order. ``copies`` names a column with how often a row
    counts; a conversation whose rows count nought has an empty summary.

    A null role or text is one space (a blank text is deleted; a role that starts with neither s, u nor a can't be kept, nor can an
    empty one); a null turn comes before all numbers and leaves no gap; rows without conversation are one conversation. Rows of one
    turn go by role and then by the hash of their text, so equal rows are neighbours and all but the first are duplicates, also
    rows that are repeated as a whole. Texts of any length travel once and are read a batch at a time. An empty
    table gives no rows. Other columns, whatever their names, are not looked at.
    """
    turns = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                      F.coalesce(F.col(text), F.lit(" ")).alias("text"), (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"))
    order = [F.asc_nulls_first("turn"), "role", "h"]
    edit_schema = _schema(turns.schema["conv"], "last boolean, turn long, role string, h binary, kind int, place long, inserted string, "
                          f"edit string, new_role string, summary struct<{SUMMARY}>, text string")
    kinds = _kinds(turns).repartition("conv").sortWithinPartitions("conv", *order)
    edits = stored(_streamed(kinds, _edits, edit_schema), "edits")
    texts = turns.where("copies > 0").select(
        "conv", F.lit(False).alias("last"), "turn", "role", F.unhex(F.md5("text")).alias("h"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("place"),
        *[F.lit(None).cast(edit_schema[c].dataType).alias(c) for c in ("inserted", "edit", "new_role", "summary")], "text")
    both = edits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "last", *order, "kind", "place")
    out = _schema(turns.schema["conv"], f"step long, edit string, role string, text string, summary struct<{SUMMARY}>")
    return _streamed(both, _repaired, out, lambda row: len(row[4] or ""))


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    audit, digest = [], hashlib.sha256()
    kept = False
    for conv, _, edit, role, text, summary in rows:
        if summary is not None:
            yield conv, *[summary[c] for c in SUMMARY_NAMES], "".join(audit), digest.hexdigest()
            audit, digest, kept = [], hashlib.sha256(), False
            continue
        audit.append(edit)
        if edit != "D":
            digest.update(f"{chr(10) if kept else ''}{role}:{text}".encode())
            kept = True


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, counts of the summary, audit, repaired_sha256), one row for each conversation of :func:`repair`, in the same stage."""
    return _streamed(repaired, _digests, _schema(repaired.schema["conv"], f"{SUMMARY}, audit string, repaired_sha256 string"))


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract: nulls are one space, ``copies`` says how often a row is there."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind, text = F.crc32(key.cast("binary")) % 20, F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = digests(repair(damaged(table(spark, sf_dir, "conversations")), copies="copies"))
    return out.withColumnRenamed("conv", "conv_id")


_CRC = ("xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({key}, ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))::BIGINT[]), "
        "lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)")
_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP11_SQL = f"""
WITH RECURSIVE kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format(key=_KEY)} % 20 AS kind FROM conversations
),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds
),
marked AS (
    SELECT *, rtrim(text, {_BLANKS}) AS trimmed, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos
    FROM damaged
),
turns AS (
    SELECT conv_id, turn, role, text, pos, left(role, 1) AS initial, trimmed = '' AS blank, trimmed <> '' AND seen AS again,
           trimmed <> '' AND NOT seen AND right(trimmed, 1) NOT IN ('.', '!', '?') AS cut,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS two
    FROM marked
),
moves(state, new) AS (VALUES ('e', ''), ('e', 'u'), ('e', 'ua'), ('s', ''), ('s', 'u'), ('s', 'ua'), ('u', ''), ('u', 'a'), ('a', ''), ('a', 'u')),
added AS (
    SELECT state, new, right(state || new, 1) AS spot, 2 * length(new) AS cost, repeat('I', length(new)) AS tail,
           CASE WHEN new LIKE 'u%' THEN 'user:' || chr(10) ELSE '' END || CASE WHEN new LIKE '%a' THEN 'assistant:' || chr(10) ELSE '' END AS written
    FROM moves
),
edits(edit, price, name) AS (VALUES ('D', 3, NULL), ('K', 0, NULL), ('R', 2, 'user'), ('R', 2, 'assistant')),
paths AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS pos, 'e' AS state, 0::BIGINT AS cost, '' AS audit, '' AS written FROM conversations
    UNION ALL
    SELECT p.conv_id, t.pos, CASE edit WHEN 'D' THEN spot WHEN 'K' THEN initial ELSE left(name, 1) END AS next_state,
           p.cost + a.cost + price + CASE WHEN edit <> 'D' AND cut THEN 1 ELSE 0 END AS next_cost, audit || tail || edit AS next_audit,
           p.written || a.written || CASE edit WHEN 'D' THEN '' ELSE coalesce(name, role) || ':' || text || chr(10) END
    FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.pos = p.pos + 1 JOIN added a USING (state) CROSS JOIN edits
    WHERE edit = 'D' OR NOT (blank OR again) AND spot || CASE edit WHEN 'K' THEN initial ELSE left(name, 1) END IN ('es', 'eu', 'su', 'au', 'ua')
    QUALIFY row_number() OVER (PARTITION BY p.conv_id, next_state ORDER BY next_cost, next_audit) = 1
),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
           count_if(again) AS duplicate, count_if(cut) AS truncated, count_if(two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
),
best AS (
    SELECT p.conv_id, gaps, blank, duplicate, truncated, illegal, p.cost + a.cost AS cost, audit || tail AS audit, p.written || a.written AS written
    FROM paths p LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id JOIN added a USING (state)
    WHERE p.pos = coalesce(n, 0) AND spot IN ('e', 'a')
    QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + a.cost, audit || tail) = 1
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
       sha256(left(written, greatest(length(written) - 1, 0)::BIGINT)) AS repaired_sha256
FROM best
"""
