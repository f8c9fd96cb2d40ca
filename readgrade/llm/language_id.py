"""Language ID by rank order: a text's most frequent n-grams against each language's, by out-of-place distance.

n-grams are one to three letters long, lower-cased, with a mark before and after each word. Profiles are
counted over all labelled texts outside the held-out quarter: each task adds up its own texts, Spark the rest.
A code has 21 bits for each letter, so different n-grams never share a code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from readgrade.llm.common import held_out, per_text, ship, slices, table

#: n-grams of a profile, and the penalty for one that the other profile lacks.
SIZE = 300
UNKNOWN = "und"
#: Letters of a text that are turned into codes at once.
PART = 1 << 20


class Letters:
    """Which code points are letters, looked up once a worker."""

    def __init__(self) -> None:
        self.known = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def codes(self, text: str) -> Iterator[np.ndarray]:
        """Codes of all n-grams of a text, a part at a time; a word mark is 0, so no code of a lone mark is made."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
        letters = np.zeros(len(points) + 2, np.int64)
        letters[1:-1] = np.where(self.known[points], points, 0)
        for begin in range(0, max(len(letters) - 2, 0), PART):
            part = letters[begin:begin + PART + 2]
            left, own, right = part[:-2], part[1:-1], part[2:]
            here = own > 0
            left, own, right = left[here], own[here], right[here]
            yield np.concatenate((
                -own,                                  # one letter
                own << 42 | right, own[left == 0],     # two: nothing in the middle bits
                left << 42 | own << 21 | right))       # three


def counted(codes: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.unique(c, return_counts=True) for c in codes]
    return parts[0] if len(parts) == 1 else merged(parts)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


def count_grams(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, code, n) over all rows, added up within each task before the exchange."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
        letters, held, size = Letters(), {}, 0

        def out():
            for name, parts in held.items():
                keys, counts = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "code", "n"])

        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            for begin, end in slices(column):
                for name, t in zip(batch.column(0).slice(begin, end - begin).to_pylist(),
                                   column.slice(begin, end - begin).to_pylist(), strict=True):
                    for part in letters.codes(t.decode("utf-8", "replace")):
                        held.setdefault(name, []).append(np.unique(part, return_counts=True))
                        size += len(held[name][-1][0])
                if size > most:
                    held = {name: [merged(parts)] for name, parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                if size > most:  # more kinds than a task should hold: the exchange adds up the rest
                    yield from out()
                    held, size = {}, 0
        yield from out()

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return (rows.where("lang is not null and text is not null").mapInArrow(run, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


def profiles(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> dict[str, np.ndarray]:
    """The ranked codes of every language: ``size`` numbers each."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = count_grams(docs, lang, text).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    table = rows.select("lang", "code", "rank").orderBy("lang", "rank").toPandas()
    return {name: part["code"].to_numpy() for name, part in table.groupby("lang")}


class Matcher:
    """Out-of-place distances of one text to all profiles at once."""

    def __init__(self, known: dict[str, np.ndarray], size: int = SIZE) -> None:
        self.names, self.size, self.letters = sorted(known), size, Letters()
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *known.values()]))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)  # the last row: in no profile
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, known[name]), k] = np.arange(len(known[name]))

    def match(self, text: str) -> tuple[str, float]:
        """The nearest language and 1 less the distance as a share of the largest possible."""
        own = ranked(*counted(self.letters.codes(text)), self.size) if text else []
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0 if len(self.codes) else -1
        at = np.where(self.codes[at] == own, at, len(self.codes))
        theirs = self.ranks[at]
        away = np.where(theirs < 0, self.size, np.minimum(np.abs(theirs - np.arange(len(own))[:, None]), self.size)).sum(0)
        best = int(away.argmin())
        return self.names[best], 1.0 - float(away[best]) / (self.size * len(own))


def identify(docs: DataFrame, known: dict[str, np.ndarray], id: str = "doc_id", text: str = "text",
             size: int = SIZE) -> DataFrame:
    """(id, lang_pred, score), one row per document, from its whole text.

    Null texts and texts without a letter get ``und`` and 0; equally near languages: the first by name. Other
    columns are not looked at.
    """
    def start():
        matcher = Matcher(known, size)

        def columns(texts):
            found = [matcher.match((t or b"").decode("utf-8", "replace")) for t in texts]
            return [pa.array([x for x, _ in found], pa.string()), np.array([x for _, x in found], float)]
        return columns

    return per_text(docs, id, text, "lang_pred string, score double", start)


def op3_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, profiles(docs.where(~held_out()))).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
