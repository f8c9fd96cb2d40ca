"""LM scoring: cross-entropy difference between a target and a background model.

Both are interpolated bigram models over one vocabulary with the same kept pairs and the same smoothing; the background
counts are scaled to the target's number of words, so that a discount weighs the same in both. All texts are counted. A
word or pair seen twice or more in the whole corpus is kept, whatever the size of the corpus; words seen once are one
unknown word. The model is a table that grows with the corpus and is never whole in one place.

The loss of a text falls into pieces that add up: of each word the loss it has alone and, as the word before another, the
weight of its unseen successors; of each kept pair what it saves. Pieces are longs, so sums do not depend on their order. At most
3 * HOT + 1 pieces are broadcast, those of words and pairs that make up 1 / HOT of all words; a text asks for the others
by a join, where no key has more than 1 / HOT of the rows. HOT decides who looks a piece up, not what it is worth, and
which words travel as small numbers in place of their hashes.

Null and empty texts have no word. Very long texts are read in parts. Repeated rows count and are scored one by one, ids
may be null or repeated, empty tables give empty results, other columns are not looked at. Nothing is
ranked, so there are no ties.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from readgrade.llm.common import checked_broadcast, ship, slices, stored, table
from readgrade.llm.word_hashes import RARE, START, hash_words, pair
from readgrade.plans.storage import discard

SEEN, DISCOUNT, HOT = 2, 0.75, 1 << 19
#: Second halves of pieces that are no pair: a word for itself, a word that ends a text. No hash of a word is so low.
WORD, END = 0, RARE
#: Bits of the number of a frequent word, which is HOT + END at most.
BITS = (HOT + END).bit_length()
#: Losses are kept in this fraction of a nat.
UNIT = 1 << 20
#: Kinds of pieces that a task adds up before it hands them to the exchange; rows of a batch on the way out; bytes of text at once.
HELD, ROWS, BYTES = 1 << 18, 1 << 17, 1 << 19


def _neighbours(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word before each (START for the first), the texts that have words, and the last word of each of these."""
    full = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[full]
    before = np.concatenate((words[:0], words[:1], words[:-1]))[:len(words)]
    before[first] = START
    return before, full, words[first + counts[full] - 1]


def _same(n: int, value: int) -> np.ndarray:
    return np.full(n, value, np.uint64)


class Coder:
    """Hashes of frequent words, which is a list of ``hot`` at most, to numbers above END; other words keep their hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return hashes
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at.astype(np.uint64) + np.uint64(END + 1), hashes)


def _words(hashes: np.ndarray, counts: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each word, and START once for each text that has words; with WORD and the flag of the text."""
    full = np.flatnonzero(counts)
    a = np.concatenate((hashes, _same(len(full), START)))
    return a, _same(len(a), WORD), np.concatenate((np.repeat(flags, counts), flags[full]))


def counted(rows: DataFrame, kinds) -> DataFrame:
    """(a, b, n, t): how often each kind occurs in all rows and in target rows of (text, target), added up within each task first.

    ``kinds()`` gives a function from word hashes, the words of each text and the flags of the texts to (a, b, flag).
    """
    def merged(parts):
        a, b = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        _, at, where = np.unique(pair(a, b), return_index=True, return_inverse=True)
        return a[at], b[at], *(np.bincount(where, np.concatenate([p[k] for p in parts]), len(at)).astype(np.int64) for k in (2, 3))

    def out(part):
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in part], names=["a", "b", "n", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, parts, size = kinds(), [], 0
        for batch in batches:
            column = batch.column(0).cast(pa.large_binary())
            for begin, end in slices(column, BYTES):
                hashes, counts = hash_words(column.slice(begin, end - begin).to_pylist())
                a, b, flag = make(hashes, counts, batch.column(1).slice(begin, end - begin).to_numpy(zero_copy_only=False).astype(np.int64))
                parts.append(merged([(a, b, np.ones(len(a)), flag)]))
                size += len(parts[-1][0])
                if size > 2 * HELD:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > HELD:
                        yield out(parts[0])
                        parts, size = [], 0
        if parts:
            yield out(merged(parts))

    return rows.mapInArrow(run, "a long, b long, n long, t long").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _key(a: str = "a", b: str = "b") -> Column:
    """One long for a piece: two numbers of frequent words side by side in its five low bytes, or a hash where one is no such number."""
    small = F.col(a).between(0, HOT + END) & F.col(b).between(0, HOT + END)
    return F.when(small, F.shiftleft(F.col(a), BITS).bitwiseOR(F.col(b))).otherwise(F.xxhash64(a, b))


class Pieces:
    """The broadcast pieces: sorted codes with two losses each; what is not there has none."""

    def __init__(self, a: np.ndarray, b: np.ndarray, losses: np.ndarray) -> None:
        codes = pair(a.view(np.uint64), b.view(np.uint64))
        order = np.argsort(codes)
        self.codes, self.losses = codes[order], np.concatenate((losses[order], np.zeros((1, 2), np.int64)))

    def at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places; the number of pieces where there is none."""
        codes = pair(a, b)
        at = np.searchsorted(self.codes, codes)
        if len(self.codes):
            at[self.codes[np.minimum(at, len(self.codes) - 1)] != codes] = len(self.codes)
        return at


@dataclass
class Models:
    """Matched models: ``rest`` (key, l0, l1) is a stored table, ``hot`` has a bound; losses of target and background."""

    coder: Coder
    hot: Pieces
    rest: DataFrame
    unknown: np.ndarray
    start: np.ndarray


def _piece(a: str, b: Column, n: str, *losses: Column) -> list[Column]:
    return [F.col(a).alias("a"), b.cast("long").alias("b"), F.col(n).alias("n"),
            *(F.round(x * UNIT).cast("int").alias(f"l{c}") for c, x in enumerate(losses))]  # below 200 nats, so an int holds it


def train(docs: DataFrame, target: str, text: str = "text", hot: int = HOT) -> Models:
    """Count all texts; rows where the boolean column ``target`` is true are the target, all rows the background."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(target), F.lit(False)).alias("target"))
    word_counts, known = stored(counted(rows, lambda: _words).drop("b"), "word-counts"), F.col("n") >= SEEN
    sums = word_counts.where(F.col("a") != START).agg(
        *(F.coalesce(F.sum(x), F.lit(0)) for x in ("t", "n", F.when(known, F.col("t")), F.when(known, F.col("n")))), F.count(F.when(known, 1))).first()
    scale = (1.0, sums[0] / max(sums[1], 1))
    whole = [sums[c] * scale[c] + 0.5 * (sums[4] + 1) for c in (0, 1)]
    unknown = [-np.log(((sums[c] - sums[2 + c]) * scale[c] + 0.5) / whole[c]) for c in (0, 1)]
    often = max(sums[1] / hot, SEEN)
    is_hot = (F.col("n") >= often) | (F.col("a") == START)
    coder = Coder(word_counts.where((F.col("n") >= often) & (F.col("a") != START)).select("a").toPandas()["a"].to_numpy(np.int64).view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(coder)

    def neighbours():
        def make(hashes, counts, flags):
            own = shared.value(hashes)
            return _neighbours(own, counts)[0], own, np.repeat(flags, counts)
        return make

    pairs = stored(counted(rows, neighbours).where(known), "pair-counts")
    codes = docs.sparkSession.createDataFrame(pa.table({"a": coder.hashes.view(np.int64), "code": np.arange(END + 1, END + 1 + len(coder.hashes))}))
    words = word_counts.where(known | (F.col("a") == START)).join(F.broadcast(codes), "a", "left").withColumn("a", F.coalesce("code", "a")).drop("code")

    def of(c: int, side: str = "") -> Column:
        return F.col(side + "tn"[c]) * scale[c]

    def cut(c: int) -> Column:
        return F.greatest(of(c) - DISCOUNT, F.lit(0.0))

    taken = pairs.groupBy("a").agg(*(F.sum(cut(c)).alias(f"taken{c}") for c in (0, 1)))
    kinds = stored(words.join(taken, "a", "left").select(
        "a", "n", "t", *(F.log((of(c) + 0.5) / whole[c]).alias(f"alone{c}") for c in (0, 1)),
        *(F.log(F.greatest(1 - F.coalesce(F.col(f"taken{c}"), F.lit(0.0)) / F.greatest(of(c), F.lit(1e-9)), F.lit(1e-12))).alias(f"left{c}") for c in (0, 1)),
    ), "words")

    def with_word(pairs: DataFrame, key: str, *columns: str) -> DataFrame:
        """Frequent words, ``hot`` and the start at most, by broadcast; only pairs of the others are shuffled."""
        side = kinds.where(is_hot).select(F.col("a").alias(key), *(F.col(c).alias(f"{key}_{c}") for c in columns))
        other = kinds.where(~is_hot).select(F.col("a").alias(key), *(F.col(c).alias(f"{key}_{c}") for c in columns))
        return pairs.join(F.broadcast(side), key).unionByName(
            pairs.join(F.broadcast(side.select(key)), key, "left_anti").join(other, key))

    matched = with_word(with_word(pairs, "a", "n", "t", "left0", "left1"), "b", "alone0", "alone1")
    saved = []
    for c in (0, 1):
        fallen = F.col(f"a_left{c}") + F.col(f"b_alone{c}")
        saved.append(fallen - F.log(cut(c) / F.greatest(of(c, "a_"), F.lit(1e-9)) + F.exp(fallen)))
    real = kinds.where(F.col("a") != START)
    pieces = (
        matched.select(*_piece("a", F.col("b"), "n", *saved))
        .unionByName(real.select(*_piece("a", F.lit(WORD), "n", *(-F.col(f"alone{c}") - F.col(f"left{c}") - float(unknown[c]) for c in (0, 1)))))
        .unionByName(real.select(*_piece("a", F.lit(END), "n", F.col("left0"), F.col("left1"))))
        .where((F.col("n") >= often) | (F.col("l0") != 0) | (F.col("l1") != 0)))
    frequent = F.col("n") >= often
    pieces = stored(pieces.select(*(F.when(frequent, F.col(c)).alias(c) for c in "ab"), F.when(~frequent, _key()).alias("key"), "l0", "l1"), "pieces")
    near = pieces.where("key is null").select("a", "b", "l0", "l1").toPandas()  # 3 * hot rows at most
    start = kinds.where(F.col("a") == START).select(*(F.round(-F.col(f"left{c}") * UNIT).cast("long") for c in (0, 1))).first()
    discard(word_counts, pairs, kinds)
    return Models(coder, Pieces(*(near[c].to_numpy(np.int64) for c in "ab"), near[["l0", "l1"]].to_numpy(np.int64)),
                  pieces.where("key is not null").select("key", "l0", "l1"),
                  np.rint(np.array(unknown) * UNIT).astype(np.int64), np.array(start or (0, 0), np.int64))


def score(docs: DataFrame, models: Models, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score), one row per document.

    Losses are in bits a word; ``score`` is the target loss less the background loss, so low means like the target.
    Texts without a word, null ones too, have null losses and the score 0. Rows are numbered where they are read, so
    ``docs`` should come from files or a stored table, as a lost task must find its rows in the same order.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((models.coder, models.hot, models.unknown, models.start))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    longs = [StructField(c, LongType()) for c in ("words", "l0", "l1")]
    schema = StructType([StructField(c, LongType()) for c in ("row", "a", "b")] + [
        StructField("head", StructType([StructField("id", docs.schema[id].dataType), *longs]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A head for each text with the pieces at hand added up, and a row for each piece that it must ask for."""
        coder, hot, unknown, start = shared.value
        for batch in batches:
            column = batch.column(2).cast(pa.large_binary())
            for begin, end in slices(column, BYTES):
                hashes, counts = hash_words(column.slice(begin, end - begin).to_pylist())
                own = coder(hashes)
                before, full, last = _neighbours(own, counts)
                row, ids = batch.column(0).slice(begin, end - begin).to_numpy(), batch.column(1).slice(begin, end - begin)
                of = np.repeat(np.arange(len(counts)), counts)
                losses = counts[:, None] * unknown  # pieces of words are told from the unknown word
                losses[full] += start
                asked = []
                for a, b, text_of in ((own, _same(len(own), WORD), of), (before, own, of), (last, _same(len(last), END), full)):
                    at = hot.at(a, b)
                    far = at == len(hot.codes)
                    for c in (0, 1):  # sums of longs below 2^53
                        losses[:, c] += np.bincount(text_of, hot.losses[at, c], len(counts)).astype(np.int64)
                    asked.append((row[text_of[far]], a[far].view(np.int64), b[far].view(np.int64)))
                head = pa.StructArray.from_arrays([ids, *(pa.array(x) for x in (counts, losses[:, 0], losses[:, 1]))], names=["id", "words", "l0", "l1"])
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(row), pa.array(np.full(len(row), -1)), head], names=schema.names)
                asked = [np.concatenate(x) for x in zip(*asked)]
                for k in range(0, len(asked[0]), ROWS):
                    part = [pa.array(x[k:k + ROWS]) for x in asked]
                    yield pa.RecordBatch.from_arrays([*part, pa.nulls(len(part[0]), head.type)], names=schema.names)

    asks = rows.mapInArrow(run, schema).select("row", _key().alias("key"), "head")
    told = asks.join(models.rest, "key", "left").where("head is not null or l0 is not null")
    sums = told.groupBy("row").agg(F.max("head.id").alias(id), F.max("head.words").alias("n_tokens"), *(
        F.sum(F.when(F.col("head").isNull(), F.col(f"l{c}")).otherwise(F.col(f"head.l{c}"))).alias(f"sum{c}") for c in (0, 1)))
    some = F.col("n_tokens") > 0
    loss = [F.when(some, F.col(f"sum{c}") / (UNIT * float(np.log(2))) / F.col("n_tokens")) for c in (0, 1)]
    return sums.select(id, "n_tokens", loss[0].alias("target_loss"), loss[1].alias("background_loss"),
                       F.coalesce(loss[0] - loss[1], F.lit(0.0)).alias("score"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good; background: all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = stored(table(spark, sf_dir, "labels").where("quality = 1 and doc_id is not null").select("doc_id").distinct(), "target-ids")
    marked = docs.join(checked_broadcast(good.withColumn("target", F.lit(True))), "doc_id", "left")
    return score(docs, train(marked, "target"))
