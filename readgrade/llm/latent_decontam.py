"""Benchmark decontamination by latent semantic retrieval.

1. Texts become numbers once: the place of each word in the vocabulary of the benchmark, 0 for any other word, stored by document.
   The vocabulary grows with the benchmark only, as all that a passage can share with an item is in it.
2. Randomised SVD of the TF-IDF matrix of all passages (words in a row, apart from each other): every task adds up
   A'(A W) for a seeded random W, the sums are added after a shuffle, and the driver finishes with matrices that are as
   large as the vocabulary (single-pass Nystroem form of the range finder).
3. Overlapping windows of every document, as points in the latent space with all directions scaled alike, are held
   against the windows of the benchmark items by cosine.
4. Each candidate is checked in the document itself: longest common subsequence of the item and the surrounding words, and the answer,
   or where the benchmark has none the item's rarest words, so that paraphrases stay and chance likeness goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from readgrade.llm.common import checked_broadcast, fresh, ship, slices, stored, table
from readgrade.llm.word_hashes import hash_words, split_words, words

#: Words of a block; two neighbouring blocks are a window.
BLOCK = 12
#: Latent directions, and random ones beyond them.
RANK, MORE, SEED = 32, 8, 11
#: Least cosine of a candidate. A window that holds an item of n words has 2 * BLOCK - n others beside it, which turn its point away,
#: the more the rarer they are, so for a shorter item this is multiplied by n / (2 * BLOCK).
COSINE = 0.55
#: Shares of the item that must be in the document in order: alone, and together with the answer words.
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.5
#: Items that are searched for in one go; more are searched for in parts.
ITEMS = 50_000
WINDOWS_AT_ONCE = 2048


class Benchmark:
    """Items as places in their own vocabulary (1 and up), the windows they are searched by, and their answer words."""

    def __init__(self, ids: list, texts: list[str], answers: list[str | None]) -> None:
        hashed = split_words([(t or "").encode() for t in texts])
        answered = [words(a.encode()) if a else None for a in answers]
        self.vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *hashed, *(w for w in answered if w is not None)]))
        kept = [k for k, w in enumerate(hashed) if len(w)]
        self.ids = [ids[k] for k in kept]
        self.items = [self.places(hashed[k]) for k in kept]
        self.answers = [None if answered[k] is None else self.places(answered[k]) for k in kept]

    def places(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 1

    @property
    def kind(self):
        return np.uint16 if self.size <= 1 << 16 else np.uint32


def passages(lengths: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Passages of each text, and the places of all of them as rows, short ones filled up with 0."""
    parts = -(-lengths // size)
    base, begin = np.cumsum(parts) - parts, np.cumsum(lengths) - lengths
    rows = np.zeros(int(parts.sum()) * size, places.dtype)
    rows[np.arange(len(places)) + np.repeat(base * size - begin, lengths)] = places
    return parts, rows.reshape(-1, size)


def row_sums(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The sum of the points of each row's places; place 0 must have the zero point."""
    out = points.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        out += points.take(rows[:, k], axis=0)
    return out


def encode(docs: DataFrame, id: str, text: str, bench: Benchmark) -> DataFrame:
    """(id, places, df): the words of every document as numbers; in one row a task instead the passages that have each word."""
    shared, kind = docs.sparkSession.sparkContext.broadcast(bench), docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, df, last = shared.value, np.zeros(shared.value.size, np.int64), None
        for batch in batches:
            column, last = batch.column(1).cast(pa.large_binary()), batch.column(0)
            for begin, end in slices(column):
                hashes, lengths = hash_words(column.slice(begin, end - begin).to_pylist())
                places = b.places(hashes).astype(b.kind)
                rows = np.sort(passages(lengths, places, 2 * BLOCK)[1], axis=1)
                new = np.ones(rows.shape, bool)
                new[:, 1:] = rows[:, 1:] != rows[:, :-1]
                df += np.bincount(rows[new], minlength=b.size)
                df[0] += len(rows) - np.count_nonzero(rows[:, :1] == 0)  # at 0: all passages
                cut = np.cumsum(lengths)[:-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array([x.tobytes() for x in np.split(places, cut)], pa.binary()),
                     pa.nulls(end - begin, pa.binary())], names=[id, "places", "df"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, last.type), pa.nulls(1, pa.binary()), pa.array([df.tobytes()], pa.binary())],
                                             names=[id, "places", "df"])

    return docs.select(F.col(id), F.col(text).cast("string")).mapInArrow(run, f"`{id}` {kind}, places binary, df binary")


PIECES, PIECE_ROWS = 64, "k long, piece binary"


def pieces(whole: np.ndarray) -> pa.RecordBatch:
    """An array of doubles cut into PIECES rows (k, piece)."""
    flat = np.asarray(whole, np.float64).ravel()
    size = -(-len(flat) // PIECES)
    return pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int64()), pa.array(
        [flat[k * size:(k + 1) * size].tobytes() for k in range(PIECES)], pa.binary())], names=["k", "piece"])


def added(parts: DataFrame, length: int) -> np.ndarray:
    """The sum of all arrays in a table of pieces, added by piece after a shuffle."""
    def add(batches):
        held: dict = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[k] = held.get(k, 0) + np.frombuffer(blob, np.float64)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                                             names=["k", "piece"])

    rows = parts.repartition("k").mapInArrow(add, PIECE_ROWS).collect()
    out = [np.frombuffer(r["piece"], np.float64) for r in sorted(rows, key=lambda r: r["k"])]
    return np.concatenate(out) if out else np.zeros(length)


def _texts(batches: Iterator[pa.RecordBatch], kind, size: int = 1 << 18) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, words of each document, and all their places, for about ``size`` words at a time."""
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        for begin, end in slices(column, size * np.dtype(kind).itemsize):
            blobs = column.slice(begin, end - begin).to_pylist()
            yield (batch.column(0).slice(begin, end - begin), np.array([len(x) // np.dtype(kind).itemsize for x in blobs], np.int64),
                   np.frombuffer(b"".join(blobs), kind))


def projected(coded: DataFrame, weights: np.ndarray, kind, width: int) -> np.ndarray:
    """A'(A W) over all passages for the seeded W, without the weights of the last factor A'."""
    size = len(weights)

    def run(batches):
        draw = (np.random.default_rng(SEED).standard_normal((size, width)) * weights[:, None]).astype(np.float32)
        total = np.zeros((size, width))
        for _, lengths, places in _texts(batches, kind):
            rows = passages(lengths, places, 2 * BLOCK)[1]
            if not len(rows):
                continue
            y = np.ascontiguousarray(row_sums(rows, draw).T)
            passage, column = np.nonzero(rows)
            own = rows[passage, column]
            for k in range(width):
                total[:, k] += np.bincount(own, y[k, passage], size)
        yield pieces(total)

    return added(coded.select("id", "places").mapInArrow(run, PIECE_ROWS), size * width).reshape(size, width)


def latent(coded: DataFrame, weights: np.ndarray, kind, rank: int = RANK) -> np.ndarray:
    """(places, rank): the point that each word adds to its passage: right singular vectors of the weighted passages, scaled alike."""
    width = min(rank + MORE, len(weights))
    draw = np.random.default_rng(SEED).standard_normal((len(weights), width))
    y = projected(coded, weights, kind, width) * weights[:, None]
    shift = 1e-9 * max(float(np.linalg.norm(y)), 1e-9)
    y += shift * draw
    inner = draw.T @ y
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > values.max() * 1e-10
    u, s, _ = np.linalg.svd(y @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    s = np.sqrt(np.maximum(s ** 2 - shift, 0))
    keep = np.flatnonzero(s > s.max() * 1e-6)[:rank] if len(s) else []
    return (weights[:, None] * u[:, keep] / np.maximum(s[keep], 1e-12) * s[keep].max()).astype(np.float32)


def windows(lengths: np.ndarray, places: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first block, unit point) of every window with words of the vocabulary, and the blocks of each text."""
    blocks, rows = passages(lengths, places, BLOCK)
    sums = row_sums(rows, points)
    count = np.where(blocks > 0, np.maximum(blocks - 1, 1), 0)
    text = np.repeat(np.arange(len(lengths)), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.cumsum(blocks) - blocks, count) + first
    z = sums[at]
    two = first + 1 < blocks[text]
    z[two] += sums[at[two] + 1]
    norm = np.sqrt(np.einsum("ij,ij->i", z, z))
    full = norm > 1e-12
    return text[full], first[full], z[full] / norm[full, None], blocks


class Marks:
    """Which answer words may be near a window, as 64 bits: a test that never turns a match away.

    Each place that is an answer word of any item has one of 64 bits. What a match must have of the item's bits
    follows from what :class:`Checker` asks for: at least ANSWER of the answer words, or VERBATIM of all words.
    """

    def __init__(self, checkers: list[Checker], size: int) -> None:
        self.bit = np.zeros(size, np.uint64)
        marked = np.array(sorted(set().union(*(c.answer for c in checkers))), np.int64)
        self.bit[marked] = np.uint64(1) << (np.arange(len(marked)) % 64).astype(np.uint64)
        self.bit[0] = 0
        self.items = np.zeros(len(checkers), np.uint64)
        self.least = np.zeros(len(checkers), np.int64)
        for k, c in enumerate(checkers):
            if c.answer:
                self.items[k] = np.bitwise_or.reduce(self.bit[sorted(c.answer)])
            kinds = len(c.masks)
            # so many answer words can be missing: by the answer rule, or, with the item word for word, those that are
            # no words of the item and as many of the others as the item may lack
            outside = len(c.answer.difference(c.masks))
            missing = max(len(c.answer) - int(np.ceil(ANSWER * len(c.answer))), outside + c.length - int(np.ceil(VERBATIM * c.length)))
            self.least[k] = max(0, int(self.items[k]).bit_count() - missing) if kinds else 0

    def blocks(self, lengths: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blocks, rows = passages(lengths, places, BLOCK)
        return np.bitwise_or.reduce(self.bit[rows], axis=1) if len(rows) else np.empty(0, np.uint64), np.cumsum(blocks) - blocks

    @staticmethod
    def around(marks: np.ndarray, reach: int) -> np.ndarray:
        """Marks of each block with ``reach`` blocks before and ``reach + 1`` behind, other texts' too: more can only let more pass."""
        out = marks.copy()
        for k in range(1, reach + 2):
            out[:-k or None] |= marks[k:]
            if k <= reach:
                out[k:] |= marks[:-k]
        return out


class Checker:
    """Longest common subsequence and answer words of one item in the words around a window."""

    def __init__(self, item: np.ndarray, answer: np.ndarray | None, weights: np.ndarray) -> None:
        self.length, self.masks = len(item), {}
        for k, w in enumerate(item.tolist()):
            self.masks[w] = self.masks.get(w, 0) | 1 << k
        if answer is None:  # the rarest third of the item's words stands in for an answer
            kinds = np.unique(item)
            answer = kinds[np.argsort(-weights[kinds], kind="stable")][:max(1, -(-len(kinds) // 3))]
        self.answer = set(answer.tolist())

    def check(self, near: list[int]) -> tuple[float, float]:
        ones = state = (1 << self.length) - 1
        for w in near:
            mask = self.masks.get(w)
            if mask:
                common = state & mask
                state = (state + common | state - common) & ones
        share = len(self.answer.intersection(near)) / len(self.answer) if self.answer else 1.0
        return (self.length - state.bit_count()) / self.length, share


def search(coded: DataFrame, id_type: str, bench: Benchmark, weights: np.ndarray, points: np.ndarray, cosine: float, begin_at: int, end_at: int) -> DataFrame:
    """(id, item, cosine, lcs, answer_share, word): for each document and each of the items from ``begin_at`` to before ``end_at`` found in it,
    the best place."""
    context = coded.sparkSession.sparkContext
    shared, kind = context.broadcast((bench.items[begin_at:end_at], bench.answers[begin_at:end_at], weights, points)), bench.kind
    schema = f"id {id_type}, item long, cosine double, lcs double, answer_share double, word long"

    def run(batches):
        items, answers, weights, points = shared.value
        lengths = np.array([len(x) for x in items], np.int64)
        of, _, queries, _ = windows(lengths, np.concatenate(items), points)
        least = np.minimum(cosine, cosine * np.minimum(lengths[of] / (2 * BLOCK), 1)).astype(np.float32)
        checkers = [Checker(i, a, weights) for i, a in zip(items, answers, strict=True)]
        marks, reach = Marks(checkers, len(weights)), -(-(lengths + BLOCK // 2) // BLOCK)
        for ids, sizes, places in _texts(batches, kind):
            text, first, z, _ = windows(sizes, places, points)
            begin = np.cumsum(sizes) - sizes
            near, base = marks.blocks(sizes, places)
            around = {int(k): marks.around(near, int(k)) for k in np.unique(reach)}
            best: dict = {}
            for part in range(0, len(z), WINDOWS_AT_ONCE):
                like = z[part:part + WINDOWS_AT_ONCE] @ queries.T
                row, query = np.divmod(np.flatnonzero(like >= least), like.shape[1])
                k, block = of[query], base[text[row + part]] + first[row + part]
                seen = np.empty(len(k), np.uint64)
                for size, own in around.items():
                    here = reach[k] == size
                    seen[here] = own[block[here]]
                able = np.bitwise_count(seen & marks.items[k]) >= marks.least[k]
                pairs: dict = {}
                for r, k, c in zip((row[able] + part).tolist(), k[able].tolist(), like[row[able], query[able]].tolist(), strict=True):
                    pairs[r, k] = max(c, pairs.get((r, k), 0.0))
                for (r, k), c in pairs.items():
                    t, n, own = int(text[r]), int(lengths[k]), checkers[k]
                    middle = (int(first[r]) + 1) * BLOCK
                    low, high = max(0, middle - n - BLOCK // 2), min(int(sizes[t]), middle + n + BLOCK // 2)
                    lcs, answer = own.check(places[begin[t] + low:begin[t] + high].tolist())
                    if lcs >= VERBATIM or lcs >= PARAPHRASE and answer >= ANSWER:
                        now = (lcs, answer, c, -int(first[r]) * BLOCK)
                        if (t, k) not in best or now > best[t, k]:
                            best[t, k] = now
            if best:
                keys = sorted(best)
                found = [best[x] for x in keys]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([t for t, _ in keys])), pa.array([begin_at + k for _, k in keys], pa.int64()), pa.array([float(x[2]) for x in found]),
                     pa.array([float(x[0]) for x in found]), pa.array([float(x[1]) for x in found]), pa.array([-x[3] for x in found], pa.int64())],
                    names=["id", "item", "cosine", "lcs", "answer_share", "word"])

    return coded.mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
               answer: str | None = None, rank: int = RANK, cosine: float = COSINE, items_at_once: int = ITEMS) -> DataFrame:
    """(id, item_id, cosine, lcs, answer_share, word): benchmark items found in documents, one row for each document and item.

    ``lcs`` is the share of the item's words that the document has in order near ``word``, the first word of the window. Null and
    empty texts on either side, and items without a word, match nothing. Repeated rows are found each on its own. The benchmark
    is the query set and is read by the driver. Vocabulary, weights and latent space are fitted once over all items; only the search goes
    through the items ``items_at_once`` at a time, so what is found for an item does not depend on how many others there are in a part.
    ``cosine`` is asked of windows for items of ``2 * BLOCK`` words or more, less of shorter ones.
    Words of a separate ``answer`` are part of the vocabulary. Of places of one item in a document the best counts, of equal ones the
    first. An empty table on either side gives no rows; texts of any length are searched window by window. Other columns, whatever
    their names, are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t"),
                            (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("a")).where("t is not null")
    kind = benchmark.schema[item_id].dataType.simpleString()
    id_type = docs.schema[id].dataType.simpleString()
    own = rows.orderBy("t", "i").toPandas()
    bench = Benchmark(own["i"].tolist(), own["t"].tolist(), own["a"].tolist())
    if not bench.items:
        return spark.createDataFrame([], f"`{id}` {id_type}, `{item_id}` {kind}, cosine double, lcs double, answer_share double, word long")
    coded = stored(encode(docs, id, text, bench).withColumnRenamed(id, "id"), "coded-texts")
    df = added(coded.where("df is not null").select("df").mapInArrow(_df_pieces, PIECE_ROWS), bench.size)
    weights = np.log((df[0] + 1) / (df + 1))
    weights[0] = 0.0
    texts = coded.where("df is null and octet_length(places) > 0").select("id", "places")
    points = latent(texts, weights, bench.kind, rank)
    if not points.shape[1]:
        points = np.eye(bench.size, dtype=np.float32)[:, :1]  # no passage has a word: nothing is found
    parts = [search(texts, id_type, bench, weights, points, cosine, k, k + items_at_once) for k in range(0, len(bench.items), items_at_once)]
    names = spark.createDataFrame(list(enumerate(bench.ids)), f"item long, name {kind}")
    return reduce(DataFrame.unionByName, parts).join(F.broadcast(names), "item").select(
        F.col("id").alias(id), F.col("name").alias(item_id), "cosine", "lcs", "answer_share", "word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, all columns as they are; rows of one text go or stay together."""
    key = fresh("text_key", docs)
    keyed = docs.withColumn(key, F.unhex(F.substring(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256), 1, 32)))
    leaks = stored(find_leaks(keyed, benchmark, id=key, text=text, **options).select(key).distinct(), "leaks")
    return keyed.join(checked_broadcast(leaks), key, "left_anti").drop(key)


def _df_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            yield pieces(np.frombuffer(blob, np.int64))


def op9_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
