"""Toxicity: class-conditional Kneser-Ney bigram models with shared backoff counts.

Each class has its own bigram counts; they back off to the class's continuation counts of the word, these
to continuation counts pooled over both classes, and those to a uniform share. So an expression that one class
happens not to show costs it little. A text's two log-likelihoods are compared by word, over the whole text and over its
most telling passage of a few words, as one word in a long text hardly moves the mean; a logistic
curve fitted on rows kept apart turns both differences into a probability.

Words are compared by a 64-bit hash: models are sorted arrays that every task can search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from readgrade.llm.common import held_out, per_text, sample_labelled, ship, slices, stored, table
from readgrade.llm.word_hashes import RARE, START, Table, hash_words, pair, split_words

#: The models are fitted on at most so many labelled rows of each class, of at most so many bytes together.
ROWS_PER_CLASS, CLASS_BYTES = 4000, 16 << 20
DISCOUNT = 0.75
#: Discounts of pair counts and of continuation counts to choose from, on rows kept apart.
DISCOUNTS = [(pairs, words) for pairs in (0.5, 0.75, 1.0, 2.0, 3.0, 10.0, 100.0, 1000.0) for words in (0.75, 1.0, 3.0, 10.0)]
#: Words of a passage that is compared on its own.
WINDOW = 4
#: One labelled row in so many is kept apart for the logistic curve.
APART = 5


class Models:
    """Both classes' models from counts of word pairs, with the words of the shared vocabulary only.

    ``pairs`` (first, second, n0, n1) holds the pairs that a class has more often than the discount, or those that are asked for, ``heads``
    (first, n0, n1) all occurrences by first word and, as t0_ and t1_ with the discount, what is left of them after it, ``kinds`` (second, f0, f1, f) by second word how many
    different words stand before it in each class and in both together. ``discounts``: taken from each pair count and from each continuation
    count of a class; what is taken goes to the level below. Where a class is a small sample large ones win: a count that both
    classes could have by chance then leaves the shared level in charge.
    """

    def __init__(self, pairs: dict, heads: dict, kinds: dict, discounts: tuple[float, float]) -> None:
        self.discounts, pooled = discounts, kinds["f"]
        shared = np.maximum(pooled - DISCOUNT, 0) / max(pooled.sum(), 1)
        shared += max(1 - shared.sum(), 1e-9) / (len(shared) + 1)
        self.unseen = max(1 - shared.sum(), 1e-9)
        order = np.argsort(heads["first"])
        where = order[np.searchsorted(heads["first"], pairs["first"], sorter=order)] if len(order) else np.empty(0, np.int64)
        gain, taken, unigram = {}, {}, {"shared": shared}
        self.left = []
        for c in (0, 1):
            share = np.maximum(pairs[f"n{c}"] - discounts[0], 0) / np.maximum(heads[f"n{c}"][where], 1)
            whole = heads.get(f"t{c}_{discounts[0]}")  # what all pairs of a head keep, if not all pairs are here
            gain[f"p{c}"] = share
            taken[f"t{c}"] = np.bincount(where, share, len(order)) if whole is None else whole / np.maximum(heads[f"n{c}"], 1)
            own = np.maximum(kinds[f"f{c}"] - discounts[1], 0) / max(kinds[f"f{c}"].sum(), 1)
            unigram[f"u{c}"] = own
            self.left.append(1 - own.sum())
        some = (gain["p0"] > 0) | (gain["p1"] > 0)  # pairs that get nothing need no place
        self.pairs = Table(pair(pairs["first"][some], pairs["second"][some]), **{c: v[some] for c, v in gain.items()})
        self.heads = Table(heads["first"], **taken)
        self.kinds = Table(kinds["second"], **unigram)

    def differences(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, 2): log P(toxic) - log P(ordinary) by word, as the mean over the text and as the largest
        mean over WINDOW words in a row (the text ends in words without a difference); zeros without words."""
        out = np.zeros((len(texts), 2))
        lengths = np.array([len(t) for t in texts], np.int64)
        full = np.flatnonzero(lengths)
        if not len(full) or not len(self.kinds):
            return out
        second = np.concatenate([texts[i] for i in full])
        lengths = lengths[full]
        starts = np.cumsum(lengths) - lengths
        at = self.kinds.at(second)
        rare = at == len(self.kinds)
        second[rare], at[rare] = RARE, self.kinds.at(np.array([RARE], np.uint64))[0]
        first = np.concatenate((np.array([START], np.uint64), second[:-1]))
        first[starts] = START
        head, both = self.heads.at(first), self.pairs.at(pair(first, second))
        base = self.kinds.columns["shared"][at]
        base = np.where(base > 0, base, self.unseen)
        log = []
        for c in (0, 1):
            lower = self.kinds.columns[f"u{c}"][at] + self.left[c] * base
            log.append(np.log(self.pairs.columns[f"p{c}"][both] + (1 - self.heads.columns[f"t{c}"][head]) * lower + 1e-30))
        delta = log[1] - log[0]
        out[full, 0] = np.add.reduceat(delta, starts) / lengths
        spread = np.zeros(len(delta) + WINDOW * len(full))
        spread[np.arange(len(delta)) + np.repeat(WINDOW * np.arange(len(full)), lengths)] = delta
        total = np.concatenate(([0.0], np.cumsum(spread)))
        means = (total[WINDOW:] - total[:-WINDOW]) / WINDOW
        begin = starts + WINDOW * np.arange(len(full))  # passages start at a word of the text, those behind it reach into the next text
        out[full, 1] = np.maximum.reduceat(means, np.stack((begin, begin + lengths), axis=1).ravel())[::2]
        return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 40) -> tuple[np.ndarray, float]:
    """(weights with the intercept last, log loss): Newton steps with a little shrinkage."""
    X, w = np.concatenate((x, np.ones((len(x), 1))), axis=1), np.zeros(x.shape[1] + 1)
    if not len(x) or y.min() == y.max():
        return w, np.inf
    scale = np.append(np.maximum(np.std(x, axis=0), 1e-9), 1)
    X = X / scale
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        w = w + np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + 1e-1 * np.eye(len(w)), X.T @ (y - p) - 1e-1 * w)
    p = np.clip(1 / (1 + np.exp(-np.clip(X @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w / scale, float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


class Classifier:
    def __init__(self, models: Models, weights: np.ndarray) -> None:
        self.models, self.weights = models, weights

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        x = self.models.differences(split_words(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -700, 700)))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        column = batch.column(0).cast(pa.large_binary())
        for begin, end in slices(column):
            yield column.slice(begin, end - begin).to_pylist(), batch.column(1).slice(begin, end - begin).to_pylist()


def count_words(rows: DataFrame) -> DataFrame:
    """(w, n) of the word hashes in (text, y)."""
    def run(batches):
        for texts, _ in _texts(batches):
            w, n = np.unique(hash_words(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["w", "n"])
    return rows.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def count_pairs(rows: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(first, second, n0, n1) of the word pairs in (text, y) with rare words set to one."""
    def run(batches):
        known = Table(vocabulary)
        for texts, labels in _texts(batches):
            frames = []
            for w, y in zip(split_words(texts), labels, strict=True):
                w[known.at(w) == len(known)] = RARE
                frames.append((np.concatenate((np.array([START], np.uint64), w[:-1]))[:len(w)], w, np.full(len(w), y)))
            first, second, y = (np.concatenate(x) for x in zip(*frames, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(y)],
                                             names=["first", "second", "y"])
    pairs = rows.mapInArrow(run, "first long, second long, y long").groupBy("first", "second")
    return pairs.agg(F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1"))


def _arrays(table: DataFrame) -> dict[str, np.ndarray]:
    """Columns of a bounded table: hashes unsigned, counts as doubles."""
    rows = table.toPandas()
    return {c: rows[c].to_numpy(np.int64).view(np.uint64) if c in ("first", "second") else rows[c].to_numpy(np.float64) for c in rows}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text",
          rows_per_class: int = ROWS_PER_CLASS, class_bytes: int = CLASS_BYTES) -> Classifier:
    """Fit on a bounded sample of the labelled rows outside the held-out quarter.

    At most ``rows_per_class`` rows of each class in the order of a hash of their id, whole, as long as they come to
    ``class_bytes`` at most together; equal texts of a class count once. Word pairs are counted in tasks; the driver holds sums
    over them, to choose the discounts the pairs of the rows kept apart, and then the pairs above the chosen one, all of which the
    sample bounds. One row in APART serves only to choose the discounts and to fit the
    curve. Without rows of both classes every text gets the score 0.5.
    """
    ship(docs.sparkSession)
    sample, counts = sample_labelled(docs, labels, label, id, text, rows_per_class, class_bytes)
    rows = stored(sample.select(F.col(text).cast("string").alias("text"), F.col(label).cast("long").alias("y")).distinct()
                  .withColumn("apart", F.pmod(F.xxhash64("text"), F.lit(APART)) == 0), "toxicity-sample")
    fitted = rows.where(~F.col("apart")).select("text", "y")
    vocabulary = count_words(fitted).where("n > 1").select("w").toPandas()["w"].to_numpy(np.int64).view(np.uint64)
    counted = stored(count_pairs(fitted, np.append(vocabulary, np.array([RARE], np.uint64))), "toxicity-pairs")
    kept = [(c, d) for d in sorted({pairs for pairs, _ in DISCOUNTS}) for c in (0, 1)]
    heads = _arrays(counted.groupBy("first").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), *[
        F.sum(F.greatest(F.col(f"n{c}") - F.lit(d), F.lit(0.0))).alias(f"k{k}") for k, (c, d) in enumerate(kept)]))
    heads |= {f"t{c}_{d}": heads.pop(f"k{k}") for k, (c, d) in enumerate(kept)}
    # the choice needs the pairs of the rows kept apart only
    asked = count_pairs(rows.where("apart").select("text", "y"), np.append(vocabulary, np.array([RARE], np.uint64))).select("first", "second")
    near = _arrays(counted.join(asked, ["first", "second"], "left_semi"))
    kinds = _arrays(counted.groupBy("second").agg(F.count_if(F.col("n0") > 0).alias("f0"), F.count_if(F.col("n1") > 0).alias("f1"),
                                                  F.count("*").alias("f")))
    apart = rows.where("apart").select("text", "y").orderBy("text", "y").toPandas()
    known, y = split_words([t.encode() for t in apart["text"]]), apart["y"].to_numpy(np.float64)
    best = None
    for discounts in DISCOUNTS:
        models = Models(near, heads, kinds, discounts)
        weights, loss = logistic(models.differences([w.copy() for w in known]), y)
        if best is None or loss < best[0]:
            best = loss, discounts, weights
    _, discounts, weights = best
    models = Models(_arrays(counted.where(F.greatest("n0", "n1") > discounts[0])), heads, kinds, discounts)
    if len(y) and y.min() < y.max():  # from the shares in the sample to the real ones
        real = np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
        weights = np.append(weights[:-1], weights[-1] + real - np.log(y.sum() / (len(y) - y.sum())))
    return Classifier(models, weights)


def score_toxicity(docs: DataFrame, classifier: Classifier, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score), one row per document: the probability of label 1 from the whole text.

    Null texts count as empty; texts without a word have the score of no difference. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # as large as the bounded sample lets it be
    return per_text(docs, id, text, "score double", lambda: lambda texts: [shared.value.score(texts)])


def op6_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
