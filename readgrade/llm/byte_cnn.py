"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over the whole text, each filter is max-pooled over chunks of
two blocks that overlap by one block, a hidden layer reads each chunk, and the mean and the maximum over all chunks
give one probability. Scoring folds embedding and filters into tables over byte pairs,
so a position costs three look-ups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from readgrade.llm.common import fresh, held_out, per_text, sample_labelled, table, with_columns

WIDTH, EMBED, FILTERS, HIDDEN, BLOCK = 6, 6, 16, 16, 128
#: The classifier is fitted on at most so many labelled rows of each class, of at most so many bytes together.
ROWS_PER_CLASS, CLASS_BYTES = 1500, 8 << 20


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another in whole blocks with at least WIDTH - 1 zero bytes behind each; first block of each text."""
    blocks = np.array([-(-(len(t) + WIDTH - 1) // BLOCK) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(blocks)))
    data = np.zeros(int(starts[-1]) * BLOCK + WIDTH - 1, np.uint8)
    for t, s in zip(texts, starts, strict=False):
        data[s * BLOCK:s * BLOCK + len(t)] = np.frombuffer(t, np.uint8)
    return data, starts


def chunks(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second block of every chunk, and the first chunk of every text."""
    counts = np.maximum(np.diff(starts) - 1, 1)
    heads = np.concatenate(([0], np.cumsum(counts)))[:-1]
    first = np.arange(counts.sum()) + np.repeat(starts[:-1] - heads, counts)
    return first, np.minimum(first + 1, np.repeat(starts[1:] - 1, counts)), heads


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {"emb": draw(256, EMBED) * 16, "conv": draw(WIDTH * EMBED, FILTERS), "conv_b": np.zeros(FILTERS, np.float32),
            "hid": draw(FILTERS, HIDDEN), "hid_b": np.zeros(HIDDEN, np.float32),
            "out": draw(2 * HIDDEN, 1)[:, 0], "out_b": np.zeros(1, np.float32)}


def head(p: dict, pooled: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """From pooled blocks to a logit for each text, with what the gradient needs."""
    first, second, heads = chunks(starts)
    act = np.maximum(pooled + p["conv_b"], 0)
    chunk = np.maximum(act[first], act[second])
    hidden = np.maximum(chunk @ p["hid"] + p["hid_b"], 0)
    counts = np.diff(np.append(heads, len(first)))
    top = np.maximum.reduceat(hidden, heads)
    mean = np.add.reduceat(hidden, heads) / counts[:, None].astype(np.float32)
    logit = np.concatenate((mean, top), axis=1) @ p["out"] + p["out_b"][0]
    return {"first": first, "second": second, "heads": heads, "act": act, "chunk": chunk, "hidden": hidden,
            "counts": counts, "top": top, "mean": mean, "logit": logit}


def gradient(p: dict, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    data, starts = layout(texts)
    size, n = int(starts[-1]) * BLOCK, len(texts)
    emb = p["emb"][data]
    seen = np.concatenate([emb[j:j + size] for j in range(WIDTH)], axis=1)
    conv = (seen @ p["conv"]).reshape(-1, BLOCK, FILTERS)
    at = conv.argmax(axis=1)
    h = head(p, np.take_along_axis(conv, at[:, None], axis=1)[:, 0], starts)
    delta = ((1 / (1 + np.exp(-h["logit"])) - labels) / n).astype(np.float32)
    g = {"out": np.concatenate((h["mean"], h["top"]), axis=1).T @ delta, "out_b": np.array([delta.sum()], np.float32)}
    of = np.repeat(np.arange(n), h["counts"])
    d_mean, d_top = np.split(delta[:, None] * p["out"], 2, axis=1)
    d_hidden = (d_mean / h["counts"][:, None])[of] + np.where(h["hidden"] == h["top"][of], d_top[of], 0)
    d_hidden *= h["hidden"] > 0
    g["hid"], g["hid_b"] = h["chunk"].T @ d_hidden, d_hidden.sum(0)
    d_chunk = d_hidden @ p["hid"].T
    d_act = np.zeros_like(h["act"])
    left = h["act"][h["first"]] >= h["act"][h["second"]]
    np.add.at(d_act, h["first"], np.where(left, d_chunk, 0))
    np.add.at(d_act, h["second"], np.where(left, 0, d_chunk))
    d_act *= h["act"] > 0
    g["conv_b"] = d_act.sum(0)
    block, filt = np.nonzero(d_act)
    where, d = block * BLOCK + at[block, filt], d_act[block, filt]
    g["conv"], g["emb"] = np.zeros_like(p["conv"]), np.zeros_like(p["emb"])
    np.add.at(g["conv"].T, filt, seen[where] * d[:, None])
    back = (p["conv"].T[filt] * d[:, None]).reshape(-1, WIDTH, EMBED)
    for j in range(WIDTH):
        np.add.at(g["emb"], data[where + j], back[:, j])
    return g


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7, steps: int = 1000, batch: int = 32,
        rate: float = 4e-3) -> dict[str, np.ndarray]:
    """Adam on the log loss of batches that hold both classes in equal parts; a single class gives a constant."""
    rng = np.random.default_rng(seed)
    p = initial(rng)
    labels = np.asarray(labels, np.float32)
    classes = [np.flatnonzero(labels == y) for y in (0, 1)]
    if not all(map(len, classes)):
        return p | {"out": p["out"] * 0}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    orders = [np.empty(0, np.int64)] * 2
    for step in range(1, steps + 1):
        part = []
        for y, own in enumerate(classes):  # each class in random passes over all its texts
            while len(orders[y]) < batch // 2:
                orders[y] = np.concatenate((orders[y], rng.permutation(own)))
            part.append(orders[y][:batch // 2])
            orders[y] = orders[y][batch // 2:]
        part = np.concatenate(part)
        for k, g in gradient(p, [texts[i] for i in part], labels[part]).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            slope = m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
            p[k] = (p[k] - rate * (1 - step / (steps + 1)) * slope).astype(np.float32)
    return p


def scorer(p: dict):
    """A function from whole texts (bytes or None) to probabilities."""
    conv = p["conv"].reshape(WIDTH, EMBED, FILTERS)
    single = [p["emb"] @ conv[j] for j in range(WIDTH)]
    pairs = [(single[j][:, None] + single[j + 1][None]).reshape(1 << 16, FILTERS) for j in range(0, WIDTH, 2)]

    def pooled(data: np.ndarray, step: int = 64) -> np.ndarray:
        """The maximum of each filter over each block, some blocks at a time."""
        out = np.empty(((len(data) - WIDTH + 1) // BLOCK, FILTERS), np.float32)
        for b in range(0, len(out), step):
            part = data[b * BLOCK:min(b + step, len(out)) * BLOCK + WIDTH - 1].astype(np.int32)
            pair, n = part[:-1] << 8 | part[1:], len(part) - WIDTH + 1
            total = pairs[0].take(pair[:n], axis=0)
            for k in range(1, len(pairs)):
                total += pairs[k].take(pair[2 * k:2 * k + n], axis=0)
            out[b:b + step] = total.reshape(-1, BLOCK, FILTERS).max(axis=1)
        return out

    def score(texts: list[bytes | None]) -> np.ndarray:
        data, starts = layout([t or b"" for t in texts])
        return 1 / (1 + np.exp(-head(p, pooled(data), starts)["logit"].astype(np.float64)))

    return score


def shifted(p: dict, ones: int, zeros: int) -> dict:
    """The network, fitted on classes in equal parts, for classes in their real proportion (add-one)."""
    return p | {"out_b": (p["out_b"] + np.log((ones + 1) / (zeros + 1))).astype(np.float32)}


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
          rows_per_class: int = ROWS_PER_CLASS, class_bytes: int = CLASS_BYTES) -> dict[str, np.ndarray]:
    """Fit on a bounded sample of the labelled rows outside the held-out quarter.

    At most ``rows_per_class`` rows of each class in the order of a hash of their id, whole, as long as they come to
    ``class_bytes`` at most together. Null labels, null ids and labels without a document are no examples.
    """
    sample, counts = sample_labelled(docs, labels, label, id, text, rows_per_class, class_bytes)
    rows = sample.orderBy(F.xxhash64(id), text).toPandas()
    if not len(rows):
        return initial(np.random.default_rng(0)) | {"out": np.zeros(2 * HIDDEN, np.float32)}
    net = fit([t.encode() for t in rows[text]], rows[label].to_numpy())
    return shifted(net, counts.get(1, 0), counts.get(0, 0))


def score_quality(docs: DataFrame, net: dict, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score), one row per document: the probability of label 1 from the whole text.

    Null texts count as empty, and empty texts have a score. Other columns are not looked at.
    """
    return per_text(docs, id, text, "score double", lambda: (lambda f: lambda texts: [f(texts)])(scorer(net)))


def keep_good(docs: DataFrame, net: dict, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, all columns as they are."""
    score = fresh("score", docs)
    scored = with_columns(docs, text, f"{score} double", lambda: (lambda f: lambda texts: [f(texts)])(scorer(net)))
    return scored.where(F.col(score) >= least).drop(score)


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
