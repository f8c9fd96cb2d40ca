import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SCHEMA, prose
from pyspark.sql import functions as F

from readgrade.llm import byte_cnn as B, kn_toxicity as K, language_id as L, lm_scoring as M, word_hashes as H


@pytest.fixture(scope="module")
def labelled(spark):
    """Good texts are words, bad ones shout; toxic ones hold a word of their own."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        good, toxic = rng.random() < 0.6, rng.random() < 0.4
        words = prose(rng, rng.randint(15, 60)).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "zog")
        t = " ".join(words)
        rows.append((i, t if good else " ".join(w.upper() + "!!" for w in words), "en", "a", len(t), "x", 0.1, "y", 1))
        labels.append((i, int(good), int(toxic)))
    labels += [(None, 1, 1), (900, 0, 0), (1, None, None)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels[:400])


def accuracy(scored, labels, at):
    truth = {i: y for i, *ys in labels for y in [ys[at]]}
    rows = scored.withColumn("out", B.held_out()).where("out").collect()
    return np.mean([(r["score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in rows])


def test_words_are_the_words_of_the_pattern(odd_rows, monkeypatch):
    texts = [None if r[1] is None else r[1].encode() for r in odd_rows]
    whole = H.split_words(texts)
    seen = {}
    for t, w in zip(texts, whole):
        plain = re.findall(r"\w+", (t or b"").decode().lower())
        assert len(plain) == len(w)
        assert all(seen.setdefault(p, h) == h for p, h in zip(plain, w.tolist()))
    assert len(set(seen.values())) == len(seen)
    monkeypatch.setattr(H, "PART", 50)
    assert all(np.array_equal(a, b) for a, b in zip(whole, H.split_words(texts)))


def test_network_gradient_is_the_slope():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in B.initial(rng).items()}
    texts, labels = [rng.bytes(400), b"", rng.bytes(700)], np.array([1.0, 0.0, 0.0])  # no two chunks alike, so no ties

    def loss():
        data, starts = B.layout(texts)
        size = int(starts[-1]) * B.BLOCK
        seen = np.concatenate([p["emb"][data][j:j + size] for j in range(B.WIDTH)], axis=1)
        z = B.head(p, (seen @ p["conv"]).reshape(-1, B.BLOCK, B.FILTERS).max(axis=1), starts)["logit"]
        return float(np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)))

    slopes = B.gradient(p, texts, labels)
    for k, at in (("conv", (3, 2)), ("hid", (1, 4)), ("out", 5), ("emb", (ord("e"), 1)), ("conv_b", 3)):
        old = p[k][at]
        p[k][at] = old + 1e-5
        up = loss()
        p[k][at] = old - 1e-5
        down = loss()
        p[k][at] = old
        assert slopes[k][at] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_tables_score_like_the_network_on_whole_texts():
    p = B.initial(np.random.default_rng(4))
    texts = [b"", b"x", b"some words " * 3000, b"y" * B.BLOCK * 2]
    data, starts = B.layout(texts)
    size = int(starts[-1]) * B.BLOCK
    emb = p["emb"][data]
    seen = np.concatenate([emb[j:j + size] for j in range(B.WIDTH)], axis=1)
    z = B.head(p, (seen @ p["conv"]).reshape(-1, B.BLOCK, B.FILTERS).max(axis=1), starts)["logit"]
    assert B.scorer(p)(texts) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)
    assert B.scorer(p)([None])[0] == B.scorer(p)([b""])[0]
    last = B.scorer(p)([b"some words " * 3000 + b"\xff\x00" * 40])[0]
    assert last != B.scorer(p)([b"some words " * 3000])[0]


def test_quality_by_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    sample = B.sample_labelled(docs, labels, "quality", "doc_id", "text", 1500, 8 << 20)[0].toPandas()
    net = B.fit([t.encode() for t in sample["text"]], sample["quality"].to_numpy(), steps=60)
    assert accuracy(B.score_quality(docs, net), truth, 0) > 0.9
    kept = B.keep_good(docs, net)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_toxicity_by_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    assert accuracy(K.score_toxicity(docs, K.train(docs, labels)), truth, 1) > 0.9


def test_models_of_a_class_add_up_to_one():
    rng = np.random.default_rng(0)
    kinds = np.arange(10, 15, dtype=np.uint64)
    rows = [(a, b, rng.integers(0, 30), rng.integers(0, 30)) for a in kinds for b in kinds]
    first, second = (np.array([r[k] for r in rows], np.uint64) for k in (0, 1))
    n = [np.array([r[k] for r in rows], float) for k in (2, 3)]
    frequent = np.maximum(*n) > 10
    fold = lambda of, by: np.array([of[by == k].sum() for k in kinds])
    m = K.Models({"first": first[frequent], "second": second[frequent], "n0": n[0][frequent], "n1": n[1][frequent]},
                 {"first": kinds, "n0": fold(n[0], first), "n1": fold(n[1], first)},
                 {"second": kinds, "f0": fold((n[0] > 0) * 1.0, second), "f1": fold((n[1] > 0) * 1.0, second), "f": fold(np.ones(25), second)},
                 (10.0, 1.0))
    for c in (0, 1):
        at, head = m.kinds.at(kinds), m.heads.at(kinds[:1])
        base = m.kinds.columns["shared"][at]
        lower = m.kinds.columns[f"u{c}"][at] + m.left[c] * base
        p = m.pairs.columns[f"p{c}"][m.pairs.at(H.pair(np.repeat(kinds[:1], 5), kinds))] + (1 - m.heads.columns[f"t{c}"][head]) * lower
        assert p.sum() + (1 - m.heads.columns[f"t{c}"][head])[0] * m.left[c] * m.unseen == pytest.approx(1, abs=1e-5)


def test_models_cover_odd_and_empty_tables(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    net, toxic = B.train(odd, none), K.train(odd, none)
    for scored in (B.score_quality(odd, net), K.score_toxicity(odd, toxic)):
        rows = scored.collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert B.score_quality(empty, net).count() == 0 and K.score_toxicity(empty, toxic).count() == 0
    assert L.identify(empty, {}).count() == 0
    assert {r["lang_pred"] for r in L.identify(odd, {}).collect()} == {"und"}
    assert M.score(empty, M.train(empty.withColumn("target", F.lit(True)), "target")).count() == 0


def plain_profile(texts, size):
    grams = Counter()
    for t in texts:
        for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split():
            w = f"_{w}_"
            grams.update(w[i:i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i:i + n] != "_")
    key = lambda g: -ord(g) if len(g) == 1 else (
        lambda p: (p[0] << 42 | p[1]) if len(p) == 2 else p[0] << 42 | p[1] << 21 | p[2])([0 if c == "_" else ord(c) for c in g])
    return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], key(x[0])))][:size]


def test_languages_by_brute_force(odd, odd_rows):
    known = L.profiles(odd.where("lang is not null"), size=50)
    plain = {g: plain_profile([r[1] for r in odd_rows if r[2] == g], 50) for g in ("en", "xx")}
    assert {g: len(p) for g, p in plain.items()} == {g: len(p) for g, p in known.items()}
    got = {(r["doc_id"], round(r["score"], 9), r["lang_pred"]) for r in L.identify(odd, known, size=50).collect()}
    want = set()
    for r in odd_rows:
        own = plain_profile([r[1]], 50)
        away = {g: sum(min(abs(p.index(x) - k), 50) if x in p else 50 for k, x in enumerate(own)) for g, p in plain.items()}
        best = min(sorted(away), key=away.get) if own else "und"
        want.add((r[0], round(1 - away[best] / (50 * len(own)), 9) if own else 0.0, best))
    assert got == want


def test_language_of_parts_is_that_of_the_whole(monkeypatch, odd_rows):
    letters, text = L.Letters(), odd_rows[-1][1]
    whole = L.counted(letters.codes(text))
    monkeypatch.setattr(L, "PART", 1000)
    parts = L.counted(letters.codes(text))
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


@pytest.mark.parametrize("hot", [1, 300, 1 << 19])
def test_losses_by_brute_force(spark, odd, odd_rows, monkeypatch, hot):
    """Whatever share of the pieces is broadcast."""
    monkeypatch.setattr(M, "HELD", 40)
    target = {i for i in range(6)}
    models = M.train(odd.withColumn("target", F.col("doc_id").isin(*target)), "target", hot=hot)
    assert (models.rest.count() == 0) == (hot == 1 << 19)
    texts = [re.findall(r"\w+", (r[1] or "").lower()) for r in odd_rows]
    flags = [r[0] in target for r in odd_rows]
    n = [Counter(w for t, f in zip(texts, flags) for w in t if all_ or f) for all_ in (False, True)]
    total = [sum(c.values()) for c in n]
    known = {w for w, c in n[1].items() if c >= 2}
    single = [Counter(w if w in known else None for w in c.elements()) for c in n]
    pairs = [Counter(p for t, f in zip(texts, flags) if all_ or f for p in zip(["<s>", *t], t)) for all_ in (False, True)]
    kept = {p for p, c in pairs[1].items() if c >= 2}
    heads = [n[k] + Counter({"<s>": sum(1 for t, f in zip(texts, flags) if t and (k or f))}) for k in (0, 1)]
    scale = [1.0, total[0] / total[1]]
    whole = [sum(single[k][w] * scale[k] + 0.5 for w in [None, *known]) for k in (0, 1)]
    share = [{x: max(pairs[k][x] * scale[k] - 0.75, 0) / max(heads[k][x[0]] * scale[k], 1e-9) for x in kept} for k in (0, 1)]
    taken = [Counter(), Counter()]
    for k in (0, 1):
        for (a, _), s in share[k].items():
            taken[k][a] += s

    def p(k, a, b):
        base = (single[k][b if b in known else None] * scale[k] + 0.5) / whole[k]
        return share[k].get((a, b), 0) + (1 - taken[k][a]) * base

    for a in ("<s>", max(known, key=n[1].get)):
        assert sum(p(0, a, w) for w in [None, *known]) == pytest.approx(1)
    want = []
    for r, t in zip(odd_rows, texts):
        loss = [-sum(np.log2(p(k, a, b)) for a, b in zip(["<s>", *t], t)) / max(len(t), 1) for k in (0, 1)]
        want.append((r[0] is None, r[0] or 0, len(t), *(loss if t else (0, 0)), loss[0] - loss[1]))
    got = [(r[0] is None, r[0] or 0, r[1], r[2] or 0, r[3] or 0, r[4]) for r in M.score(odd, models).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g == pytest.approx(w, abs=1e-5)


def test_a_larger_corpus_keeps_what_it_knew(spark, odd):
    """Rare pairs of a small corpus stay in the model when the corpus grows tenfold by other texts."""
    small = odd.select("doc_id", "text").withColumn("target", F.lit(True))
    others = spark.range(100, 400).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 400), x -> concat('other', (x * id) % 97))) as text", "false as target")
    models = [M.train(d, "target", hot=50) for d in (small, small.unionByName(others))]
    texts = [re.findall(r"\w+", (r["text"] or "").lower()) for r in small.where("doc_id is not null").collect()]
    pairs = [p for p, n in Counter(p for t in texts for p in zip(t, t[1:])).items() if n >= 2]
    told = [set(m.rest.select("key").toPandas()["key"]) for m in models]
    for m, keys in zip(models, told):  # every pair that is seen twice has a piece of its own or one that is worth nothing
        of = {w: m.coder(h) for w, h in zip((w for p in pairs for w in p), H.words(" ".join(w for p in pairs for w in p).encode()).reshape(-1, 1))}
        found = [p for p in pairs if m.hot.at(of[p[0]], of[p[1]])[0] < len(m.hot.codes)]
        asked = spark.createDataFrame([tuple(int(of[w].view(np.int64)[0]) for w in p) for p in pairs if p not in set(found)], "a long, b long")
        seen = {r["key"] for r in asked.select(M._key().alias("key")).collect()}
        assert len(found) + len(seen) == len(pairs) and len(seen & keys) > 0.9 * len(seen) > 0


def test_kneser_ney_by_brute_force(spark, monkeypatch):
    """Counts, both likelihoods and the best passage restated with dictionaries of words."""
    import math
    import re
    from collections import Counter, defaultdict

    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(25)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(3, 30))) + (" Bad word bad" if i % 3 == 0 else "") + f" once{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    for d_pairs, d_words in ((0.75, 0.75), (2.0, 1.0)):
        monkeypatch.setattr(K, "DISCOUNTS", [(d_pairs, d_words)])
        model = K.train(docs, labels).models
        rows = K.stored(docs.join(labels, "doc_id").where(~K.held_out()).selectExpr("text", "toxic", "pmod(xxhash64(text), 5) = 0 AS apart"), "brute").collect()
        fitted = [(re.findall(r"\w+", r["text"].lower()), r["toxic"]) for r in rows if not r["apart"]]
        n = Counter(w for t, _ in fitted for w in t)
        known = lambda t: [w if n[w] > 1 else None for w in t]
        pairs, before = (Counter(), Counter()), (defaultdict(set), defaultdict(set))
        for t, y in fitted:
            for a, b in zip(["<s>", *known(t)], known(t)):
                pairs[y][a, b] += 1
                before[y][b].add(a)
        heads = [Counter() for _ in pairs]
        for y in (0, 1):
            for (a, _), k in pairs[y].items():
                heads[y][a] += k
        pooled = {b: len(before[0][b] | before[1][b]) for b in {*before[0], *before[1]}}
        whole = sum(pooled.values())
        shared = {b: max(k - 0.75, 0) / whole for b, k in pooled.items()}
        rest = max(1 - sum(shared.values()), 1e-9) / (len(shared) + 1)
        shared = {b: s + rest for b, s in shared.items()}
        unseen = max(1 - sum(shared.values()), 1e-9)

        def likelihood(y, a, b):
            kinds = sum(len(x) for x in before[y].values())
            own = {w: max(len(x) - d_words, 0) / kinds for w, x in before[y].items()}
            lower = own.get(b, 0) + (1 - sum(own.values())) * shared.get(b, unseen)
            share = lambda x: max(pairs[y][a, x] - d_pairs, 0) / max(heads[y][a], 1)
            return share(b) + (1 - sum(share(x) for _, x in [p for p in pairs[y] if p[0] == a])) * lower

        for t in [texts[0], texts[1], "bad word unknown w1 w2", "", "w3"]:
            own = known(re.findall(r"\w+", t.lower()))
            delta = [math.log(likelihood(1, a, b)) - math.log(likelihood(0, a, b)) for a, b in zip(["<s>", *own], own)]
            padded = delta + [0.0] * K.WINDOW
            want = [sum(delta) / len(delta), max(sum(padded[i:i + K.WINDOW]) / K.WINDOW for i in range(len(delta)))] if delta else [0, 0]
            assert np.allclose(model.differences(H.split_words([t.encode()]))[0], want, atol=2e-3)


def test_sample_is_bounded_by_its_bytes_together(spark):
    docs = spark.createDataFrame([(i, "x" * (100 if i % 2 else 5000)) for i in range(400)] + [(1, "y" * 50), (7, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(400)], "doc_id long, toxic int")
    for rows, size in ((1000, 1 << 30), (40, 1 << 30), (1000, 60_000), (1000, 3000)):
        sample, counts = K.sample_labelled(docs, labels, "toxic", "doc_id", "text", rows, size)
        found = sample.toPandas()
        assert sum(counts.values()) == sum(1 for i in range(400) if K_bucket(i) != 2)
        for y in (0, 1):
            own = found[found["toxic"] == y]
            assert own["doc_id"].nunique() <= rows and own["text"].str.len().sum() <= size and len(own) > 10
            if size > 5000 and rows >= 1000:
                assert (own["text"].str.len() == 5000).any()  # long texts are learnt from


def K_bucket(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4
