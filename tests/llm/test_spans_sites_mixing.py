import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SCHEMA, prose
from pyspark.sql import functions as F

from readgrade.llm import latent_decontam as D, line_dedup as S, mixing as X, token_counts as T


def test_token_spans_are_the_texts_own(odd_rows):
    encoder = T.Encoder()
    for text in [r[1] or "" for r in odd_rows[:-2]] + ["naïve 日本語\n\n x", "🙂🙂"]:
        first, last = encoder.spans(text)
        pieces = [encoder.encoding.decode_single_token_bytes(t) for t in encoder.encoding.encode_ordinary(text)]
        at, chars = 0, [k for k, c in enumerate(text) for _ in c.encode()]
        for piece, a, b in zip(pieces, first, last, strict=True):
            assert (a, b) == (chars[at], chars[at + len(piece) - 1] + 1)
            at += len(piece)


@pytest.mark.parametrize("rule", T.RULES)
def test_sections_by_brute_force(rule):
    rng = np.random.default_rng(6)
    for _ in range(40):
        cuts = np.sort(rng.choice(60, 8, replace=False))
        begins, ends = cuts[::2], cuts[1::2]
        edges = np.concatenate(([0], np.sort(rng.choice(np.arange(1, 60), 20, replace=False)), [60]))
        first, last = edges[:-1], edges[1:]
        want = np.zeros(len(begins) + 1)
        for a, b in zip(first, last):
            inside = [max(0, min(b, e) - max(a, s)) for s, e in zip(begins, ends)]
            outside = b - a - sum(inside)
            if rule == "start":
                want[next((k for k, (s, e) in enumerate(zip(begins, ends)) if s <= a < e), -1)] += 1
            elif rule == "majority":
                want[inside.index(max(inside)) if max(inside) > 0 and max(inside) >= outside else -1] += 1
            else:
                want += np.append(inside, outside) / (b - a)
        counts, none = T.attribute(first, last, begins, ends, rule)
        assert np.append(counts, none) == pytest.approx(want)


def test_every_token_is_given_to_one_line(odd, odd_rows, empty):
    encoder = T.Encoder()
    got = defaultdict(float)
    for r in T.count_tokens(odd, rule="split").collect():
        got[r["doc_id"]] += r["n_tokens"]
    want = defaultdict(float)
    for r in odd_rows:
        want[r[0]] += len(encoder.encoding.encode_ordinary(r[1] or ""))
    assert got == pytest.approx(want)
    assert T.count_tokens(empty).count() == 0
    rows = {(r["section"], r["start"], r["end"]) for r in T.count_tokens(odd).where("doc_id = 32").collect()}
    assert rows == {(0, 0, 3)}


PAGES = [(k, f"http://a.example/{k}", f"<nav>menu</nav><p>own {k}</p><p>menu</p><!-- x --><script>1<2</script>") for k in range(12)] + [
    (20, "https://u:p@A.example:80/x?y", "<p> menu </p><p>one &amp; two</p>"), (21, "nohost", "<p>menu</p>"), (22, None, "<p>menu</p>"),
    (23, "http://b.example", None), (24, "http://b.example", ""), (0, "http://a.example/0", "<p>menu</p>"), (None, "http://c.example", "<b>menu</b>")]


def test_site_lines_by_hand(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("site", F.lit("theirs"))
    out = S.drop_boilerplate(pages, S.host(F.col("url")), S.page_text(F.col("html")))
    assert out.columns == ["page_id", "url", "html", "site", "_site", "clean_text", "n_lines", "n_dropped"]
    rows = {(r["page_id"], r["_site"], r["clean_text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}
    assert (3, "a.example", "own 3", 3, 2) in rows and (20, "a.example", "one & two", 2, 1) in rows
    assert (21, "", "menu", 1, 0) in rows and (22, "", "menu", 1, 0) in rows and (23, "b.example", "", 0, 0) in rows
    assert (None, "c.example", "menu", 1, 0) in rows and (0, "a.example", "", 1, 1) in rows
    assert out.count() == len(PAGES) and out.where("page_id < 0").count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_site_lines_against_sql(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    mine = sorted((tuple(r) for r in S.op8_site_lines(spark, str(tmp_path)).select("clean_text", "n_dropped", "n_lines", "page_id", "site").collect()), key=repr)
    theirs = con.execute(f"SELECT clean_text, n_dropped, n_lines, page_id, site FROM ({S.OP8_SQL})").fetchall()
    assert mine == sorted(theirs, key=repr)


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(6)
    rows = []
    for k in range(900):
        rows.append((k, prose(rng, rng.randint(1, 40)), "en", "big" if k < 700 else f"s{k % 4}" if k < 895 else "tiny"))
    rows += [(5, prose(rng, 5), "en", "big"), (5, prose(rng, 5), "en", "big"), (None, prose(rng, 9), None, None), (901, None, "en", "void"), (902, "", "en", "big")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).cache(), rows


def test_mixture_against_sql(spark, sources, tmp_path):
    sources[0].write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    mine = [tuple(r) for r in X.op5_temperature_mixing(spark, str(tmp_path)).select("block_rank", "doc_id", "epoch", "source").collect()]
    theirs = con.execute(f"SELECT block_rank, doc_id, epoch, source FROM ({X.OP5_SQL})").fetchall()
    assert sorted(mine, key=repr) == sorted(theirs, key=repr)
    assert len({e for _, _, e, _ in mine}) > 1


def test_mixture_keeps_its_promises(sources):
    docs, rows = sources
    size = lambda t: len(re.findall(r"\S+", t or ""))
    own = Counter()
    for i, t, _, s in rows:
        own[s or ""] += size(t)
    total = sum(own.values())
    for options in ({"entropy": 0.9, "repeats": 50.0}, {"entropy": 1.0, "repeats": 2.0}, {"budget": 0.3}, {"budget": 9.0}):
        used, times = Counter(), Counter()
        for r in X.mix(docs, **options).collect():
            used[r["source"] or ""] += size(r["text"])
            times[r["doc_id"], r["text"]] += 1
        repeats, budget = options.get("repeats", 4.0), min(options.get("budget", 1.0), options.get("repeats", 4.0)) * total
        assert sum(used.values()) <= budget
        assert sum(used.values()) >= budget - sum(max(size(t) for _, t, _, s in rows if (s or "") == k) for k in used) - len(used) - 10
        assert max(used[s] / own[s] for s in used) <= repeats * 1.001
        if options.get("repeats") == 50.0:
            share = [v / sum(used.values()) for v in used.values()]
            assert -sum(p * math.log(p) for p in share) >= 0.9 * math.log(len(used)) - 0.06  # whole documents only
    assert "void" not in used


def test_mixture_of_nothing_and_of_odd_rows(odd, empty):
    assert X.mix(empty).count() == 0
    out = X.mix(odd)
    assert out.columns == [*odd.columns, "_epoch", "block_rank"]
    assert out.count() > 0


@pytest.fixture(scope="module")
def exam(spark):
    rng = random.Random(7)
    items = [(k, prose(rng, rng.randint(15, 60)), "x") for k in range(25)] + [(30, None, "x"), (31, "", "x"), (32, "...", "x")]
    docs, want = [], set()
    for i in range(300):
        words = prose(rng, rng.randint(0, 150)).split()
        if i % 5 == 0:
            k = rng.randrange(25)
            item = items[k][1].split()
            if i % 2:  # a paraphrase: every eighth word another one
                item = [w if j % 8 else "else" for j, w in enumerate(item)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
            want.add((i, k))
        docs.append((i, " ".join(words).upper() if i % 3 else "\n".join(words), "en", "a", 1, "x", 0.1, "y", 1))
    docs += [(900, None, "en", "a", 1, "x", 0.1, "y", 1), (0, docs[0][1], "en", "a", 1, "x", 0.1, "y", 1), (901, "zz " * 40000 + docs[0][1], *docs[0][2:])]
    want.add((901, next(k for i, k in want if i == 0)))
    return (spark.createDataFrame(docs, SCHEMA).repartition(3).cache(), spark.createDataFrame(items, "item_id long, text string, cosine string"), want, docs, items)


def test_leaks_by_recall_against_brute_force(exam):
    docs, items, want, rows, texts = exam
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, items).collect()}
    assert len(got & want) >= 0.95 * len(want)
    known = {k: (t or "").split() for k, t, _ in texts}

    def lcs(a, b):
        line = [0] * (len(b) + 1)
        for x in a:
            last = line[:]
            for j, y in enumerate(b, 1):
                line[j] = last[j - 1] + 1 if x == y else max(last[j], line[j - 1])
        return line[-1]

    plain = {r[0]: (r[1] or "").lower().split() for r in rows if r[0] < 900}
    for i, k in got - want:  # what else is found is in the document in order
        assert lcs(known[k], plain[i]) >= 0.5 * len(known[k])
    whole, parts = (sorted(map(tuple, D.find_leaks(docs, items, items_at_once=n).drop("cosine").collect()), key=repr) for n in (50_000, 10))
    assert whole == parts


@pytest.mark.parametrize("length", [None, 16, 10])
def test_recall_of_the_cosine_by_length_and_change(spark, sf, length):
    """Items planted in documents, whole or cut, with 0, 20 or 40 % of the words replaced, against the acceptance rule without the cosine."""
    rng = random.Random(3)
    texts, items = ([r["text"] or "" for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()] for t in ("documents", "benchmark"))
    items, others = [" ".join(t.split()[:length]) for t in items], " ".join(texts).split()
    rows, planted = [], {}
    for share in (0.0, 0.2, 0.4):
        for _ in range(150):
            k, words = rng.randrange(len(items)), rng.choice(texts).split()[:300]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w if rng.random() >= share else rng.choice(others) for w in items[k].split()]
            planted[len(rows), k] = share
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    every, found = ({(r[0], r[1]) for r in D.find_leaks(docs, bench, cosine=c).collect()} for c in (-1.0, D.COSINE))
    assert found <= every
    for share, least in ((0.0, 0.99), (0.2, 0.98), (0.4, 0.97)):
        own = {p for p, s in planted.items() if s == share} & every
        assert len(own & found) >= least * len(own) > 50
    assert len(found) >= 0.98 * len(every)


def test_answers_apart_from_the_item(spark, rng):
    """A word-for-word copy needs no answer near it; a half copy needs answer words, and unknown words are none."""
    item = [prose(rng, 1) + f"q{k}" for k in range(20)]
    answer = ["ans1", "ans2", "ans3"]
    items = spark.createDataFrame([(1, " ".join(item), " ".join(answer))], "item_id long, text string, answer string")
    half = [w if k % 5 < 3 else f"other{k}" for k, w in enumerate(item)]
    rows = [(1, " ".join(item)), (2, " ".join(half + answer)), (3, " ".join(half + ["zz1", "zz2", "zz3"])), (4, prose(rng, 60)), (5, " ".join(half + ["ans2", "x", "ans3"]))]
    docs = spark.createDataFrame([(i, prose(rng, 12) + " " + t + " " + prose(rng, 12)) for i, t in rows], "doc_id long, text string")
    got = {r["doc_id"]: r for r in D.find_leaks(docs, items, answer="answer", cosine=-1.0).collect()}
    assert set(got) == {1, 2, 5}
    assert got[1]["lcs"] == 1.0 and got[1]["answer_share"] == 0.0 and got[2]["answer_share"] == 1.0


def test_subsequence_and_marks():
    rng = np.random.default_rng(8)
    weights = rng.random(40)
    for _ in range(200):
        item, near = rng.integers(1, 40, 20), rng.integers(1, 40, 60).tolist()
        if rng.random() < 0.5:
            near[20:40] = [w if rng.random() < 0.8 else 5 for w in item.tolist()]
        c = D.Checker(item, None, weights)
        table = np.zeros((21, 61), int)
        for i, x in enumerate(item):
            for j, y in enumerate(near):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        lcs, answer = c.check(near)
        assert lcs == table[-1, -1] / 20
        marks = D.Marks([c], 40)
        bits = int(np.bitwise_or.reduce(marks.bit[near]) & marks.items[0]).bit_count()
        if lcs >= D.VERBATIM or lcs >= D.PARAPHRASE and answer >= D.ANSWER:
            assert bits >= marks.least[0]


def test_leaks_of_odd_and_empty_tables(odd, empty, exam, spark):
    items = exam[1]
    assert D.find_leaks(empty, items).count() == 0
    assert D.find_leaks(odd, items.where("item_id >= 30")).count() == 0
    assert D.find_leaks(odd, items.limit(0)).count() == 0
    clean = D.drop_leaks(odd, items)
    assert clean.columns == odd.columns
    gone = odd.count() - clean.count()  # the one text of 30,000 of the few words there are may hold an item by chance
    assert gone == odd.where("doc_id = 38").count() - clean.where("doc_id = 38").count()
    assert D.drop_leaks(exam[0], items).count() <= exam[0].count() - 60
