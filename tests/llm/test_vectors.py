import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readgrade.llm import hard_negatives as H, topk as T
from readgrade.llm.vectors import integer_rows, matrix

SCHEMA = "vec_id long, embedding array<float>, label int, row long, id string, score double, block int, shard int"


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def whole(rows):
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in good]


def first(scored, k):
    """Best scores, then smaller ids, null last; of rows that agree in both any is as good."""
    return sorted(scored, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]


@pytest.fixture(scope="module")
def odd_vectors():
    """Clusters, copies, repeated ids, ties, nulls, other lengths, values that are no numbers."""
    rng, rows = random.Random(4), []
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    for i in range(260):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.05) for x in c], rng.randint(0, 2)))
    rows += [(i, rows[0][1], 1) for i in range(300, 340)] + [(i, [float(rng.randint(-1, 1)) for _ in range(6)], 0) for i in range(400, 460)]
    rows += [(100, rows[5][1], 2), (100, rows[5][1], 2), (None, rows[0][1], 0), (None, rows[3][1], None), (500, None, 1), (600, [], 1),
             (700, [1.0, None], 0), (800, [math.nan, 1.0], 0), (900, [math.inf], 1), (1000, [0.5, -0.5], 1), (1100, [0.0] * 6, 0), (1200, [1e6] * 6, 2)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, odd_vectors):
    return spark.createDataFrame([(*r, 1, "x", 0.5, 2, 3) for r in odd_vectors], SCHEMA).repartition(3).cache()


def plain_top(rows, k, every):
    out = []
    for at, (i, v, _) in enumerate(rows):
        if i is not None and i % every == 0:
            best = first([(j, dot(v, w)) for place, (j, w, _) in enumerate(rows) if place != at], k)
            out += [(i, rank + 1, j, s) for rank, (j, s) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,block", [(8192, 512), (40, 3), (7, 2)])
def test_top_k_by_brute_force(frame, odd_vectors, shard, block):
    got = T.top_k(frame, 5, 50, shard_rows=shard, block_rows=block)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top(whole(odd_vectors), 5, 50)


def test_fewer_rows_than_wanted_and_none(spark, frame):
    few = spark.createDataFrame([(0, [1.0], 1), (50, [2.0], 1), (51, [0.5], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, T.top_k(few).collect())) == [(0, 1, 50, 131072), (0, 2, 51, 32768), (50, 1, 0, 131072), (50, 2, 51, 65536)]
    assert T.top_k(frame.limit(0)).count() == 0


def test_reading_stops_early():
    """A few outstanding rows: their scores end the lists long before all rows are met."""
    rng = np.random.default_rng(1)
    x = np.concatenate((rng.normal(0, 1, (5000, 4)), rng.normal(100, 1, (8, 4)))).round() * 10
    lists = T.Lists(x, np.arange(len(x)), np.arange(len(x)))
    met = []
    rounds = lists._rounds
    lists._rounds = lambda q: (met.append(len(m)) or (m, b) for m, b in rounds(q))
    top, scores = lists.best(np.ones(4), -1, 5)
    assert sorted(top) == sorted(np.lexsort((np.arange(len(x)), -x.sum(1)))[:5]) and sum(met) < 200
    assert len(lists.best(np.ones(4), -1, 5, floor=1e9)[0]) == 0


def test_products_beyond_exact_doubles(spark):
    big = [(0, [3e6, 1.0], 1), (1, [3e6, 2.0], 1), (2, [3e6, 3.0], 1), (100, [3e6, 1.0], 0)]
    rows = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    got = {(r[0], r[2]): r[3] for r in T.top_k(rows, 3, 50).collect()}
    assert got == {(i, j): dot(v, w) for i, v, _ in whole(big) if i % 50 == 0 for j, w, _ in whole(big) if j != i}


def plain_negatives(rows, every):
    rows = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in rows if label is not None]
    out = []
    for at, (i, v, label) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(j, dot(v, w), other) for place, (j, w, other) in enumerate(rows) if place != at]
        for p, ps, _ in first([s for s in scored if s[2] == label], 5):
            inside = [s for s in scored if s[2] != label and 80 * ps <= 100 * s[1] <= 100 * ps]
            out += [(i, p, rank + 1, n, ps, ns) for rank, (n, ns, _) in enumerate(first(inside, 5))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,block", [(8192, 512), (50, 3), (9, 1)])
def test_negatives_by_brute_force(frame, odd_vectors, shard, block):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = H.mine(frame, F.col("vec_id") % 20 == 0, label=label, shard_rows=shard, block_rows=block)
    want = plain_negatives(whole(odd_vectors), 20)
    assert len(want) > 100 and sorted(map(tuple, got.collect()), key=repr) == want
    assert H.mine(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_spans_with_parents_first():
    rng = np.random.default_rng(2)
    a = np.concatenate((rng.normal(0, 1, (30, 3)), rng.normal(50, 1, (30, 3)), np.zeros((3, 3))))
    order, parent, edge = H.spanning_tree(a)
    place = {k: n for n, k in enumerate(order)}
    assert sorted(order) == list(range(63)) and all(place[parent[k]] < place[k] for k in order[1:])
    assert np.allclose(edge[order[1:]], [np.linalg.norm(a[k] - a[parent[k]]) for k in order[1:]])
    assert (edge > 20).sum() == 1  # one edge between the two clouds


def test_bounds_hold_and_spare_work():
    """Bounds enclose every score; in tight clusters with a narrow window few rows are scored again."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 200, (5, 16))
    x = np.floor(centres[rng.integers(0, 5, 4000)] + rng.normal(0, 2, (4000, 16)))
    a = x[:40]
    exact, scored = x @ a.T, 0

    def wanted(k, low, high):
        assert (low <= exact[:, k]).all() and (exact[:, k] <= high).all()
        top = exact[:, k].max()
        return (high >= 0.99 * top) & (low <= top)

    for k, at, scores in H.walk(a, x, wanted):
        scored += len(at)
        assert (scores == exact[at, k]).all() and set(np.flatnonzero(exact[:, k] >= 0.99 * exact[:, k].max())) <= set(at)
    assert scored < 0.5 * exact.size


def test_ragged_lists_end_in_zeros(spark, frame):
    import pyarrow as pa

    assert matrix(pa.chunked_array([pa.array([[1, 2], [], [3]], pa.list_(pa.int64()))])).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert integer_rows(frame, "vec_id", "embedding").where("id is null").count() == 2
