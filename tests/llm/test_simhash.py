import re

import numpy as np
import xxhash
from conftest import prose

from readgrade.llm import bitslice, simhash as S
from readgrade.llm.components import components


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, linked):
    root = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if root[i] != root[j] and linked(values[i], values[j]):
                    root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
                    changed = True
    return root


def test_fingerprint_by_its_definition(odd_rows):
    for r in odd_rows[:-2]:
        assert S.fingerprint(None if r[1] is None else r[1].encode()) == plain_print(r[1])


def test_near_pairs_of_any_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 30, dtype=np.uint64)
    parts = [base]
    for _ in range(6):
        parts.append(parts[-1] ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)))
    x = np.sort(np.concatenate(parts))
    ends = np.repeat([70, 71, 150, len(x)], [70, 1, 79, len(x) - 150])
    apart = np.bitwise_count(x[:, None] ^ x[None])
    for radius in (0, 1, 2, 3, 5):
        got = {(i, j) for a, b in bitslice.near_pairs(x, ends, radius, block=7) for i, j in zip(a.tolist(), b.tolist())}
        assert got == {(i, j) for i in range(len(x)) for j in range(i + 1, ends[i]) if apart[i, j] <= radius}


def test_split_buckets_lose_no_link(spark):
    """Many fingerprints around a few centres, so that every bucket is over the limit and is split twice."""
    rng = np.random.default_rng(2)
    x = []
    for c in rng.integers(0, 2 ** 63, 3, dtype=np.uint64).tolist():
        for _ in range(40):
            y = c
            for b in rng.choice(64, rng.integers(0, 6), replace=False).tolist():
                y ^= 1 << b
            x.append(y)
    x = sorted({v - (1 << 64) if v >> 63 else v for v in x})
    frame = spark.createDataFrame([(v,) for v in x], "fp long")
    want = roots(x, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    for limit in (2, 10, 4096):
        found = dict(tuple(r) for r in components(S.links(frame, 3, limit)).collect())
        for i in range(len(x)):
            assert found.get(x[i], x[i]) == x[want[i]]


def test_groups_by_brute_force(odd, odd_rows):
    prints = [plain_print(r[1]) for r in odd_rows]
    root = roots(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    want = []
    for r, p, k in zip(odd_rows, prints, root):
        ids = [o[0] for o, q in zip(odd_rows, root) if q == k and o[0] is not None]
        want.append((r[0], f"{p:016x}", min(ids) if ids else None))
    assert sorted(map(tuple, S.near_groups(odd).collect()), key=repr) == sorted(want, key=repr)
    kept = S.drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(root))


def test_near_copies_meet_and_others_do_not(spark, rng):
    text = prose(rng, 9000).split()
    near = text[:]
    near[200] = "changed"
    frame = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(near)), (3, prose(rng, 400))], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in S.near_groups(frame).collect()} == {1: 1, 2: 1, 3: 3}


def test_components_of_a_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 51), (51, 50), (7, 7), (None, 3)], "a long, b long")
    assert {tuple(r) for r in components(chain).collect()} == {(i, 0) for i in range(41)} | {(50, 50), (51, 50)}
    assert components(chain.where("a < 0")).count() == 0


def test_empty(empty):
    assert S.near_groups(empty).count() == 0
    assert S.drop_near_copies(empty).count() == 0
