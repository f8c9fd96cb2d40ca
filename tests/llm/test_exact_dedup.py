import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from readgrade.llm import exact_dedup as E


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_marks_like_brute_force(odd, odd_rows):
    got = sorted((tuple(r) for r in E.mark_copies(odd).collect()), key=repr)
    assert got == brute(odd_rows)


def test_bytes_decide_when_hashes_clash(odd, odd_rows):
    weak = lambda sha: F.substring(sha, 1, 1)
    got = sorted((tuple(r) for r in E.mark_copies(odd, hashed=weak).collect()), key=repr)
    assert got == brute(odd_rows)


def test_kept_rows_keep_their_columns(odd, odd_rows):
    kept = E.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r[0] for r in kept.collect()), key=repr) == sorted((r[0] for r in brute(odd_rows) if r[3]), key=repr)
    assert {tuple(r) for r in kept.collect()} <= set(odd_rows)


def test_empty(empty):
    assert E.mark_copies(empty).count() == 0
    assert E.drop_copies(empty).count() == 0


def test_main_path_is_native(odd):
    plan = E.mark_copies(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
