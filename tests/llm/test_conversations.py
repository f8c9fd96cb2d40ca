import hashlib
import itertools
import random
import re

import pytest

from readgrade.llm import conversations as C
from readgrade.llm.survivors import Survivors

SCHEMA = "conv_id long, turn long, role string, text string, copies long, step int, edit string, summary string"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
WIDE = ["", "u", "a", "uu", "ua", "au", "aa", "uau", "aua"]


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[ \t-\r]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_way(rows, found, news=WIDE):
    """All edits without any state: what is written, its cost and its initials."""
    options = []
    for (role, text), fault in zip(rows, found):
        way = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            way += [(more, "K", [(role, text)]), (2 + more, "R", [("user", text)]), (2 + more, "R", [("assistant", text)])]
        options.append([(2 * len(n) + c, "I" * len(n) + e, [({"u": "user", "a": "assistant"}[x], "") for x in n] + w)
                        for n in news for c, e, w in way])
    options.append([(2 * len(n), "I" * len(n), [({"u": "user", "a": "assistant"}[x], "") for x in n]) for n in news])
    for way in itertools.product(*options):
        written = [w for _, _, part in way for w in part]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in written)):
            yield sum(c for c, _, _ in way), "".join(e for _, e, _ in way), written


def plain(turns):
    """The contract, word for word, on (turn, role, text) in order."""
    rows = [(r, t) for _, r, t in turns]
    found, numbers = faults(rows), [n for n, _, _ in turns if n is not None]
    cost, audit, written = min(every_way(rows, found, ["", "u", "a", "ua"]))
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in written).encode()).hexdigest())


def test_survivors_against_every_way():
    rng = random.Random(3)
    for _ in range(120):
        n = rng.choice([0, 1, 1, 2, 2, 2, 3])
        rows = [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", " "]), f"{i}" + rng.choice([".", "!", ""])) for i in range(n)]
        found = [rng.choice(["", "", "", "truncated", "blank"]) for _ in rows]
        want = min(every_way(rows, found, WIDE if n < 3 else WIDE[:4]))
        assert _run(rows, found) == want


def _run(rows, found):
    s, out = Survivors(), []
    for (role, text), fault in zip(rows, found):
        out += s.turn((role, text), role[:1], fault in ("blank", "duplicate"), fault == "truncated")
    rest, last, cost = s.end()
    names, written, audit = {"u": "user", "a": "assistant"}, [], ""
    for (role, text), new, edit, new_role in out + rest:
        written += [(names[c], "") for c in new] + ([] if edit == "D" else [(new_role or role, text)])
        audit += "I" * len(new) + edit
    return cost, audit + "I" * len(last), written + [(names[c], "") for c in last]


def test_ties_over_long_unresolved_suffixes():
    """User turns only: two ways stay equally cheap to the end, and the least in ASCII wins as a whole string."""
    rows = [("user", f"{i}.") for i in range(401)]
    assert _run(rows, [""] * 401)[:2] == (402, "KI" + "KR" * 200)
    short = [("user", f"{i}.") for i in range(4)]
    assert _run(short, [""] * 4)[:2] == min(every_way(short, [""] * 4, ["", "u", "a"]))[:2]


def test_resolved_edits_leave_memory():
    """A regular conversation of any length keeps a few nodes only."""
    s, kept = Survivors(), 0
    for i in range(3000):
        kept += len(s.turn(i, "ua"[i % 2], False, False))
    assert kept > 2990
    nodes, level = 0, [s.root]
    while level:
        nodes += len(level)
        level = [k for n in level for k in n.kids]
    assert nodes < 12


def _rows(df, names):
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def _ordered(rows):
    md5 = lambda t: hashlib.md5(t.encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), md5(r[2])))


@pytest.fixture(scope="module")
def odd_turns():
    rng, rows = random.Random(8), []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 3)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "assistant", "", None, "tool"])
            text = rng.choice([f"Say {turn}.", f"Say {turn}", "Yes!", "", " \t\n", None, "é.\u0085", "end. \n"])
            rows.append((conv, rng.choice([turn, turn, None, turn + 2, 1]), role, text))
    return rows + [(70, None, None, None), (71, 0, "user", "a."), (71, 0, "user", "a."), (71, 5, "user", "a.")]


def test_repair_by_brute_force(spark, odd_turns):
    """Nulls everywhere, repeated rows, ties of turn, blank texts and clashing names."""
    frame = spark.createDataFrame([(*r, 1, 5, "x", "y") for r in odd_turns], SCHEMA).repartition(4)
    want = []
    for conv in {r[0] for r in odd_turns}:
        mine = _ordered([(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd_turns if c == conv])
        want.append((conv, *plain(mine)))
    got = C.digests(C.repair(frame))
    assert _rows(got, ["conv", *COUNTS, "audit", "repaired_sha256"]) == sorted(want, key=repr)


def test_real_outputs(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "So?"), (1, 2, "assistant", "Well"), (1, 2, "assistant", " ")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = [tuple(r) for r in C.repair(frame).orderBy("step").collect()]
    edits = [(r[2], r[3], r[4]) for r in out[:-1]]
    assert [e for e in edits if e[0] != "D"] == [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "So?"), ("K", "assistant", "Well")]
    assert out[-1][2] is None and tuple(out[-1][5]) == (0, 1, 0, 1, 2, 6)


def test_dropped_rows_leave_their_conversation(spark):
    frame = spark.createDataFrame([(5, 1, "user", "x.", 0, 0, "", ""), (6, 1, "user", "x.", 2, 0, "", "")], SCHEMA)
    got = {r["conv"]: tuple(r)[1:] for r in C.digests(C.repair(frame, copies="copies")).collect()}
    assert got[5] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[6][:6] == (0, 0, 1, 0, 1, 5) and got[6][6] == "KDI"


def test_empty_table_and_very_long_text(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert C.digests(C.repair(frame)).count() == 0
    long = "word " * 400_000 + "end."
    frame = spark.createDataFrame([(1, 0, "user", long, 1, 0, "", ""), (1, 1, "assistant", "Yes.", 1, 0, "", "")], SCHEMA)
    assert C.digests(C.repair(frame)).first()["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:Yes.".encode()).hexdigest()
