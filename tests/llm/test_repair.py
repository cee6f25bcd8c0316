"""The audit DP against all edit sequences, and whole conversations against plain code."""

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.llm import repair
from corpusflow.llm.common import table


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying all edits, as strings."""
    found = faults(rows)

    @lru_cache(None)
    def rest(i, state, inserts):
        """Least (cost, audit, lines) from row i on, by what came last."""
        out = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        want = "a" if state == "u" else "u"
        names = {"u": "user", "a": "assistant"}
        if inserts < 3:
            c, a, t = rest(i, want, inserts + 1)
            out.append((c + 5, "I" + a, (names[want] + ":", *t)))
        if i < len(rows):
            role, text = rows[i]
            c, a, t = rest(i + 1, state, 0)
            out.append((c + 2, "D" + a, t))
            if found[i] not in ("blank", "duplicate"):
                cut = 5 * (found[i] == "truncated")
                if role[:1] == want or (state == "" and role[:1] == "s"):
                    c, a, t = rest(i + 1, role[0], 0)
                    out.append((c + cut, "K" + a, (f"{role}:{text}", *t)))
                c, a, t = rest(i + 1, want, 0)
                out.append((c + 1 + cut, "R" + a, (f"{names[want]}:{text}", *t)))
        return min(out, default=(10**9, "", ()))

    return rest(0, "", 0)


def by_hand(turned):
    """The figures of rows ``(turn, role, text)`` in order."""
    rows = [r[1:] for r in turned]
    found, turns = faults(rows), {t for t, _, _ in turned if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, lines = cheapest(tuple(rows))
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha256("\n".join(lines).encode()).hexdigest())


TEXTS = ["Yes.", "No!", "cut off", " \n", "", "So?  "]
ROWS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(TEXTS)), max_size=9)


def audit_of(rows):
    seen, made = set(), repair.Repair()
    for i, (role, text) in enumerate(rows):
        made.add(i, role, text, (role, text) in seen)
        seen.add((role, text))
    return made.result()


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_cheapest_and_least_audit(rows):
    assert audit_of(rows) == by_hand([(i, *r) for i, r in enumerate(rows)])


@pytest.mark.parametrize("hashes", [None, 1, 2])
def test_long_conversations_forget_and_collide(monkeypatch, hashes):
    """Also with hashes so weak that nearly all collide."""
    if hashes:
        monkeypatch.setattr(repair, "_MOD", hashes)
    monkeypatch.setattr(repair, "OPEN", 16)
    rnd = random.Random(7)
    for n in (30, 120):
        rows = [(rnd.choice(["user", "assistant", "system", "x"]), rnd.choice([*TEXTS, *(f"t{k}." for k in range(60))])) for _ in range(n)]
        assert audit_of(rows) == by_hand([(i, *r) for i, r in enumerate(rows)])


def test_order_of_audits():
    root = repair.Node("", None)

    def node(s):
        out = root
        for c in s:
            out = repair.Node(c, out)
        return out

    rnd = random.Random(2)
    words = ["".join(rnd.choice("DK") for _ in range(rnd.randrange(9))) for _ in range(60)]
    for a in words:
        for b in words:
            assert repair.less(node(a), node(b)) == (a < b)


def damaged(conv_id, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    how = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
    role = "user" if how == 4 else role
    text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
    return [(turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)


def whole(rows):
    groups = {}
    for conv_id, turn, role, text in rows:
        groups.setdefault(conv_id, []).extend(damaged(conv_id, turn, role, text))
    order = lambda r: (r[0] is not None, r[0], r[1].encode(), sha256(r[2].encode()).digest())
    return {i: by_hand(sorted(g, key=order)) for i, g in groups.items()}


def found(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_table(spark):
    rows = table(spark, "/root/testdata/sf0.01", "conversations")
    assert found(repair.repair(repair.damaged(rows))) == whole([tuple(r) for r in rows.collect()])


def test_awkward_rows(spark):
    rnd = random.Random(11)
    rows = []
    for conv in [None, *range(40)]:
        for turn in rnd.sample(range(-3, 30), rnd.randrange(9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None]), rnd.choice(["user", "assistant", "system", None, "tool"]), rnd.choice(["Yes.", "", None, "Long " * 60000, "Ende.\n", "é…", "no end"])))
    rows += [(99, 5, "user", "Same."), (99, 5, "user", "Same."), (99, 5, "assistant", "Same.")] + [(98, t, "user", "Hot.") for t in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"kind": F.lit("x"), "digest": F.lit(1), "cost": F.lit(None).cast("int")})
    got = found(repair.repair(repair.damaged(frame.repartition(5))))
    want = whole([r for r in rows if r[0] != 98])
    assert {i: g for i, g in got.items() if i != 98} == want
    # one row of the hot conversation is first; all copies go
    assert got[98][6].count("K") + got[98][6].count("R") <= 2 and got[98][2] > 2500
    assert repair.repair(repair.damaged(frame.limit(0))).count() == 0


def test_all_rows_gone(spark):
    frame = spark.createDataFrame([(1, 1, "user", "Hi.", True), (2, None, None, None, False)], "conv_id long, turn long, role string, text string, gone boolean")
    nothing = sha256(b"").hexdigest()
    assert found(repair.repair(frame)) == {1: (0, 0, 0, 0, 0, 0, "", nothing), 2: (0, 1, 0, 0, 0, 2, "D", nothing)}
