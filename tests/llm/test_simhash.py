"""Fingerprints, links and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import simhash
from corpusflow.llm.graph import components


def by_hand(text):
    import xxhash

    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(fps, limit=4):
    fps = sorted(set(fps))
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= limit:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {fps[i]: fps[find(i)] for i in range(len(fps))}


def cluster(rnd, n, flips):
    base = rnd.getrandbits(64)
    out = []
    for _ in range(n):
        x = base
        for b in rnd.sample(range(64), rnd.randint(0, flips)):
            x ^= 1 << b
        out.append(simhash.signed(x))
    return out


@pytest.mark.parametrize("text", ["", None, " \n", "One two", "a b c d", "Ä b  c\td e F g\x0bh", "wort " * 50, "x y z " * 40 + "é à"])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == by_hand(text)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first()
    import xxhash

    assert row.h == simhash.signed(xxhash.xxh64(b"a b c d", seed=42).intdigest())


def test_tree_against_brute_force():
    rnd = random.Random(7)
    values = [simhash.signed(rnd.getrandbits(64)) for _ in range(200)]
    for flips in (1, 3, 5, 8):
        values += cluster(rnd, 150, flips)
    fp = np.array(sorted(set(values)), dtype=np.int64).view(np.uint64)
    want = groups_by_hand(fp.view(np.int64).tolist())
    root = simhash.tree_roots(fp, 4)
    got = {}
    for i, r in enumerate(root.tolist()):
        got.setdefault(r, set()).add(int(fp.view(np.int64)[i]))
    expected = {}
    for x, r in want.items():
        expected.setdefault(r, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("group_rows", [1 << 16, 20])
def test_links_against_brute_force(spark, group_rows):
    rnd = random.Random(3)
    values = [0, -1, simhash.signed(1 << 63)] + [simhash.signed(rnd.getrandbits(64)) for _ in range(150)]
    for flips in (2, 4, 6):
        values += cluster(rnd, 60, flips)
    values = sorted(set(values))
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    label = {r.node: r.label for r in components(simhash.links(fps, 4, group_rows)).collect()}
    assert {v: label.get(v, v) for v in values} == groups_by_hand(values)


def test_near_duplicates_rows(spark):
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(5, base), (9, base), (None, base), (2, base + " tail"), (7, "quite another text of its own"), (7, "quite another text of its own"), (30, ""), (31, None), (1, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    got = simhash.near_duplicates(docs).collect()
    want = groups_by_hand([simhash.signed(by_hand(t)) for _, t in rows])
    smallest = {}
    for i, t in rows:
        root = want[simhash.signed(by_hand(t))]
        smallest[root] = min([x for x in (smallest.get(root), i) if x is not None], default=None)
    expected = sorted((str(i), simhash.signed(by_hand(t)), smallest[want[simhash.signed(by_hand(t))]]) for i, t in rows)
    assert sorted((str(r.doc_id), r.fp, r.component_id) for r in got) == expected


def test_drop_keeps_one_row_each(spark):
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(4, base, "a"), (3, base, "b"), (3, base, "b"), (None, base, "c"), (8, "other words here and there", None), (None, "lonely text without any id", "d"), (10, None, "e"), (11, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [rows[1], rows[4], rows[5], rows[6]]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)]
    label = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(label[i] == 0 for i in range(41)) and all(label[i] == 100 for i in range(100, 140))


def test_groups_past_memory_give_the_same_links(spark):
    """Under every limit, odd ones too, through fingerprints half-way."""
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(4)]
    fps = sorted({b ^ sum(1 << i for i in rnd.sample(range(64), k)) for b in base for k in (0, 1, 2, 3, 4, 5, 6)})
    fps += [0, 1, 7]
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    for limit in (1, 2, 3):
        root = {f: f for f in fps}
        for r in simhash.middle_links(frame, limit).collect():
            low, high = sorted((root[r.a % 2**64], root[r.b % 2**64]))
            root = {k: low if v == high else v for k, v in root.items()}
        want = {f: f for f in fps}
        for a in fps:
            for b in fps:
                if want[a] != want[b] and bin(a ^ b).count("1") <= limit:
                    low, high = sorted((want[a], want[b]))
                    want = {k: low if v == high else v for k, v in want.items()}
        assert root == want, limit
