"""Near copies by shingle similarity, against brute force."""

import random

import numpy as np
from helpers import awkward, nothing
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from corpusflow.llm import simhash, similar
from corpusflow.llm.common import table

SF = "/root/testdata/sf0.01"


def near(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def kept_by_hand(texts):
    sets = {i: frozenset(similar.shingles(t or "").tolist()) for i, t in texts.items()}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and root[i] != root[j] and near(sets[i], sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    return sorted(set(root.values()))


def test_copies_with_changed_words(spark):
    rnd = random.Random(4)
    texts = {}
    for g in range(12):
        base = [f"w{rnd.randrange(5000)}" for _ in range(200)]
        for k, changes in enumerate([0, 1, 2, 3, 8, 30]):
            words = list(base)
            for at in rnd.sample(range(200), changes):
                words[at] = f"new{rnd.randrange(10**6)}"
            texts[10 * g + k] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.drop_similar(docs).collect()) == kept_by_hand(texts)


def test_recall_on_documents(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = similar.drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == kept_by_hand(texts)


def links_of(spark, sets, met=None, first=None):
    hashed = {k: np.array([xxh64_intdigest(str(x)) for x in v], np.uint64) for k, v in sets.items()}
    frame = spark.createDataFrame([(bytearray(k), h.view(np.int64).tolist()) for k, h in hashed.items()], "node binary, hashes array<long>")
    fps = {k: simhash.signed(simhash.majority(h)) for k, h in hashed.items()}
    sketches = {k: similar.sketch(similar.least_hashes(h)) for k, h in hashed.items()}
    met = spark.createDataFrame([(bytearray(k), b, fps[k], sketches[k]) for k, b in (met or [(k, 1) for k in sets])], "node binary, bucket long, fp long, sketch array<long>")
    return {(bytes(r.a), bytes(r.b)) for r in similar.near_links(met, frame, first).collect()}


def test_links_beside_the_smallest_are_found(spark):
    assert links_of(spark, {b"a": [1, 2, 3], b"b": list(range(10, 30)), b"c": list(range(10, 31))}) == {(b"c", b"b")}


def test_large_bucket_is_connected_without_its_pairs(spark, monkeypatch):
    """Chains of near sets, mixed with strangers, in one bucket: in rounds, not by pairs."""
    sets, groups = {}, 3
    for g in range(groups):
        for k in range(14):
            sets[f"{g}-{k}".encode()] = [1000 * g + x for x in range(k, k + 60)]
    for k in range(20):
        sets[f"x{k}".encode()] = [10**6 + 100 * k + x for x in range(60)]
    compared = []
    inner = similar.verified
    monkeypatch.setattr(similar, "verified", lambda p, s, least: (compared.append(p.count()), inner(p, s, least))[1])
    found = links_of(spark, sets)
    root = {k: k for k in sets}
    for a, b in found:
        low, high = sorted((root[a], root[b]))
        root = {k: low if v == high else v for k, v in root.items()}
        assert near(frozenset(sets[a]), frozenset(sets[b]))
    assert len(set(root.values())) <= groups + 20 + 6
    assert max(compared) <= 2 * len(sets)


def test_gray_pairs_meet_without_a_band(spark):
    nodes = spark.createDataFrame([(bytearray(b"a"), 0), (bytearray(b"b"), 3), (bytearray(b"c"), 3), (bytearray(b"d"), -1)], "node binary, fp long")
    assert {(bytes(r.a), bytes(r.b)) for r in similar.gray_pairs(nodes).collect()} == {(b"b", b"a"), (b"c", b"b")}


def test_awkward_rows(spark):
    assert sorted(str(r.doc_id) for r in similar.drop_similar(awkward(spark)).collect()) == ["1", "2", "4", "6", "None"]
    assert similar.drop_similar(nothing(spark)).count() == 0


def test_sketches_of_near_sets_are_close():
    """Pairs of exactly 0.8 stay within the bits that candidates may differ in; sets that
    share little don't."""
    rnd = np.random.default_rng(5)
    for n in (9, 90, 900):
        for _ in range(60):
            pool = rnd.integers(0, 1 << 64, 2 * n, dtype=np.uint64)
            a, b, c = pool[:n], np.concatenate([pool[: n - n // 9], pool[n : n + n // 9]]), pool[n:]
            assert near(frozenset(a.tolist()), frozenset(b.tolist()))
            bits = [np.array(similar.sketch(similar.least_hashes(x))) for x in (a, b, c)]
            differ = [sum(int(v).bit_count() for v in (bits[0] ^ other).view(np.uint64)) for other in bits[1:]]
            assert differ[0] <= similar.SKETCH_BITS < differ[1]


def test_buckets_leave_once_connected(spark):
    rows = [(1, "a", "a"), (1, "b", "a"), (2, "a", "a"), (2, "c", "c")]
    placed = spark.createDataFrame(rows, "bucket long, node string, label string")
    assert {r.bucket for r in similar.unfinished(placed).collect()} == {2}


def test_gray_order_cut_by_leading_bits(spark, monkeypatch):
    """Large buckets are ordered in parts; what is near is found all the same."""
    monkeypatch.setattr(similar, "ORDERED", 4)
    sets = {f"{g}-{k}".encode(): [100 * g + x for x in range(k, k + 60)] for g in range(12) for k in range(2)}
    found = links_of(spark, sets)
    assert found == {(f"{g}-1".encode(), f"{g}-0".encode()) for g in range(12)}


def test_pairs_that_rounds_do_not_look_at_are_found(spark, monkeypatch):
    """One near pair among strangers of one bucket whose sketches are close to each other's,
    as are all: rounds end without it, the rest of the bucket is compared block by block."""
    monkeypatch.setattr(similar, "HUBS", 1)
    monkeypatch.setattr(similar, "NEIGHBOURS", 1)
    monkeypatch.setattr(similar, "BLOCK", 16, raising=False)
    sets = {f"{k:03d}".encode(): [*range(70), *range(1000 * (k + 1), 1000 * (k + 1) + 30)] for k in range(60)}
    for k in (3, 41):
        sets[f"{k:03d}-near".encode()] = [*range(70), *range(1000 * (k + 1) + 2, 1000 * (k + 1) + 30)]
    pairs = {(max(a, b), min(a, b)) for a in sets for b in sets if a != b and near(frozenset(sets[a]), frozenset(sets[b]))}
    assert len(pairs) == 2
    assert links_of(spark, sets) == pairs


def test_blocks_bring_each_two_labels_together(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 3)
    rows = [(1, bytearray([k]), bytearray([0 if k < 12 else k])) for k in range(20)]
    dealt = similar.blocks(spark.createDataFrame(rows, "bucket long, node binary, label binary"))
    groups = {}
    for r in dealt.collect():
        groups.setdefault((r.u, r.p), ([], []))[0 if r.left else 1].append((bytes(r.node), bytes(r.label)))
    met = {frozenset((a[0], b[0])) for left, right in groups.values() for a in left for b in right if a[1] != b[1]}
    want = {frozenset((bytes(a[1]), bytes(b[1]))) for a in rows for b in rows if a[2] != b[2]}
    assert want <= met
    assert max(len(left) for left, _ in groups.values()) <= 8
