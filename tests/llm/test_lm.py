"""Scores against counting in dictionaries, and the model's own properties."""

import math
import re
import zlib
from collections import Counter, namedtuple

import numpy as np
import pytest
from helpers import LONG, awkward, nothing
from pyspark.sql import functions as F

from corpusflow.llm import lm
from corpusflow.llm.common import table

END = None
Row = namedtuple("Row", "bucket q2 q1 n")


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def counts_of(texts):
    one, two = Counter(), Counter()
    for t in texts:
        ts = tokens(t)
        one.update(ts)
        two.update(zip([END, *ts], ts))
    return one, two


def part_of(i):
    if i is None:
        return lm.KEPT
    crc = zlib.crc32(str(i).encode())
    return lm.OTHER if crc % 7 == 2 else lm.HELD if crc // 7 % lm.HELD_EVERY == 0 else lm.KEPT


def by_hand(rows):
    """{(id, tokens): figures} by dictionaries; weights from all held-back tokens."""
    parts = [[t for i, t in rows if part_of(i) == p] for p in (lm.KEPT, lm.HELD)]
    k1, k2 = counts_of(parts[0])
    bucket = lambda c: min(c.bit_length(), lm.BUCKETS)
    log = lambda x: 1 if x == 0 else round(lm.STEPS * math.log2(x))
    kinds, nk = Counter(), sum(k1.values())
    for t in parts[1]:
        ts = tokens(t)
        for u, w in zip([END, *ts], ts):
            kinds[bucket(k1[u]), log(k2[u, w] / k1[u] if k1[u] else 0), log(k1[w] / nk if nk else 0)] += 1
    mix = lm.weights([Row(*k, n) for k, n in sorted(kinds.items())], len(k1))
    one, two = counts_of(parts[0] + parts[1])
    n, v = sum(one.values()), len(one)
    out = []
    for i, t in rows:
        ts = tokens(t)
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in ts)
        score = 0.0
        for u, w in zip([END, *ts], ts):
            a, z, o = mix[bucket(one[u])]
            score += math.log10(a * (two[u, w] / one[u] if one[u] else 0) + z * one[w] / n + o / (v + 1)) if n else 0.0
        out.append((i, part_of(i) == lm.OTHER, len(ts), sum(one[w] > 0 for w in ts), n, base, score))
    return out


def agree(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = sorted(by_hand(rows), key=repr)
    assert len(got) == len(want)
    key = lambda r: (repr(r[0]), *r[1:5], round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("block, shard", [(1 << 20, 1 << 20), (3000, 500)])
def test_given_table_against_dictionaries(spark, sf_dir, monkeypatch, block, shard):
    """The same in many small blocks, which workers learn of through the closure's copy."""
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    monkeypatch.setattr(lm, "SHARD", shard)
    agree(lm.score_documents(docs.repartition(block % 7 + 1)), rows)


def test_blocks_close_and_answers_fit():
    """Blocks and shards without Spark: packing is reversible, keys are sorted and apart."""
    made = lm.Block()
    for i, t in enumerate(["A b a", "", "b  a\tc", "é É " * 50]):
        made.add(i, t)
    number, part, n, ids, ends, words, packed = made.row(5, lm.KEPT)
    assert (number, part, n, ids, ends) == (5, 0, 110, [0, 1, 2, 3], [4, 5, 9, 110])
    grams = lm.Grams(words, packed)
    assert (np.diff(grams.keys.astype(object)) > 0).all() and grams.counts.sum() == 2 * n
    assert (lm.unpacked_keys(lm.packed_keys(grams.keys)) == grams.keys).all()
    for most in (0, 255, 256, 1 << 16, 1 << 32):
        some = np.array([0, most, 1])
        assert (lm.unpacked_counts(lm.packed_counts(some)) == some).all()


def test_long_text_is_cut_at_spaces(monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 7)
    text = "Some Words\x0band more ÀB \x1c x " * 40
    assert [w.decode() for ws in lm.words_of(text) for w in ws] == tokens(text)[:-1]


def test_weights():
    """They sum to one; a context never seen predicts nothing; counts decide."""
    mix = lm.weights([Row(3, -2, -40, 90), Row(3, 1, -8, 10), Row(0, 1, 1, 5)], 1000)
    assert mix.shape == (lm.BUCKETS + 1, 3) and mix.sum(axis=1) == pytest.approx(1) and (mix[1:] > 0).all()
    assert mix[0, 0] == 0 and mix[0, 2] > 0.5 and mix[3, 0] > 0.8
    assert (mix[7] == mix[9]).all()  # no counts of their own
    assert lm.weights([], 0)[5] == pytest.approx(1 / 3)


def test_held_back_texts_are_scored_better_than_by_single_words(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    r = lm.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 0.9 * r[1] and r[0] < 0


def test_awkward_rows(spark):
    frame = awkward(spark, [(6, LONG), (8, "A b \x1f c"), (9, "x" * 200_000)])
    agree(lm.score_documents(frame.repartition(3)), [(r.doc_id, r.text) for r in frame.collect()])
    assert lm.score_documents(nothing(spark)).count() == 0
    other = frame.where("doc_id is not null").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    unseen = lm.score_documents(other).collect()
    assert unseen and all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in unseen)
