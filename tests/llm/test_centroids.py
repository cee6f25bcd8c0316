"""Orchard search and the rounds around it against plain loops over all centroids."""

import random
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.llm import centroids
from corpusflow.llm.common import table


def by_hand(rows, k=8, rounds=10, dims=64, scale=1024):
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cs = [list(v) for _, v in first]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cs))

    for _ in range(rounds):
        found = [place(v)[1] for _, v in kept]
        for i in range(len(cs)):
            own = [v for (_, v), f in zip(kept, found) if f == i]
            if own:
                cs[i] = [sum(col) // len(own) for col in zip(*own)]
    out = [(i, *place(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return [(i, c, d, inertia[c], sum(inertia.values()), sha256(",".join(map(str, cs[c])).encode()).hexdigest()) for i, c, d in out]


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(1, 40), st.integers(1, 3), st.integers(1, 4), st.integers(0, 10**6))
def test_search_finds_the_nearest_with_ties(k, n, dims, spread, seed):
    rnd = np.random.default_rng(seed)
    cs, vs = rnd.integers(-spread, spread + 1, (k, dims)), rnd.integers(-spread, spread + 1, (n, dims))
    found, far, _ = centroids.nearest(vs, cs, centroids.neighbours(cs))
    for v, f, d in zip(vs.tolist(), found.tolist(), far.tolist()):
        assert (d, f) == min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cs.tolist()))


def test_search_prunes():
    rnd = np.random.default_rng(5)
    cs = rnd.integers(-1000, 1000, (50, 2))
    vs = rnd.integers(-1000, 1000, (2000, 2))
    assert centroids.nearest(vs, cs, centroids.neighbours(cs))[2] < 0.5 * 50 * 2000


def test_given_table_against_plain_loops(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    assert plain(centroids.cluster(rows)) == sorted(by_hand([(r.vec_id, r.embedding) for r in rows.collect()]), key=repr)


def test_awkward_vectors(spark):
    rnd = random.Random(3)
    ok = [(i, [rnd.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(4)]) for i in range(30)]
    rows = [*ok, *ok[:7], (None, [0.5] * 4), (40, None), (41, []), (42, [1.0] * 3), (43, [1.0] * 5), (44, [1.0, None, 0.0, 0.0]), (45, [float("nan")] * 4), (46, [float("inf"), 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("clash"), "v": F.lit(1), "distance": F.lit(None).cast("string")})
    assert plain(centroids.cluster(frame.repartition(3), dims=4)) == sorted(by_hand(rows, dims=4), key=repr)
    few = frame.where("vec_id in (1, 2) and size(embedding) = 4").dropDuplicates(["vec_id"])
    assert {r.distance for r in centroids.cluster(few, dims=4).collect()} == {0}
    assert centroids.cluster(frame.limit(0), dims=4).count() == 0
    assert centroids.cluster(frame.where("vec_id > 40"), dims=4).count() == 0
