"""Centroid clustering of vectors by Orchard search.

Vectors become whole numbers, so distances and means are exact and results depend on
neither order nor partitioning. Each round every vector looks for its nearest centroid:
every centroid has the list of the others in order of their distance from it; a search
walks the list of the best centroid so far, jumps to the list of a closer one as soon as it
finds it, never measures a centroid twice, and stops at the first one that stands strictly
more than twice the present distance away: by the triangle inequality nothing behind it is
nearer, or as near. Batches of vectors walk together, in numpy.

Spark sums the vectors of each centroid: one row per centroid and batch leaves a task, so a
cluster with most of the vectors costs no more than others. The driver holds the centroids
alone, ``k`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import python_ready, written

#: Clusters, rounds, components of a vector, units of a component, text before hashed ids.
CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, "3"
#: Whole components reach from -LARGEST to LARGEST, so squared distances of 64 fit a long.
LARGEST = 1 << 27
#: Vectors that walk together.
ROWS = 1 << 13


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(other centroids by distance, smaller number first; those squared distances)."""
    k = len(centroids)
    apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    order = np.stack([np.lexsort((np.arange(k), np.where(np.arange(k) == i, -1, apart[i])))[1:] for i in range(k)])
    return order, np.take_along_axis(apart, order, axis=1)


def nearest(vectors: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, distances measured); ties: smaller number."""
    order, apart = lists
    n, k = len(vectors), len(centroids)
    best = np.zeros(n, dtype=np.int64)
    least = ((vectors - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), dtype=bool)
    visited[:, 0] = True
    place = np.zeros(n, dtype=np.int64)
    walking, measured = np.arange(n), n
    while k > 1 and len(walking):
        here = best[walking]
        other = order[here, place[walking]]
        # beyond twice the distance, in squares: a quarter rounded up stays exact in a long
        beyond = -(-apart[here, place[walking]] // 4) > least[walking]
        walking, other = walking[~beyond], other[~beyond]
        place[walking] += 1
        new = ~visited[walking, other]
        at, to = walking[new], other[new]
        visited[at, to] = True
        measured += len(at)
        far = ((vectors[at] - centroids[to]) ** 2).sum(axis=1)
        closer = (far < least[at]) | ((far == least[at]) & (to < best[at]))
        at, to, far = at[closer], to[closer], far[closer]
        best[at], least[at], place[at] = to, far, 0
        walking = walking[place[walking] < k - 1]
    return best, least, measured


def _arrays(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for low in range(0, batch.num_rows, ROWS):
        some = batch.slice(low, ROWS)
        flat = some.column("v").flatten().to_numpy(zero_copy_only=False)
        yield some, flat.reshape(-1, dims).astype(np.int64)


def whole_vectors(vectors: DataFrame, id_: str, column: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v) of the vectors with exactly ``dims`` components, all finite, as whole
    numbers ``floor(scale * x)``."""
    x = F.col(column)
    number = lambda c: c.cast("double")
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(number(c)) & (F.abs(number(c)) != float("inf")), F.lit(False)))
    rows = vectors.select(F.col(id_).alias("vec_id"), x.alias("x")).where((F.size(column) == dims) & fine)
    scaled = F.transform("x", lambda c: F.floor(number(c) * scale))
    small = F.forall("x", lambda c: F.abs(number(c) * scale) <= LARGEST)
    checked = F.when(small, F.transform(scaled, lambda c: c.cast("int"))).otherwise(F.raise_error(F.lit(f"a component exceeds {LARGEST / scale}")).cast("array<int>"))
    return rows.select("vec_id", checked.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose hashed ids come first; a null id hashes as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    top = rows.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in top], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; empty ones stay."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = neighbours(centroids)
        for batch in batches:
            sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), dtype=np.int64)
            for _, vectors in _arrays(batch, dims):
                found = nearest(vectors, centroids, lists)[0]
                np.add.at(sums, found, vectors)
                counts += np.bincount(found, minlength=len(centroids))
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at]), pa.array(list(sums[at]), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    parts = rows.mapInArrow(run, "cluster long, n long, s array<long>")
    total = F.array(*[F.sum(F.col("s")[i].cast("decimal(38,0)")).cast("string") for i in range(dims)])
    new = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), total.alias("s")).collect():
        new[r.cluster] = [int(x) // r.n for x in r.s]
    return new


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
    id_: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector.

    Vectors that are null, of another length, or with a null or non-finite component are
    left out. Rows that share an id, or are equal, are rows of their own; rows with equal
    hashed ids start in order of their components. With fewer vectors than ``k`` there are
    fewer centroids. An empty table gives no rows. Other columns of the table play no part,
    whatever their names. Components beyond ``LARGEST`` units, whose squared distances would
    not fit a long, raise an error.
    """
    if dims > DIMS:
        raise ValueError(f"squared distances of over {DIMS} components may not fit a long")
    python_ready(vectors.sparkSession)
    rows = written(whole_vectors(vectors, id_, column, dims, scale))
    kind = rows.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(rows, k, seed).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        new = moved(rows, centroids)
        if (new == centroids).all():  # all further rounds repeat this one
            break
        centroids = new
    names = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = neighbours(centroids) if len(centroids) else None
        for batch in batches:
            for some, vectors in _arrays(batch, dims):
                found, far, _ = nearest(vectors, centroids, lists)
                yield pa.RecordBatch.from_arrays([some.column("vec_id"), pa.array(found.astype(np.int32)), pa.array(far), pa.array([names[i] for i in found.tolist()], pa.string())], ["vec_id", "cluster", "distance", "centroid_sha256"])

    placed = written(rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance long, centroid_sha256 string"))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    each = placed.groupBy("cluster").agg(exact.alias("c"))
    # k rows: bounded, and made before the join is planned
    sums = [(r.cluster, int(r.c)) for r in each.collect()]
    every = sum(c for _, c in sums)
    dim = vectors.sparkSession.createDataFrame([(i, c, every) for i, c in sums], "cluster int, cluster_inertia long, inertia long")
    return placed.join(F.broadcast(dim), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
