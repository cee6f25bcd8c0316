"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints of 64 bits are cut into six blocks. Two fingerprints that differ in at most
four bits agree on at least two blocks, so each fingerprint is filed under the fifteen
choices of two blocks: the shared masked bits are the index's upper node, which no
member differs from. Below it fingerprints stand in order of their Gray rank, so that
neighbours differ in few bits. Small groups are compared by sliding the group over
itself; in larger ones runs of sixteen neighbours are nodes again, each with the mask and
pattern of the bits its members share. Pairs of nodes are followed downwards while the
differences of their shared bits stay within the limit, and dropped as a whole where they
exceed it, or where all members are connected already.

A group gives one link per member, to the smallest fingerprint it is connected to; Spark
joins these into components. A group of more than ``GROUP_ROWS`` fingerprints isn't held
in memory: its members go to a second pass, which files each under every fingerprint
within half the limit of it. Two fingerprints within the limit share such a middle, and
all that share one are within the limit of each other, so a minimum per middle links them
exactly and no group is ever compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import free_name, python_ready, written
from corpusflow.llm.graph import components

#: Words of a shingle, seed of its hash, and the most bits two fingerprints may differ in.
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Blocks of bits (first bit, bits); two of six stay whole under four differences.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
#: Distinct fingerprints of one upper node that a task holds at once.
GROUP_ROWS = 1 << 16
#: Members of a node, and the size from which a group gets a tree.
FAN, SMALL = 16, 64
#: Pairs of nodes that are looked at together.
FRONTIER = 1 << 20


def block_mask(block: tuple[int, int]) -> int:
    return ((1 << block[1]) - 1) << block[0]


MASKS = [block_mask(a) | block_mask(b) for a, b in combinations(BLOCKS, 2)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint as an unsigned number; 0 where the text has no word."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) < shingle:
        bounds = [(0, len(joined))]
    else:
        bounds = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    return majority(np.array([xxh64_intdigest(joined[a:b], seed) for a, b in bounds], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set."""
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[low : low + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, *keep: str, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of each row with ``fp`` (long), in one pass without a shuffle."""
    python_ready(docs.sparkSession)
    rows = docs.select(*keep, F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [signed(fingerprint(t.as_py() or "", shingle, seed)) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(fps, pa.int64())], [*keep, "fp"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, fp long")


def gray_rank(fp):
    """Place of a fingerprint in the Gray code, as a column of 64 bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def local_roots(n: int, a: np.ndarray, b: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The smallest row each of ``n`` rows is connected to by the pairs (a, b)."""
    root = np.arange(n) if start is None else start.copy()
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low != high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def small_links(keys: np.ndarray, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one key within the limit; rows of a key stand together."""
    left, right, step = [], [], 1
    at = np.arange(len(fp))
    while True:
        at = at[: np.searchsorted(at, len(fp) - step)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= limit]
        left.append(near)
        right.append(near + step)
        step += 1
    empty = np.empty(0, dtype=np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def tree_roots(fp: np.ndarray, limit: int) -> np.ndarray:
    """Roots of the rows of one large group, which stand in Gray order.

    Neighbours in Gray order are linked first, by two more orders of the bits as well, so
    that dense groups are mostly connected before pairs of nodes are followed.
    """
    n = len(fp)
    root = np.arange(n)
    for turn in (0, 21, 42):
        turned = (fp << np.uint64(turn)) | (fp >> np.uint64((64 - turn) % 64)) if turn else fp
        order = np.argsort(turned, kind="stable") if turn else np.arange(n)
        for step in (1, 2, 3, 4):
            a, b = order[:-step], order[step:]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= limit
            root = local_roots(n, a[near], b[near], root)

    # nodes bottom-up: bits that all members share, and their values
    levels = [(np.full(n, ~np.uint64(0)), fp)]
    while len(levels[-1][1]) > 1:
        mask, pattern = levels[-1]
        first = np.arange(0, len(pattern), FAN)
        ones = np.bitwise_and.reduceat(pattern & mask, first)
        zeros = np.bitwise_and.reduceat(~pattern & mask, first)
        levels.append((ones | zeros, ones))

    def spans(level: int) -> tuple[np.ndarray, np.ndarray]:
        first = np.arange(0, n, FAN**level)
        return np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)

    work = [(len(levels) - 1, np.array([0]), np.array([0]))]
    while work:
        level, u, v = work.pop()
        mask, pattern = levels[level]
        low, high = spans(level) if level else (root, root)
        apart = (low[u] != high[u]) | (low[v] != high[v]) | (low[u] != low[v])
        near = np.bitwise_count((pattern[u] ^ pattern[v]) & mask[u] & mask[v]) <= limit
        u, v = u[apart & near], v[apart & near]
        if not len(u):
            continue
        if level == 0:
            root = local_roots(n, u, v, root)
            continue
        below = len(levels[level - 1][1])
        per = FRONTIER // (FAN * FAN)
        grid = np.arange(FAN)
        for at in range(0, len(u), per):
            cu = (u[at : at + per, None] * FAN + grid)[:, :, None]
            cv = (v[at : at + per, None] * FAN + grid)[:, None, :]
            cu, cv = np.broadcast_arrays(cu, cv)
            cu, cv = cu.ravel(), cv.ravel()
            ok = (cu <= cv) & (cv < below)
            work.append((level - 1, cu[ok], cv[ok]))
    return root


def _links_of(keys: np.ndarray, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest one of its component) of whole groups in key order."""
    n = len(fp)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([first, [n]]))
    large = np.repeat(size > SMALL, size)
    small_at = np.flatnonzero(~large)
    a, b = small_links(keys[small_at], fp[small_at], limit)
    root = local_roots(n, small_at[a], small_at[b])
    for at, k in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
        root[at : at + k] = at + tree_roots(fp[at : at + k], limit)
    least = fp.view(np.int64).copy()
    np.minimum.at(least, root, fp.view(np.int64))
    linked = np.flatnonzero(fp.view(np.int64) != least[root])
    return fp.view(np.int64)[linked], least[root][linked]


def links(fps: DataFrame, limit: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps(fp)`` that connect just those
    that pairs within the limit connect."""
    if limit > DISTANCE:
        raise ValueError(f"the six blocks serve up to {DISTANCE} differing bits")
    spark = python_ready(fps.sparkSession)
    filed = fps.select(gray_rank(F.col("fp")).alias("gray"), F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in MASKS])).alias("node", "pattern"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filed = filed.repartition(parts, "node", "pattern").sortWithinPartitions("node", "pattern", "gray")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray, over: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), over))], ["a", "b", "over"])

        kept_key, kept_fp = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
        over_key = None  # the key of a group that is too large, while its rows come
        for batch in batches:
            gray = batch.column("gray").to_numpy().view(np.uint64)
            node = batch.column("node").to_numpy().astype(np.uint64)
            # a pattern fits its mask's 22 bits: packed with the node it is one number
            pattern = batch.column("pattern").to_numpy().view(np.uint64)
            key = _packed(node, pattern)
            fp = gray ^ (gray >> np.uint64(1))
            if over_key is not None:
                same = key == over_key
                yield out(fp[same].view(np.int64), fp[same].view(np.int64), True)
                key, fp = key[~same], fp[~same]
                if not len(key):
                    continue
                over_key = None
            key, fp = np.concatenate([kept_key, key]), np.concatenate([kept_fp, fp])
            others = np.flatnonzero(key != key[-1])
            last = int(others[-1]) + 1 if len(others) else 0  # the last group may go on
            for piece in _whole(key[:last], fp[:last], limit, group_rows):
                yield out(*piece)
            kept_key, kept_fp = key[last:], fp[last:]
            if len(kept_key) > group_rows:
                over_key = kept_key[0]
                yield out(kept_fp.view(np.int64), kept_fp.view(np.int64), True)
                kept_key, kept_fp = kept_key[:0], kept_fp[:0]
        for piece in _whole(kept_key, kept_fp, limit, group_rows):
            yield out(*piece)

    found = written(filed.mapInArrow(run, "a long, b long, over boolean"))
    pairs = found.where("not over").select("a", "b")
    if found.where("over").limit(1).count():
        pairs = pairs.unionByName(middle_links(found.where("over").select(F.col("a").alias("fp")).distinct(), limit))
    return pairs


def _packed(node: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """Node and the masked bits, moved together, in one number."""
    out = node << np.uint64(32)
    for k, (x, y) in enumerate(combinations(BLOCKS, 2)):
        at = node == k
        p = pattern[at]
        out[at] |= ((p >> np.uint64(x[0])) & np.uint64((1 << x[1]) - 1)) << np.uint64(y[1]) | ((p >> np.uint64(y[0])) & np.uint64((1 << y[1]) - 1))
    return out


def _whole(key: np.ndarray, fp: np.ndarray, limit: int, group_rows: int):
    """Links of groups that are complete; members of those too large as they are."""
    if not len(key):
        return
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([first, [len(key)]]))
    large = np.repeat(size > group_rows, size)
    if large.any():
        over = fp[large].view(np.int64)
        yield over, over, True
        key, fp = key[~large], fp[~large]
    if len(key):
        a, b = _links_of(key, fp, limit)
        yield a, b, False


def middle_links(fps: DataFrame, limit: int = DISTANCE) -> DataFrame:
    """Links of fingerprints through those half-way: every one within ``limit // 2``
    flips of a fingerprint is a key, and the members of a key link to its smallest.

    Under an odd limit fingerprints within the rest of the limit of a key meet those within
    ``limit // 2`` of it instead; two that meet are within the limit, so all of the former
    link to the smallest of the latter, and that one to the smallest of the former."""

    def keyed(reach: int) -> DataFrame:
        flips = [0]
        for k in range(1, reach + 1):
            flips += [signed(sum(1 << i for i in c)) for c in combinations(range(64), k)]
        rows = fps.select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip"))
        return rows.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))

    near = keyed(limit // 2)
    least = near.groupBy("middle").agg(F.min("fp").alias("b"))
    pairs = keyed(limit - limit // 2).join(least, "middle").select(F.col("fp").alias("a"), "b")
    if limit % 2:
        wide = keyed(limit - limit // 2).groupBy("middle").agg(F.min("fp").alias("b"))
        pairs = pairs.unionByName(near.join(wide, "middle").select(F.col("fp").alias("a"), "b"))
    return pairs.where("a <> b").distinct()


def near_duplicates(docs: DataFrame, limit: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED, *keep: str) -> DataFrame:
    """(doc_id, columns of ``keep``, fp, root, component_id) of each row.

    Words are what ASCII white space separates, ASCII letters in lower case. ``root`` is
    the smallest fingerprint of the row's component and never null; ``component_id`` the
    smallest ``doc_id`` there, null where all of them are. Null and empty texts have
    fingerprint zero and are linked to each other like any other fingerprint. Rows that
    share a ``doc_id`` are rows of their own. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, "doc_id", *keep, shingle=shingle, seed=seed))
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(fps.select("fp"), limit)).select(F.col("node").alias("fp"), F.col("label").alias("root"))
    rooted = fps.join(labels, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = written(rooted.join(least, "root").select("fp", "root", "component_id"))
    return rows.join(placed, "fp").select("doc_id", *keep, "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, limit: int = DISTANCE, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest ``doc_id``
    (null last), and among rows of that id the one whose columns hash smallest. Of rows
    that are equal in all columns one stays."""
    row = free_name(docs, "_row")
    marked = with_row_hash(docs, row)
    found = written(near_duplicates(marked, limit, shingle, seed, row).select("doc_id", row, "root"))
    return first_rows(marked, found, row)


def with_row_hash(docs: DataFrame, row: str) -> DataFrame:
    """The rows with a hash of all their columns in the column ``row``."""
    return docs.withColumn(row, F.xxhash64(*[F.to_json(F.struct(c)) if "map" in t else F.col(c) for c, t in docs.dtypes]))


def first_rows(marked: DataFrame, found: DataFrame, row: str) -> DataFrame:
    """The first row of each root of ``found(doc_id, row, root)``, without the column ``row``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col(row).alias("r")))
    best = found.groupBy("root").agg(first.alias("best")).select(F.col("best.d").alias("_d"), F.col("best.r").alias("_r"))
    kept = marked.join(best, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col(row) == F.col("_r")), "left_semi")
    again = found.groupBy("doc_id", row).count().where("count > 1").limit(1).count()
    if again:
        kept = kept.dropDuplicates(["doc_id", row])
    return kept.drop(row)


def hex_of(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
