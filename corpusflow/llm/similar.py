"""Near copies by the similarity of their shingles: candidates by SimHash and MinHash, verified.

A text is the set of its five-word shingles, as hashes. Texts of one set are one node. Every
link has been verified on whole sets. Candidates come from two indexes:

* The Gray-order index of ``simhash`` over 64-bit fingerprints of the sets gives each node
  the smallest one that pairs of at most four differing bits connect it to. These are the
  closest copies. At a similarity of 0.8 fingerprints differ in 10 bits on average and 13
  are needed to find nine pairs in ten, which no choice of blocks serves at scale (figures
  in the README), so this index alone does not give the right result.
* The least hashes of a set under ``BANDS * ROWS`` orders, cut into bands: sets that agree on
  a band meet in its bucket. Two sets of similarity s do so with probability
  ``1 - (1 - s**ROWS)**BANDS``, which is 0.9993 at 0.8.

A node's sketch holds one bit of each least hash. Sets of similarity s differ in
``(1 - s) / 2`` of the bits on average, 14.4 of 144 at 0.8, and in over ``SKETCH_BITS`` about
once in 30,000 pairs of 0.8; sets are moved and compared only for candidates within that.

All nodes of a bucket of up to ``SMALL`` are candidates of each other. In larger ones every
node looks, round by round, at ``HUBS`` members picked at random and at its ``NEIGHBOURS``
next in a Gray order of the fingerprints, turned anew each round, and is compared with
that of the closest sketch it isn't connected to yet. A round costs in proportion to the
nodes, and a group of many copies is connected in one or two. Once under one in ``YIELD`` of
the pairs of a round is a link, what is left is finished exactly: each two nodes of a bucket
that aren't connected are held against each other, block by block, by sketches and then by
sets, inside the tasks. So every candidate of every bucket is either connected or compared,
and no bucket's pairs are ever listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import free_name, giving_back, python_ready, written
from corpusflow.llm.graph import components
from corpusflow.llm.simhash import DISTANCE, SEED, first_rows, gray_rank, links, majority, signed, with_row_hash

#: Words of a shingle, and the least similarity (shared shingles among all) of near copies.
SHINGLE, LEAST = 5, 0.8
#: Bands of a signature, and least hashes that make one up.
BANDS, ROWS = 24, 6
#: Bits of a sketch that near sets may differ in.
SKETCH_BITS = 30
#: Nodes of a bucket up to which all are compared with each other at once.
SMALL = 8
#: Members of a larger bucket that each node looks at in a round: picked ones, next ones.
HUBS, NEIGHBOURS = 4, 8
#: Nodes of a bucket from which its Gray order is cut by leading bits.
ORDERED = 4096
#: Pairs compared per new link from which rounds end and the rest is compared in blocks.
YIELD = 10
#: Nodes of a block, on either side.
BLOCK = 1024
#: Keys up to which rows wanted are found by a broadcast, some 50 MB; else by a shuffle.
BROADCAST_KEYS = 1_000_000
_R = np.random.default_rng(23)
_TURN = _R.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
_FACTOR = _R.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The distinct hashes in order; words as those of the fingerprints, and a text of
    fewer words than a shingle is one as a whole."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    bounds = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    return np.unique(np.array([xxh64_intdigest(joined[a:b], seed) for a, b in bounds], dtype=np.uint64))


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least hash under each order."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for low in range(0, len(hashes), 1 << 14):
        part = hashes[low : low + (1 << 14)]
        for k in range(0, BANDS * ROWS, 16):
            turned = (part[None, :] ^ _TURN[k : k + 16, None]) * _FACTOR[k : k + 16, None]
            least[k : k + 16] = np.minimum(least[k : k + 16], turned.min(axis=1))
    return least


def buckets(least: np.ndarray) -> list[int]:
    """The bucket of each band, as signed numbers."""
    from xxhash import xxh64_intdigest

    data = least.astype("<u8").tobytes()
    size = 8 * ROWS
    out = np.array([xxh64_intdigest(data[k * size : (k + 1) * size], k) for k in range(BANDS)], dtype=np.uint64)
    return out.view(np.int64).tolist()


def sketch(least: np.ndarray) -> list[int]:
    """A mixed bit of each least hash, packed into signed numbers."""
    bits = ((least ^ (least >> np.uint64(29))) * _FACTOR[0]) >> np.uint64(63)
    packed = np.packbits(bits.astype(np.uint8)).tobytes()
    return np.frombuffer(packed.ljust(-len(packed) % 8 + len(packed), b"\0"), "<i8").tolist()


def signatures(docs: DataFrame, row: str, shingle: int, seed: int) -> DataFrame:
    """(doc_id, row, node, fp, buckets, sketch) of each row; ``node`` is a digest of the set.
    An empty set has neither buckets nor a sketch."""
    rows = docs.select("doc_id", row, "text")
    kinds = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, `{row}` long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, fps, bands, sketches = [], [], [], []
            for t in batch.column(2):
                hashes = shingles(t.as_py() or "", shingle, seed)
                nodes.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                fps.append(signed(majority(hashes)))
                least = least_hashes(hashes)
                bands.append(buckets(least) if len(hashes) else [])
                sketches.append(sketch(least) if len(hashes) else [])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (bands, sketches)]
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(fps, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", row, "node", "fp", "buckets", "sketch"])

    return rows.mapInArrow(giving_back(run), f"{kinds}, node binary, fp long, buckets array<long>, sketch array<long>")


def sets_of(texts: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(node, hashes) of ``texts(node, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                hashes = [shingles(t.as_py() or "", shingle, seed).view(np.int64) for t in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(hashes, pa.list_(pa.int64()))], ["node", "hashes"])

    return texts.mapInArrow(giving_back(run), "node binary, hashes array<long>")


def wanted(rows: DataFrame, keys: DataFrame, on) -> DataFrame:
    """``rows`` that have one of the distinct ``keys``: few keys go to the rows, else rows
    are shuffled."""
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, on)


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, near) of the pairs, ``near`` where their sets are similar enough."""
    pairs = written(pairs)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = wanted(sets, nodes, "node")
    left = some.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = some.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    near = both >= least * (F.size("ha") + F.size("hb") - both)
    # sets differ by at most the fifth that may be missing, or they can't be near
    fits = (F.size("ha") >= least * F.size("hb")) & (F.size("hb") >= least * F.size("ha"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", (fits & near).alias("near"))


def shared(met: DataFrame) -> DataFrame:
    """The rows of ``met`` whose bucket has several nodes; a node is in a bucket once."""
    several = written(met.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    return wanted(met, several, "bucket")


def unfinished(placed: DataFrame) -> DataFrame:
    """The rows whose bucket has nodes that aren't connected yet."""
    labels = placed.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    return placed.join(labels.where("least <> most").select("bucket"), "bucket", "left_semi")


def pair(a, b):
    return F.greatest(a, b).alias("a"), F.least(a, b).alias("b")


def apart(x, y):
    """Bits that two sketches differ in."""
    return sum(F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(-(-BANDS * ROWS // 64)))


def within(met: DataFrame) -> DataFrame:
    """The pairs of close sketches in the buckets of up to ``SMALL`` nodes."""
    small = met.where(F.col("size") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("node", "sketch"))).alias("nodes"))
    each = small.select("nodes", F.posexplode("nodes").alias("at", "y"))
    pairs = each.select("y", F.explode(F.slice("nodes", F.lit(1), F.col("at"))).alias("x"))
    return pairs.where(apart(F.col("x.sketch"), F.col("y.sketch")) <= SKETCH_BITS).select(*pair(F.col("x.node"), F.col("y.node"))).distinct()


def across(placed: DataFrame, round_: int) -> DataFrame:
    """Pairs for one round over ``placed(bucket, node, fp, sketch, size, label)``, the larger
    buckets: each node with that member of closest sketch among those it looks at and
    isn't connected to, in each bucket, and in the first round in all buckets together.

    Picked members are those of least hash, which does not depend on the bucket, so the
    buckets of one group of copies share them."""
    member = F.struct("node", "label", "sketch")
    picked = [F.min_by(member, F.xxhash64("node", F.lit(round_ * HUBS + k))) for k in range(HUBS)]
    hubs = placed.groupBy("bucket").agg(F.array(*picked).alias("hubs"))
    shift = (7 * round_) % 64
    turned = F.shiftleft("fp", shift).bitwiseOR(F.shiftrightunsigned("fp", 64 - shift)) if shift else F.col("fp")
    # neighbours agree on the leading bits of their rank, so cutting there parts few
    bits = F.greatest(F.lit(0), F.least(F.lit(31), F.ceil(F.log2(F.col("size") / ORDERED)))).cast("int")
    part = F.when(bits > 0, F.call_function("shiftrightunsigned", F.col("_rank"), 64 - bits)).otherwise(F.lit(0).cast("long"))
    ranked = placed.withColumn("_rank", gray_rank(turned)).withColumn("_part", part)
    order = Window.partitionBy("bucket", "_part").orderBy("_rank", "node")
    following = F.array(*[F.lead(member, k).over(order) for k in range(1, NEIGHBOURS + 1)])
    seen = ranked.withColumn("after", following).join(hubs, "bucket")
    others = F.filter(F.concat("hubs", "after"), lambda o: (o["label"] != F.col("label")) & (apart(F.col("sketch"), o["sketch"]) <= SKETCH_BITS))
    closest = F.array_min(F.transform(others, lambda o: F.struct(apart(F.col("sketch"), o["sketch"]).alias("apart"), o["node"].alias("node"))))
    best = seen.select("node", closest.alias("best")).where("best is not null")
    if round_ == 0:
        best = best.groupBy("node").agg(F.min("best").alias("best"))
    return best.select(*pair(F.col("node"), F.col("best.node"))).distinct()


def blocks(placed: DataFrame) -> DataFrame:
    """The rows of ``placed(bucket, node, label, ...)`` dealt to blocks ``(bucket, u, p)`` of
    some ``BLOCK`` nodes on either side, in which each two rows of a bucket and of different
    labels meet, on ``left`` and not.

    One of such two is not of the bucket's most frequent label, so only others are on the
    left: a large group of copies is not held against itself."""
    each = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    main = each.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("_size"), F.max("n").alias("_most"))
    rows = placed.join(main, "bucket")
    parts, others = F.ceil(F.col("_size") / BLOCK), F.ceil((F.col("_size") - F.col("_most")) / BLOCK)
    at = F.xxhash64("node")
    right = rows.select(*placed.columns, F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), others - 1)).alias("u"), F.pmod(at, parts).alias("p"))
    left = rows.where("label <> main").select(*placed.columns, F.lit(True).alias("left"), F.pmod(at, others).alias("u"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("p"))
    return right.unionByName(left)


def close_in_block(block: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each row on the left that has close ones of other labels on the right, and these."""
    label = block.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    bits = block.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(label), -1)
    side = block.column("left").to_numpy()
    left, right = np.flatnonzero(side), np.flatnonzero(~side)
    for low in range(0, len(left), 256):
        some = left[low : low + 256]
        differ = sum(np.bitwise_count(bits[some, k, None] ^ bits[None, right, k]).astype(np.int16) for k in range(bits.shape[1]))
        close = (differ <= SKETCH_BITS) & (label[some, None] != label[None, right])
        for k in np.flatnonzero(close.any(axis=1)).tolist():
            yield int(some[k]), right[close[k]]


def with_close(block: pa.Table) -> pa.Table:
    """The bucket and node of the rows that have a close one of another label."""
    found = np.zeros(block.num_rows, dtype=bool)
    for x, others in close_in_block(block):
        found[x] = True
        found[others] = True
    return block.select(["bucket", "node"]).filter(pa.array(found))


def near_in_block(block: pa.Table, least: float) -> pa.Table:
    """(a, b) of near rows, a pair of each two labels that have one."""
    nodes, label = block.column("node").to_pylist(), block.column("label").to_pylist()
    sets = block.column("hashes").combine_chunks()
    size = np.diff(sets.offsets.to_numpy())
    start = np.cumsum(size) - size
    ids = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
    mark = np.zeros(len(ids), dtype=bool)
    found: dict[tuple, tuple] = {}
    for x, others in close_in_block(block):
        others = others[(size[others] >= least * size[x]) & (size[x] >= least * size[others])]
        mine = ids[start[x] : start[x] + size[x]]
        mark[mine] = True
        for low in range(0, len(others), 256):
            some = others[low : low + 256]
            first = np.cumsum(size[some]) - size[some]
            flat = np.arange(size[some].sum()) + np.repeat(start[some] - first, size[some])
            both = np.add.reduceat(mark[ids[flat]], first, dtype=np.int64)
            for y in some[both >= least * (size[x] + size[some] - both)].tolist():
                found[min(label[x], label[y]), max(label[x], label[y])] = (max(nodes[x], nodes[y]), min(nodes[x], nodes[y]))
        mark[mine] = False
    return pa.table([pa.array([a for a, _ in found.values()], pa.binary()), pa.array([b for _, b in found.values()], pa.binary())], names=["a", "b"])


def rest(placed: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that connect all near nodes of different labels that share a bucket of
    ``placed(bucket, node, sketch, label)``; sets are moved only for nodes that have a close
    sketch to be held against."""
    dealt = blocks(placed.select("bucket", "node", "sketch", "label"))
    close = written(dealt.groupBy("bucket", "u", "p").applyInArrow(with_close, "bucket long, node binary").distinct())
    some = wanted(sets, close.select("node").distinct(), "node")
    dealt = blocks(placed.select("bucket", "node", "sketch", "label").join(close, ["bucket", "node"]).join(some, "node"))
    return dealt.groupBy("bucket", "u", "p").applyInArrow(lambda block: near_in_block(block, least), "a binary, b binary").distinct()


def near_links(met: DataFrame, sets: DataFrame, first: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """(a, b) between nodes of ``met(bucket, node, fp, sketch)`` that connect what is near;
    pairs of ``first(a, b)`` are compared as well."""
    met = written(shared(met))
    pairs = within(met) if first is None else within(met).unionByName(first).distinct()
    tried = written(verified(pairs, sets, least))
    found = tried.where("near").select("a", "b")
    large = met.where(F.col("size") > SMALL).select("bucket", "node", "fp", "sketch", "size")
    if large.isEmpty():
        return found
    label, round_, some = components(found), 0, True
    while True:
        placed = written(unfinished(large.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))))
        large = placed.drop("label")
        if not some or placed.isEmpty():
            break
        pairs = across(placed, round_).join(tried, ["a", "b"], "left_anti")
        checked = written(verified(pairs, sets, least))
        new, tried = checked.where("near").select("a", "b"), tried.unionByName(checked)
        got, compared = new.count(), checked.count()
        round_, some = round_ + 1, got * YIELD >= compared > 0
        if got:
            found, label = found.unionByName(new), merged(label, new)
        elif not some:
            break
    if placed.isEmpty():
        return found
    return found.unionByName(written(rest(placed, sets, least)))


def merged(label: DataFrame, new: DataFrame) -> DataFrame:
    """Labels after new links: only the labels that the links connect are looked at."""
    ends = new
    for end in ("a", "b"):
        ends = ends.join(label.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end, "left").withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    moved = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("to"))
    known = label.unionByName(new.select(F.explode(F.array("a", "b")).alias("node"), F.col("node").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    return written(known.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def gray_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes whose fingerprints the Gray-order index connects: each with the
    smallest of its fingerprint, and that one with the smallest fingerprint's."""
    each = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    linked = links(each.select("fp"), DISTANCE).groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("root"))
    roots = each.select(F.col("fp").alias("root"), F.col("first").alias("b"))
    far = each.join(linked, "fp").join(roots, "root").select(*pair(F.col("first"), F.col("b")))
    same = nodes.join(each, "fp").where("node <> first").select(*pair(F.col("node"), F.col("first")))
    return far.unionByName(same)


def drop_similar(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row of each group that pairs of at least this similarity connect, with all its
    columns: that of the smallest ``doc_id`` (null last), and among rows of that id the
    one whose columns hash smallest; of rows equal in all columns one. Null and empty texts
    are copies of each other. An empty table stays empty. Very long texts are read whole."""
    python_ready(docs.sparkSession)
    row = free_name(docs, "_row")
    marked = with_row_hash(docs, row)
    rows = written(signatures(marked, row, shingle, seed))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col(row).alias("r")))
    nodes = written(rows.groupBy("node").agg(best.alias("best"), F.first("fp").alias("fp"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")))
    # most buckets have one node: only ids are held against those that have several
    met = shared(nodes.select("node", F.explode("buckets").alias("bucket"))).drop("size")
    met = written(met.join(nodes.select("node", "fp", "sketch"), "node"))
    first = written(gray_pairs(nodes.where(F.size("buckets") > 0)))
    asked = met.select("node").union(first.select("a")).union(first.select("b")).distinct()
    keys = written(nodes.join(asked, "node").select("node", F.col("best.d").alias("_d"), F.col("best.r").alias("_r")))
    texts = marked.select(F.col("doc_id").alias("_id"), F.col(row).alias("_hash"), "text")
    texts = wanted(texts, keys, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_r")))
    sets = written(sets_of(texts.select("node", "text"), shingle, seed).dropDuplicates(["node"]))
    label = components(near_links(met, sets, first, least)).select("node", F.col("label").alias("root"))
    found = written(rows.select("doc_id", row, "node").join(label, "node", "left").select("doc_id", row, F.coalesce("root", "node").alias("root")))
    return first_rows(marked, found, row)
