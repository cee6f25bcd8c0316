"""Language-model scores by deleted interpolation.

A word's probability mixes three estimates: its share of what followed the word before it,
its share of all tokens, and an equal share of each known word and one unknown:

    P(w | u) = a[b] c(u, w) / c(u)  +  z[b] c(w) / N  +  o[b] / (V + 1)

``b`` is the bucket of how often the context ``u`` was seen, and ``a, z, o`` are the bucket's
weights, which sum to one. They are learned on deleted counts: a part of the learned
texts is held back, the estimates are made from the others, and expectation-maximisation
finds the weights under which the held-back counts are likeliest. Scores then use the counts
of all learned texts. A text ends with one end token, which is also the context of the next
text's first word, so how often a word is a context is how often it occurs at all.

Counts are of the whole corpus and as large as it is, so they live in shards and never in one
place. Tokens are written once, in blocks of a million with a word list each. A
block asks each shard once about the words and pairs it has, as sorted 64-bit hashes with
their counts; the shard, a range of hashes, sums what all blocks sent and answers each in
the same order. A word in every text is thus one key per block, and shards are even
whatever is frequent. Questions and answers are packed columns, some bytes a pair.

Words are told apart by 63 bits of their hash: among a billion distinct words five pairs in a
hundred corpora share one. A text is held whole by one task, with its block.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import python_ready, texts_of
from corpusflow.workdir import workspace

#: Tokens after which a block is closed, and tokens of the corpus per shard of counts.
BLOCK, SHARD = 1 << 20, 1 << 20
#: Bytes of a text that are split at once.
CHUNK = 1 << 22
#: Context frequencies 0, 1, 2-3, 4-7, ... ; the last bucket takes all above.
BUCKETS = 24
#: Every so many learned texts are one held back for the weights.
HELD_EVERY = 8
#: Steps of the logarithms that held-back estimates are summed under, per octave.
STEPS = 4
#: Rounds of expectation-maximisation, and the count each estimate starts with, so that
#: none gets no weight at all.
ROUNDS, PRIOR = 40, 1.0
#: What a block's texts are for: counts, weights, neither.
KEPT, HELD, OTHER = 0, 1, 2
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: The end token; no word has a space.
END = b" "


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words in lower case (A-Z alone), some at a time."""
    data = text.encode("utf-8", "surrogatepass")
    low = 0
    while low < len(data):
        cut = _SPACE.search(data, low + CHUNK)
        high = cut.start() if cut else len(data)
        yield data[low:high].lower().split()
        low = high


def planes(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones, which packs better."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, "<u8"), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest takes; the first byte says how many."""
    most = int(counts.max()) if len(counts) else 0
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + planes(counts.astype(kind))


def unpacked_counts(data: bytes) -> np.ndarray:
    return unplanes(data[1:], f"<u{data[0]}").astype(np.int64)


class Block:
    """Texts of one part, as they come in."""

    def __init__(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict(lambda: len(self.index))
        self.index[END]
        self.ids: list = []
        self.pieces: list[np.ndarray] = []
        self.ends: list[int] = []
        self.tokens = 0

    def add(self, doc_id, text: str) -> None:
        for words in words_of(text):
            self.pieces.append(np.fromiter(map(self.index.__getitem__, words), np.uint32, len(words)))
            self.tokens += len(words)
        self.pieces.append(np.zeros(1, np.uint32))
        self.tokens += 1
        self.ids.append(doc_id)
        self.ends.append(self.tokens)

    def row(self, number: int, part: int) -> tuple:
        from xxhash import xxh64_intdigest

        words = np.fromiter((xxh64_intdigest(w) for w in self.index), np.uint64, len(self.index))
        tokens = np.concatenate(self.pieces)
        kind = "<u2" if len(words) <= 1 << 16 else "<u4"
        return number, part, self.tokens, self.ids, self.ends, words.astype("<u8").tobytes(), bytes([np.dtype(kind).itemsize]) + planes(tokens.astype(kind))


def mixed(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes."""
    x = u * np.uint64(0x9E3779B97F4A7C15) + w
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Grams:
    """The words and pairs of a block: ``keys`` sorted, words even and pairs odd."""

    def __init__(self, words: bytes, tokens: bytes) -> None:
        hashes = np.frombuffer(words, "<u8")
        self.tokens = unpacked_counts(tokens)
        self.before = np.concatenate([[0], self.tokens[:-1]])
        pair, self.pair_at, pairs = np.unique(self.before * len(hashes) + self.tokens, return_inverse=True, return_counts=True)
        self.u, self.w = pair // len(hashes), pair % len(hashes)
        self.pairs = pairs
        even = np.uint64(0xFFFFFFFFFFFFFFFE)
        keys = np.concatenate([hashes & even, mixed(hashes[self.u], hashes[self.w]) | np.uint64(1)])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.counts = np.concatenate([np.bincount(self.tokens, minlength=len(hashes)), pairs])[self.order]
        self.n_words = len(hashes)

    def answers(self, table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
        """(counts of the words, counts of the pairs) from the rows of all shards."""
        rows = sorted(zip(table.column("shard").to_pylist(), table.column(column).to_pylist()))
        out = np.empty(len(self.keys), np.int64)
        out[self.order] = np.concatenate([unpacked_counts(data) for _, data in rows])
        return out[: self.n_words], out[self.n_words :]


def bucket_of(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(seen.astype(np.float64))[1], BUCKETS)


def token_blocks(docs: DataFrame, part: Column) -> DataFrame:
    """Texts as token blocks, written in the shared folder; no shuffle."""
    rows = docs.select("doc_id", F.col("text").alias("text"), part.alias("part"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Block] = {}
        task, made, type_ = TaskContext.get().partitionId(), 0, None

        def out(p: int) -> pa.RecordBatch:
            nonlocal made
            columns = zip(*[opened.pop(p).row(task << 24 | made, p)])
            made += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(type_), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["block", "part", "n", "ids", "ends", "words", "tokens"])

        for batch in batches:
            type_ = batch.schema.field(0).type
            ids, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at = 0
            for texts in texts_of(batch.column(1)):
                for text in texts:
                    p = parts[at]
                    opened.setdefault(p, Block()).add(ids[at], text)
                    at += 1
                    if opened[p].tokens >= BLOCK:
                        yield out(p)
        for p in list(opened):
            yield out(p)

    shape = f"block long, part int, n long, ids array<{kind}>, ends array<long>, words binary, tokens binary"
    return _kept(rows.mapInArrow(run, shape))


def _kept(df: DataFrame) -> DataFrame:
    path = workspace(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shard_answers(blocks: DataFrame, shards: int) -> DataFrame:
    """(block, part, shard, total, kept, v, v_kept): for each block and shard the counts of
    the block's keys there, in key order, over all learned texts and (for held-back blocks)
    without those held back; ``v`` and ``v_kept`` are the shard's distinct words, on one row
    of each shard."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, part, words, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                grams = Grams(words, tokens)
                of = ((grams.keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                first = np.flatnonzero(np.diff(of, prepend=np.uint64(shards)))
                cuts = [*first.tolist(), len(of)]
                rows = [(int(of[a]), block, part, packed_keys(grams.keys[a:b]), packed_counts(grams.counts[a:b])) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()])], ["shard", "block", "part", "keys", "counts"])

    def answer(asked: pa.Table) -> pa.Table:
        shard = asked.column("shard")[0].as_py()
        parts = asked.column("part").to_pylist()
        keys = [unpacked_keys(k) for k in asked.column("keys").to_pylist()]
        counts = [unpacked_counts(c) for c in asked.column("counts").to_pylist()]
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros((2, len(known)), np.int64)
        low = 0
        for part, some in zip(parts, counts):
            if part != OTHER:  # keys of a block are distinct
                sums[part][at[low : low + len(some)]] += some
            low += len(some)
        total = sums[KEPT] + sums[HELD]
        word = known & np.uint64(1) == 0
        v, v_kept = int((word & (total > 0)).sum()), int((word & (sums[KEPT] > 0)).sum())
        out, low = [], 0
        for block, part, some in zip(asked.column("block").to_pylist(), parts, counts):
            here = at[low : low + len(some)]
            low += len(some)
            out.append((block, part, shard, packed_counts(total[here]), packed_counts(sums[KEPT][here]) if part == HELD else b"", v, v_kept))
            v = v_kept = 0
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["block", "part", "shard", "total", "kept", "v", "v_kept"])

    asked = blocks.select("block", "part", "words", "tokens").mapInArrow(ask, "shard long, block long, part int, keys binary, counts binary")
    shape = "block long, part int, shard long, total binary, kept binary, v long, v_kept long"
    return _kept(asked.groupBy("shard").applyInArrow(answer, shape))


def held_counts(blocks: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """(bucket, q2, q1, n): how many held-back tokens had estimates of these logarithms
    from the texts that are not held back; null where the estimate was zero. There are as
    many rows as kinds of logarithms at most, however many tokens."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bucket", "q2", "q1", "n"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        if not block.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        grams = Grams(block.column("words")[0].as_py(), block.column("tokens")[0].as_py())
        words, pairs = grams.answers(answers, "kept")
        none = np.int64(1)  # estimates are at most 1, their logarithms at most 0
        seen = words[grams.u]
        with np.errstate(divide="ignore", invalid="ignore"):
            q2 = np.where(pairs > 0, np.rint(STEPS * np.log2(pairs / seen)), none).astype(np.int64)
            q1 = np.where(words[grams.w] > 0, np.rint(STEPS * np.log2(words[grams.w] / max(n, 1))), none).astype(np.int64)
        rows, at = np.unique(np.stack([bucket_of(seen), q2, q1], axis=1), axis=0, return_inverse=True)
        sums = np.bincount(at.ravel(), grams.pairs).astype(np.int64)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip([*rows.T, sums], types)], names=names)

    held = blocks.where(F.col("part") == HELD).select("block", "words", "tokens").groupBy("block")
    asked = answers.where(F.col("part") == HELD).select("block", "shard", "kept").groupBy("block")
    found = held.cogroup(asked).applyInArrow(run, "bucket int, q2 int, q1 int, n long")
    return found.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))


def weights(rows: list, v: int) -> np.ndarray:
    """Weights of the three estimates for each bucket, by expectation-maximisation.

    Buckets without held-back counts take those of all counts together. A context that was
    never seen has no followers, so the first weight of bucket 0 is zero."""
    bucket = np.array([r.bucket for r in rows], np.int64)
    logs = np.array([[r.q2, r.q1] for r in rows], float).reshape(-1, 2)
    n = np.array([r.n for r in rows], float)
    shares = np.concatenate([np.where(logs > 0, 0.0, 2.0 ** (logs / STEPS)), np.full((len(rows), 1), 1 / (v + 1))], axis=1)

    def fit(at: np.ndarray, seen: bool) -> np.ndarray:
        mix = np.array([1.0, 1.0, 1.0]) if seen else np.array([0.0, 1.0, 1.0])
        mix /= mix.sum()
        for _ in range(ROUNDS):
            part = shares[at] * mix
            part /= part.sum(axis=1, keepdims=True)
            mix = (part * n[at, None]).sum(axis=0) + PRIOR * (mix > 0)
            mix /= mix.sum()
        return mix

    every = np.arange(len(rows))
    out = []
    for b in range(BUCKETS + 1):
        own = np.flatnonzero(bucket == b)
        out.append(fit(own if len(own) else every, b > 0))
    return np.array(out)


def score_texts(docs: DataFrame, learn: Column, held: Column) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of each row.

    The model is learned from rows where ``learn`` is true; those of them where ``held`` is
    true serve for the weights. Null conditions are false. Null and empty texts have the
    end token alone. Rows that repeat, or share an id, are rows of their own, and are learned
    from as often as they stand; a null ``doc_id`` is an id like any other. Other columns play
    no part. Where nothing is learned every token is unknown, and has probability 1. An
    empty table gives no rows.
    """
    python_ready(docs.sparkSession)
    part = F.when(~F.coalesce(learn, F.lit(False)), OTHER).when(F.coalesce(held, F.lit(False)), HELD).otherwise(KEPT)
    blocks = token_blocks(docs, part.cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    sizes = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    n, n_kept = sizes.get(KEPT, 0) + sizes.get(HELD, 0), sizes.get(KEPT, 0)
    answers = shard_answers(blocks, max(1, -(-sum(sizes.values()) // SHARD)))
    v, v_kept = answers.agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("v_kept"), F.lit(0))).first()
    mix = weights(held_counts(blocks, answers, n_kept).collect(), v_kept)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: block.column(c)[0].as_py() for c in ("part", "ends", "words", "tokens")}
        grams = Grams(row["words"], row["tokens"])
        words, pairs = grams.answers(answers, "total")
        seen = words[grams.u]
        own = mix[bucket_of(seen)]
        chance = own[:, 0] * pairs / np.maximum(seen, 1) + own[:, 1] * words[grams.w] / max(n, 1) + own[:, 2] / (v + 1)
        if not n:
            chance[:] = 1.0
        first = np.concatenate([[0], row["ends"][:-1]]).astype(np.int64)
        count = words[grams.tokens]
        score = np.add.reduceat(np.log10(chance)[grams.pair_at.ravel()], first)
        base = np.add.reduceat(np.log10((count + 1) / (n + v + 1)), first)
        known = np.add.reduceat((count > 0).astype(np.int64), first)
        size = np.diff(row["ends"], prepend=0)
        ids = block.column("ids").combine_chunks().flatten()
        columns = [ids, pa.array(np.full(len(first), row["part"] != OTHER)), *(pa.array(x) for x in (size, known, np.full(len(first), n), base, score))]
        return pa.Table.from_arrays(columns, names=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    asked = answers.select("block", "shard", "total").groupBy("block")
    return blocks.drop("n").groupBy("block").cogroup(asked).applyInArrow(run, shape)


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def score_documents(docs: DataFrame, parts: int = 7, held_out: int = 2) -> DataFrame:
    """Scores under a model of all rows but those whose ``crc32(doc_id) % parts`` is
    ``held_out``; a null id is learned from. Every eighth learned id by the same
    checksum serves for the weights."""
    id_ = F.col("doc_id")
    learn = F.coalesce(fold(id_, parts) != held_out, F.lit(True))
    held = F.floor(F.crc32(id_.cast("string").cast("binary")) / parts) % HELD_EVERY == 0
    found = score_texts(docs, learn, held)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
