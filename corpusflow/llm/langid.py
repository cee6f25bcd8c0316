"""Language identification by prediction with partial matching.

Each language has a tree of byte contexts of up to three bytes, with counts of the bytes
that followed. A byte's code length is that of the longest known context it was seen in;
each longer context costs an escape, whose probability is the share of distinct
followers (method C). Below the empty context all 256 bytes are equally likely. Counts
are frozen when a text is scored, so the code length of a byte depends on it and the
three bytes before alone: a text's length under a language is an exact sum over its
four-byte grams. The language with the shortest code wins.

Counts come from a bounded sample of texts per language; they are grouped by Spark and
the tables broadcast, whose size the sample bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import block_of, first_by_hash, python_ready, texts_of

#: Bytes of the longest context.
ORDER = 3
#: Texts a language's tree is counted from, and their greatest length in characters.
PER_LANGUAGE, LONGEST = 400, 20_000
UNKNOWN = "und"
MEMO_GRAMS = 1 << 21
#: Bytes whose grams are counted at once.
CHUNK = 1 << 22


def grams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct four-byte grams, counts) of the text in lower case; line ends stand
    before its start. A very long text comes in several parts."""
    data = np.frombuffer(b"\n" * ORDER + text.lower().encode(), dtype=np.uint8)
    for low in range(0, len(data) - ORDER, CHUNK):
        part = data[low : low + CHUNK + ORDER].astype(np.uint32)
        n = len(part) - ORDER
        packed = np.zeros(n, dtype=np.uint32)
        for k in range(ORDER + 1):
            packed = packed << np.uint32(8) | part[k : k + n]
        yield np.unique(packed, return_counts=True)


@dataclass
class Tree:
    """Code lengths in bits by order: of grams seen, and of the escape from a context."""

    seen: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @classmethod
    def of(cls, packed: np.ndarray, counts: np.ndarray) -> Tree:
        seen, bits, contexts, escapes = [], [], [], []
        for order in range(ORDER + 1):
            gram, at = np.unique(packed & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(at, counts)
            context, of = np.unique(gram >> np.uint32(8), return_inverse=True)
            total, distinct = np.bincount(of, n), np.bincount(of)
            seen.append(gram)
            bits.append(-np.log2(n / (total + distinct)[of]))
            contexts.append(context)
            escapes.append(-np.log2(distinct / (total + distinct)))
        return cls(seen, bits, contexts, escapes)

    def cost(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of the last byte of each gram behind the bytes before it."""
        if order < 0:
            return np.full(len(packed), 8.0)
        at = np.minimum(np.searchsorted(self.seen[order], packed), len(self.seen[order]) - 1)
        known = self.seen[order][at] == packed
        out = self.bits[order][at]
        other = packed[~known]
        if len(other):
            context = other >> np.uint32(8)
            of = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            escape = np.where(self.contexts[order][of] == context, self.escapes[order][of], 0.0)
            out[~known] = escape + self.cost(other & np.uint32((1 << 8 * order) - 1), order - 1)
        return out


class Identifier:
    """Trees by language, and a bounded memo of code lengths of grams."""

    def __init__(self, trees: dict[str, Tree]):
        self.languages = sorted(trees)
        self.trees = [trees[x] for x in self.languages]
        self._forget()

    def _forget(self):
        self.known = np.empty(0, dtype=np.uint32)
        self.costs = np.empty((0, len(self.trees)))

    def _costs(self, packed: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, packed), max(len(self.known) - 1, 0))
        new = self.known[at] != packed if len(self.known) else np.ones(len(packed), dtype=bool)
        if new.any():
            if len(self.known) > MEMO_GRAMS:
                self._forget()
                new[:] = True
            more = np.unique(packed[new])
            grams = np.concatenate([self.known, more])
            costs = np.concatenate([self.costs, np.stack([t.cost(more) for t in self.trees], axis=1)])
            order = np.argsort(grams, kind="stable")
            self.known, self.costs = grams[order], costs[order]
            at = np.searchsorted(self.known, packed)
        return self.costs[at]

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.trees)))
        owner, packed, counts = [], [], []
        held = 0

        def take():
            if packed:
                who = np.repeat(owner, [len(p) for p in packed])
                bits = self._costs(np.concatenate(packed)) * np.concatenate(counts)[:, None]
                for k in range(len(self.trees)):
                    out[:, k] += np.bincount(who, bits[:, k], len(texts))

        for i, text in enumerate(texts):
            for p, c in grams(text):
                owner.append(i)
                packed.append(p)
                counts.append(c)
                held += len(p)
            if held > 1 << 19:
                take()
                owner, packed, counts, held = [], [], [], 0
        take()
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, its probability where all are equally likely beforehand) of each text."""
        readable = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if self.trees else []
        languages, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if readable:
            bits = self.code_lengths([texts[i] for i in readable])
            best = bits.argmin(axis=1)
            behind = bits - bits.min(axis=1, keepdims=True)
            score[readable] = 1 / np.exp2(-behind).sum(axis=1)
            for i, k in zip(readable, best.tolist()):
                languages[i] = self.languages[k]
        return languages, score


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, longest: int = LONGEST) -> Identifier:
    """Trees from ``docs(doc_id, text, lang)``: up to ``per_language`` texts of each
    language, those whose ids hash smallest. Of a text longer than ``longest`` one block
    serves, and an id that repeats within a language counts once; rows without id, text
    or language don't serve for learning. Only ids are ranked."""
    spark = python_ready(docs.sparkSession)
    usable = docs.where("doc_id is not null and lang is not null and length(text) > 0")
    chosen = first_by_hash(usable.select("doc_id", "lang").distinct(), "lang", per_language)
    rows = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    text = block_of(F.col("doc_id"), F.col("text"), longest)
    sample = rows.groupBy("doc_id", "lang").agg(F.min(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for packed, n in grams(text):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(packed), pa.string()), pa.array(packed.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    langs = np.array(rows.column("lang").to_pylist(), dtype=object)
    packed, n = rows.column("gram").to_numpy().astype(np.uint32), rows.column("n").to_numpy().astype(np.float64)
    trees = {}
    for lang in set(langs.tolist()):
        at = np.flatnonzero(langs == lang)
        at = at[np.argsort(packed[at])]
        trees[lang] = Tree.of(packed[at], n[at])
    return Identifier(trees)


def identify(docs: DataFrame, model: Identifier) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row. Null texts and texts without a letter are
    ``und`` with score 0, as all texts are where nothing was learned. Rows with null or
    repeated ids are rows like any other; other columns are not read."""
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            languages, scores = [], [np.empty(0)]
            for texts in texts_of(batch.column(1)):
                found, some = model.predict(texts)
                languages += found
                scores.append(some)
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
