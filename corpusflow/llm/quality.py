"""Quality rules: fixed rules, then a hashed n-gram logistic regression.

The rules fail texts of too few words or with too many repeated ones. What passes is
scored by a logistic regression over hashed word and character n-grams, trained on
labelled rows and calibrated to a probability, and kept from a fixed threshold on. Texts
are scored whole, in Arrow batches where they lie; nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusflow.llm import hashing
from corpusflow.llm.common import giving_back, labelled_sample, python_ready, texts_of, warn_of_missing_class

MIN_WORDS = 50
#: Percent of words in repeated windows of three beyond which a text fails.
MAX_REPEATED = 50
SYMBOLS = "#*$%&|<>"
#: A text is kept from this calibrated probability of good quality on.
KEEP_FROM = 0.5
#: The model learns from so many labelled texts of each class, and of up to so many
#: characters of each.
PER_CLASS, LONGEST = 1200, 20_000
#: One in so many of them is held back for calibration.
HELD_BACK = 4


def rule_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0
    word_chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            covered = np.zeros(n, dtype=bool)
            at = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows)))
            for k in range(3):
                covered[at + k] = True
            repeated = int(covered.sum())
    return n, word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED * n_words


@dataclass
class QualityModel:
    """Weights by bucket (None: nothing to learn from, and every text scores 1) and the
    calibration of their sum."""

    weights: np.ndarray | None
    slope: float = 0.0
    shift: float = 0.0

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(texts))
        return hashing.sigmoid(self.slope * hashing.mean_weights([t.encode() for t in texts], self.weights) + self.shift)


def fit(texts: list[str], labels: np.ndarray, share: float) -> QualityModel:
    """A model from labelled texts; ``share`` is the part of good rows among all labelled
    ones, to which probabilities are calibrated. Without texts of both classes only the
    fixed rules are left, of which a warning tells."""
    if warn_of_missing_class(labels, "quality"):
        return QualityModel(None)
    data = [t.encode() for t in texts]
    held = np.zeros(len(texts), dtype=bool)
    for value in (0, 1):  # some of each class, however few there are
        at = np.flatnonzero(labels == value)
        held[at[:: HELD_BACK] if len(at) >= HELD_BACK else at] = True
    few = (~held).sum() < 2 or len(set(labels[~held].tolist())) < 2
    learn = np.ones(len(texts), dtype=bool) if few else ~held
    kept = labels[learn]
    balance = np.where(kept > 0, 0.5 / max(kept.sum(), 1), 0.5 / max((1 - kept).sum(), 1))
    parts = hashing.rows_of([d for d, x in zip(data, learn) if x], scale=30)
    weights, _ = hashing.fit_logistic(parts, kept, balance, 1 << hashing.BUCKET_BITS)
    del parts  # not held while texts are scored
    weights *= 30
    held_labels = labels[held]
    prior = np.where(held_labels > 0, share / max(held_labels.sum(), 1), (1 - share) / max((1 - held_labels).sum(), 1))
    slope, shift = hashing.fit_platt(hashing.mean_weights([d for d, x in zip(data, held) if x], weights), held_labels, prior)
    return QualityModel(weights, slope, shift)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, longest: int = LONGEST) -> QualityModel:
    """Learn from a bounded sample of rows with a quality label: at most ``2 * per_class``
    texts, or blocks of ``longest`` characters of longer ones, come to the driver."""
    rows = labelled_sample(docs, labels, "quality", (per_class, per_class), longest).orderBy("doc_id").collect()
    seen = {r["quality"]: r["count"] for r in labels.where("quality in (0, 1)").groupBy("quality").count().collect()}
    share = seen.get(1, 0) / max(sum(seen.values()), 1)
    return fit([r.text for r in rows], np.array([r.label for r in rows], dtype=np.int64), share)


def judge(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """Counts and verdict of each row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score, kept``.

    Null and empty texts have no words, fail, and score 0. Ids play no part, so null and
    repeated ones are rows like any other; other columns are not read.
    """
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, scores = _judged(batch.column(1), shared.value)
            columns = [batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(5)), pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= keep_from))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_failed", "score", "kept"])

    schema = f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, base_failed boolean, score double, kept boolean"
    return rows.mapInArrow(run, schema)


def _judged(column: pa.Array, model: QualityModel) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    counts, scores = [], [np.empty(0)]
    for texts in texts_of(column):
        some = [rule_counts(t) for t in texts]
        counts += some
        scores.append(np.where([c[0] > 0 for c in some], model.score(texts), 0.0))
    failed = np.array([base_failed(c[0], c[4]) for c in counts], dtype=bool)
    return counts, failed, np.concatenate(scores)


def keep_good(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows that are kept, with all their columns."""
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, failed, scores = _judged(batch.column(at), shared.value)
            yield batch.filter(pa.array(~failed & (scores >= keep_from)))

    return docs.mapInArrow(giving_back(run), docs.schema)
