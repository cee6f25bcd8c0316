"""What the driver holds while it learns from labelled texts."""

import tracemalloc

import numpy as np

from corpusflow.llm import hashing, quality, toxicity


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def spoken(n: int, words: int, seed: int) -> list[str]:
    r = np.random.default_rng(seed)
    return [" ".join(f"{x:x}" for x in r.integers(0, 1 << 40, words).tolist()) for _ in range(n)]


def test_quality_training_takes_little_besides_its_features(monkeypatch):
    texts = spoken(300, 500, 1)  # 1.6 MB, some 4 million features of 8 bytes
    monkeypatch.setattr(hashing, "minimise", lambda value, w, steps, memory=8: w - 0.01 * value(w)[1])
    labels = np.arange(300) % 2
    assert peak_mb(lambda: quality.fit(texts, labels, 0.5)) < 70


def test_toxicity_training_does_not_count_all_that_clean_texts_say():
    texts = ["you utter grobnick " + t for t in spoken(40, 10, 2)] + spoken(1000, 100, 3)
    labels = np.array([1] * 40 + [0] * 1000)
    assert peak_mb(lambda: toxicity.learn_words(texts, labels)) < 15
    near = [f"{a} grobnick {b}" for a, b in zip(spoken(40, 1, 4), spoken(40, 1, 5))]
    order = np.random.default_rng(6).permutation(1040)
    mixed = [[*near, *texts[40:]][i] for i in order]
    assert "grobnick" in toxicity.learn_words(mixed, labels[order])[0]


def test_pieces_change_no_sum(monkeypatch):
    texts = [t.encode() for t in spoken(60, 40, 7)] + [b"", b"a", b" "]
    weights = np.random.default_rng(8).normal(size=1 << 12).astype(np.float32)
    whole, parts = hashing.mean_weights(texts, weights), hashing.rows_of(texts, 12)
    monkeypatch.setattr(hashing, "PIECE", 700)
    assert (hashing.mean_weights(texts, weights) == whole).all()

    def entries(parts):
        return [x for low, n, col, val in parts for x in zip(np.repeat(np.arange(low, low + len(n)), n).tolist(), col.tolist(), val.tolist())]

    assert len(hashing.rows_of(texts, 12)) > len(parts) and entries(hashing.rows_of(texts, 12)) == entries(parts)
