"""Hashed word and character n-grams of many texts at once, in numpy.

Texts are laid end to end as bytes. A gram's bucket comes from a polynomial of its bytes
(modulo 2**64), so buckets of all grams are a few array operations; sums over a text are
differences of running sums at its borders.
"""

from __future__ import annotations

import numpy as np

#: Bytes of the character grams and words of the word grams.
CHAR_GRAMS, WORD_GRAMS = (3, 5), (1, 2)
KINDS = len(CHAR_GRAMS) + len(WORD_GRAMS)
BUCKET_BITS = 18
#: Sums run over texts of up to so many bytes together; a longer one is taken alone.
CHUNK = 1 << 20
#: Of these so many bytes are laid out at once, as arrays take a multiple of them.
PIECE = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE + 1)
            factors = np.full(size, _BASE, dtype=np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors[1:] = _INVERSE
            self.down = np.multiply.accumulate(factors)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _bucket(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x2545F4914F6CDD1D & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def grams(data: np.ndarray, borders: np.ndarray, bits: int = BUCKET_BITS):
    """For each kind of gram (buckets, borders): buckets of all grams in text order and
    where each text's begin. ``borders`` has a text's first byte, and at last the end."""
    n = len(data)
    wide = data.astype(np.uint64) + np.uint64(1)
    for size in CHAR_GRAMS:
        if n < size:
            yield np.empty(0, np.int64), np.zeros(len(borders), np.int64)
            continue
        h = wide[: n - size + 1].copy()
        for k in range(1, size):
            h *= np.uint64(0x100000001B3)
            h += wide[k : n - size + 1 + k]
        at = np.arange(len(h))
        owner_end = np.repeat(borders[1:], np.diff(borders))[: len(h)]
        inside = at + size <= owner_end
        counts = np.maximum(np.diff(borders) - size + 1, 0)
        yield _bucket(h[inside], size, bits), np.concatenate([[0], np.cumsum(counts)])
    space = _SPACE[data]
    first = np.zeros(n, dtype=bool)
    first[borders[:-1][borders[:-1] < n]] = True
    starts = np.flatnonzero(~space & (first | np.concatenate([[True], space[:-1]])))
    last = np.concatenate([first[1:], [True]])
    ends = np.flatnonzero(~space & (last | np.concatenate([space[1:], [True]]))) + 1
    up, down = _powers.to(n + 1)
    running = np.concatenate([[np.uint64(0)], np.cumsum(wide * up[:n], dtype=np.uint64)])
    word = (running[ends] - running[starts]) * down[starts]
    at = np.searchsorted(starts, borders)
    yield _bucket(word, 101, bits), at
    pair = word[:-1] * np.uint64(0x100000001B3) + word[1:]
    ends_text = np.zeros(len(word), dtype=bool)
    ends_text[at[1:][at[1:] > at[:-1]] - 1] = True
    yield _bucket(pair[~ends_text[:-1]], 102, bits), np.concatenate([[0], np.cumsum(np.maximum(np.diff(at) - 1, 0))])


def runs(texts: list[bytes], size: int, low: int, end: int):
    """(first, end) of runs of texts of up to ``size`` bytes."""
    while low < end:
        high, n = low + 1, len(texts[low])
        while high < end and n + len(texts[high]) <= size:
            n += len(texts[high])
            high += 1
        yield low, high
        low = high


def chunks(texts: list[bytes]):
    """For each run of texts of up to ``CHUNK`` bytes, (first text, data, borders) of its
    pieces of up to ``PIECE``, laid out one after the other."""

    def pieces(low: int, end: int):
        for first, high in runs(texts, PIECE, low, end):
            some = texts[first:high]
            yield first, np.frombuffer(b"".join(some), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in some])])

    for low, end in runs(texts, CHUNK, 0, len(texts)):
        yield pieces(low, end)


def mean_weights(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """For each text, the sum over kinds of the mean weight of its grams."""
    bits = int(np.log2(len(weights)))
    out = np.zeros(len(texts))
    for pieces in chunks(texts):
        sums = [0.0] * KINDS  # run on over the pieces
        for low, data, borders in pieces:
            for kind, (buckets, at) in enumerate(grams(data, borders, bits)):
                running = np.cumsum(np.concatenate([[sums[kind]], weights[buckets]]), dtype=np.float64)
                sums[kind] = running[-1]
                counts = np.diff(at)
                out[low : low + len(counts)] += np.diff(running[at]) / np.maximum(counts, 1)
    return out


def rows_of(texts: list[bytes], bits: int = BUCKET_BITS, scale: float = 1.0) -> list[tuple]:
    """The same features, times ``scale``, as sparse rows in parts of some texts and one
    kind: (first text, buckets of each, buckets, values), buckets of a text once per kind."""
    parts: list[tuple] = []
    for pieces in chunks(texts):
        kinds: list[list[tuple]] = [[] for _ in range(KINDS)]
        for low, data, borders in pieces:
            for kind, (buckets, at) in zip(kinds, grams(data, borders, bits)):
                counts = np.diff(at)
                owner = np.repeat(np.arange(len(counts)), counts)
                key, n = np.unique(owner << bits | buckets, return_counts=True)
                r = key >> bits
                val = (n / counts[r]).astype(np.float32) * np.float32(scale)
                kind.append((low, np.bincount(r, minlength=len(counts)), (key & (1 << bits) - 1).astype(np.int32), val))
        parts += [x for kind in kinds for x in kind]
    return parts


def fit_logistic(parts: list[tuple], label, weight, dim: int, l2: float = 1e-6, steps: int = 40) -> tuple[np.ndarray, float]:
    """Weights and bias of a weighted logistic regression by L-BFGS over the parts of
    ``rows_of``, so that what a step takes besides them is that of one part. Only columns
    that occur take part."""
    occurs = np.zeros(dim, dtype=bool)
    for _, _, col, _ in parts:
        occurs[col] = True
    used = np.flatnonzero(occurs)
    n, d = len(label), len(used)
    sign = np.where(label > 0, 1.0, -1.0)
    weight = weight / weight.sum()

    def value(w):
        full, z, sums = np.zeros(dim), np.zeros(n), np.zeros(dim)
        full[used] = w[:d]
        for low, sizes, col, val in parts:
            np.add.at(z, np.repeat(np.arange(low, low + len(sizes)), sizes), val * full[col])
        z += w[d]
        m = sign * z
        loss = (weight * np.logaddexp(0, -m)).sum() + 0.5 * l2 * (w[:d] @ w[:d])
        g = -weight * sign / (1 + np.exp(np.clip(m, -500, 500)))
        for low, sizes, col, val in parts:
            np.add.at(sums, col, val * np.repeat(g[low : low + len(sizes)], sizes))
        grad = np.empty(d + 1)
        grad[:d] = sums[used] + l2 * w[:d]
        grad[d] = g.sum()
        return loss, grad

    w = minimise(value, np.zeros(d + 1), steps)
    full = np.zeros(dim, dtype=np.float32)
    full[used] = w[:d]
    return full, float(w[d])


def minimise(value, w: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving."""
    loss, grad = value(w)
    pairs: list[tuple] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y, rho in reversed(pairs):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * y
        if pairs:
            s, y, rho = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(np.linalg.norm(q), 1e-12)
        for (s, y, rho), a in zip(pairs, reversed(alphas)):
            q += (a - rho * (y @ q)) * s
        step, slope = 1.0, grad @ q
        if slope <= 1e-18:
            break
        while step > 1e-10:
            new, new_grad = value(w - step * q)
            if new <= loss - 1e-4 * step * slope:
                break
            step *= 0.5
        else:
            break
        s, y = -step * q, new_grad - grad
        if s @ y > 1e-18:
            pairs = [*pairs[-memory + 1 :], (s, y, 1.0 / (s @ y))]
        w, done, loss, grad = w + s, loss - new < 1e-7 * max(abs(loss), 1e-9), new, new_grad
        if done:
            break
    return w


def fit_platt(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is a calibrated probability."""
    scale = max(float(np.std(score)), 1e-9)
    sign, weight = np.where(label > 0, 1.0, -1.0), weight / weight.sum()

    def value(w):
        m = sign * (w[0] * score / scale + w[1])
        g = -weight * sign / (1 + np.exp(np.clip(m, -500, 500)))
        return (weight * np.logaddexp(0, -m)).sum() + 1e-3 * w[0] ** 2, np.array([(g * score / scale).sum() + 2e-3 * w[0], g.sum()])

    a, b = minimise(value, np.array([1.0, 0.0]), 100)
    return float(a / scale), float(b)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
