"""Secret scans: fixed patterns, and a character convolutional network over candidates.

Fixed patterns find assignments, access keys and hexadecimal runs. Beside them, every
long run of key characters that has a letter is a candidate: a small network reads its
characters and those around it, and flags it from a threshold on that keeps a given recall
on labelled findings held back from training. A candidate of any length is read, in
windows, and what a fixed pattern covers of it does not hide the rest. Texts are scanned
whole, in Arrow batches where they lie.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import giving_back, python_ready, texts_of
from corpusflow.llm.hashing import fit_platt, sigmoid

#: The fixed patterns, with the least length of the whole match or of its second group.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "model")

CANDIDATE_LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{14,}[A-Za-z0-9+/_=-]")
_LETTER = re.compile(r"[A-Za-z]")

#: Parts of the long words that are no keys.
SYLLABLES = """the er ing on ed an es re con pro tion ment able ver un in com per sub trans port form act graph
    schaft keit ung lich zeit haus land gesell fahrt stadt wirt ein auf aus ge ent arbeit frei strasse
    eau eux ille aire tre ché ment que ance oir pour mais entre dad ción mente ar os as ado ente mar sol
    data get set user name file list test item node type value index table string count""".replace("ché", "che").replace("ción", "cion").split()

#: Characters of a window: before, of and behind the candidate, and its steps.
BEFORE, INSIDE, BEHIND, STRIDE = 24, 48, 12, 32
WIDTH = BEFORE + INSIDE + BEHIND
ALPHABET = {c: i + 2 for i, c in enumerate(string.printable[:95])}
CODES = len(ALPHABET) + 2  # 0: nothing there, 1: another character
EMBED, CONV, FILTERS, HIDDEN = 10, 5, 20, 16
#: Labelled findings made for training, the part held back, and the recall kept there.
FINDINGS, HELD_BACK, RECALL = 3000, 4, 0.98


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Codes of a candidate and its surroundings, a window for every ``STRIDE`` of it."""
    out = []
    for low in range(start, max(start + 1, end - INSIDE + STRIDE), STRIDE):
        high = min(end, low + INSIDE)
        row = np.zeros(WIDTH, dtype=np.int64)
        left = text[max(0, low - BEFORE) : low]
        row[BEFORE - len(left) : BEFORE] = [ALPHABET.get(c, 1) for c in left]
        row[BEFORE : BEFORE + high - low] = [ALPHABET.get(c, 1) for c in text[low:high]]
        right = text[high : high + BEHIND]
        row[BEFORE + INSIDE : BEFORE + INSIDE + len(right)] = [ALPHABET.get(c, 1) for c in right]
        out.append(row)
    return out


_SPOTS = WIDTH - CONV + 1
_PARTS = [slice(0, BEFORE), slice(BEFORE, BEFORE + INSIDE - CONV + 1), slice(BEFORE + INSIDE - CONV + 1, _SPOTS)]


class Network:
    """Embedding, one convolution, the largest answer before, inside and behind the
    candidate, a hidden layer, and a logit."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.3, (CODES, EMBED)),
            "conv": r.normal(0, (2 / (CONV * EMBED)) ** 0.5, (CONV * EMBED, FILTERS)),
            "conv_b": np.zeros(FILTERS),
            "hidden": r.normal(0, (2 / (3 * FILTERS)) ** 0.5, (3 * FILTERS, HIDDEN)),
            "hidden_b": np.zeros(HIDDEN),
            "out": r.normal(0, 0.3, HIDDEN),
            "out_b": np.zeros(1),
        }

    def forward(self, x: np.ndarray):
        p = self.p
        e = p["embed"][x]
        cols = np.concatenate([e[:, k : k + _SPOTS] for k in range(CONV)], axis=2)
        answer = cols @ p["conv"] + p["conv_b"]
        best = [answer[:, part].argmax(axis=1) + part.start for part in _PARTS]
        rows = np.arange(len(x))[:, None]
        pooled = np.concatenate([answer[rows, b, np.arange(FILTERS)] for b in best], axis=1)
        active = np.maximum(pooled, 0)
        hidden = active @ p["hidden"] + p["hidden_b"]
        logit = np.maximum(hidden, 0) @ p["out"] + p["out_b"][0]
        return logit, (x, cols, best, pooled, active, hidden)

    def backward(self, g: np.ndarray, kept) -> dict[str, np.ndarray]:
        x, cols, best, pooled, active, hidden = kept
        p, grad = self.p, {}
        on = np.maximum(hidden, 0)
        grad["out"], grad["out_b"] = on.T @ g, np.array([g.sum()])
        gh = np.outer(g, p["out"]) * (hidden > 0)
        grad["hidden"], grad["hidden_b"] = active.T @ gh, gh.sum(axis=0)
        gp = (gh @ p["hidden"].T) * (pooled > 0)
        ga = np.zeros((len(x), _SPOTS, FILTERS))
        rows = np.arange(len(x))[:, None]
        for k, b in enumerate(best):
            ga[rows, b, np.arange(FILTERS)] += gp[:, k * FILTERS : (k + 1) * FILTERS]
        flat = ga.reshape(-1, FILTERS)
        grad["conv"], grad["conv_b"] = cols.reshape(-1, cols.shape[2]).T @ flat, flat.sum(axis=0)
        gc = (flat @ p["conv"].T).reshape(len(x), _SPOTS, CONV, EMBED)
        ge = np.zeros((len(x), WIDTH, EMBED))
        for k in range(CONV):
            ge[:, k : k + _SPOTS] += gc[:, :, k]
        grad["embed"] = np.zeros_like(p["embed"])
        np.add.at(grad["embed"], x.ravel(), ge.reshape(-1, EMBED))
        return grad

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 3e-3, seed: int = 11):
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for low in range(0, len(order), batch):
                at = order[low : low + batch]
                logit, kept = self.forward(x[at])
                grad = self.backward((sigmoid(logit) - y[at]) / len(at), kept)
                step += 1
                for k, g in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


@dataclass
class SecretModel:
    network: Network
    slope: float
    shift: float
    threshold: float

    def score(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """Calibrated probability of each candidate: the greatest of its windows'."""
        parts = [windows(text, a, b) for a, b in spans]
        flat = np.stack([w for ws in parts for w in ws])
        logit = np.concatenate([self.network.forward(flat[i : i + 512])[0] for i in range(0, len(flat), 512)])
        first = np.cumsum([0, *(len(ws) for ws in parts[:-1])])
        return sigmoid(self.slope * np.maximum.reduceat(logit, first) + self.shift)


def fit(findings: list[tuple[str, int, int, int]], recall: float = RECALL) -> SecretModel:
    """A model from labelled findings (text, start, end, 1 if a secret)."""
    x = np.stack([windows(t, a, b)[0] for t, a, b, _ in findings])
    y = np.array([label for *_, label in findings], dtype=np.float64)
    held = np.arange(len(x)) % HELD_BACK == 0
    network = Network()
    network.fit(x[~held], y[~held])
    logit = network.forward(x[held])[0]
    slope, shift = fit_platt(logit, y[held], np.ones(held.sum()))
    good = np.sort(sigmoid(slope * logit + shift)[y[held] > 0])
    threshold = float(good[int((1 - recall) * len(good))]) if len(good) else 0.5
    return SecretModel(network, slope, shift, max(threshold, 0.5))


def example_findings(n: int = FINDINGS, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """Labelled findings by rule: keys of many makes behind words that announce them, and
    what only looks like keys: addresses, versions, numbers, file names, times, ids, long
    words and names of several words. Keys without a digit are among them."""
    r = random.Random(seed)
    alnum, upper, lower, hexa = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase, "0123456789abcdef"

    def some(chars: str, low: int, high: int) -> str:
        return "".join(r.choice(chars) for _ in range(r.randint(low, high)))

    def word() -> str:
        return some(lower, 2, 9)

    def prose(k: int) -> str:
        return " ".join(word() for _ in range(k))

    def real() -> str:
        return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))

    def names(low: int, high: int) -> list[str]:
        return [real() for _ in range(r.randint(low, high))]

    def key() -> str:
        return r.choice([
            lambda: r.choice(["sk-", "pk_live_", "ghp_", "gho_", "xoxb-", "glpat-", "npm_", "AIza", "key-", "SG."]) + some(alnum + "_-", 20, 48),
            lambda: some(alnum + "+/", 30, 64) + r.choice(["", "=", "=="]),
            lambda: some(hexa, 20, 64),
            lambda: some(upper, 18, 40),
            lambda: "eyJ" + some(alnum + "_-", 15, 40) + "." + some(alnum + "_-", 15, 40) + "." + some(alnum + "_-", 15, 40),
            lambda: some(alnum, 16, 48),
            lambda: some(string.ascii_letters, 16, 40),
        ])()

    def harmless() -> str:
        return r.choice([
            lambda: word() + "." + word() + str(r.randint(1, 99)) + "." + r.choice(["example.com", "example.org", "example.net"]),
            lambda: "v" + ".".join(str(r.randint(0, 400)) for _ in range(3)) + "-" + word() + "." + str(r.randint(0, 99)) + "-" + word(),
            lambda: "-".join([word(), word(), str(r.randint(1900, 2030)), word(), word()]),
            lambda: "/".join([word(), word(), word() + str(r.randint(0, 99)), word() + "." + r.choice(["py", "html", "txt", "png"])]),
            lambda: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}-{r.randint(10, 59)}-{r.randint(10, 59)}Z",
            lambda: "_".join(word() for _ in range(4)) + str(r.randint(0, 9)),
            lambda: "".join(r.choice(["th", "er", "ing", "on", "ed", "an", "es"]) for _ in range(9)) + str(r.randint(0, 999)),
            lambda: word() + "=" + word() + str(r.randint(1, 500)) + "=" + word() + word(),
            lambda: "".join(r.choice(SYLLABLES) for _ in range(r.randint(6, 12))),
            lambda: r.choice("_-/.=+").join(names(3, 7)),
            lambda: "".join(w.capitalize() for w in names(3, 7)),
            lambda: (w := names(3, 7))[0] + "".join(x.capitalize() for x in w[1:]),
            lambda: r.choice(["", "_", "-", "/"]).join(names(3, 7)).upper(),
            lambda: "/" + "/".join(names(2, 5)) + "." + r.choice(["py", "html", "txt", "png", "jpeg", "java"]),
            lambda: r.choice(["--", "---", "==", "____"]).join([real().capitalize(), real() + real(), real() + real()]),
            lambda: "page" + str(r.randint(1, 90)) + "-" + word() + "-" + word() + word(),
        ])()

    out = []
    while len(out) < n:
        label = int(r.random() < 0.5)
        value = key() if label else harmless()
        if len(value) < CANDIDATE_LEAST or not _LETTER.search(value):
            continue
        cue = r.choice(["key: ", 'auth = "', "credential=", "Authorization: Bearer ", "export KEY=", "pwd '", "private_key: ", ""]) if label else r.choice(["see ", "from ", "at ", "file ", "https://", "release ", "id ", "", '"'])
        left = prose(r.randint(0, 8)) + r.choice([" ", "\n", "; "]) + cue
        right = r.choice(['"', "'", "", ""]) + r.choice([" ", "\n", ", ", "."]) + prose(r.randint(0, 6))
        out.append((left + value + right, len(left), len(left) + len(value), label))
    return out


@functools.cache
def default_model() -> SecretModel:
    """The model of the findings above; they are fixed, so one per process serves."""
    return fit(example_findings())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's place) by the fixed patterns, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def uncovered(start: int, end: int, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of start:end that no span of ``taken`` covers, which are in order."""
    parts, at = [], start
    for a, b, _ in taken:
        if a < end and b > at:
            if a > at:
                parts.append((at, a))
            at = b
    return [*parts, (at, end)] if at < end else parts


def model_spans(text: str, taken: list[tuple[int, int, int]], model: SecretModel) -> list[tuple[int, int, int]]:
    """What the network flags of candidates and no fixed pattern's span covers.

    A part beside such a span is scored by itself if it is as long as a candidate. A
    shorter one belongs to the key around it if the network flags the whole run, but not
    where it is the name in front of an assignment or of a value.
    """
    found: list[tuple[int, int]] = []  # what is scored, and which part that decides on
    parts: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        near = [s for s in taken if s[0] < b and a < s[1]] if taken else []
        for low, high in uncovered(a, b, near) if near else [(a, b)]:
            whole = high - low >= CANDIDATE_LEAST
            named = not whole and (text[high - 1] == "=" or any(s[0] == high and s[2] == 0 for s in near))
            if not named and _LETTER.search(text, low if whole else a, high if whole else b):
                found.append((low, high) if whole else (a, b))
                parts.append((low, high))
    if not found:
        return []
    score = model.score(text, found)
    return [(a, b, 3) for (a, b), p in zip(parts, score.tolist()) if p >= model.threshold]


def spans_of(text: str, model: SecretModel) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(spans of the fixed patterns, all spans) of a whole text. Both scans look only into
    texts that have a long word, or a keyword."""
    if any(len(w) >= CANDIDATE_LEAST for w in text.split()):
        base = base_spans(text)
        return base, sorted([*base, *model_spans(text, base, model)], key=lambda s: (s[0], s[2]))
    low = text.lower()
    base = base_spans(text) if any(k in low for k in KEYWORDS) or "AKIA" in text else []
    return base, base


def said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, model: SecretModel | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_model, base_sha256, spans, findings`` of each row.

    ``spans`` are kind:start:end in code points, ``findings`` the same as structs with the
    text found. Null and empty texts have none. Rows with null or repeated ids are rows
    like any other; other columns are not read.
    """
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model or default_model())
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    finding = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, values = [], []
            for texts in texts_of(batch.column(1)):
                some = [spans_of(t, shared.value) for t in texts]
                both += some
                values += [[t[a:b] for a, b, _ in every] for t, (_, every) in zip(texts, some)]
            counts = [[sum(s[2] == k for s in every) for k in range(4)] for _, every in both]
            columns = [
                batch.column(0),
                *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)),
                pa.array([hashlib.sha256(said(base).encode()).hexdigest() for base, _ in both], pa.string()),
                pa.array([said(every) for _, every in both], pa.string()),
                pa.array([[{"kind": KINDS[k], "start": a, "end": b, "value": v} for (a, b, k), v in zip(every, found)] for found, (_, every) in zip(values, both)], pa.list_(finding)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans", "findings"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, findings array<struct<kind:string,start:long,end:long,value:string>>")


def redact(docs: DataFrame, model: SecretModel | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The rows with every found span replaced by ``mark``, overlapping ones by one mark;
    a column ``n_chars`` follows the text if it is there. Texts without a span, null ones
    too, stay as they are."""
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model or default_model())
    at = docs.columns.index("text")

    def clean(text: str | None) -> str | None:
        spans = spans_of(text, shared.value)[1] if text else []
        if not spans:
            return text
        out, upto = [], 0
        for a, b, _ in spans:
            if a >= upto:
                out += [text[upto:a], mark]
            upto = max(upto, b)
        return "".join([*out, text[upto:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            parts = (columns[at].slice(low, 512).to_pylist() for low in range(0, batch.num_rows, 512))
            columns[at] = pa.array([clean(t) for texts in parts for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    cleaned = docs.mapInArrow(giving_back(run), docs.schema)
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(count))
    return cleaned
