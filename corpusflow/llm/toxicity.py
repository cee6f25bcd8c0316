"""Toxicity by a weighted finite-state grammar of clauses.

Words are mapped to symbols: insults, threats, targets, negations and words of reporting.
Small transducers over these symbols rewrite what stands within reach of another symbol:
an insult near a target becomes a targeted one, one behind a negation a negated one, one
in reported speech a reported one, and a target behind a threat a threat against someone.
German, French and Spanish put the object before an infinitive, so a threat behind an
object form of its language is a threat against someone as well.
Their composition is one machine that reads a clause from left to right and gives its
matches, each with the weight of its words and of its kind.

Insults are the fixed list below, words and word starts learned from labelled texts, the
latter only where no ordinary word begins that way. Over the clauses of a text one more
machine tells the first lone insult from those that pile up behind it. The weights of
kinds are learned from the same texts within bounds that keep their order: one lone
insult, or negated and reported ones, never make a text toxic, while one insult at a
target or one threat does. Texts are scored whole, in Arrow batches where they lie;
nothing is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import fold_of, giving_back, labelled_sample, python_ready, texts_of, warn_of_missing_class
from corpusflow.llm.hashing import minimise, sigmoid
from corpusflow.llm.simhash import fingerprint

#: From this score on a text is toxic.
TOXIC_FROM = 0.7
#: Clean and toxic labelled texts that the model learns from, and of how many characters
#: of each.
PER_CLASS, LONGEST = (6000, 1500), 20_000
#: A learned stem: lengths of word starts, texts it must occur in, its least log odds.
STEMS, STEM_TEXTS, STEM_ODDS = range(4, 11), 8, 3.5
#: Least letters of a learned whole word.
WORD_LETTERS = 4
MEMO_ENTRIES = 400_000

#: Words of the grammar, plain lists in four languages.
INSULTS = """idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown
    imbecile cretin bastard asshole dickhead jackass halfwit scumbag vermin
    idioten dumm dummkopf arschloch abschaum widerlich erbärmlich wertlos versager trottel
    idiote imbécile connard crétin abruti ordure minable dégoûtant
    idiota imbécil estúpido estúpida cabrón basura patético asqueroso inútil""".split()
THREATS = "kill hurt destroy shoot beat burn stab strangle murder smash töten umbringen schlagen erschießen".split()
ROMANCE_THREATS = "tuer frapper détruire brûler matar golpear destruir quemar".split()
TARGETS = """you your youre yourself he she they them him her people everyone du dich dir ihr euch sie
    tu toi te vous ils elles vosotros ustedes usted ellos ellas tú""".split()
#: Forms that are objects before a threat: German ones, those of French and Spanish, and
#: the French one that is an object only right before the infinitive. Spanish "os" is an
#: English and a French word too, so it serves for nothing else.
OBJECTS, ROMANCE_OBJECTS, NEXT_OBJECTS, ONLY_OBJECTS = ["dich", "euch"], ["te"], ["vous"], ["os"]
NEGATIONS = "not no never isnt arent wasnt dont doesnt nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = """said says say called calls wrote writes claimed claims quoted quotes according allegedly reported
    sagte sagt nannte schrieb laut dit disait écrit appelé selon dijo dice escribió llamó según""".split()
#: Weight of a listed insult, until labelled texts say otherwise, and of a threat.
LISTED = 3.0

OTHER, TARGET, OBJECT, ROMANCE_OBJECT, NEXT_OBJECT, ONLY_OBJECT, NEGATION, REPORT, THREAT, ROMANCE_THREAT, INSULT = range(11)
SYMBOLS = "OTDEVSNRHLI"
#: What the grammar finds.
KINDS = ("I", "II", "It", "In", "Ir", "HT", "Hn", "Hr")
CLAUSE_END = 16
_EDGE = re.compile(r"^\W+|\W+$")


class Transducer:
    """A machine that reads symbols one by one and gives one for each."""

    def __init__(self, step, start=0):
        self.step, self.start = step, start

    def __matmul__(self, other: Transducer) -> Transducer:
        """First this machine, then the other over what it gives."""

        def step(state, symbol):
            mine, symbol = self.step(state[0], symbol)
            theirs, symbol = other.step(state[1], symbol)
            return (mine, theirs), symbol

        return Transducer(step, (self.start, other.start))

    def table(self, symbols: str) -> list[list[tuple[int, str]]]:
        """The machine written out over its reachable states: table[state][symbol]."""
        states, rows, at = {self.start: 0}, [], 0
        order = [self.start]
        while at < len(order):
            row = []
            for s in symbols:
                to, out = self.step(order[at], s)
                if to not in states:
                    states[to] = len(order)
                    order.append(to)
                row.append((states[to], out))
            rows.append(row)
            at += 1
        return rows


def within(triggers: str, change: dict[str, str], reach: int, far: dict[str, str] | None = None, more: int = 0) -> Transducer:
    """Rewrites symbols that stand within ``reach`` words behind one of the triggers, and
    those of ``far`` within ``more`` words beyond."""
    set_off, far = frozenset(triggers), far or {}

    def step(left: int, symbol: str):
        out = change.get(symbol, symbol) if left > more else symbol
        out = far.get(symbol, out) if left else out
        return (reach + more if symbol in set_off else max(left - 1, 0)), out

    return Transducer(step)


def object_first(reach: int) -> Transducer:
    """Rewrites threats that stand within ``reach`` words behind an object form of their
    language, and right behind one that must stand next to them."""
    threat = {"D": "H", "E": "L", "S": "L", "V": "L"}

    def step(state: tuple[str, int], symbol: str):
        verb, left = state
        out = "TH" if left and symbol == verb else symbol
        if symbol in threat:
            return (threat[symbol], 1 if symbol == "V" else reach), out
        return (verb, left - 1) if left > 1 else ("", 0), out

    return Transducer(step, ("", 0))


#: A negation stands before the object, as in "no te voy a matar", so it reaches further.
GRAMMAR = (
    within("HL", dict.fromkeys("TDEV", "HT"), 4)
    @ object_first(4)
    @ within("TDEV", {"I": "It"}, 4)
    @ within("N", {"I": "In", "It": "In", "HT": "Hn"}, 3, {"TH": "Hn"}, 2)
    @ within("R", {"I": "Ir", "It": "Ir", "HT": "Hr", "TH": "Hr"}, 8)
    @ Transducer(lambda state, symbol: (state, "HT" if symbol == "TH" else symbol))
)
_TABLE = GRAMMAR.table(SYMBOLS)
#: Over all clauses of a text: lone insults behind the first one pile up.
_PILE = Transducer(lambda seen, kind: (seen or kind == "I", "II" if seen and kind == "I" else kind), False).table(KINDS)


#: Log odds by which the bounds of kinds stay clear of the threshold.
CLEAR = 0.3


def bounds(bias: float, toxic_from: float = TOXIC_FROM) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest weight of each kind over ``bias``. A kind's feature is
    ``log1p`` of the weight of its matches: of a listed word ``LISTED``, of no word more
    than twice that."""
    threshold = math.log(toxic_from / (1 - toxic_from))
    below, above = threshold - CLEAR - bias, threshold + CLEAR - bias
    one, strongest, many = math.log1p(LISTED), math.log1p(2 * LISTED), math.log1p(20 * LISTED)
    least = {"It": above / one, "HT": above / one}
    greatest = {"I": below / strongest, "II": 2 * above / one, "It": 2 * above / one, "HT": 2 * above / one,
                "In": below / many, "Ir": below / many, "Hr": below / many}
    return np.array([least.get(k, 0.0) for k in KINDS]), np.array([greatest.get(k, 0.0) for k in KINDS])


@dataclass
class ToxicityModel:
    """Weights of insult words and stems, and of the kinds of matches."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, LISTED))
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -3.0
    kinds: np.ndarray = field(default_factory=lambda: sum(bounds(-3.0)) / 2)

    def insult(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        return max([found, *(self.stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n)])


class Reader:
    """Features of texts under a model; symbols of words are kept in a bounded memo."""

    _FIXED = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT), **dict.fromkeys(THREATS, THREAT), **dict.fromkeys(ROMANCE_THREATS, ROMANCE_THREAT),
              **dict.fromkeys(OBJECTS, OBJECT), **dict.fromkeys(ROMANCE_OBJECTS, ROMANCE_OBJECT), **dict.fromkeys(NEXT_OBJECTS, NEXT_OBJECT), **dict.fromkeys(ONLY_OBJECTS, ONLY_OBJECT)}

    def __init__(self, model: ToxicityModel):
        self.model, self.codes = model, {}

    def code(self, token: str) -> int:
        """Symbol of a token, with a mark where a clause ends behind it."""
        word = _EDGE.sub("", token).replace("'", "").replace("’", "")
        symbol = INSULT if self.model.insult(word) > 0 else self._FIXED.get(word, OTHER)
        code = symbol | (CLAUSE_END if token[-1] in ".!?;:" else 0)
        if len(self.codes) >= MEMO_ENTRIES:
            self.codes.clear()
        if len(token) <= 64:
            self.codes[token] = code
        return code

    def matches(self, text: str) -> dict[str, float]:
        """Weight of what the grammar finds, by kind, over all clauses of the text."""
        tokens = text.lower().split()
        known = self.codes.get
        codes = np.array([c if (c := known(t)) is not None else self.code(t) for t in tokens], dtype=np.uint8)
        found: dict[str, float] = {}
        hits = np.flatnonzero((codes & 15) >= THREAT)
        if not len(hits):
            return found
        ends = np.flatnonzero(codes & CLAUSE_END)
        clauses = np.unique(np.searchsorted(ends, hits))
        piled = 0
        for k in clauses.tolist():
            low = int(ends[k - 1]) + 1 if k else 0
            high = int(ends[k]) + 1 if k < len(ends) else len(tokens)
            state = 0
            for i in range(low, high):
                state, out = _TABLE[state][codes[i] & 15]
                if out in KINDS:
                    piled, out = _PILE[piled][KINDS.index(out)]
                    weight = self.model.insult(_EDGE.sub("", tokens[i]).replace("'", "").replace("’", "")) if out[0] == "I" else LISTED
                    found[out] = found.get(out, 0.0) + weight
        return found

    def features(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(KINDS)))
        place = {k: i for i, k in enumerate(KINDS)}
        for n, text in enumerate(texts):
            for kind, weight in self.matches(text).items():
                out[n, place[kind]] = math.log1p(weight)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.features(texts) @ self.model.kinds + self.model.bias)


def apart(texts: list[str], bits: int = 8) -> np.ndarray:
    """Places of texts that are no near copies of earlier ones, which would count one
    text's words many times."""
    fps = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
    kept: list[int] = []
    held = np.empty(len(fps), dtype=np.uint64)
    for i, fp in enumerate(fps):
        if not len(kept) or np.bitwise_count(held[: len(kept)] ^ fp).min() > bits:
            held[len(kept)] = fp
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def ordinary_words(vocabulary: str) -> list[str]:
    """Whole words of a tokenizer file with word ends, in order: a vocabulary of general
    text, against which learned word starts are held."""
    with open(vocabulary, encoding="utf-8") as f:
        entries = json.load(f)["model"]["vocab"]
    return sorted(w for e in entries if e.endswith("</w>") and (w := e.removesuffix("</w>")).isalpha())


def begins_a_word(stem: str, ordinary: list[str]) -> bool:
    at = bisect_left(ordinary, stem)
    return at < len(ordinary) and ordinary[at].startswith(stem)


def learn_words(texts: list[str], labels: np.ndarray, ordinary: list[str] = []) -> tuple[dict[str, float], dict[str, float]]:
    """(weights of whole words, learned stems): log odds of texts with a word, smoothed,
    so that a few mislabelled texts don't hide it. A toxic text counts for a word only
    where the word has other neighbours than in earlier ones, so that passages which
    texts share count once.

    Listed insults weigh ``LISTED`` at least, unless labelled texts speak against them;
    other words count if they tell toxic texts apart. A stem is the shortest word start
    that does so and that none of the sorted ``ordinary`` words begins with.
    """
    counts = {0: Counter(), 1: Counter()}
    whole = {0: Counter(), 1: Counter()}
    total = np.bincount(labels, minlength=2)
    places: set[int] = set()
    asked = starts = None
    for text, label in sorted(zip(texts, labels.tolist()), key=lambda x: -x[1]):
        if not label and asked is None:  # of clean texts only what toxic ones say often
            asked = {w for w, n in whole[1].items() if n >= STEM_TEXTS}.union(INSULTS)
            starts = {s for s, n in counts[1].items() if n >= STEM_TEXTS}
        said = [_EDGE.sub("", t).replace("'", "").replace("’", "") for t in text.lower().split()]
        words = set(said)
        if label:
            met = [hash(place) for place in zip(["", *said], said, [*said[1:], ""])]
            words = {w for w, place in zip(said, met) if place not in places}
            places.update(met)
        begun = {w[:n] for w in words for n in STEMS if len(w) >= n}
        whole[label].update(words if label else words & asked)
        counts[label].update(begun if label else begun & starts)

    def odds(n1: int, n0: int) -> float:
        return math.log((n1 + 0.5) / (total[1] + 1)) - math.log((n0 + 0.5) / (total[0] + 1))

    known: dict[str, float] = {}
    for w in INSULTS:
        n1, n0 = whole[1][w], whole[0][w]
        told = odds(n1, n0) if n1 + n0 >= STEM_TEXTS else LISTED
        known[w] = max(LISTED, min(told, 2 * LISTED)) if told > 0 else 0.0
    for w, n1 in whole[1].items():
        if w not in known and len(w) >= WORD_LETTERS and n1 >= STEM_TEXTS and (told := odds(n1, whole[0][w])) >= STEM_ODDS:
            known[w] = min(told, 2 * LISTED)
    stems: dict[str, float] = {}
    for n in STEMS:
        for stem, n1 in counts[1].items():
            if len(stem) != n or n1 < STEM_TEXTS or any(stem[:k] in stems for k in STEMS if k < n):
                continue
            if (told := odds(n1, counts[0][stem])) >= STEM_ODDS and not begins_a_word(stem, ordinary):
                stems[stem] = min(told, 2 * LISTED)
    return known, stems


def fit(texts: list[str], labels: np.ndarray, share: float, ordinary: list[str] = []) -> ToxicityModel:
    """Learn words and stems, then the weights of kinds within their bounds. ``share`` is
    the part of toxic rows among all labelled ones. The bias is the log odds of texts in
    which nothing is found, held between -6 and -2. Without texts of both classes the
    grammar's own weights serve, of which a warning tells."""
    model = ToxicityModel()
    if warn_of_missing_class(labels, "toxic"):
        return model
    own = apart(texts)
    model.words, model.stems = learn_words([texts[i] for i in own], labels[own], ordinary)
    x = Reader(model).features(texts)
    sign = np.where(labels > 0, 1.0, -1.0)
    weight = np.where(labels > 0, share / max(labels.sum(), 1), (1 - share) / max((1 - labels).sum(), 1))
    plain = ~x.any(axis=1)
    toxic, clean = weight[plain & (labels > 0)].sum(), weight[plain & (labels == 0)].sum()
    model.bias = float(np.clip(math.log((toxic + 1e-4) / (clean + 1e-4)), -6.0, -2.0))
    least, greatest = bounds(model.bias)

    def weights(u):
        return least + (greatest - least) * sigmoid(u)

    def value(u):
        m = sign * (x @ weights(u) + model.bias)
        inner = sigmoid(u)
        g = x.T @ (-weight * sign * sigmoid(-m)) * (greatest - least) * inner * (1 - inner)
        return (weight * np.logaddexp(0, -m)).sum() + 1e-4 * u @ u, g + 2e-4 * u

    model.kinds = weights(minimise(value, np.zeros(len(KINDS)), 200))
    return model


def train(
    docs: DataFrame, labels: DataFrame, vocabulary: str | None = None, per_class: tuple[int, int] = PER_CLASS, longest: int = LONGEST
) -> ToxicityModel:
    """Learn from a bounded sample of labelled rows outside the held-out fold: at most
    ``sum(per_class)`` texts, or blocks of ``longest`` characters of longer ones, come to
    the driver. ``vocabulary`` is a tokenizer file whose words are taken as ordinary ones;
    without it stems are not held against any."""
    open_labels = labels.where(fold_of(F.col("doc_id")) != 1)
    rows = labelled_sample(docs, open_labels, "toxic", per_class, longest).orderBy("doc_id").collect()
    seen = {r["toxic"]: r["count"] for r in open_labels.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    share = seen.get(1, 0) / max(sum(seen.values()), 1)
    ordinary = ordinary_words(vocabulary) if vocabulary else []
    return fit([r.text for r in rows], np.array([r.label for r in rows], dtype=np.int64), share, ordinary)


def score_documents(docs: DataFrame, model: ToxicityModel, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """``doc_id, score, predicted`` of each row. Null and empty texts have no match and
    get the score of such texts; very long ones are read whole, in time linear in their
    words. Equal texts score alike, rows with null or repeated ids are rows like any
    other, an empty table gives none, and other columns are not read."""
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            score = np.concatenate([np.empty(0), *map(reader.score, texts_of(batch.column(1)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= toxic_from).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The rows that score below ``toxic_from``, with all their columns."""
    spark = python_ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            score = np.concatenate([np.empty(0), *map(reader.score, texts_of(batch.column(at)))])
            yield batch.filter(pa.array(score < toxic_from))

    return docs.mapInArrow(giving_back(run), docs.schema)
