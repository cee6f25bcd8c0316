"""Packing documents into training windows by the sum-of-squares rule.

A document is its token ids and an end-of-text id. Whole windows are cut off first;
what is left is placed online: of all fill levels at which some window is open, and
the empty window, the one is taken that makes the sum of squared counts of partially
filled windows smallest. The counts are kept in an array by level, and the windows
open at a level in a stack, so memory is bounded by the number of levels that are in
use. A window whose fill is a power of two needs no padding and counts as finished for
the sum of squares, but can still be added to.

At the end of a partition the windows that would be padded are laid end to end and
cut anew, and the last rest is cut at powers of two, so a partition pads nothing
(``pad_powers=True``), or less than one window.

Each partition packs its own rows, in one pass over the text: nothing is shuffled, and
a partition that is run again gives the same pieces as long as its rows come in the
same order, as they do from files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.bpe import read_spec
from corpusflow.llm.common import python_ready

WINDOW = 2048
END_ID = 1
#: Words whose ids are kept, some 200 bytes each.
MEMO_ENTRIES = 600_000


class Ids:
    """Token ids of whole texts by the tokenizers library.

    The vocabulary drops white space, puts text in lower case and lets no token reach
    over white space, so the ids of a text are those of its words. Words repeat: their ids
    are kept, and the library is asked for new ones only, many at a time.
    ``across_space=True`` (a vocabulary that keeps white space) asks for whole texts.
    """

    #: A word that stands between asked ones, and marks that the vocabulary cuts off letters.
    BETWEEN, MARKS = "~", b".,!?;:#$%&*"

    def __init__(self, spec: bytes, across_space: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.across_space = across_space
        self.known: dict[bytes, bytes] = {}
        if not across_space:
            self.between = self._ask(self.BETWEEN)
            self.tails: dict[bytes, bytes] = {}

    def _ask(self, text: str) -> np.ndarray:
        # the fast form gives the same ids without places in the text
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    @staticmethod
    def _words(text: str) -> list[bytes]:
        raw = text.encode()
        # in lower case early, where neither special tokens nor marks above letters can
        # make a difference: it leaves fewer words to tell apart
        if "<|" not in text and (text.isascii() or _latin(text)):
            raw = raw.lower()
        return raw.split()

    def _ask_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        between = self.BETWEEN.encode()
        apart = [w for w in words if between in w]
        found = {w: self._ask(w.decode()).tobytes() for w in apart}
        if apart:
            words = [w for w in words if w not in found]
        for low in range(0, len(words), 2000):
            some = words[low : low + 2000]
            ids = self._ask(f" {self.BETWEEN} ".encode().join(some).decode())
            cuts = np.flatnonzero(ids == self.between[0])
            if len(self.between) != 1 or len(cuts) != len(some) - 1:
                found.update((w, self._ask(w.decode()).tobytes()) for w in some)
                continue
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            found.update((w, ids[a:b].tobytes()) for w, a, b in zip(some, starts, ends))
        return found

    def _new(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of unknown words; a run of marks behind a letter has its own."""
        marked = {w: b for w in words if (b := w.rstrip(self.MARKS))[-1:].isalpha() and len(b) < len(w)}
        bare = set(marked.values())
        found = {w: self.known[w] for w in bare if w in self.known}
        found |= self._ask_words(list((words - marked.keys()) | (bare - found.keys())))
        found |= {w: found[b] + self._tail(w[len(b) :]) for w, b in marked.items()}
        return found

    def _tail(self, marks: bytes) -> bytes:
        ids = self.tails.get(marks)
        if ids is None:
            ids = self._ask(marks.decode()).tobytes()
            if len(self.tails) < 10_000:
                self.tails[marks] = ids
        return ids

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.across_space:
            return [self._ask(t).tobytes() for t in texts]
        split = [self._words(t) for t in texts]
        get = self.known.get
        got = [list(map(get, words)) for words in split]
        new = {w for words, ids in zip(split, got) if None in ids for w, x in zip(words, ids) if x is None}
        if new:
            found = self._new(new)
            got = [[found[w] if x is None else x for w, x in zip(words, ids)] if None in ids else ids for words, ids in zip(split, got)]
            if len(self.known) + len(found) > MEMO_ENTRIES:
                self.known.clear()
            self.known.update(found)
        return [b"".join(ids) for ids in got]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Packer:
    """Open windows by fill level; a piece is (doc, start, length, ids, doc_tokens)."""

    def __init__(self, window: int = WINDOW, pad_powers: bool = True):
        self.window, self.pad_powers = window, pad_powers
        self.counts = np.zeros(window, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]
        levels = np.arange(window)
        self.free = (levels & (levels - 1)) == 0 if pad_powers else levels == 0
        self.free[0] = True
        self.opened = 0

    def _change(self, size: int) -> tuple[int, int]:
        """(level to place at, change of the sum of squares), the fullest of equals."""
        n, w = self.counts, self.window
        at = np.flatnonzero(n[: w - size + 1] > 0)
        at = np.concatenate([[0], at]) if not len(at) or at[0] else at
        leaves = np.where(self.free[at], 0, 1 - 2 * n[at])
        to = at + size
        inside = np.minimum(to, w - 1)
        joins = np.where((to == w) | self.free[inside], 0, 2 * n[inside] + 1)
        cost = leaves + joins
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return int(at[best]), int(cost[best])

    def place(self, piece: tuple) -> list | None:
        """Put a piece of less than a window in; the window if that made it full."""
        size = piece[2]
        level, _ = self._change(size)
        if level == 0:
            held: list = []
        else:
            held = self.open[level].pop()
            self.counts[level] -= 1
        held.append(piece)
        if level + size == self.window:
            return held
        self.open[level + size].append(held)
        self.counts[level + size] += 1
        return None

    def add(self, doc, ids: bytes, total: int) -> Iterator[list]:
        """Windows that a document fills."""
        whole = total // self.window * self.window
        for start in range(0, whole, self.window):
            yield [(doc, start, self.window, ids[4 * start : 4 * (start + self.window)], total)]
        if total > whole:
            full = self.place((doc, whole, total - whole, ids[4 * whole :], total))
            if full:
                yield full

    def finish(self) -> Iterator[list]:
        """The windows still open: those that need no padding as they are, the others
        laid end to end and cut anew."""
        rest = []
        for level in range(1, self.window):
            for held in self.open[level]:
                if self.free[level]:
                    yield held
                else:
                    rest.extend(held)
        left = sum(p[2] for p in rest)
        target, held, filled = 0, [], 0
        for doc, start, length, ids, total in rest:
            while length:
                if not target:
                    target = self.window if left >= self.window or not self.pad_powers else 1 << (left.bit_length() - 1)
                take = min(length, target - filled)
                held.append((doc, start, take, ids[: 4 * take], total))
                doc, start, length, ids = doc, start + take, length - take, ids[4 * take :]
                filled, left = filled + take, left - take
                if filled == target:
                    yield held
                    target, held, filled = 0, [], 0
        if held:
            yield held


def pack_documents(
    docs: DataFrame,
    spec_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    across_space: bool = False,
    pad_powers: bool = True,
    keep_ids: bool = True,
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    and, with ``keep_ids``, the piece's ``ids``.

    Null and empty texts are documents of the end id alone. Rows with null or repeated
    ``doc_id`` are packed like any other; other columns are not read. An empty table
    gives no rows. A sequence's number is its partition's, shifted by 40 bits, plus its
    place there.
    """
    spark = python_ready(docs.sparkSession)
    spec = spark.sparkContext.broadcast(read_spec(spec_path))
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col("doc_id"), F.col("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids_of(spec.value, across_space)
        packer = Packer(window, pad_powers)
        base, made = TaskContext.get().partitionId() << 40, 0
        id_type = None

        def batch_of(windows: list[list]) -> pa.RecordBatch:
            nonlocal made
            out: list[tuple] = []
            for held in windows:
                at = 0
                for doc, start, length, ids, total in held:
                    out.append((doc, start, length, zlib.crc32(ids), total, base + made, at, ids))
                    at += length
                made += 1
            columns = [pa.array([r[0] for r in out], id_type), *(pa.array([r[k] for r in out], pa.int64()) for k in range(1, 7))]
            if keep_ids:
                columns.append(pa.array([np.frombuffer(r[7], "<u4").astype(np.int32) for r in out], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * keep_ids)

        for batch in batches:
            id_type = batch.schema.field(0).type
            doc_ids = batch.column(0).to_pylist()
            for low in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(low, 256).to_pylist()]
                full = []
                for doc, ids in zip(doc_ids[low : low + 256], ids_of.of(texts)):
                    ids += end
                    full.append(packer.add(doc, ids, len(ids) // 4))
                yield batch_of(list(chain.from_iterable(full)))
        if id_type is not None:
            yield batch_of(list(packer.finish()))

    return rows.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


_ready: dict[int, Ids] = {}


def _ids_of(spec: bytes, across_space: bool) -> Ids:
    key = hash((spec, across_space))
    if key not in _ready:
        _ready[key] = Ids(spec, across_space)
    return _ready[key]
