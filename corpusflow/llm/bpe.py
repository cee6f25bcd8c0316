"""BPE encoding and decoding by backtracking over longest token matches.

A byte-level vocabulary is given as the JSON text of a public tokenizer. An
Aho-Corasick automaton over all tokens lists the matches of a piece of text in one
pass, which gives the longest token at each position. The encoder takes the longest
token, and goes on as long as neighbouring tokens are *compatible*: merging their
joined bytes by rank would give these two tokens back. Where no token fits, it steps
back to a shorter one; a position found to be a dead end is never entered again, so
the time is linear in the text. The result is the merge sequence's own.

Decoding is a gather from one blob of token bytes through a table of offsets.

Texts repeat the same pieces over and over, so ids of pieces are kept in a memo of
bounded size; the encoder runs where the memo has no entry.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import python_ready

#: How the byte-level tokenizer cuts text before merging. Fixed value of the vocabulary.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space other than space, tab and line ends: its runs can reach over a chunk's edge.
RARE_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: A run of white space with the word after it. No piece reaches from a word into the
#: white space behind it, so chunks can be encoded one by one.
CHUNKS = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
MEMO_ENTRIES = 400_000
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for: printable
    Latin-1 characters for themselves, the other bytes in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, spec: bytes | str):
        import ahocorasick

        spec = json.loads(spec)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        token = [b""] * size
        for text, i in vocab.items():
            token[i] = bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            token[i] = text.encode()
        # the offset table
        self.lengths = np.array([len(t) for t in token], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.blob = np.frombuffer(b"".join(token), dtype=np.uint8)

        # merges: rank and result of a pair of ids; rank and halves of a merged id
        self.merged: dict[int, int] = {}
        self.rank = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.merged.setdefault(i << 32 | j, rank)
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = rank, i, j
        self.length = self.lengths.tolist()
        by_bytes = {token[i]: i for i in vocab.values() if len(token[i]) == 1 or self.rank[i] >= 0}
        self.automaton = ahocorasick.Automaton()
        for t, i in by_bytes.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        #: the longest token that is a proper prefix of a token, or -1
        self.shorter = [-1] * size
        for t, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_bytes), -1)
        self.fits: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge across the border of two tokens comes before the merges
        that make them.

        Beside the border stand, one after another, the tokens of a's right edge and
        of b's left edge. The walk goes back in time: it undoes the later of the two
        last merges, and looks at each pair that stood side by side. A merge of such a
        pair would have happened if its rank came before the merge that replaced
        either; between equal ranks the one further left is first.
        """
        key = a << 32 | b
        known = self.fits.get(key)
        if known is not None:
            return known
        x, y, until_x, until_y, fits = a, b, _NEVER, _NEVER, True
        while True:
            rank = self.merged.get(x << 32 | y)
            if rank is not None and rank < until_x and rank <= until_y:
                fits = False
                break
            if self.rank[x] < 0 and self.rank[y] < 0:
                break
            if self.rank[x] > self.rank[y]:
                until_x, x = self.rank[x], self.right[x]
            else:
                until_y, y = self.rank[y], self.left[y]
        if len(self.fits) >= MEMO_ENTRIES:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece: longest matches, checked pair by pair, with steps back."""
        n = len(piece)
        longest = [-1] * (n + 1)
        reach = [0] * (n + 1)
        length = self.length
        for end, i in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - length[i]
            if length[i] > reach[start]:
                reach[start], longest[start] = length[i], i
        open_at = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else -1
            while token >= 0 and not (open_at[at + length[token]] and (last < 0 or self.compatible(last, token))):
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at]
            elif last < 0:
                raise ValueError("the vocabulary lacks single bytes of this text")
            else:
                open_at[at] = False
                out.pop()
                at -= length[last]
                token = last
        return out

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
            if len(self.pieces) >= MEMO_ENTRIES:
                self.pieces.clear()
            if len(piece) <= 64:
                self.pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids = b"".join(map(self._piece, PIECES.findall(chunk)))
        if len(self.chunks) >= MEMO_ENTRIES:
            self.chunks.clear()
        if len(chunk) <= 64:
            self.chunks[chunk] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if RARE_SPACE.search(text):
            return b"".join(map(self._piece, PIECES.findall(text)))
        known, parts = self.chunks.get, []
        for chunk in CHUNKS.findall(text):
            parts.append(known(chunk) or self._chunk(chunk))
        return b"".join(parts)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens are found in the text."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(
            np.array([self.special[part]], dtype="<u4").tobytes() if part in self.special else self._plain(part)
            for part in self.cut.split(text)
        )

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        if not len(ids):
            return ""
        ids = np.asarray(ids, dtype=np.int64)
        size = self.lengths[ids]
        ends = np.cumsum(size)
        source = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - size), size)
        return self.blob[source].tobytes().decode("utf-8", "replace")


_ready: dict[bytes, Bpe] = {}


def bpe_of(spec: bytes) -> Bpe:
    """One encoder per vocabulary and process."""
    key = hashlib.sha256(spec).digest()
    if key not in _ready:
        _ready[key] = Bpe(spec)
    return _ready[key]


def read_spec(path: str) -> bytes:
    """A tokenizer file, read on the driver; executors need not have it."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, spec_path: str, keep_ids: bool = True) -> DataFrame:
    """Each row's ``doc_id`` with ``ids`` (array of int), ``n_tokens``, ``decoded`` and digests.

    Null texts count as empty; an empty text has no ids. Rows with null or repeated
    ``doc_id`` are rows like any other; other columns are not read. With
    ``keep_ids=False`` the ids and the decoded text stay in the worker and only their
    digests come out. Rows stay in their partitions; nothing is shuffled.
    """
    spark = python_ready(docs.sparkSession)
    spec = spark.sparkContext.broadcast(read_spec(spec_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        for batch in batches:
            counts, digests, back_digests, ids_out, back_out = [], [], [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                array = np.frombuffer(ids, dtype="<u4")
                back = bpe.decode(array)
                counts.append(len(array))
                digests.append(hashlib.sha256(ids).hexdigest())
                back_digests.append(hashlib.sha256(back.encode()).hexdigest())
                if keep_ids:
                    ids_out.append(array.astype(np.int32))
                    back_out.append(back)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back_digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(back_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id"), F.col("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + (", ids array<int>, decoded string" if keep_ids else ""))
