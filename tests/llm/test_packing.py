"""Packing: every id in one piece, gapless windows, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import awkward, nothing

from corpusflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, ids_of, window=2048):
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for doc, pieces in docs.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids_of[doc])
            part = np.array(ids_of[doc][p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids_of[doc])
    padded = 0
    for pieces in windows.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded


def test_against_the_library(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = Tokenizer.from_file(PATH)
    ids_of = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    rows = packing.pack_documents(docs.repartition(3), PATH).collect()
    assert check(rows, ids_of) == 0
    assert all(list(r.ids) == ids_of[r.doc_id][r.start : r.start + r.length] for r in rows)
    plain = packing.pack_documents(docs.repartition(3), PATH, pad_powers=False).collect()
    check(plain, ids_of)
    fills = defaultdict(int)
    for r in plain:
        fills[r.sequence_id] += r.length
    assert sum(f < 2048 for f in fills.values()) <= 3  # one a partition


def test_words_are_the_librarys(spark):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(PATH), packing.Ids(packing.read_spec(PATH))
    rnd = random.Random(1)
    letters = "ab eE'st're  \n\t\x0b\x1c\x85\xa0 　1٣éßñİH̱K漢字😀!?-_~.,"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|ENDOFTEXT|>", "it's, they'll. ~ ~~ ~", "A.B.C., x,,", "́a b́"]
    for text, ids in zip(texts, own.of(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_level_is_the_best_by_brute_force():
    rnd = random.Random(4)
    for pad_powers in (True, False):
        packer = packing.Packer(64, pad_powers)
        for _ in range(400):
            size = rnd.randint(1, 63)
            counts = packer.counts.copy()

            def cost(level):
                after = counts.copy()
                if level:
                    after[level] -= 1
                if level + size < 64:
                    after[level + size] += 1
                return int((after[~packer.free] ** 2).sum())

            levels = [0] + [h for h in range(1, 65 - size) if counts[h]]
            level, change = packer._change(size)
            assert level in levels and cost(level) == min(map(cost, levels))
            assert change == cost(level) - int((counts[~packer.free] ** 2).sum())
            packer.place((0, 0, size, b"0000" * size, size))


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = packing.pack_documents(docs, PATH).collect()
    assert sum(r.length for r in rows if r.doc_id == 2) == 1
    assert sum(r.length for r in rows if r.doc_id == 5) == 2 * sum(r.length for r in rows if r.doc_id == 4)
    assert any(r.doc_id is None for r in rows)
    assert packing.pack_documents(nothing(spark), PATH).count() == 0


def test_marks_behind_letters_ask_for_no_word_anew(monkeypatch):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(PATH), packing.Ids(packing.read_spec(PATH))
    asked, inner = [], own._ask_words
    monkeypatch.setattr(own, "_ask_words", lambda words: (asked.extend(words), inner(words))[1])
    rnd = random.Random(2)
    texts = [" ".join(w + "".join(rnd.choice(".,!?;:#$%&*") for _ in range(k)) for w in ("alpha", "Beta", "gamma") for k in range(6)) for _ in range(50)]
    texts += ["a$'s a&'ll 5%%% é!! (x).* x.y.* $$$ a$$b$$ a~.", "a!́ b*́c"]
    for text, ids in zip(texts, own.of(texts[:50]) + own.of(texts[50:])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert sorted(asked[:3]) == [b"alpha", b"beta", b"gamma"] and len(asked) <= 16
