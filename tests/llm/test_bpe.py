"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, nothing

from corpusflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.read_spec(PATH))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(own, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(own.encode(text), "<u4").tolist()
    assert got == want, text
    assert own.decode(np.array(got)) == library.decode(want, skip_special_tokens=False) == text


def test_random_texts(own, library):
    rnd = random.Random(1)
    letters = "ab eE'st're  \n\t\r\x0b\x0c\x1c\x85\xa0 ​　1٣éßñ漢字😀!?-_"
    for k in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        check(own, library, text + ("<|endoftext|>" + text if k % 9 == 0 else ""))
        check(own, library, "".join(chr(rnd.choice([rnd.randint(1, 0x2FF), rnd.randint(1, 0xD7FF)])) for _ in range(6)))


def test_one_long_word(own, library):
    rnd = random.Random(2)
    check(own, library, "".join(rnd.choice("aeionrst") for _ in range(20_000)))


def test_pair_table_against_merging(own):
    """A pair fits just if merging its joined bytes by rank gives it back."""
    rnd = random.Random(3)
    size = 50_000
    for _ in range(3000):
        a, b = rnd.randrange(size), rnd.randrange(size)
        joined = bytes(own.blob[own.offsets[a] : own.offsets[a + 1]]) + bytes(own.blob[own.offsets[b] : own.offsets[b + 1]])
        ids = [own.automaton.get(chr(c)) for c in joined]
        while True:
            ranked = [(own.merged[x << 32 | y], i) for i, (x, y) in enumerate(zip(ids, ids[1:])) if x << 32 | y in own.merged]
            if not ranked:
                break
            rank, i = min(ranked)
            ids[i : i + 2] = [next(k for k in (own.automaton.get((bytes(own.blob[own.offsets[ids[i]] : own.offsets[ids[i] + 1]]) + bytes(own.blob[own.offsets[ids[i + 1]] : own.offsets[ids[i + 1] + 1]])).decode("latin-1")),))]
        assert own.compatible(a, b) == (ids == [a, b])


def test_rows(spark, library):
    docs = awkward(spark)
    got = bpe.encode_documents(docs, PATH).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = library.encode(r.decoded, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert sorted(r.decoded for r in got) == sorted(r.text or "" for r in docs.collect())
    assert bpe.encode_documents(nothing(spark), PATH).count() == 0
