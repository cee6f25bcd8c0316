"""Trees, edits and the order of documents, against plain Python."""

import hashlib
import random

from helpers import awkward, nothing
from pyspark.sql import functions as F

from corpusflow.llm import merkle


def test_edit_report_against_python(spark):
    docs = awkward(spark, [(-5, "Ünï cödé tëxt 😀 with marks. And more!\n\nNew section"), (2**62, "far away"), (-(2**63), "least"), (5000, "x" * 300)])
    rows = docs.collect()
    ring = sorted((r.doc_id, r.text or "") for r in rows if r.doc_id is not None)
    want = []
    for i, (doc, text) in enumerate(ring):
        q = len(text) // 4
        edited = text[: len(text) - q] + ring[(i + 1) % len(ring)][1][:q]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    text = "no id here"
    want.append((None, len(text), hashlib.sha256(text[: len(text) - 2].encode()).hexdigest()))
    got = merkle.edit_report(docs).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = {r.fingerprint for r in got if r.doc_id in (4, 5)}
    assert len(same) == 1
    assert len({r.fingerprint for r in got}) == len({r.text or "" for r in rows})


def test_single_and_no_document(spark):
    one = merkle.edit_report(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert merkle.edit_report(nothing(spark)).count() == 0


def test_following_many_scattered_ids(spark):
    rnd = random.Random(5)
    ids = sorted({rnd.randrange(-(2**63), 2**63) >> rnd.randrange(0, 60) for _ in range(400)})
    got = {r.k: r.next_k for r in merkle.following(spark.createDataFrame([(i,) for i in ids], "k long"), (4, 20, 20, 20)).collect()}
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_changes_are_located(spark):
    old = "one\ntwo\n\nthree\nfour\n\nfive"
    texts = {"same": old, "line": old.replace("four", "FOUR"), "more": old + "\nsix\n\nseven\neight", "less": "one\ntwo"}
    rows = spark.createDataFrame([(k, old, v) for k, v in texts.items()], "name string, a string, b string")
    trees = merkle.merkle_trees(merkle.merkle_trees(rows, "a").withColumnRenamed("merkle", "old"), "b")
    found = {r.name: [tuple(x) for x in r.where] for r in trees.select("name", merkle.changed_paragraphs(F.col("old"), F.col("merkle")).alias("where")).collect()}
    assert found["same"] == []
    assert found["line"] == [(1, 1)]
    assert found["more"] == [(2, 1), (3, 0), (3, 1)]
    assert found["less"] == [(1, 0), (1, 1), (2, 0)]


def test_likeness_falls_with_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = merkle.edit_report(docs).where("n_chars > 400").agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert r.e > 0.5 and r.n < 0.1
