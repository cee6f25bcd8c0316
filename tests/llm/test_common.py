"""Samples for learning."""

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import quality, toxicity
from corpusflow.llm.common import block_of, first_by_hash, giving_back, labelled_sample


def test_first_by_hash_is_the_smallest_hashes(spark):
    ids = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("g"))
    got = {(r.g, r.doc_id) for r in first_by_hash(ids, "g", 120).collect()}
    want = set()
    for g in ("rare", "hot"):
        rows = ids.where(F.col("g") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(120).collect()
        want |= {(g, r.doc_id) for r in rows}
    assert got == want and len(got) == 220


def test_labelled_sample_leaves_out_what_is_unclear(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c" * 50), (4, "d"), (4, "d"), (5, None), (None, "x"), (7, "g"), (8, "h"), (6, "z"), (6, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (5, 0), (6, 0), (None, 1), (7, 0), (7, 1), (8, None), (9, 1), (2, 1)], "doc_id long, toxic int")
    got = [tuple(r) for r in labelled_sample(docs, labels, "toxic", (10, 10), 20).collect()]
    long = [t for i, t, _ in got if i == 3]
    assert len(long) == 1 and long[0] in ("c" * 20, "c" * 10)
    assert sorted(r for r in got if r[0] != 3) == [(1, "a", 0), (2, "b", 1), (4, "d", 1), (6, "y", 0)]


def test_blocks_lie_anywhere_in_a_text(spark):
    text = "".join(chr(97 + i % 26) * 10 for i in range(26))
    rows = spark.range(200).select("id", block_of(F.col("id"), F.lit(text), 10).alias("t")).collect()
    assert {r.t for r in rows} == {chr(97 + i) * 10 for i in range(26)}
    short = spark.range(3).select(block_of(F.col("id"), F.lit("ab"), 10).alias("t"), block_of(F.col("id"), F.lit(""), 10).alias("e")).collect()
    assert {(r.t, r.e) for r in short} == {("ab", "")}


def test_classes_of_long_or_repeated_rows_are_learned(spark):
    good, bad = "orderly prose of plain words " * 60, "buy now click here win cash " * 60
    docs = spark.createDataFrame([(i, good) for i in range(20)] * 2 + [(100 + i, bad * 30) for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)], "doc_id long, quality int")
    model = quality.train(docs, labels, longest=500)
    high, low = model.score([good, bad])
    assert high > quality.KEEP_FROM > low


def test_a_missing_class_is_told(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning, match="quality = 0"):
        quality.train(docs, labels)
    with pytest.warns(UserWarning, match="toxic = 0"):
        toxicity.train(docs.withColumn("doc_id", F.lit(2).cast("long")), labels.withColumn("doc_id", F.lit(2).cast("long")))


def test_giving_back_changes_no_rows():
    assert list(giving_back(lambda batches: (2 * b for b in batches))(iter([1, 2, 3]))) == [2, 4, 6]
