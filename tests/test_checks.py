"""Signatures and configuration checks as work of Spark, against their Python forms."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.plans.config import ConfigError, config_problems, validate_config
from corpusflow.plans.prompts import json_text, signature, signature_of, source_identity, source_identity_of

ODD = ["", "plain", 'a"b\\c', "tab\there\nand\r\b\f", "\x00\x01\x1f\x7f", "é ß 漢字", "😀 and 𝔘", "a/b {c}: [d], ~!", " ￿"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=20, max_size=20))
def test_strings_as_json(spark, more):
    values = [*ODD, *more, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", json_text(F.col("v")).alias("j"))
    assert {r.i: r.j for r in frame.collect()} == {i: json.dumps(v) for i, v in enumerate(values)}


def test_signatures_per_row(spark):
    frame = spark.createDataFrame([(v, w) for v in ODD for w in (None, "split")], "name string, split string")
    identity = source_identity_of(type=F.lit("table"), name=F.col("name"), split=F.col("split"))
    sig = signature_of(type=F.lit('"passthrough"'), source=json_text(identity), fields=F.lit('["title", null]'))
    for r in frame.select("name", "split", identity.alias("identity"), sig.alias("sig")).collect():
        want = source_identity({"type": "table", "name": r.name, "split": r.split})
        assert r.identity == want
        assert r.sig == signature(type="passthrough", fields=["title", None], source=want)


def test_problems_per_row(spark):
    good = {"dataset": {"sample_size": 5}, "source": {"type": "table", "name": "t"}, "transform": {"type": "passthrough"}}
    bad = {**good, "dataset": {"sample_size": -1}, "load": {"mode": "?"}}
    rows = [(1, json.dumps(good)), (2, json.dumps(bad)), (3, "no json"), (4, None), (5, "[1]"), (None, json.dumps(good))]
    got = {r.id: r.problems for r in config_problems(spark.createDataFrame(rows, "id long, config string")).collect()}
    assert got[1] == [] and got[None] == [] and [len(got[i]) for i in (3, 4, 5)] == [1, 1, 1]
    try:
        validate_config(bad)
    except ConfigError as e:
        assert got[2] == e.problems and len(e.problems) == 2
