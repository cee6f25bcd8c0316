import json

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import ledger as L
from corpusflow.operators.cache import cache_stats, lookup, read_cache_jsonl, split_by_cache
from corpusflow.operators.store import VersionedTable
from corpusflow.schemas import LEDGER, POST_FIELDS


def entries(spark, rows):
    return spark.createDataFrame([(s, p, h, n) for n, (s, p, h) in enumerate(rows)], LEDGER)


def pairs(df):
    return {tuple(r) for r in df.collect()}


def mapping(spark, d):
    return spark.createDataFrame(list(d.items()), "source_id string, post_id long")


def hash_map(spark, d):
    rows = [(h, p, n) for n, (h, p) in enumerate(d.items())]
    return spark.createDataFrame(rows, "content_hash string, post_id long, seq long")


LINES = [
    '{"source_id":"0","post_id":4}',
    '{"source_id":"","post_id":5}',
    '{"source_id":null,"post_id":6,"content_hash":"only-hash"}',
    '{"source_id":"z","post_id":0,"content_hash":"h0"}',
    '{"source_id":"z","post_id":-1}',
    '{"source_id":"z","post_id":"7"}',
    '{"source_id":"f","post_id":7.0}',
    '{"source_id":"a","post_id":1,"content_hash":"h1"}',
    "",
    "{bad",
    '{"source_id":"a","post_id":2,"content_hash":"h1"}',
    '{"source_id":9,"post_id":3}',
]


def test_ledger_import(spark, tmp_path):
    path = tmp_path / "ledger.jsonl"
    path.write_text("\n".join(LINES))
    led = L.read_ledger_jsonl(spark, str(path)).cache()
    assert pairs(L.latest(led)) == {("0", 4), ("a", 2), ("9", 3)}
    assert pairs(L.first_hash(led)) == {("only-hash", 6), ("h1", 1)}
    assert pairs(L.find_post(led, "a")) == {("a", 2)}
    assert L.find_post(led, "nope").isEmpty()


def test_merge_writes_only_changes(spark):
    led = entries(spark, [("a", 1, "ha"), ("b", 2, None), ("c", 3, None)])
    got = L.changes(
        led,
        mapping(spark, {"a": 1, "b": 2, "c": 3, "d": 4, "e": 0, "x": 9, "y": 9}),
        hash_map(spark, {"ha": 1, "hb": 2, "hd-old": 4, "hd": 4, "": 3, "h9": 9}),
    )
    assert pairs(got) == {("b", 2, "hb"), ("d", 4, "hd"), ("x", 9, "h9"), ("y", 9, "h9")}
    moved = L.changes(led, mapping(spark, {"a": 8}))
    assert pairs(moved) == {("a", 8, None)}
    merged = led.unionByName(got.withColumn("seq", F.lit(100)))
    again = L.changes(
        merged,
        mapping(spark, {"a": 1, "b": 2, "c": 3, "d": 4, "x": 9, "y": 9}),
        hash_map(spark, {"ha": 1, "hb": 2, "hd": 4, "h9": 9}),
    )
    assert again.isEmpty()


def test_small_batches_filter_the_ledger_where_it_is_read(spark):
    led = entries(spark, [("a", 1, "ha"), ("b", 2, None), ("a", 3, None)])
    wanted = spark.createDataFrame([("a",), ("a",), ("z",)], "source_id string")
    small = L.only_for(L.latest(led), wanted, "source_id", 3)
    assert pairs(small) == {("a", 3)}
    plan = small._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    assert pairs(L.only_for(L.latest(led), wanted, "source_id", 10**9)) == {("a", 3), ("b", 2)}


def test_replace_and_sets(spark):
    got = L.replacement(mapping(spark, {"a": 1, "b": 2, "n": -1}), hash_map(spark, {"h1": 1, "h2": 1}))
    assert pairs(got) == {("a", 1, "h2"), ("b", 2, None)}
    assert pairs(L.replacement(mapping(spark, {"a": 1}))) == {("a", 1, None)}
    ours, theirs = mapping(spark, {"a": 1, "b": 2, "c": 3}), mapping(spark, {"b": 2, "c": 9, "d": 4})
    assert L.drift(ours, theirs).first().asDict() == dict(only_in_log=1, only_on_target=1, differing=1)
    assert pairs(L.only_in(ours, theirs)) == {("a",)} and pairs(L.only_in(theirs, ours)) == {("d",)}
    assert pairs(L.differing(ours, theirs)) == {("c",)}
    assert pairs(L.overlay(ours, theirs)) == {("a", 1), ("b", 2), ("c", 9), ("d", 4)}
    assert pairs(L.fill(ours, theirs, "source_id")) == {("a", 1), ("b", 2), ("c", 3), ("d", 4)}


def test_meta_shapes(spark):
    rows = [
        (1, [("source_id", "x"), ("source_id", "0"), ("content_hash", "h")]),
        (2, [("content_hash", "")]),
        (0, [("source_id", "zero id")]),
        (3, None),
        (4, [("source_id", "0"), ("content_hash", "h")]),
    ]
    as_list = spark.createDataFrame(rows, "id long, meta array<struct<key string, value string>>")
    got = L.target_entries(as_list)
    assert pairs(L.latest(got)) == {("0", 4)} and pairs(L.first_hash(got)) == {("h", 1)}
    as_map = spark.createDataFrame([(5, {"source_id": "m"}), (6, {})], "id long, meta map<string,string>")
    assert pairs(L.source_ids(as_map)) == {("m", 5)}
    other = spark.createDataFrame([(5, "text")], "id long, meta string")
    assert L.target_entries(other).isEmpty()


def test_reconcile_modes(spark, tmp_path):
    target = entries(spark, [("b", 2, "hb"), ("c", 9, "hc"), ("d", 4, None)])
    log_rows = entries(spark, [("a", 1, "ha"), ("b", 2, None), ("c", 3, "hc")])

    def table(name, rows=None):
        t = VersionedTable(spark, str(tmp_path / name), LEDGER)
        if rows is not None:
            t.append(rows, "first")
        return t

    trusted = L.reconcile(table("t1", log_rows), target)
    assert pairs(trusted.posts) == {("a", 1), ("b", 2), ("c", 3)} and trusted.drift is None
    assert pairs(trusted.hashes) == {("ha", 1), ("hc", 3)}

    t2 = table("t2", log_rows)
    verified = L.reconcile(t2, target, "verify")
    assert verified.drift.first().asDict() == dict(only_in_log=1, only_on_target=1, differing=1)
    assert pairs(verified.posts) == {("b", 2), ("c", 9), ("d", 4)}
    assert {tuple(r)[:3] for r in t2.read().collect()} == {("b", 2, "hb"), ("c", 9, "hc"), ("d", 4, None)}

    t3 = table("t3")
    filled = L.reconcile(t3, target)
    assert pairs(filled.posts) == {("b", 2), ("c", 9), ("d", 4)} and t3.read().count() == 3

    skipped = L.reconcile(None, target, "skip")
    assert skipped.posts.isEmpty() and skipped.hashes.isEmpty()
    with pytest.raises(ValueError, match="known: trust_ledger, verify, skip"):
        L.reconcile(None, target, "guess")


def test_versioned_table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), LEDGER)
    assert t.read().isEmpty() and t.version() == 0
    t.append(entries(spark, [("a", 1, None)]), "one")
    t.append(entries(spark, [("a", 2, None)]), "one")
    t.append(entries(spark, [("b", 3, None)]), "two")
    assert {r.post_id for r in t.read().collect()} == {2, 3}
    assert {r.post_id for r in t.read(without="one").collect()} == {3}
    assert {r.post_id for r in t.read(only="one").collect()} == {2}
    t.replace(t.read().filter("post_id = 3"))
    fresh = VersionedTable(spark, str(tmp_path / "t"), LEDGER)
    assert fresh.version() == 1 and {r.post_id for r in fresh.read().collect()} == {3}
    fresh.truncate()
    assert VersionedTable(spark, str(tmp_path / "t"), LEDGER).read().isEmpty()


def test_merge_and_replace_count_what_they_write(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "ledger"), LEDGER)
    assert L.merge(t, mapping(spark, {"a": 1, "b": 2}), hash_map(spark, {"h": 1}), "one") == 2
    assert L.merge(t, mapping(spark, {"a": 1, "b": 3}), None, "two") == 1
    assert pairs(L.latest(t.read())) == {("a", 1), ("b", 3)}
    assert L.replace(t, mapping(spark, {"b": 3, "c": 0})) == 1
    assert pairs(L.latest(t.read())) == {("b", 3)} and L.first_hash(t.read()).isEmpty()


def post(source_id, **kw):
    base = dict(title="t", content="c", category="n", author="a", date_gmt="d", source_id=source_id)
    return {**base, **kw}


def test_cache_import_and_lookup(spark, tmp_path):
    missing = post("m")
    del missing["title"]
    lines = [
        {"sig": "S", "post": post("x", content_hash="hx")},
        {"sig": "old", "post": post("y")},
        {"sig": "S", "post": missing},
        {"sig": "S", "post": post("u", extra=1)},
        {"sig": "S", "post": post("x", title="later")},
        {"post": post("nosig")},
        {"sig": "S", "post": None},
    ]
    path = tmp_path / "cache.jsonl"
    path.write_text("\n".join(["", "{bad", "[]"] + [json.dumps(x) for x in lines]))
    cached = read_cache_jsonl(spark, str(path)).cache()
    found = lookup(cached, "S").collect()
    assert [(r.source_id, r.title, r.content_hash) for r in found] == [("x", "later", "")]

    rows = spark.createDataFrame([("x", "from-row"), ("z", "hz"), ("x", "from-row")], "source_id string, content_hash string")
    hits, misses = split_by_cache(rows, cached, "S")
    assert hits.columns == list(POST_FIELDS)
    assert [(r.source_id, r.content_hash) for r in hits.collect()] == [("x", "from-row")] * 2
    assert [r.source_id for r in misses.collect()] == ["z"]
    stats = cache_stats(cached, "S", rows).first().asDict()
    assert stats == dict(loaded_at_start=2, stale_at_start=2, hits=2, misses=1, size=2)
