"""The key index against the target it stands for, and what its lookups read."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import ledger as L
from corpusflow.operators.keys import KeyIndex
from corpusflow.plans.transforms import Passthrough
from corpusflow.schemas import LEDGER
from corpusflow.streaming import read_stream, stream_publish
from corpusflow.streaming.streams import published_table
from test_streaming import CFG, FIELDS, put


def entries(spark, low, high, seq=0):
    n = F.col("id")
    return spark.range(low, high).select(
        F.concat(F.lit("s"), n).alias("source_id"), (n + 1).alias("post_id"), F.md5(n.cast("string")).alias("content_hash"), (n + seq).alias("seq")
    )


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def scanned(df):
    """Rows that the scans of a plan gave, after row groups were skipped."""
    physical = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = physical.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def index(spark, tmp_path):
    made = KeyIndex(spark, str(tmp_path / "index"), 16)
    made.add(entries(spark, 0, 3000), "one")
    made.add(entries(spark, 3000, 6000), "two", made.greatest())
    return made


def test_lookups_equal_the_ledgers(spark, index):
    """Repeats too: the last entry of an id wins, the first of a hash."""
    again = entries(spark, 100, 110).withColumns({"post_id": F.col("post_id") + 9000, "seq": F.lit(10**6)})
    index.add(again, "three", index.greatest())
    every = entries(spark, 0, 6000).unionByName(again)
    for n in (5, 50_000):  # literals, and bucket to bucket
        wanted = entries(spark, 90, 130).unionByName(entries(spark, 7000, 7003))
        assert rows(index.posts(wanted, n)) == rows(L.latest(every).join(wanted.select("source_id"), "source_id", "left_semi"))
        assert rows(index.hashes(wanted, n)) == rows(L.first_hash(every).join(wanted.select("content_hash"), "content_hash", "left_semi"))
        without = index.posts(wanted, n, without="three")
        assert rows(without) == rows(L.latest(entries(spark, 0, 6000)).join(wanted.select("source_id"), "source_id", "left_semi"))
    assert rows(index.find("s105")) == [("s105", 9106)] and index.find("none").isEmpty()
    assert index.greatest() == 9110 and index.top("two") == 6000 and index.top("nope") is None


def test_empty_and_null_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), 4)
    odd = spark.createDataFrame([("", 1, "h", 1), (None, 2, None, 2), ("a", 3, "", 3)], LEDGER)
    assert index.posts(odd, 3).isEmpty() and index.greatest() == 0
    index.add(odd, "one")
    assert rows(index.posts(odd, 3)) == [("a", 3)] and rows(index.hashes(odd, 5000)) == [("h", 1)]
    index.add(odd.limit(0), "none", index.greatest())
    assert index.top("none") == 3


def test_the_index_is_never_shuffled(spark, index):
    few = index.posts(entries(spark, 5, 8), 3)
    assert re.search(r"SelectedBucketsCount: [123] out of 16", plan(few)) and "Exchange" not in plan(few)
    assert "SelectedBucketsCount: 1 out of 16" in plan(index.find("s7"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = plan(index.posts(entries(spark, 0, 5000), 50_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in many  # the batch's side alone is shuffled
    scan = many[: many.index("FileScan")].splitlines()
    joined = next(i for i, line in enumerate(scan) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in scan[joined:])
    assert not any("Exchange" in line for line in scan[:joined])


def test_a_point_lookup_skips_row_groups(spark, tmp_path):
    """By order and Bloom filters: an id costs one row group, a missing one none."""
    index = KeyIndex(spark, str(tmp_path / "i"), 1)
    for option in ("parquet.block.size", "parquet.page.row.count.limit", "parquet.block.row.count.limit"):
        spark.sparkContext._jsc.hadoopConfiguration().set(option, "1000")
    try:
        index.add(entries(spark, 0, 20_000), "one")
    finally:
        for option in ("parquet.block.size", "parquet.page.row.count.limit", "parquet.block.row.count.limit"):
            spark.sparkContext._jsc.hadoopConfiguration().unset(option)
    file = next((tmp_path / "i" / "g=0" / "ids").glob("*.parquet"))
    groups = pq.ParquetFile(file).metadata.num_row_groups
    assert groups > 5
    assert 0 < scanned(index.table("ids").where("key = 's77'")) <= 20_000 / groups * 2
    assert scanned(index.table("ids").where("key = 's77x'")) == 0


def test_buckets_read_stay_level_as_the_target_grows(spark, tmp_path):
    """Four times the target in four times the buckets: a key costs the same rows."""
    cost = []
    for n, buckets in ((4000, 8), (16_000, 32)):
        index = KeyIndex(spark, str(tmp_path / f"i{n}"), 8)
        index.add(entries(spark, 0, n), "one")
        while index.buckets < buckets:
            index.rebuild()
        assert KeyIndex(spark, str(tmp_path / f"i{n}")).buckets == buckets
        assert rows(index.posts(entries(spark, 17, 18), 1)) == [("s17", 18)]
        cost.append(index.table("ids").count() / index.buckets)
        files = {f.name.rsplit("_", 1)[1] for f in (tmp_path / f"i{n}" / f"g={index.generation}" / "ids").glob("*.parquet")}
        assert len(files) == buckets
    assert cost[0] == cost[1]


def test_catch_up_enters_what_the_target_has(spark, tmp_path):
    target = published_table(spark, str(tmp_path / "posts"))
    for name, low in (("a", 0), ("b", 50)):
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields if f.name not in LEDGER.fieldNames()]
        target.append(entries(spark, low, low + 50).select("*", *rest), name)
    index = KeyIndex(spark, str(tmp_path / "i"), 4)
    assert index.catch_up(target, without="b") == 1 and index.greatest() == 50
    assert index.catch_up(target) == 1 and index.catch_up(target) == 0
    assert index.posts(entries(spark, 0, 200), 200).count() == 100 and not index.is_due()


def test_a_stream_with_an_index_publishes_as_one_without(spark, tmp_path):
    cats = spark.createDataFrame([("N", 1)], "name string, id long")
    got = {}
    for kind in ("plain", "indexed"):
        home = tmp_path / kind
        home.mkdir()
        target = published_table(spark, str(home / "posts"))
        for day, drop in enumerate([[("a", "one"), ("b", "two")], [("a", "new"), ("c", "two"), ("d", "four")], [("e", "one"), ("f", "six")]]):
            put(home / "in", f"{day}.jsonl", [{"id": i, "text": t} for i, t in drop])
            # a new object each time, as after a restart
            index = KeyIndex(spark, str(home / "keys"), 4) if kind == "indexed" else None
            source = read_stream(spark, str(home / "in"), FIELDS)
            stream_publish(source, target, str(home / "ckpt"), CFG, Passthrough().posts, cats, index=index).awaitTermination()
        got[kind] = rows(target.read().select("post_id", "source_id", "content_hash"))
    assert got["plain"] == got["indexed"] and {r[1] for r in got["indexed"]} == set("abdf")


def test_a_replayed_batch_does_not_meet_itself(spark, tmp_path):
    """The index was written, the stream's own commit was not: the batch comes again."""
    put(tmp_path / "in", "0.jsonl", [{"id": "a", "text": "one"}, {"id": "b", "text": "two"}])
    cats = spark.createDataFrame([("N", 1)], "name string, id long")
    target, index = published_table(spark, str(tmp_path / "posts")), KeyIndex(spark, str(tmp_path / "keys"), 4)

    def publish():
        source = read_stream(spark, str(tmp_path / "in"), FIELDS)
        stream_publish(source, target, str(tmp_path / "ckpt"), CFG, Passthrough().posts, cats, index=index).awaitTermination()
        return rows(target.read().select("post_id", "source_id"))

    first = publish()
    for file in (tmp_path / "ckpt" / "commits").iterdir():
        file.unlink()
    assert publish() == first and len(first) == 2
