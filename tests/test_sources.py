import json

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.numbering import number_rows
from corpusflow.operators.sampling import sample_rows
from corpusflow.sources import SOURCES, read_corpus, register_source
from corpusflow.sources.readers import line_counts

LINES = [
    '{"id":"a","content":"x","category":"News","title":"T"}',
    "",
    "   ",
    "{bad",
    "[1]",
    "5",
    '{"id":null,"content":0}',
    '{"content":"no id"}',
    '{"id":"x","content":{"q":1}}',
    '{"id":2}{"id":3}',
    "{'id':4}",
    '{"id":5,"id":6}',
    '{"id":0,"content":false}',
    '{"id":"z","content":"0"}',
]


@pytest.fixture
def jsonl(tmp_path):
    path = tmp_path / "corpus.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def test_jsonl_is_strict(spark, jsonl):
    cfg = {"type": "jsonl", "path": jsonl, "field_map": {"id": "id", "body": "content", "extra": "nope"}}
    df = read_corpus(spark, cfg)
    assert df.columns == ["source_id", "body", "extra"]
    rows = {r.source_id: r.body for r in df.collect()}
    named = {k: v for k, v in rows.items() if len(k) < 32}
    assert named == {"a": "x", "x": '{"q":1}', "6": "", "0": "", "z": "0"}
    assert sorted(v for k, v in rows.items() if len(k) == 32) == ["", "no id"]
    counts = line_counts(spark.read.text(jsonl)).first()
    assert (counts.blank, counts.malformed, counts.parsed) == (2, 5, 7)


def test_positional_ids_count_parsed_rows(spark, jsonl):
    cfg = {"type": "jsonl", "path": jsonl, "field_map": {"body": "content"}, "id_fallback": "position"}
    rows = read_corpus(spark, cfg).collect()
    assert {r.source_id: r.body for r in rows} == {
        "a": "x", "1": "", "2": "no id", "x": '{"q":1}', "6": "", "0": "", "z": "0",
    }


def test_positions_follow_file_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "many"
    path.mkdir()
    want, n = [], 0
    for part in range(3):
        lines = []
        for _ in range(2000 * (part + 1)):
            lines.append(json.dumps({"content": f"row {n}"}))
            want.append(f"row {n}")
            n += 1
        (path / f"p{part}.jsonl").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        cfg = {"type": "jsonl", "path": str(path), "field_map": {"body": "content"}, "id_fallback": "position"}
        df = read_corpus(spark, cfg)
        assert df.rdd.getNumPartitions() > 3
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.body for r in sorted(rows, key=lambda r: int(r.source_id))] == want


def test_table_source_maps_types(spark, tmp_path):
    path = str(tmp_path / "t" / "train")
    spark.sql(
        """select * from values
        ('a', 0, 0.0D, false, array(), named_struct('q', 1), 'x'),
        (null, 7, 1.5D, true, array(1, 2), null, null) as t(id, n, d, b, arr, st, s)"""
    ).write.parquet(path)
    field_map = {"n": "n", "d": "d", "b": "b", "arr": "arr", "st": "st", "body": "s", "gone": "missing"}
    cfg = {"type": "table", "path": str(tmp_path / "t"), "split": "train", "field_map": field_map, "row_key": True}
    rows = sorted(read_corpus(spark, cfg).collect(), key=lambda r: r.n)
    assert tuple(rows[0])[:-1] == ("a", "", "", "", "", '{"q":1}', "x", "")
    assert tuple(rows[1])[1:-1] == ("7", "1.5", "true", "[1,2]", "", "", "")
    assert rows[1].source_id.endswith(".parquet:1") or rows[1].source_id.endswith(".parquet:0")
    hashed = read_corpus(spark, {**cfg, "id_fallback": "hash"}).filter("length(source_id) = 32")
    assert hashed.count() == 1
    assert len({r.row_key for r in rows}) == 2


def test_parquet_positions(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(900).select(F.format_string("%04d", "id").alias("s")).orderBy("s").repartitionByRange(4, "s").sortWithinPartitions("s").write.parquet(path)
    cfg = {"type": "table", "path": path, "field_map": {"body": "s"}, "id_fallback": "position", "row_key": True}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        rows = read_corpus(spark, cfg).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(int(r.source_id) == int(r.body) for r in rows)
    assert len({r.row_key for r in rows}) == 900


def test_catalog_table_with_split(spark):
    spark.sql("select 'train' split, 'a' id, 'x' s union all select 'test', 'b', 'y'").createOrReplaceTempView("corpus_t")
    cfg = {"type": "table", "name": "corpus_t", "split": "train", "field_map": {"body": "s"}}
    assert [tuple(r) for r in read_corpus(spark, cfg).collect()] == [("a", "x")]


def test_source_registry(spark):
    with pytest.raises(ValueError, match="unknown source type 'nope'; known: jsonl, table"):
        read_corpus(spark, {"type": "nope"})
    register_source("tiny", lambda s, cfg: s.createDataFrame([(cfg["x"], "b")], "source_id string, body string"))
    try:
        assert read_corpus(spark, {"type": "tiny", "x": "1"}).first().source_id == "1"
    finally:
        SOURCES.pop("tiny")


def test_projection_reaches_the_scan(spark, sf_dir):
    cfg = {"type": "table", "path": f"{sf_dir}/documents.parquet", "field_map": {"id": "doc_id", "body": "text"}}
    plan = read_corpus(spark, cfg)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1]
    assert "lang" not in schema and "n_chars" not in schema
    ids = read_corpus(spark, {**cfg, "row_key": True}).select("source_id", "row_key")
    assert "text" not in ids._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_dense_and_in_digest_order(spark):
    df = spark.range(5000).withColumn("k", F.md5(F.col("id").cast("string"))).repartition(7)
    rows = sorted(number_rows(df, F.col("k"), ["id"], "n", start=10).collect(), key=lambda r: r.k)
    assert [r.n for r in rows] == list(range(11, 5011))


def test_samples_nest_and_ignore_partitioning(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("source_id"))
    ids = lambda frame: {r.source_id for r in frame.collect()}
    small, large = ids(sample_rows(df, 100, 7)), ids(sample_rows(df.repartition(5), 700, 7))
    assert len(small) == 100 and len(large) == 700 and small < large
    assert ids(sample_rows(df, 100, 8)) != small
    assert sample_rows(df, 0).count() == 3000 and sample_rows(df, 5000).count() == 3000
    assert sample_rows(df, 3000).count() == 3000
    want = sorted(df.collect(), key=lambda r: __import__("hashlib").md5(f"7:sample:{r.source_id}".encode()).hexdigest())
    assert small == {r.source_id for r in want[:100]}


@pytest.mark.parametrize("n", [1, 50, 150, 151, 299, 300, 301])
def test_sample_size_is_exact_with_a_hot_id(spark, n):
    hot = spark.range(150).select(F.lit("hot").alias("source_id"), (F.col("id") % 3).alias("v"))
    rest = spark.range(150).select(F.col("id").cast("string").alias("source_id"), F.col("id").alias("v"))
    assert sample_rows(hot.unionByName(rest), n).count() == min(n, 300)
