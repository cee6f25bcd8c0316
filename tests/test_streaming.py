import json

from pyspark.sql import functions as F

from corpusflow.plans.transforms import Passthrough
from corpusflow.streaming import read_stream, stream_publish
from corpusflow.streaming.streams import StreamSink, published_table, results_table

CFG = {
    "dataset": {"seed": 1},
    "transform": {"category": {"labels": ["N"]}, "date": {"range_start": "2020-01-01", "range_end": "2021-01-01"}},
}
FIELDS = {"id": "id", "body": "text", "title": "title"}


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


class Failing(Passthrough):
    """Posts of rows that mention a failure carry an error."""

    def posts(self, df):
        made = super().posts(df)
        return made.withColumn("error", F.when(F.col("content").contains("fail"), F.lit("boom")))


def test_results_of_a_stream(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [{"id": "x", "text": "ok"}, {"id": "y", "text": "fail"}, {"id": "x", "text": "two"}, {"id": "o", "text": "q", "title": "t"}])
    cats = spark.createDataFrame([("N", 1)], "name string, id long")
    target, results = published_table(spark, str(tmp_path / "posts")), results_table(spark, str(tmp_path / "results"))
    rows = read_stream(spark, str(tmp_path / "in"), FIELDS)
    stream_publish(rows, target, str(tmp_path / "ckpt"), CFG, Failing().posts, cats, results=results).awaitTermination()
    got = sorted((r.source_id, r.ok, r.skipped, r.error) for r in results.read().collect() if r.source_id != "x")
    assert got == [("o", True, None, None), ("y", False, None, "transform: boom")]
    assert {(r.ok, r.skipped) for r in results.read().filter("source_id = 'x'").collect()} == {(True, None), (True, True)}
    assert {r.source_id for r in target.read().collect()} == {"x", "o"}


def run(spark, folder, target, ckpt, cats, **kw):
    job = stream_publish(
        read_stream(spark, str(folder), FIELDS, max_files=1), target, str(ckpt), CFG, Passthrough().posts, cats, **kw
    )
    job.awaitTermination()
    return job


def test_publish_once_over_batches_restarts_and_replays(spark, tmp_path):
    src, ckpt = tmp_path / "in", tmp_path / "ckpt"
    cats = spark.createDataFrame([("N", 1)], "name string, id long")
    target = published_table(spark, str(tmp_path / "posts"))
    put(src, "a.jsonl", [{"id": f"a{i}", "text": f"text {i % 30}", "title": f"T{i}"} for i in range(40)] + [{"id": "e1", "text": ""}])
    put(src, "b.jsonl", [{"id": f"b{i}", "text": f"text {i}"} for i in range(20, 50)] + [{"id": "a1", "text": "other"}, {"id": "e2", "text": " "}])
    job = run(spark, src, target, ckpt, cats)
    batches = [p for p in job.recentProgress if p["numInputRows"]]
    assert sorted(p["observedMetrics"]["rows"]["fetched"] for p in batches) == [32, 41]

    def check(n):
        rows = target.read().collect()
        assert len(rows) == n
        assert len({r.source_id for r in rows}) == n and len({r.post_id for r in rows}) == n
        hashes = [r.content_hash for r in rows if r.content_hash]
        assert len(set(hashes)) == len(hashes)
        return {(r.source_id, r.post_id) for r in rows}

    # 50 texts and two blank ones; a1 may or may not be the copy that was kept
    first = check(len(target.read().collect()))
    assert len(first) in (52, 53)

    # a restart with nothing new does nothing, and takes up new files
    run(spark, src, target, ckpt, cats)
    assert check(len(first)) == first
    put(src, "c.jsonl", [{"id": "c1", "text": "text 49"}, {"id": "c2", "text": "fresh"}])
    run(spark, src, target, ckpt, cats)
    after = check(len(first) + 1)
    assert after > first

    # replaying the last batch, as after a crash, replaces it
    sink = StreamSink(target, str(ckpt), CFG, Passthrough().posts, cats)
    rows = spark.createDataFrame([("c1", "text 49", ""), ("c2", "fresh", "")], "source_id string, body string, title string")
    sink(rows, 2)
    assert check(len(first) + 1) == after

    # a new checkpoint sees everything again and publishes nothing twice
    run(spark, src, target, tmp_path / "ckpt2", cats)
    assert check(len(first) + 1) == after


class DiesOnce:
    """A results table whose first write never comes through."""

    def __init__(self, table):
        self.table, self.died = table, False

    def append(self, df, batch):
        if not self.died:
            self.died = True
            raise ConnectionError("no answer")
        self.table.append(df, batch)


def test_a_stream_killed_before_its_outcomes_recovers_them(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [{"id": "x", "text": "one"}, {"id": "y", "text": "two"}, {"id": "y2", "text": "two"}])
    cats = spark.createDataFrame([("N", 1)], "name string, id long")
    target, results = published_table(spark, str(tmp_path / "posts")), results_table(spark, str(tmp_path / "results"))
    flaky = DiesOnce(results)

    def start():
        rows = read_stream(spark, str(tmp_path / "in"), FIELDS)
        return stream_publish(rows, target, str(tmp_path / "ckpt"), CFG, Passthrough().posts, cats, results=flaky)

    try:
        start().awaitTermination()
        raise AssertionError("the stream went on")
    except Exception as e:
        assert "no answer" in str(e)
    first = sorted((r.source_id, r.post_id) for r in target.read().collect())
    assert len(first) == 2 and results.read().isEmpty()
    put(tmp_path / "in", "b.jsonl", [{"id": "z", "text": "three"}])
    start().awaitTermination()
    got = {r.source_id: (r.ok, r.recovered_after_retry) for r in results.read().collect()}
    assert {i: got[i] for i, _ in first} == {i: (True, True) for i, _ in first} and got["z"] == (True, None)
    there = sorted((r.source_id, r.post_id) for r in target.read().collect())
    assert there[: len(first)] == first and len(there) == 3


def test_failed_rows_come_again_with_later_batches(spark, tmp_path):
    """Twice at most; one that works then is published, the other stays failed."""
    cats = spark.createDataFrame([("N", 1)], "name string, id long")
    target, results = published_table(spark, str(tmp_path / "posts")), results_table(spark, str(tmp_path / "results"))
    broken = {"both": True}

    def posts(df):
        made = Passthrough().posts(df)
        bad = F.col("content").contains("never") | (F.lit(broken["both"]) & F.col("content").contains("later"))
        return made.withColumn("error", F.when(bad, F.lit("boom")))

    for k in range(5):
        put(tmp_path / "in", f"{k}.jsonl", [{"id": f"ok{k}", "text": f"good {k}"}] + ([{"id": "l", "text": "later"}, {"id": "n", "text": "never"}] if k == 0 else []))
        broken["both"] = k < 1
        rows = read_stream(spark, str(tmp_path / "in"), FIELDS)
        stream_publish(rows, target, str(tmp_path / "ckpt"), CFG, posts, cats, results=results, retries=2).awaitTermination()
    assert {r.source_id for r in target.read().collect()} == {"l", *(f"ok{k}" for k in range(5))}
    tries = [(r.source_id, r.ok) for r in results.read().collect() if r.source_id in "ln"]
    assert sorted(tries) == [("l", False), ("l", True), ("n", False), ("n", False), ("n", False)]
