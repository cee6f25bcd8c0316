"""The line source: ranges, numbers and streams against the lines themselves."""

import gzip
import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.sources import lines as L
from corpusflow.sources import read_corpus


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"bc", b"\n", b"\r\n", b"\r", b"\xc3\xa9", b" "]), max_size=40).map(b"".join), st.integers(1, 9), st.integers(1, 7))
def test_every_line_is_in_one_range(data, size, read):
    """Cut anywhere, and read in pieces of any length, a file gives its lines in order."""
    old, L.READ_BYTES = L.READ_BYTES, read
    try:
        got = []
        for start in range(0, len(data), size):
            stream = io.BytesIO(data)
            stream.seek(max(0, start - 1))
            got += list(L._lines(stream, start, min(start + size, len(data))))
    finally:
        L.READ_BYTES = old
    want = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
    assert got == (want[:-1] if want[-1] == b"" else want)


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows))


def some(n, seed):
    rnd = random.Random(seed)
    made = [{"id": f"{seed}-{i}", "text": "é " * rnd.randrange(40), "n": rnd.choice([0, 7, None, [], "x"])} for i in range(n)]
    return [x for r in made for x in ([r, "", "[1]"] if rnd.random() < 0.1 else [r])]


@pytest.mark.parametrize("size", [37, 1000, 1 << 20])
def test_rows_equal_the_jsonl_source(spark, tmp_path, size):
    put(tmp_path / "in", "a.jsonl", some(200, 1))
    put(tmp_path / "in", "b.jsonl", some(50, 2))
    put(tmp_path / "in", "_hidden", ["not read"])
    (tmp_path / "in" / "c.jsonl.gz").write_bytes(gzip.compress(b'{"id": "z", "text": "packed"}\n' * 2))
    cfg = {"path": str(tmp_path / "in"), "field_map": {"id": "id", "body": "text", "n": "n"}}
    rows = lambda kind: sorted(map(tuple, read_corpus(spark, {**cfg, "type": kind, "range_bytes": size}).collect()))
    assert rows("text_lines") == rows("jsonl")


def test_numbers_without_moving_lines(spark, tmp_path):
    put(tmp_path / "in", "b.txt", [f"b{i}" for i in range(1000)])
    put(tmp_path / "in", "a.txt", [f"a{i}" for i in range(77)])
    scan = L.scan_lines(spark, str(tmp_path / "in"), 100)
    assert scan.rdd.getNumPartitions() > 40
    df = L.numbered(scan)
    got = {r.value: r.position for r in df.collect()}
    assert got == {v: i for i, v in enumerate([f"a{i}" for i in range(77)] + [f"b{i}" for i in range(1000)])}
    plan = df._jdf.queryExecution().executedPlan().toString()
    moved = plan[plan.index("BroadcastHashJoin") + 20 : plan.index("Scan")]
    assert "Exchange" not in moved and "Sort" not in moved


def test_positions_become_ids(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", [{"t": "x"}, "", {"t": "y", "id": "own"}, {"t": "z"}])
    cfg = {"type": "text_lines", "path": str(tmp_path / "in"), "field_map": {"t": "t"}, "id_fallback": "position", "range_bytes": 5}
    assert sorted((r.source_id, r.t) for r in read_corpus(spark, cfg).collect()) == [("0", "x"), ("3", "z"), ("own", "y")]


def test_empty_and_missing_paths(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [])
    assert L.scan_lines(spark, str(tmp_path / "in")).count() == 0
    assert L.numbered(L.scan_lines(spark, str(tmp_path / "in"))).count() == 0
    with pytest.raises(Exception, match="no such path"):
        L.scan_lines(spark, str(tmp_path / "none")).count()


def test_a_stream_takes_new_files_once(spark, tmp_path):
    def start():
        rows = L.stream_ranges(spark, str(tmp_path / "in"), {"id": "id", "n": "n"})
        job = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        job.awaitTermination()
        return sorted(r.source_id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put(tmp_path / "in", "b.jsonl", [{"id": "b", "n": 1}])
    assert start() == ["b"] and start() == ["b"]
    put(tmp_path / "in", "a.jsonl", [{"id": "a", "n": 1}, {"id": "c", "n": 0}])
    assert start() == ["a", "b", "c"]
    offset = json.loads(sorted((tmp_path / "ckpt" / "offsets").glob("[0-9]*"))[-1].read_text().splitlines()[-1])
    assert set(offset) == {"time", "file"}  # as long as ever
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.agg(F.count(F.when(F.col("n") == "", 1))).first()[0] == 1
