"""Completions are committed task by task: a run that dies pays for open tasks only."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.cache import CACHE_TABLE, split_by_cache, with_cache
from corpusflow.operators.store import VersionedTable
from corpusflow.schemas import POST_FIELDS


def transform(calls, poison):
    """Posts by a costly function that notes each call and dies on one row."""

    def run(batches):
        for batch in batches:
            for id_ in batch.column("source_id").to_pylist():
                if id_ == poison:
                    time.sleep(8)  # the others end first
                    raise RuntimeError("worker lost")
                with open(Path(calls) / id_, "a") as f:
                    f.write("x")
            yield batch

    def posts(df):
        made = df.select("source_id").mapInArrow(run, "source_id string")
        return made.select(*[F.col("source_id").alias(f) for f in POST_FIELDS], F.lit(None).cast("string").alias("error"))

    return posts


def test_a_dead_run_pays_for_open_tasks_only(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = spark.range(60).select(F.concat(F.lit("r"), "id").alias("source_id"), F.lit("h").alias("content_hash"))
    cache = VersionedTable(spark, str(tmp_path / "cache"), CACHE_TABLE)
    with pytest.raises(Exception, match="worker lost"):
        with_cache(rows, cache, "S", transform(str(calls), "r7"), "one", 10)
    landed = {r.source_id for r in cache.read().collect()}
    assert 20 <= len(landed) < 60 and "r7" not in landed
    posts, made = with_cache(rows, cache, "S", transform(str(calls), None), "one", 10)
    assert {r.source_id for r in made.collect()} == {f"r{i}" for i in range(60)} - landed
    assert sorted(r.source_id for r in posts.collect()) == sorted(f"r{i}" for i in range(60))
    assert all((calls / i).read_text() == "x" for i in landed)


def test_one_job_and_a_file_per_task(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = spark.range(500).select(F.concat(F.lit("r"), "id").alias("source_id"), F.lit("h").alias("content_hash"))
    cache = VersionedTable(spark, str(tmp_path / "cache"), CACHE_TABLE)
    _, made = with_cache(rows, cache, "S", transform(str(calls), None), "one", 10)
    files = list((tmp_path / "cache").glob("data/v=0/batch=*/*.parquet"))
    assert made.count() == 500 and 20 <= len(files) <= 50
    _, made = with_cache(rows, cache, "S", transform(str(calls), None), "two", 10)
    assert made.count() == 0 and (calls / "r3").read_text() == "x"


def test_rows_stay_put_beside_a_table_that_is_not_there_yet(spark, tmp_path):
    """A fresh stage has no results, so no row is moved to look for some."""
    table = VersionedTable(spark, str(tmp_path / "fresh"), CACHE_TABLE)
    rows = spark.range(9).selectExpr("cast(id as string) source_id", "'' content_hash")
    hits, misses = split_by_cache(rows, table.read(), "S")
    assert "Join" not in misses._jdf.queryExecution().optimizedPlan().toString()
    assert hits.count() == 0 and misses.count() == 9 and table.read().schema == CACHE_TABLE
