import pytest
from pyspark.sql import functions as F

from corpusflow.functions.picks import sample_key
from corpusflow.operators import dedup
from corpusflow.operators.dedup import (
    dedup_content,
    hash_coverage,
    resume_filter,
    row_funnel,
    select_rows,
    with_content_hash,
)


def rows_of(spark, bodies):
    """(id, body) pairs as hashed rows with a sample order and a row key."""
    df = spark.createDataFrame(
        [(i, b, f"{n:05d}") for n, (i, b) in enumerate(bodies)],
        "source_id string, body string, row_key string",
    )
    return with_content_hash(df).withColumn("sample_key", sample_key(F.col("source_id")))


def brute_force(rows, published=(), known=()):
    kept, seen = [], set()
    counts = dict(cross_run=0, within_run=0, empty_hash=0)
    rows = sorted(rows, key=lambda r: (r.sample_key, r.source_id, r.row_key))
    fresh = [r for r in rows if r.source_id not in published]
    for r in fresh:
        h = r.content_hash
        if not h:
            counts["empty_hash"] += 1
            kept.append(r.row_key)
        elif h in known:
            counts["cross_run"] += 1
        elif h in seen:
            counts["within_run"] += 1
        else:
            seen.add(h)
            kept.append(r.row_key)
    return sorted(kept), dict(
        counts, fetched=len(rows), after_source_id_resume=len(fresh), after_content_dedup=len(kept)
    )


CORPUS = (
    [("a", "one"), ("b", " one\n"), ("c", "two"), ("d", ""), ("e", " "), ("e", ""), ("e", "")]
    + [(f"h{i}", "hot text") for i in range(400)]
    + [(f"u{i}", f"text {i % 90}") for i in range(300)]
    + [("same", "again"), ("same", "again"), ("same", "other")]
    + [("p1", "text 3"), ("p2", "only here")]
)


@pytest.mark.parametrize("with_known", [True, False])
def test_dedup_matches_brute_force(spark, monkeypatch, with_known):
    df = rows_of(spark, CORPUS).repartition(6).cache()
    published = ["p1", "p2", "u7", "absent"]
    ledger = spark.createDataFrame([(p, 1) for p in published], "source_id string, post_id long")
    known = rows_of(spark, [("k", "two"), ("k2", "text 5"), ("k3", "nowhere"), ("k4", "")])
    hashes = {r.content_hash for r in known.collect()} if with_known else set()
    known = known if with_known else None
    kept, counts = brute_force(df.collect(), published, hashes)

    fresh = resume_filter(df, ledger)
    keys = lambda frame: sorted(r.row_key for r in frame.collect())
    assert keys(dedup_content(fresh, known)) == kept
    assert keys(select_rows(df, ledger, known)) == kept
    for bound in (0, 1000, len(kept)):
        monkeypatch.setattr(dedup, "BROADCAST_ROWS", bound)
        row = row_funnel(df, ledger, known).first()
        assert keys(select_rows(df, ledger, known, counts=row)) == kept
    # without row keys copies alike in id and text may swap, their number may not
    plain = dedup_content(fresh.drop("row_key"), known)
    assert plain.count() == len(kept)
    assert row_funnel(df, ledger, known).first().asDict() == counts
    # deduplicating again changes nothing
    assert dedup_content(dedup_content(fresh, known), known).count() == len(kept)


def test_funnel_without_ledger(spark):
    df = rows_of(spark, CORPUS)
    kept, counts = brute_force(df.collect())
    assert row_funnel(df).first().asDict() == counts
    assert select_rows(df).count() == len(kept)


@pytest.mark.parametrize(
    "bodies, want",
    [(["", " "], "none"), (["", "x"], "partial"), (["", "x", "y"], "ok"), ([], "ok")],
)
def test_hash_coverage(spark, bodies, want):
    df = rows_of(spark, [(str(i), b) for i, b in enumerate(bodies)])
    assert hash_coverage(row_funnel(df)).first().coverage == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_hashes_shrink_before_the_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = docs.select(F.col("doc_id").cast("string").alias("source_id"), F.col("text").alias("body"))
    plan = plan_of(dedup_content(with_content_hash(df)))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "Python" not in plan


def test_texts_stay_put_when_little_is_dropped(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = with_content_hash(
        docs.select(
            F.col("doc_id").cast("string").alias("source_id"),
            F.col("text").alias("body"),
            F.concat(F.lit("k"), F.col("doc_id")).alias("row_key"),
        )
    )
    counts = row_funnel(df).first()
    plan = plan_of(select_rows(df, counts=counts))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin [row_key" not in plan.split("BroadcastExchange")[0]
    distinct = df.dropDuplicates(["content_hash"])
    same = row_funnel(distinct).first()
    assert select_rows(distinct, counts=same) is distinct


def test_texts_of_a_batch_of_known_length_stay_put(spark, monkeypatch):
    """Up to the bound keys are broadcast without being counted; beyond it, and without a
    length, the same rows are kept by a shuffle."""
    rows = spark.range(40).selectExpr("cast(id as string) source_id", "cast(id % 7 as string) content_hash", "cast(id as string) row_key", "'text' body")
    known = spark.createDataFrame([("3",)], "content_hash string")
    ways = [dedup.select_rows(rows, None, known, rows=n) for n in (40, None)]
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 39)
    ways.append(dedup.select_rows(rows, None, known, rows=40))
    kept = [sorted(r.source_id for r in w.collect()) for w in ways]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 6
    # only the logical plan tells: such small sides are broadcast anyway
    hinted = [w._jdf.queryExecution().analyzed().toString().count("Hint") + w._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") for w in ways]
    assert hinted[0] > 0 and hinted[1] == hinted[2] == 0
