"""The one-row report of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """One row of outcome counts. ``posts_uploaded`` counts skipped posts too, as
    posts known to be on the target; ``posts_created`` does not."""
    ok, dry = F.coalesce("ok", F.lit(False)), F.coalesce("dry_run", F.lit(False))
    skipped = F.coalesce("skipped", F.lit(False))
    failed = F.count_if(~ok)
    return outcomes.agg(
        F.count_if(ok & ~dry).alias("posts_uploaded"),
        F.count_if(ok & ~dry & ~skipped).alias("posts_created"),
        F.count_if(skipped).alias("posts_skipped_existing"),
        F.count_if(F.coalesce("recovered_after_retry", F.lit(False))).alias("posts_recovered"),
        failed.alias("posts_failed"),
        F.when(failed > 0, 1).otherwise(0).alias("exit_code"),
    )


def pace(elapsed: Column, posts: Column) -> Column:
    """Seconds per post; null when there are none."""
    return F.round(F.try_divide(elapsed, posts), 4)


def _retries(chat: DataFrame | None) -> list[str]:
    return [n for n in ("retries", "rate_limited") if chat is not None and n in chat.columns]


def _as_struct(df: DataFrame | None, names: list[str]) -> Column:
    """A one-row table as a struct value; null when there is none."""
    if df is None:
        kinds = ", ".join(f"{n}: string" for n in names)
        return F.lit(None).cast(f"struct<{kinds}>")
    return df.select(F.struct(*names)).scalar()


def _fact(value: object) -> Column:
    return F.lit(None).cast("string") if value is None else F.lit(value)


def run_summary(
    outcomes: DataFrame,
    posts: DataFrame,
    elapsed_sec: float,
    funnel: DataFrame | None = None,
    chat: DataFrame | None = None,
    embedding: DataFrame | None = None,
    cache: DataFrame | None = None,
    calls: int = 0,
    facts: dict[str, object] | None = None,
) -> DataFrame:
    """All counters of a run in one row.

    ``posts`` and ``outcomes`` are each read once, and only in the columns counted.
    Without a funnel, the rows fetched are those prepared plus those failed.
    """
    prepared = posts.agg(F.count(F.lit(1))).scalar()
    counts = outcome_counts(outcomes).withColumn("posts_prepared", prepared)
    funnel_names = ["fetched", "after_source_id_resume", "after_content_dedup"]
    dedup_names = ["cross_run", "within_run", "empty_hash"]
    if funnel is not None and "coverage" in funnel.columns:
        dedup_names.append("coverage")
    fetched = F.col("posts_prepared") + F.col("posts_failed")
    if funnel is not None:
        counted = funnel.select("fetched").scalar()
        fetched = F.when(counted > 0, counted).otherwise(fetched)
    elapsed = F.lit(float(elapsed_sec))
    return counts.select(
        *[_fact(value).alias(name) for name, value in (facts or {}).items()],
        fetched.alias("rows_fetched"),
        "posts_prepared",
        "posts_uploaded",
        "posts_created",
        "posts_skipped_existing",
        "posts_recovered",
        "posts_failed",
        "exit_code",
        F.lit(calls).cast("bigint").alias("completion_calls"),
        F.round(elapsed, 2).alias("elapsed_sec"),
        pace(elapsed, F.col("posts_prepared")).alias("pace_sec_per_post"),
        _as_struct(funnel, funnel_names).alias("rows_funnel"),
        _as_struct(funnel, dedup_names).alias("content_dedup"),
        _as_struct(chat, ["model", "input_tokens", "output_tokens", "est_usd", "priced", *_retries(chat)]).alias("chat_cost"),
        _as_struct(
            embedding, ["posts", "est_tokens", "provider", "model", "dimensions", "est_usd"]
        ).alias("embedding_estimate"),
        _as_struct(cache, ["loaded_at_start", "stale_at_start", "hits", "misses", "size"]).alias("cache"),
    )
