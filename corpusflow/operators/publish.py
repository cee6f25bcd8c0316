"""The post sink: what happens to each post, which posts are created, and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import block_content, html_escape, or_empty, redact, with_byline
from ..schemas import OUTCOME
from .dedup import first_per_key
from .ledger import META_BYLINE, META_HASH, META_SOURCE_ID
from .numbering import number_rows

COPY_CHUNK = 1_000_000


def outcome_rows(df: DataFrame, **given: Column) -> DataFrame:
    """Rows in the outcome schema; what is not given is null."""
    return df.select(
        *[
            (given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in OUTCOME.fields
        ]
    )


def dry_run_outcomes(posts: DataFrame) -> DataFrame:
    return outcome_rows(posts, source_id=F.col("source_id"), ok=F.lit(True), dry_run=F.lit(True))


def error_outcomes(errors: DataFrame, stage: str) -> DataFrame:
    """``(source_id, error)`` rows as failed outcomes of a stage; the run goes on.
    Errors are shortened, and what looks like a credential is taken out."""
    text = F.concat(F.lit(f"{stage}: "), redact(or_empty(F.col("error"))))
    return outcome_rows(errors, source_id=F.col("source_id"), ok=F.lit(False), error=text)


def with_category(posts: DataFrame, categories: DataFrame) -> DataFrame:
    """Add ``category_id``; null when the category is not in the mapping.

    Mappings are as large as the label list, so Spark broadcasts them on their
    size; a large one is shuffled, and adaptive execution splits a hot label.
    """
    dim = categories.select(F.col("name").alias("category"), F.col("id").alias("category_id"))
    return posts.join(dim, "category", "left")


def with_author(posts: DataFrame, authors: DataFrame | None) -> DataFrame:
    """Add ``author_id``; null when there is none, which is no error."""
    if authors is None:
        return posts.withColumn("author_id", F.lit(None).cast("bigint"))
    dim = authors.select(F.col("name").alias("author"), F.col("id").alias("author_id"))
    return posts.join(dim, "author", "left")


def category_errors(resolved: DataFrame) -> DataFrame:
    """Failed outcomes of posts without a category id."""
    error = F.concat(F.lit("category not in mapping: '"), F.col("category"), F.lit("'"))
    return outcome_rows(
        resolved.filter(F.col("category_id").isNull()),
        source_id=F.col("source_id"),
        ok=F.lit(False),
        error=error,
    )


def assign_ids(
    resolved: DataFrame, existing: DataFrame, top_id: int = 0, own: DataFrame | None = None
) -> DataFrame:
    """One row per source id with a category: how often it occurs, its post id, and
    whether that post was there before.

    New ids are dense from ``top_id + 1`` in the order of the id's MD5. ``own`` has the
    ids an earlier attempt of this batch gave; its posts are made again under them.
    """
    counted = (
        resolved.filter(F.col("category_id").isNotNull())
        .groupBy("source_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    known = existing.select("source_id", F.col("post_id").alias("_old"))
    matched = counted.join(known, "source_id", "left")
    old = matched.filter(F.col("_old").isNotNull()).select(
        "source_id", "copies", F.col("_old").alias("post_id"), F.lit(False).alias("created")
    )
    made = F.lit(True).alias("created")
    fresh = counted.join(known, "source_id", "left_anti")
    if own is not None:
        again = fresh.join(own.select("source_id", "post_id"), "source_id")
        old = old.unionByName(again.select("source_id", "copies", "post_id", made))
        fresh = fresh.join(own.select("source_id"), "source_id", "left_anti")
    new = number_rows(
        fresh,
        F.md5("source_id"),
        ["source_id"],
        "post_id",
        top_id,
    ).select("source_id", "copies", "post_id", made)
    return old.unionByName(new)


def _repeat(df: DataFrame, times: Column, out: str) -> DataFrame:
    """Each row ``times`` times, numbered from 0; long runs go in chunks, so that no
    array grows with the copies of one id."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / COPY_CHUNK).cast("bigint"))
    start = F.col("_chunk") * COPY_CHUNK
    end = F.least(start + COPY_CHUNK, times) - 1
    return (
        df.withColumn("_chunk", F.explode(chunks))
        .hint("rebalance")  # the chunks of one id go to many tasks
        .withColumn(out, F.explode(F.sequence(start, end.cast("bigint"))))
        .drop("_chunk")
    )


def publish_outcomes(resolved: DataFrame, assigned: DataFrame) -> DataFrame:
    """One outcome per post: created, skipped because it was there, or failed.

    Of the posts that share a source id the first is created and the others are
    skipped with its post id. Their outcomes are alike, so they are made from a
    count per id and no text is moved for them.
    """
    copies = _repeat(assigned, F.col("copies"), "_copy")
    skipped = ~F.col("created") | (F.col("_copy") > 0)
    done = outcome_rows(
        copies,
        source_id=F.col("source_id"),
        ok=F.lit(True),
        post_id=F.col("post_id"),
        skipped=F.when(skipped, F.lit(True)),
    )
    return done.unionByName(category_errors(resolved))


def created_posts(resolved: DataFrame, assigned: DataFrame) -> DataFrame:
    """The posts to write, with their ids: the first post of each new source id."""
    order = ["content_hash", "title", "date_gmt"]
    valid = resolved.filter(F.col("category_id").isNotNull())
    first = first_per_key(valid, "source_id", order)
    new = assigned.filter("created").select("source_id", "post_id")
    return first.join(new, "source_id")


def recover(outcomes: DataFrame, target_index: DataFrame) -> DataFrame:
    """Failed outcomes whose post did land on the target become skipped ones."""
    landed = target_index.select("source_id", F.col("post_id").alias("_landed"))
    joined = outcomes.join(landed, "source_id", "left")
    hit = ~F.col("ok") & F.col("_landed").isNotNull()

    def pick(name: str, value: Column) -> Column:
        return F.when(hit, value).otherwise(F.col(name))

    return outcome_rows(
        joined,
        source_id=F.col("source_id"),
        ok=F.col("ok") | hit,
        post_id=pick("post_id", F.col("_landed")),
        skipped=pick("skipped", F.lit(True)),
        recovered_after_retry=pick("recovered_after_retry", F.lit(True)),
        dry_run=F.col("dry_run"),
        error=F.when(~hit, F.col("error")),
        status=F.when(~hit, F.col("status")),
    )


def recovered_entries(recovered: DataFrame, posts: DataFrame) -> DataFrame:
    """Ledger entries of recovered posts."""
    hit = recovered.filter("recovered_after_retry").select("source_id", "post_id")
    hashes = posts.groupBy("source_id").agg(F.min("content_hash").alias("content_hash"))
    return hit.join(hashes, "source_id", "left").select("source_id", "post_id", "content_hash")


def rendered(post_content: Column, author: Column, byline: bool) -> Column:
    body = block_content(post_content)
    return with_byline(body, author) if byline else body


def payload(status: str = "publish", byline: bool = False) -> Column:
    """The publish request of a post as JSON text; a missing author is left out."""
    meta = F.create_map(
        F.lit(META_SOURCE_ID),
        F.col("source_id"),
        F.lit(META_BYLINE),
        F.col("author"),
        F.lit(META_HASH),
        F.col("content_hash"),
    )
    return F.to_json(
        F.struct(
            html_escape(F.col("title")).alias("title"),
            rendered(F.col("content"), F.col("author"), byline).alias("content"),
            F.lit(status).alias("status"),
            F.col("date_gmt"),
            F.array(F.col("category_id")).alias("categories"),
            meta.alias("meta"),
            F.col("author_id").alias("author"),
        )
    )
