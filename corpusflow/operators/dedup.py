"""Resume filter, content dedup and their counters.

Copies of one text may make up a large part of a corpus, so nothing here brings
the rows of one hash together: first-row windows trim before the shuffle
(``WindowGroupLimit``), counters are partial aggregates, and rows with an empty
hash, which are all kept, never share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.text import content_hash

HASH = "content_hash"
ORDER = ("sample_key", "source_id")

#: Row keys are some 30 bytes, so this many make a hash table of about 100 MB.
BROADCAST_ROWS = 1_000_000


def with_content_hash(df: DataFrame, body: str = "body") -> DataFrame:
    """Hash the raw body, before any cleaning."""
    return df.withColumn(HASH, content_hash(F.col(body)))


def resume_filter(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Drop rows whose ``source_id`` is already published. Where rows have a ``row_key``
    only keys are joined with the ledger, and texts stay where they are as long as the
    keys to drop are few."""
    if "row_key" in df.columns and len(df.columns) > 3:
        done = df.select("source_id", "row_key").join(ledger.select("source_id"), "source_id", "left_semi")
        return df.join(done.select("row_key"), "row_key", "left_anti").select(*df.columns)
    return df.join(ledger.select("source_id"), "source_id", "left_anti")


def first_per_key(df: DataFrame, key: Column | str, order: list[Column | str]) -> DataFrame:
    """The first row of each key. Each task keeps its own first before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _order(df: DataFrame, order: tuple[str, ...]) -> list[str]:
    present = [c for c in order if c in df.columns]
    return present + (["row_key"] if "row_key" in df.columns else [])


def dedup_key() -> Column:
    """The content hash, or a key of its own for a row without one."""
    return F.when(F.col(HASH) == "", F.concat(F.lit("row:"), F.col("row_key"))).otherwise(
        F.col(HASH)
    )


def dedup_content(
    df: DataFrame, known: DataFrame | None = None, order: tuple[str, ...] = ORDER
) -> DataFrame:
    """First row per content hash, without hashes in ``known``; empty hashes stay.

    Dropping known hashes after taking the first row gives the same rows as before
    it, and both steps then use one partitioning by hash. With a ``row_key`` column
    the choice is made on keys and no text is sorted or moved by hash; without one,
    rows with an empty hash take a branch of their own, which needs no shuffle.
    """
    if "row_key" in df.columns:
        return select_rows(df, None, known, order)
    kept = first_per_key(df.filter(F.col(HASH) != ""), HASH, _order(df, order))
    if known is not None:
        kept = kept.join(known.select(HASH), HASH, "left_anti")
    return kept.select(*df.columns).unionByName(df.filter(F.col(HASH) == ""))


def selection_keys(df: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The columns that decide which rows are kept; narrow beside a text."""
    return df.select(*dict.fromkeys(["source_id", HASH, *_order(df, order)]))


def select_rows(
    df: DataFrame,
    ledger: DataFrame | None = None,
    known: DataFrame | None = None,
    order: tuple[str, ...] = ORDER,
    keys: DataFrame | None = None,
    counts: Row | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Resume filter plus content dedup, deciding on keys and moving text at most once.

    The wide way shuffles every text by id for the ledger and again by hash. Here
    only ``selection_keys`` goes through those joins; the rows to keep are then
    picked by ``row_key``, which is unique and so cannot be skewed. ``keys`` may be
    a stored copy of the selection keys.

    With ``counts``, the row of a funnel, the pick takes the cheapest form: nothing
    when nothing is dropped; a broadcast of the keys kept or dropped when one of the
    two is at most ``BROADCAST_ROWS`` long, and texts stay where they were read;
    else a shuffle. ``rows``, the length of ``df``, serves as well where it is at most
    ``BROADCAST_ROWS``. Needs ``row_key``.
    """
    keys = selection_keys(df, order) if keys is None else keys
    fresh = keys if ledger is None else resume_filter(keys, ledger)
    first = F.min(F.struct(*_order(df, order))).getField("row_key").alias("row_key")
    winners = fresh.groupBy(dedup_key().alias("_key")).agg(first)
    if known is not None:
        winners = winners.join(known.select(F.col(HASH).alias("_key")), "_key", "left_anti")
    kept = winners.select("row_key")
    if rows is not None and rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(kept), "row_key", "left_semi")
    if counts is not None:
        n_kept = counts["after_content_dedup"]
        n_dropped = counts["fetched"] - n_kept
        if n_dropped == 0:
            return df
        if n_kept <= BROADCAST_ROWS:
            return df.join(F.broadcast(kept), "row_key", "left_semi")
        if n_dropped <= BROADCAST_ROWS:
            dropped = keys.select("row_key").join(kept, "row_key", "left_anti")
            return df.join(F.broadcast(dropped), "row_key", "left_anti")
    return df.join(kept, "row_key", "left_semi")


def row_funnel(
    df: DataFrame,
    ledger: DataFrame | None = None,
    known: DataFrame | None = None,
    dedup: bool = True,
) -> DataFrame:
    """One row of counts: fetched, after resume, after dedup, and what dedup dropped
    (nothing without ``dedup``).

    ``fetched = resumed + cross_run + within_run + after_content_dedup``. A hash
    that is both known and repeated counts as ``cross_run``.
    """
    keys = df.select("source_id", HASH)
    if ledger is None:
        keys = keys.withColumn("_done", F.lit(False))
    else:
        done = ledger.select("source_id").distinct().withColumn("_done", F.lit(True))
        keys = keys.join(done, "source_id", "left")
    fresh = ~F.coalesce("_done", F.lit(False))
    groups = keys.groupBy(HASH).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(fresh).alias("_fresh")
    )
    if known is None:
        groups = groups.withColumn("_known", F.lit(False))
    else:
        seen = known.select(HASH).distinct().withColumn("_known", F.lit(True))
        groups = groups.join(seen, HASH, "left")
    is_known = F.coalesce("_known", F.lit(False)) & (F.col(HASH) != "") & F.lit(dedup)
    repeated = F.when(F.lit(dedup) & ~is_known & (F.col(HASH) != "") & (F.col("_fresh") > 0), F.col("_fresh") - 1)

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    counts = groups.agg(
        total(F.col("_all"), "fetched"),
        total(F.col("_fresh"), "after_source_id_resume"),
        total(F.when(is_known, F.col("_fresh")), "cross_run"),
        total(repeated, "within_run"),
        total(F.when(F.col(HASH) == "", F.col("_fresh")), "empty_hash"),
    )
    return counts.withColumn(
        "after_content_dedup",
        F.col("after_source_id_resume") - F.col("cross_run") - F.col("within_run"),
    )


def hash_coverage(funnel: DataFrame) -> DataFrame:
    """Add ``coverage``: ``none`` or ``partial`` when all or half of the rows hash to
    empty, which mostly means the body field is mapped wrongly; else ``ok``."""
    rows, empty = F.col("after_source_id_resume"), F.col("empty_hash")
    return funnel.withColumn(
        "coverage",
        F.when(rows == 0, "ok")
        .when(empty >= rows, "none")
        .when(empty * 2 >= rows, "partial")
        .otherwise("ok"),
    )
