"""The ledger of published rows: indexes, merge, replace, drift, reconcile.

Two indexes come from a ledger: source id to post (the last entry wins) and
content hash to post (the first entry wins). Arrival order is ``seq``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strict_json
from ..functions.text import or_empty
from ..schemas import LEDGER
from ..sources.positions import line_position, with_file_columns
from ..sources.readers import parse_lines
from .dedup import BROADCAST_ROWS
from .store import VersionedTable

MODES = ("trust_ledger", "verify", "skip")

# Names of the meta entries a published post carries.
META_SOURCE_ID = "source_id"
META_BYLINE = "byline"
META_HASH = "content_hash"


def valid_entries(ledger: DataFrame) -> DataFrame:
    """Entries with a positive post id and something to look it up by.

    The source id ``"0"`` is valid; only null and empty ones are not.
    """
    named = or_empty(F.col("source_id")) != ""
    hashed = or_empty(F.col("content_hash")) != ""
    return ledger.filter((F.col("post_id") > 0) & (named | hashed))


def read_ledger_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Import JSON lines; the place in the file becomes ``seq``. A post id counts
    only as a JSON integer."""
    scan = with_file_columns(spark.read.text(path)).withColumn("_raw", F.col("value"))
    members = {"_id": "source_id", "post_text": "post_id", "content_hash": "content_hash"}
    rows = line_position(parse_lines(scan, members), "seq")
    whole = F.col("post_text").rlike(r"\A[0-9]+\z") & ~strict_json.is_text(F.col("_raw"), "post_id")
    return valid_entries(
        rows.select(
            F.col("_id").alias("source_id"),
            F.when(whole, F.col("post_text").try_cast("bigint")).alias("post_id"),
            F.nullif(F.col("content_hash"), F.lit("")).alias("content_hash"),
            "seq",
        )
    )


def named_entries(ledger: DataFrame) -> DataFrame:
    return valid_entries(ledger).filter(or_empty(F.col("source_id")) != "")


def latest(ledger: DataFrame) -> DataFrame:
    """``source_id -> post_id``; the last entry wins."""
    return named_entries(ledger).groupBy("source_id").agg(F.max_by("post_id", "seq").alias("post_id"))


def first_hash(ledger: DataFrame) -> DataFrame:
    """``content_hash -> post_id``; the first entry wins."""
    hashed = valid_entries(ledger).filter(or_empty(F.col("content_hash")) != "")
    return hashed.groupBy("content_hash").agg(F.min_by("post_id", "seq").alias("post_id"))


def only_for(index: DataFrame, wanted: DataFrame, key: str, rows: int) -> DataFrame:
    """The part of an index that ``wanted`` (of ``rows`` rows) asks about.

    A small batch against a long ledger: the batch's keys are broadcast, the ledger is
    filtered where it is read, below its aggregate, and only matches are shuffled. A
    large batch leaves the index whole, to be joined by a shuffle.
    """
    if rows > BROADCAST_ROWS:
        return index
    return index.join(F.broadcast(wanted.select(key).distinct()), key, "left_semi")


def find_post(ledger: DataFrame, source_id: str) -> DataFrame:
    """The post of one source id: at most one row. The filter reaches the scan."""
    return latest(ledger.filter(F.col("source_id") == source_id))


def meta_value(meta: Column, kind: T.DataType, key: str) -> Column:
    """One meta entry of a map, or of a list of key/value pairs (the last wins)."""
    if isinstance(kind, T.MapType):
        return F.try_element_at(meta, F.lit(key))
    if isinstance(kind, T.ArrayType):
        hits = F.filter(meta, lambda entry: entry["key"] == key)
        return F.try_element_at(hits, F.lit(-1)).getField("value")
    return F.lit(None).cast("string")


def target_entries(target: DataFrame, seq: Column | None = None) -> DataFrame:
    """What the target's posts say about themselves, as ledger entries.

    ``target`` has ``id`` and ``meta`` (map or list of pairs). Later ids count as
    later entries unless ``seq`` gives another order.
    """
    kind = target.schema["meta"].dataType
    meta = F.col("meta")
    return valid_entries(
        target.select(
            meta_value(meta, kind, META_SOURCE_ID).cast("string").alias("source_id"),
            F.col("id").cast("bigint").alias("post_id"),
            F.nullif(meta_value(meta, kind, META_HASH).cast("string"), F.lit("")).alias("content_hash"),
            (F.col("id") if seq is None else seq).cast("bigint").alias("seq"),
        )
    )


def source_ids(target: DataFrame) -> DataFrame:
    """Only the source-id index of a target."""
    return latest(target_entries(target))


def published_entries(published: DataFrame) -> DataFrame:
    """Ledger entries of a published-posts table that keeps meta as columns."""
    return valid_entries(published.select("source_id", "post_id", "content_hash", "seq"))


def _hash_of_post(hashes: DataFrame) -> DataFrame:
    """``post_id -> content_hash``; of several hashes on one post the last stays."""
    order = ["seq", "content_hash"] if "seq" in hashes.columns else ["content_hash"]
    valid = hashes.filter((or_empty(F.col("content_hash")) != "") & (F.col("post_id") > 0))
    return valid.groupBy("post_id").agg(
        F.max(F.struct(*order)).content_hash.alias("content_hash")
    )


def _stamp(mapping: DataFrame, hashes: DataFrame | None) -> DataFrame:
    valid = mapping.filter(F.col("post_id") > 0).select("source_id", "post_id")
    if hashes is None:
        return valid.withColumn("content_hash", F.lit(None).cast("string"))
    return valid.join(_hash_of_post(hashes), "post_id", "left").select(
        "source_id", "post_id", "content_hash"
    )


def replacement(mapping: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """The entries of a ledger rebuilt from ``mapping`` (``source_id -> post_id``),
    stamped with the hash of each post. Without ``hashes`` the hash index is lost."""
    return _stamp(mapping, hashes)


def changes(ledger: DataFrame, mapping: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """The entries to append so that the ledger also says ``mapping``.

    An entry is new when its post id differs from the ledger's, or when it brings
    a hash the ledger does not have; of several bringing the same hash, the first.
    """
    stamped = _stamp(mapping, hashes)
    brings = (
        stamped.filter(F.col("content_hash").isNotNull())
        .groupBy("content_hash")
        .agg(F.min("source_id").alias("source_id"))
        .join(first_hash(ledger).select("content_hash"), "content_hash", "left_anti")
        .select("source_id", F.lit(True).alias("_new_hash"))
    )
    current = latest(ledger).withColumnRenamed("post_id", "_current")
    joined = stamped.join(current, "source_id", "left").join(brings, "source_id", "left")
    moved = ~F.col("post_id").eqNullSafe(F.col("_current"))
    return joined.filter(moved | F.col("_new_hash").isNotNull()).select(
        "source_id", "post_id", "content_hash"
    )


def replace(
    ledger: VersionedTable, mapping: DataFrame, hashes: DataFrame | None = None, batch: str = "replace"
) -> int:
    """Rebuild the ledger from ``mapping``; entries it does not have are gone. Returns
    the number of entries."""
    rows = replacement(mapping, hashes).withColumn("seq", F.lit(ledger.next_seq()))
    ledger.replace(rows, batch)
    return ledger.read(only=batch).count()


def merge(
    ledger: VersionedTable, mapping: DataFrame, hashes: DataFrame | None = None, batch: str = "merge"
) -> int:
    """Append what ``mapping`` changes; returns the number of entries written."""
    rows = changes(ledger.read(without=batch), mapping, hashes)
    ledger.append(rows.withColumn("seq", F.lit(ledger.next_seq())), batch)
    return ledger.read(only=batch).count()


def overlay(left: DataFrame, right: DataFrame, key: str = "source_id") -> DataFrame:
    """Union of two maps; the right side wins."""
    return right.unionByName(left.join(right.select(key), key, "left_anti"))


def fill(left: DataFrame, right: DataFrame, key: str = "content_hash") -> DataFrame:
    """Union of two maps; the left side wins."""
    return overlay(right, left, key)


def only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Source ids of ``left`` that ``right`` does not have."""
    return left.select("source_id").join(right.select("source_id"), "source_id", "left_anti")


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Source ids both sides have, with different posts."""
    other = right.withColumnRenamed("post_id", "_other")
    return left.join(other, "source_id").filter(F.col("post_id") != F.col("_other")).select("source_id")


def drift(ledger_index: DataFrame, target_index: DataFrame) -> DataFrame:
    """One row: ids only in the ledger, only on the target, and with other posts."""
    ours = ledger_index.withColumnRenamed("post_id", "_ours")
    theirs = target_index.withColumnRenamed("post_id", "_theirs")
    a, b = F.col("_ours"), F.col("_theirs")
    return ours.join(theirs, "source_id", "full_outer").agg(
        F.count_if(b.isNull()).alias("only_in_log"),
        F.count_if(a.isNull()).alias("only_on_target"),
        F.count_if(a.isNotNull() & b.isNotNull() & (a != b)).alias("differing"),
    )


@dataclass
class Known:
    """What is already published, as indexes, and how the ledger and target differ."""

    posts: DataFrame
    hashes: DataFrame
    drift: DataFrame | None = None


def reconcile(
    ledger: VersionedTable | None,
    target: DataFrame,
    mode: str = "trust_ledger",
    batch: str = "reconcile",
    without: str | None = None,
) -> Known:
    """Decide what is already published.

    ``trust_ledger`` uses the ledger and looks at the target only when the ledger
    is empty, which it then fills; ``verify`` lets the target replace the ledger;
    ``skip`` takes nothing as published. ``target`` holds ledger-like entries. The
    ledger is read ``without`` the batch of a run that is being repeated.
    """
    if mode not in MODES:
        raise ValueError(f"mode={mode!r}; known: {', '.join(MODES)}")
    spark = target.sparkSession
    empty = spark.createDataFrame([], LEDGER)
    if mode == "skip":
        return Known(latest(empty), first_hash(empty))
    entries = ledger.read(without=without) if ledger else empty
    if mode == "trust_ledger" and not named_entries(entries).isEmpty():
        return Known(latest(entries), first_hash(entries))
    posts, hashes = latest(target), first_hash(target)
    report = drift(latest(entries), posts)
    if ledger is None:
        return Known(posts, hashes, report)
    # the report compares with the ledger as it was, so it is taken before the write
    report = spark.createDataFrame(report.collect(), report.schema)
    if mode == "verify":
        replace(ledger, posts, hashes, batch)
        return Known(posts, hashes, report)
    merged = Known(overlay(latest(entries), posts), fill(first_hash(entries), hashes), report)
    merge(ledger, posts, hashes, batch)
    return merged
