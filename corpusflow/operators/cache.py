"""Transform results kept under the signature they were made with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strict_json
from ..functions.text import or_else, or_empty, py_strip, redact
from ..schemas import CACHE, POST_FIELDS
from ..sources.positions import line_position, with_file_columns
from .dedup import first_per_key
from .store import VersionedTable

#: A stored cache row: the entry, its arrival order, and what making it took. A
#: row whose transform failed has no post, so a later run tries it again.
CACHE_TABLE = T.StructType(
    [
        *CACHE.fields,
        T.StructField("seq", T.LongType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("retries", T.IntegerType()),
        T.StructField("rate_limited", T.IntegerType()),
    ]
)

REQUIRED = POST_FIELDS[:-1]

#: Files of a task move to their place when it ends, not when the job does (Hadoop's file
#: committer; committers of object stores have rules of their own).
COMMIT_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def read_cache_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Import JSON lines as ``(sig, post, seq)``.

    Lines that are no JSON object are dropped. ``post`` is null when a member is
    missing or unknown; a missing ``content_hash`` reads as empty.
    """
    member = T.StructType([T.StructField(f, T.StringType()) for f in POST_FIELDS])
    shape = T.StructType([T.StructField("sig", T.StringType()), T.StructField("post", member)])
    line = py_strip(F.col("value"))
    scan = with_file_columns(spark.read.text(path)).filter(strict_json.is_json_object(line))
    numbered = line_position(scan, "seq")
    entry = F.get(
        F.from_json(F.concat(F.lit("["), line, F.lit("]")), T.ArrayType(shape), strict_json.STRICT),
        F.lit(0),
    )
    keys = F.json_object_keys(F.get_json_object(line, "$.post"))
    post = entry.post
    whole = F.size(F.array_except(keys, F.array(*[F.lit(f) for f in POST_FIELDS]))) == 0
    for name in REQUIRED:
        whole = whole & F.array_contains(keys, name)
    filled = F.struct(*[or_empty(post[f]).alias(f) for f in POST_FIELDS])
    return numbered.select(entry.sig.alias("sig"), F.when(whole, filled).alias("post"), "seq")


def _is_usable(sig: str) -> Column:
    # a post is whole or null, so its id tells; no text is read to find out
    return F.coalesce((F.col("sig") == sig) & F.col("post.source_id").isNotNull(), F.lit(False))


def usable(entries: DataFrame, sig: str) -> DataFrame:
    """Well-formed entries made under ``sig``; stale ones are left in the scan."""
    return entries.filter(F.col("sig") == sig).filter(F.col("post.source_id").isNotNull())


def lookup(entries: DataFrame, sig: str, rows: DataFrame | None = None) -> DataFrame:
    """One post per source id; the last entry wins. Given the ``rows`` in question,
    posts of others are left out before they are moved."""
    flat = usable(entries, sig).select("post.*", "seq")
    if rows is not None:
        flat = flat.join(rows.select("source_id"), "source_id", "left_semi")
    last = first_per_key(flat, "source_id", [F.desc("seq"), F.desc("content_hash")])
    return last.select(*POST_FIELDS)


def split_by_cache(rows: DataFrame, entries: DataFrame, sig: str) -> tuple[DataFrame, DataFrame]:
    """(cached posts of these rows, rows without one).

    Of the rows with a cached post only id and hash are read, and of the cached posts
    of the others nothing but their ids. A cached post keeps its author and date; an
    empty hash is filled from the row.
    """
    stamp = rows.select("source_id", F.col("content_hash").alias("_hash"))
    fields: list[Column] = [F.col(f) for f in POST_FIELDS[:-1]]
    hash_ = or_else(F.col("content_hash"), or_empty(F.col("_hash"))).alias("content_hash")
    hits = lookup(entries, sig, rows).join(stamp, "source_id").select(*fields, hash_)
    ids = usable(entries, sig).select(F.col("post.source_id").alias("source_id"))
    return hits, rows.join(ids, "source_id", "left_anti")


def with_cache(
    rows: DataFrame,
    cache: VersionedTable,
    sig: str,
    transform: Callable[[DataFrame], DataFrame],
    batch: str,
    slice_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(posts of ``rows``, what was made now), transforming only rows not cached.

    New results are written to the cache first and read back, so an expensive
    transform runs once per row whatever is done with the posts later. ``transform``
    returns the post fields, ``error`` and any of the usage columns; rows with an
    error yield no post and are not cached, but asked again next time.

    One job makes them all, and each task's results are in the cache as soon as it ends:
    a run that dies pays again for the tasks that were open. With ``slice_rows`` a task gets
    about so many rows at most, dealt by a hash of their ids; one that runs again replaces its
    files. Whatever is there counts, also what an earlier attempt of the same ``batch`` left.
    """
    hits, misses = split_by_cache(rows, cache.read(), sig)
    stamp = cache.next_seq()
    if slice_rows:
        tasks = -(-misses.count() // slice_rows)
        if tasks > 1:  # fewer rows stay in the tasks that read them
            misses = misses.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism), F.xxhash64("source_id"))
    done = transform(misses)
    usage = [
        (F.col(f.name) if f.name in done.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CACHE_TABLE.fields[3:]
    ]
    post = F.when(F.col("error").isNull(), F.struct(*POST_FIELDS)).alias("post")
    result = done.select(F.lit(sig).alias("sig"), post, F.lit(stamp).alias("seq"), *usage)
    name = f"{batch}-{stamp}"
    cache.append(result.withColumn("error", redact(F.col("error"))), name, **COMMIT_BY_TASK)
    made = cache.read(only=name)
    good = made.filter(F.col("post").isNotNull()).select("post.*")
    return hits.unionByName(good), made.drop("post", "sig", "seq")


def cache_stats(
    entries: DataFrame, sig: str, rows: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """One row: entries loaded and stale, hits and misses of ``rows``, final size.

    ``entries`` is the cache before the run. Ids in ``failed`` got no post, and count
    in the size only if they were there before."""
    good = _is_usable(sig)
    loaded = entries.agg(
        F.count_if(good).alias("loaded_at_start"),
        F.count_if(~F.col("sig").eqNullSafe(F.lit(sig))).alias("stale_at_start"),
    )
    ids = usable(entries, sig).select(F.col("post.source_id").alias("source_id")).distinct()
    cached = ids.withColumn("_cached", F.lit(True))
    asked = rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("_asked"))
    both = asked.join(cached, "source_id", "full_outer")
    hit = F.col("_cached").isNotNull()
    stored = F.lit(True)
    if failed is not None:
        lost = failed.select("source_id").distinct().withColumn("_lost", F.lit(True))
        both = both.join(lost, "source_id", "left")
        stored = hit | F.col("_lost").isNull()

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    counts = both.agg(
        total(F.when(hit, F.col("_asked"))).alias("hits"),
        total(F.when(~hit, F.col("_asked"))).alias("misses"),
        F.count_if(stored).alias("size"),
    )
    names = ["loaded_at_start", "stale_at_start", "hits", "misses", "size"]
    return loaded.unionByName(counts, allowMissingColumns=True).agg(
        *[F.max(name).alias(name) for name in names]
    )
