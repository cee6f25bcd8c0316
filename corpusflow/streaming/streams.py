"""Streams of corpus rows into a published-posts table.

The stream carries rows through the same Column functions as a batch run. What is
already published is read from the target itself, so target and ledger cannot
part, and a micro-batch writes under a name of its own, so replaying it after a
crash replaces it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.picks import sample_key
from ..operators import publish
from ..operators.cache import with_cache
from ..operators.dedup import BROADCAST_ROWS, HASH, row_funnel, select_rows, with_content_hash
from ..operators.keys import KeyIndex
from ..operators.ledger import first_hash, latest, only_for, published_entries
from ..operators.store import VersionedTable, _read_if_exists, arrival
from ..plans.runs import PUBLISHED, published_rows
from ..plans.transforms import with_picks
from ..schemas import OUTCOME, POST_FIELDS
from ..sources.positions import row_key
from ..sources.readers import map_fields, parse_lines, split_field_map


def read_stream(
    spark: SparkSession,
    path: str,
    field_map: dict[str, str],
    schema: T.StructType | None = None,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New files under ``path`` as ``source_id`` plus logical fields.

    With a ``schema`` the files are Parquet; without one, strict JSON lines. Rows
    without an id get a hash of their fields. ``max_files`` per trigger bounds the
    work taken on at once.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    id_field, fields = split_field_map(field_map)
    if schema is not None:
        rows = map_fields(reader.schema(schema).parquet(path), field_map)
    else:
        rows = parse_lines(reader.text(path), {"_id": id_field, **fields})
    names = list(fields)
    fallback = F.md5(F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])))
    return rows.select(F.coalesce("_id", fallback).alias("source_id"), *[F.col(f"`{n}`") for n in names])


def transform_stream(rows: DataFrame, cfg: dict, posts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hash, pick and transform, row by row; nothing here keeps state."""
    body = (cfg.get("transform") or {}).get("body_field") or "body"
    return posts(with_picks(with_content_hash(rows, body), cfg))


def stream_dedup(rows: DataFrame, body: str = "body") -> DataFrame:
    """First row per content hash over the whole life of the stream.

    State grows by one hash per distinct text and is never dropped, so give it the
    RocksDB state store, or use ``stream_publish``, which asks the target instead.
    Rows with an empty hash all pass, on a branch without state.
    """
    hashed = with_content_hash(rows, body)
    distinct = hashed.filter(F.col(HASH) != "").dropDuplicates([HASH])
    return distinct.unionByName(hashed.filter(F.col(HASH) == ""))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: the same after a restart, new for a new
    checkpoint even at the old place."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


@dataclass
class StreamSink:
    """The ``foreachBatch`` function of ``stream_publish``."""

    target: VersionedTable
    checkpoint: str
    cfg: dict
    posts: Callable[[DataFrame], DataFrame]
    categories: DataFrame
    authors: DataFrame | None = None
    results: VersionedTable | None = None
    cache: VersionedTable | None = None
    signature: str = ""
    slice_rows: int | None = None
    index: KeyIndex | None = None
    retries: int = 0
    caught_up: bool = False

    def _again(self, stream: str, batch_id: int, like: DataFrame) -> DataFrame:
        """Rows whose transform failed in a batch and that are to be tried once more."""
        return _read_if_exists(like.sparkSession, f"{self.target.path}/staged/{stream}/again/{batch_id}", like.schema)

    def _recovered(self, done: DataFrame, landed: DataFrame) -> DataFrame:
        """Outcomes in which posts that landed in an attempt that died say so."""
        before = landed.select("source_id", F.col("post_id").alias("_landed")).distinct()
        joined = done.join(before, "source_id", "left")
        hit = F.col("_landed").eqNullSafe(F.col("post_id")) & F.col("ok") & F.col("skipped").isNull()
        flag = F.when(hit, F.lit(True)).otherwise(F.col("recovered_after_retry"))
        return joined.withColumn("recovered_after_retry", flag).select(*done.columns)

    def _known(self, arrived: DataFrame, n: int, stream: str, batch_id: int) -> tuple[DataFrame, DataFrame, int]:
        """(ids, hashes) that the target has, of those that arrived, and its top post id,
        all but those of this batch, which a replay writes anew."""
        batch = f"{stream}-{batch_id}"
        if self.index is None:
            there = self.target.read(without=batch)
            entries = published_entries(there)
            posts = only_for(latest(entries), arrived, "source_id", n)
            hashes = only_for(first_hash(entries), arrived, HASH, n)
            return posts, hashes, there.agg(F.max("post_id")).first()[0] or 0
        if not self.caught_up:
            self.index.catch_up(self.target, batch)
            self.caught_up = True
        top = self.index.top(f"{stream}-{batch_id - 1}")
        top = self.index.greatest(batch) if top is None else top
        return self.index.posts(arrived, n, batch), self.index.hashes(arrived, n, batch), top

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        load = self.cfg.get("load") or {}
        body = (self.cfg.get("transform") or {}).get("body_field") or "body"
        stream = _stream_id(spark, self.checkpoint)
        batch = f"{stream}-{batch_id}"
        # read the source once; the stage holds one micro-batch and is reused
        hashed = with_content_hash(rows, body).withColumn("sample_key", sample_key(F.col("source_id")))
        hashed = hashed.withColumn("attempt", F.lit(0))
        if self.retries:
            hashed = hashed.unionByName(self._again(stream, batch_id - 1, hashed))
        arrived = self._stage(f"{stream}/arrived", hashed).select("*", row_key().alias("row_key"))
        n = arrived.count()
        posts, hashes, top = self._known(arrived, n, stream, batch_id)
        # keys are counted first where that may keep the texts of a large batch in place
        counts = row_funnel(arrived, posts, hashes).first() if n > BROADCAST_ROWS else None
        fresh = select_rows(arrived, posts, hashes, counts=counts, rows=n)
        # the transform runs once per row; its failures become results, not lost rows
        ready = with_picks(fresh, self.cfg)
        if self.cache is None:
            made = self._stage(f"{stream}/made", self.posts(ready).select(*POST_FIELDS, "error"))
            good = made.filter(F.col("error").isNull()).select(*POST_FIELDS)
        else:
            good, made = with_cache(ready, self.cache, self.signature, self.posts, batch, self.slice_rows)
            good = self._stage(f"{stream}/made", good)
        resolved = publish.with_category(good, self.categories)
        assigned = publish.assign_ids(resolved, posts, top)
        created = publish.with_author(publish.created_posts(resolved, assigned), self.authors)
        # what an attempt at this batch that died left on the target
        landed = self._stage(f"{stream}/landed", self.target.read(only=batch).select("source_id", "post_id"))
        byline = bool((load.get("author") or {}).get("prepend_to_content"))
        status = load.get("post_status", "publish")
        self.target.append(published_rows(created, status, byline, arrival()), batch)
        if self.index is not None:
            self.index.add(published_entries(self.target.read(only=batch)), batch, top)
        errors = made.filter(F.col("error").isNotNull()).select("source_id", "error")
        if self.retries:
            lost = arrived.drop("row_key").join(errors.select("source_id").distinct(), "source_id", "left_semi")
            lost = lost.where(F.col("attempt") < self.retries).withColumn("attempt", F.col("attempt") + 1)
            self._stage(f"{stream}/again/{batch_id}", lost.select(*hashed.columns))
        if self.results is not None:
            done = self._recovered(publish.publish_outcomes(resolved, assigned), landed)
            self.results.append(
                done.unionByName(publish.error_outcomes(errors, "transform")), batch
            )

    def _stage(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.target.path}/staged/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_publish(
    rows: DataFrame,
    target: VersionedTable,
    checkpoint: str,
    cfg: dict,
    posts: Callable[[DataFrame], DataFrame],
    categories: DataFrame,
    authors: DataFrame | None = None,
    results: VersionedTable | None = None,
    trigger: dict | None = None,
    cache: VersionedTable | None = None,
    signature: str = "",
    slice_rows: int | None = None,
    index: KeyIndex | None = None,
    retries: int = 0,
) -> StreamingQuery:
    """Publish a stream of rows, each source id and each content once.

    With a ``cache`` of results made under ``signature`` a row that has one is not
    transformed again, in a replayed micro-batch neither.

    A restart with the same ``checkpoint`` goes on where the stream stopped.
    With an ``index`` of the target's keys a micro-batch reads the parts of it that its own
    keys fall in, and nothing of the target; without one it reads the target's key columns.
    With ``results`` each micro-batch also records the outcome of every post; a post that
    landed in an attempt that died before its outcome was written has it as recovered.
    Rows whose transform failed come again with the next micro-batch, ``retries`` times at
    most; every attempt leaves an outcome.
    ``trigger`` defaults to working off what is there and stopping. Row counts of
    every micro-batch show up in the query's progress as the ``rows`` metrics.
    """
    observed = rows.observe("rows", *_metrics(F.col("source_id")))
    sink = StreamSink(target, checkpoint, cfg, posts, categories, authors, results, cache, signature, slice_rows, index, retries)
    return (
        observed.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _metrics(id_: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("fetched"), F.count_if(id_ == "").alias("empty_ids")]


def results_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, OUTCOME)


def published_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, PUBLISHED)
