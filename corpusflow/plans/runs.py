"""A whole run: corpus to published posts, or to prepared posts when dry."""

from __future__ import annotations

import time
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cost, dimensions, publish
from ..operators.cache import CACHE_TABLE, cache_stats, with_cache
from ..operators.dedup import (
    hash_coverage,
    resume_filter,
    row_funnel,
    select_rows,
    selection_keys,
    with_content_hash,
)
from ..operators.ledger import Known, latest, merge, only_for, published_entries, reconcile
from ..operators.sampling import sample_rows
from ..operators.store import VersionedTable, arrival
from ..schemas import DIMENSION, LEDGER, POST, POST_FIELDS
from ..sources import read_corpus
from ..sources.positions import row_key
from ..sources.readers import is_parquet
from .config import validate_config
from .summary import run_summary
from .transforms import Completing, author_pool, build_transform, labels_of, with_picks

#: A post as it stands on the target.
PUBLISHED = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("date_gmt", T.StringType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("byline", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)


@dataclass
class Prepared:
    rows: DataFrame
    funnel: DataFrame | None


def _body_field(cfg: dict) -> str:
    return (cfg.get("transform") or {}).get("body_field") or "body"


def sample_size(dataset: dict) -> int:
    """Rows to sample; 0 for all."""
    size = dataset["sample_size"]
    return 0 if size == "all" else int(size)


def sampled_rows(
    spark: SparkSession, cfg: dict, run_dir: str, dry_run: bool
) -> tuple[DataFrame, DataFrame]:
    """The sample, each row with its key, order and (unless dry) hash; and its keys.

    Parquet sources are read where they are, and only the selection keys are
    written down. Other sources are costly to parse and their rows have no stable
    place, so their sample is written once and read from there, by columns. A corpus
    is read for its keys and again for what is kept; a sample reads its ids twice
    before that. ``sample_size`` of 0 or ``all`` takes every row and saves these scans.
    """
    source, dataset = dict(cfg["source"]), cfg.get("dataset") or {}
    in_place = is_parquet(source)
    if in_place:
        source["row_key"] = True
    n, seed = sample_size(dataset), int(dataset.get("seed", 42))
    rows = sample_rows(read_corpus(spark, source), n, seed)
    body = _body_field(cfg)
    if dry_run or body not in rows.columns:
        rows = rows.withColumn("content_hash", F.lit(""))
    else:
        rows = with_content_hash(rows, body)
    if dry_run:
        return rows, rows
    if in_place or "row_key" in rows.columns:
        keys = selection_keys(rows)
        keys.write.mode("overwrite").parquet(f"{run_dir}/keys")
        return rows, spark.read.schema(keys.schema).parquet(f"{run_dir}/keys")
    rows.write.mode("overwrite").parquet(f"{run_dir}/rows")
    staged = spark.read.schema(rows.schema).parquet(f"{run_dir}/rows")
    rows = staged.select("*", row_key().alias("row_key"))
    return rows, selection_keys(rows)


def prepare_rows(
    rows: DataFrame, keys: DataFrame, cfg: dict, known: Known | None, dry_run: bool
) -> Prepared:
    """Drop what is published or repeated, and count it. A dry run keeps every row and
    hashes none."""
    if dry_run or known is None:
        return Prepared(rows, _counted(row_funnel(keys, dedup=False)))
    if not (cfg.get("dataset") or {}).get("dedup_content", True):
        funnel = _counted(row_funnel(keys, known.posts, dedup=False))
        fresh = resume_filter(rows, known.posts)
        return Prepared(fresh.withColumn("content_hash", F.lit("")), funnel)
    funnel = row_funnel(keys, known.posts, known.hashes)
    counts = funnel.first()
    kept = select_rows(rows, known.posts, known.hashes, keys=keys, counts=counts)
    fixed = hash_coverage(rows.sparkSession.createDataFrame([counts], funnel.schema))
    if fixed.first()["coverage"] != "ok":
        warnings.warn(
            f"{counts['empty_hash']} of {counts['after_source_id_resume']} rows have no text to hash; "
            "is the body field mapped right?",
            stacklevel=2,
        )
    return Prepared(kept, fixed)


def _counted(funnel: DataFrame) -> DataFrame:
    """A funnel as it is now: the ledger grows while the run goes on. Where nothing is
    hashed there is no coverage to speak of."""
    fixed = funnel.sparkSession.createDataFrame([funnel.first()], funnel.schema)
    return fixed.withColumn("coverage", F.lit(None).cast("string"))


def published_rows(created: DataFrame, status: str, byline: bool, seq: int) -> DataFrame:
    """Created posts as target rows: title escaped, content in blocks."""
    return created.select(
        "post_id",
        "source_id",
        publish.html_escape(F.col("title")).alias("title"),
        publish.rendered(F.col("content"), F.col("author"), byline).alias("content"),
        F.lit(status).alias("status"),
        "date_gmt",
        "category_id",
        "author_id",
        F.col("author").alias("byline"),
        "content_hash",
        F.lit(seq).cast("bigint").alias("seq"),
    )


def catch_up(ledger: VersionedTable, target: VersionedTable, batch: str) -> None:
    """Enter posts that reached the target in a run that died before its ledger entry.

    The target is written first and is the authority. Its batches that the ledger has
    under the same name need no look; of the others those posts are entered that the
    ledger does not know. An empty ledger is left to ``reconcile``.
    """
    entries = ledger.read(without=batch)
    if entries.isEmpty():
        return
    seen = ledger.batches().filter(F.col("batch") != batch)
    others = target.batches().filter(F.col("batch") != batch).join(seen, "batch", "left_anti")
    names = [r.batch for r in others.collect()]
    if not names:
        return
    posts = published_entries(target.read(only=names))
    missing = posts.join(entries.select("source_id", "post_id"), ["source_id", "post_id"], "left_anti")
    if not missing.isEmpty():
        ledger.append(missing, f"catch-up-{arrival()}")


def purge(target: VersionedTable, ledger: VersionedTable | None = None) -> tuple[int, int]:
    """Empty the target and its ledger; (deleted, failed)."""
    deleted = target.read().count()
    target.truncate()
    if ledger is not None:
        ledger.truncate()
    return deleted, 0


def _dimension(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> VersionedTable:
    fields = [*DIMENSION.fields, *[T.StructField(name, T.StringType()) for name in extra]]
    return VersionedTable(spark, path, T.StructType(fields))


BROADCAST_NAMES = 100_000
AUTHOR_COLUMNS = ("username", "email", "first_name", "last_name")


def resolve_dimensions(
    spark: SparkSession, cfg: dict, batch: str
) -> tuple[DataFrame, DataFrame | None]:
    """Category and author ids, making the missing ones on the target side.

    Rows once written stay as they are: names are looked up among all rows, those of an
    earlier attempt of this batch too, and only what is missing is added, under a name
    of its own.
    """
    load = cfg["load"]
    author_cfg = load.get("author") or {}
    names = labels_of(cfg["transform"])
    labels = spark.createDataFrame([(x,) for x in names], "name string")
    categories = _dimension(spark, f"{load['target']}/categories")
    found = dimensions.ensure_categories(categories.read(), labels)
    _add(categories, found.created, batch)
    authors, pool = None, author_pool(cfg)
    if author_cfg.get("create_users", True) and pool:
        table = _dimension(spark, f"{load['target']}/authors", AUTHOR_COLUMNS)
        people = spark.createDataFrame([(x,) for x in pool], "name string")
        domain = author_cfg.get("email_domain", "example.invalid")
        made = dimensions.ensure_authors(table.read(), people, domain)
        _add(table, made.created, batch)
        authors = _bounded(made.mapping, len(pool))
    return _bounded(found.mapping, len(names)), authors


def _add(table: VersionedTable, rows: DataFrame, batch: str) -> None:
    if not rows.isEmpty():
        table.append(rows, f"{batch}-{arrival()}")


def _bounded(mapping: DataFrame, rows: int) -> DataFrame:
    """Broadcast a mapping with as many rows as a configured list, unless that is long.

    Spark cannot see how short it is, and would shuffle all posts by category."""
    return F.broadcast(mapping) if rows <= BROADCAST_NAMES else mapping


@dataclass
class RunResult:
    posts: DataFrame
    outcomes: DataFrame
    summary: DataFrame
    drift: DataFrame | None = None

    @property
    def exit_code(self) -> int:
        return int(self.summary.first()["exit_code"])


def write_posts(posts: DataFrame, path: str, fmt: str = "json") -> None:
    posts.select(*POST_FIELDS).write.mode("overwrite").format(fmt).save(path)


def write_results(outcomes: DataFrame, path: str) -> None:
    outcomes.write.mode("overwrite").json(path)


def run(
    spark: SparkSession,
    cfg: dict,
    run_dir: str,
    completing: Completing | None = None,
    run_id: str | None = None,
) -> RunResult:
    """Run a configuration. Running the same ``run_id`` again replaces its output.

    ``load.target`` is the folder of the target tables, ``load.ledger`` of the
    ledger (inside the target by default), ``transform.cache.path`` of the cache.
    Posts are written once and read back for everything after, so the transform
    runs once per row and lost executors cost no calls already stored. One run at a
    time may write to a target.
    """
    validate_config(cfg, completing is not None)
    started, began = time.monotonic(), time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    batch = run_id or f"run-{arrival()}"
    load, dataset = cfg.get("load") or {}, cfg.get("dataset") or {}
    dry_run = bool(load.get("dry_run", True))

    known = target = ledger = None
    if not dry_run:
        target = VersionedTable(spark, f"{load['target']}/posts", PUBLISHED)
        mode = load.get("mode", "trust_ledger")
        if mode != "skip":
            ledger = VersionedTable(spark, load.get("ledger") or f"{load['target']}/ledger", LEDGER)
            catch_up(ledger, target, batch)
        there = published_entries(target.read(without=batch))
        known = reconcile(ledger, there, mode, f"fill-{arrival()}", without=batch)

    rows, keys = sampled_rows(spark, cfg, run_dir, dry_run)
    if known is not None:
        n = keys.count()
        known.posts = only_for(known.posts, keys, "source_id", n)
        known.hashes = only_for(known.hashes, keys, "content_hash", n)
    prepared = prepare_rows(rows, keys, cfg, known, dry_run)
    transform = build_transform(cfg, completing)
    ready = with_picks(prepared.rows, cfg)

    cache_cfg = (cfg.get("transform") or {}).get("cache") or {}
    cached = usage = None
    slice_rows = getattr(transform, "slice_rows", None)
    if cache_cfg.get("enabled", True) and cache_cfg.get("path"):
        cache = VersionedTable(spark, cache_cfg["path"], CACHE_TABLE)
        before = cache.read()
        posts, made = with_cache(ready, cache, transform.signature(), transform.posts, batch, slice_rows)
        write_posts(posts, f"{run_dir}/posts", "parquet")
        lost = made.filter(F.col("error").isNotNull()).select("source_id")
        asked = spark.read.parquet(f"{run_dir}/posts").select("source_id").unionByName(lost)
        cached = cache_stats(before, transform.signature(), asked, lost)
    else:
        # without a cache nothing made before counts, so each attempt has its own stage
        staged = VersionedTable(spark, f"{run_dir}/staged/{batch}-{arrival()}", CACHE_TABLE)
        posts, made = with_cache(ready, staged, transform.signature(), transform.posts, batch, slice_rows)
        write_posts(posts, f"{run_dir}/posts", "parquet")
    posts = spark.read.schema(POST).parquet(f"{run_dir}/posts")
    errors = made.filter(F.col("error").isNotNull()).select("source_id", "error")
    failed = publish.error_outcomes(errors, "transform")

    if dry_run:
        outcomes = publish.dry_run_outcomes(posts).unionByName(failed)
    else:
        categories, authors = resolve_dimensions(spark, cfg, batch)
        resolved = publish.with_category(posts, categories)
        here = target.read(without=batch)
        own = latest(published_entries(target.read(only=batch)))
        top = target.read().agg(F.max("post_id")).first()[0] or 0
        # written once: both the posts and the outcomes go by it
        ids = publish.assign_ids(resolved, known.posts, top, own)
        ids.write.mode("overwrite").parquet(f"{run_dir}/assigned")
        assigned = spark.read.schema(ids.schema).parquet(f"{run_dir}/assigned")
        created = publish.with_author(publish.created_posts(resolved, assigned), authors)
        author_cfg = load.get("author") or {}
        target.append(
            published_rows(
                created,
                load.get("post_status", "publish"),
                bool(author_cfg.get("prepend_to_content")),
                max(here.agg(F.max("seq")).first()[0] or 0, arrival() - 1) + 1,
            ),
            batch,
        )
        if ledger is not None:
            ledger.append(published_entries(target.read(only=batch)), batch)
        done = publish.publish_outcomes(resolved, assigned).unionByName(failed)
        # a post that failed here may stand on the target all the same
        landed = latest(published_entries(target.read(only=batch)))
        done = publish.recover(done, landed)
        back = publish.recovered_entries(done, posts)
        if ledger is not None and not back.isEmpty():
            merge(ledger, back.select("source_id", "post_id"), None, f"{batch}-recovered")
        write_results(done, f"{run_dir}/results")
        outcomes = spark.read.schema(publish.OUTCOME).json(f"{run_dir}/results")

    chat = None
    calls = 0
    if completing is not None:
        usage = cost.usage_totals(made.withColumn("model", F.lit(completing.model)))
        calls = made.count()
        usage = spark.createDataFrame(usage.collect(), usage.schema)
        chat = cost.chat_cost(usage, cost.pricing_table(spark, cfg.get("pricing")))
    embedding_cfg = (cfg.get("costs") or {}).get("embedding")
    embedding = None
    if embedding_cfg:
        embedding = cost.embedding_cost(
            posts,
            embedding_cfg.get("usd_per_1m_tokens", 0.0),
            embedding_cfg.get("provider"),
            embedding_cfg.get("model"),
            embedding_cfg.get("dimensions"),
        )
    facts = {
        "run_id": batch,
        "source_type": cfg["source"]["type"],
        "transform_type": cfg["transform"]["type"],
        "dry_run": dry_run,
        "sample_size_requested": sample_size(dataset),
        "source": cfg["source"].get("path") or cfg["source"].get("name"),
        "started_at": began,
        "concurrency": completing.policy.concurrency if completing else None,
    }
    report = run_summary(
        outcomes,
        posts,
        time.monotonic() - started,
        prepared.funnel,
        chat,
        embedding,
        cached,
        calls,
        facts,
    )
    report.coalesce(1).write.mode("overwrite").json(f"{run_dir}/summary")
    stored = spark.read.schema(report.schema).json(f"{run_dir}/summary")
    return RunResult(posts, outcomes, stored, known.drift if known else None)
