"""Queries that write tables and read them back: sinks, caches, ledgers, whole runs.

Each works in a folder of its own in the shared one, over the given tables.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ..functions import text
from ..functions.cleaners import CLEANERS, apply_cleaners, cleaner
from ..operators import dedup, dimensions, ledger
from ..operators.cache import CACHE_TABLE, read_cache_jsonl, with_cache
from ..operators.keys import KeyIndex
from ..operators.store import VersionedTable
from ..schemas import DIMENSION, LEDGER, OUTCOME, POST, POST_FIELDS
from ..sources import SOURCES, read_corpus, register_source
from ..sources.lines import numbered, scan_lines, stream_ranges
from ..streaming.streams import published_table, read_stream, results_table, stream_publish
from ..workdir import workspace
from . import oracle as o
from . import queries as q
from . import config as checks
from . import runs
from .prompts import json_text, signature_of, source_identity_of
from .transforms import TRANSFORMS, register_transform

QUERIES: dict[str, q.Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def register(fn: q.Query) -> q.Query:
        QUERIES[fn.__name__], ORACLE[fn.__name__] = fn, sql
        return fn

    return register


@query("SELECT event_id, regexp_replace(props, '\\{[^{}]*\\}', '-', 'g') AS cleaned FROM events")
def clean_braces(spark: SparkSession, sf: str) -> DataFrame:
    step = {"type": "regex_replace", "pattern": "{[^{}]*}", "replacement": "-"}
    return q.table(spark, sf, "events").select("event_id", apply_cleaners(F.col("props"), [step]).alias("cleaned"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS orders FROM orders GROUP BY 1")
def orders_by_month(spark: SparkSession, sf: str) -> DataFrame:
    month = text.year_month(F.col("o_orderdate").cast("string")).alias("ym")
    return q.table(spark, sf, "orders").groupBy(month).agg(F.count(F.lit(1)).alias("orders"))


@query(o.ORACLE["passthrough_posts"])
def posts_sink(spark: SparkSession, sf: str) -> DataFrame:
    folder = workspace(spark)
    runs.write_posts(q.QUERIES["passthrough_posts"](spark, sf), folder)
    return spark.read.schema(POST).json(folder)


@query("""SELECT CAST(event_id AS VARCHAR) AS source_id, false AS ok, 'transform: ' || props AS error
    FROM events WHERE event_type = 'error'""")
def results_sink(spark: SparkSession, sf: str) -> DataFrame:
    folder = workspace(spark)
    runs.write_results(q.QUERIES["transform_errors"](spark, sf), folder)
    return spark.read.schema(OUTCOME).json(folder).select("source_id", "ok", "error")


@query("""SELECT CASE WHEN doc_id % 3 = 0 THEN 'old' ELSE 'now' END AS sig,
        CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS VARCHAR) END AS source_id,
        CASE WHEN doc_id % 5 <> 0 THEN md5(text) END AS content_md5,
        CASE WHEN doc_id % 5 <> 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'h' ELSE '' END END AS content_hash
    FROM documents WHERE doc_id % 7 <> 0""")
def cache_jsonl_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without a whole post keep their place; lines that are no object go."""
    id_ = F.col("doc_id")
    full = F.struct(*[F.col("text").alias(f) if f == "content" else q.id_text("doc_id").alias(f) for f in POST_FIELDS[:-1]])
    hashed = F.struct(*[F.col("text").alias(f) if f == "content" else (F.lit("h") if f == "content_hash" else q.id_text("doc_id")).alias(f) for f in POST_FIELDS])
    sig = F.when(id_ % 3 == 0, "old").otherwise("now").alias("sig")
    line = (
        F.when(id_ % 7 == 0, F.lit("[1, 2"))
        .when(id_ % 5 == 0, F.to_json(F.struct(sig, F.struct(q.id_text("doc_id").alias("source_id")).alias("post"))))
        .when(id_ % 2 == 0, F.to_json(F.struct(sig, hashed.alias("post"))))
        .otherwise(F.to_json(F.struct(sig, full.alias("post"))))
    )
    folder = workspace(spark)
    q.table(spark, sf, "documents").select(line.alias("value")).write.text(folder)
    post = F.col("post")
    return read_cache_jsonl(spark, folder).select("sig", post.source_id.alias("source_id"), F.md5(post.content).alias("content_md5"), post.content_hash.alias("content_hash"))


@query(f"SELECT source_id, md5(body) AS content_md5, 0 AS made_again FROM {o.DOCS}")
def cache_append(spark: SparkSession, sf: str) -> DataFrame:
    """All posts through a cache in slices; a second pass finds each of them there."""
    rows = q.with_picks(dedup.with_content_hash(q.corpus(spark, sf)), q.CONFIG)
    cache = VersionedTable(spark, workspace(spark), CACHE_TABLE)
    with_cache(rows, cache, "S", q.PASSTHROUGH.posts, "one", 400)
    posts, made = with_cache(rows, cache, "S", q.PASSTHROUGH.posts, "one", 400)
    return posts.select("source_id", F.md5("content").alias("content_md5"), F.lit(made.count()).alias("made_again"))


@query("""SELECT 'appended' AS step, (SELECT count(*) FROM labels) + (SELECT count(*) FROM documents) AS entries
    UNION ALL SELECT 'replaced', (SELECT count(*) FROM labels) + (SELECT count(*) FROM labels)
    UNION ALL SELECT 'truncated', 0 UNION ALL SELECT 'anew', (SELECT count(*) FROM labels)""")
def ledger_append_truncate(spark: SparkSession, sf: str) -> DataFrame:
    log = VersionedTable(spark, workspace(spark), LEDGER)
    labelled = q.published(spark, sf)
    all_docs = q.table(spark, sf, "documents").select(q.id_text("doc_id").alias("source_id"), (F.col("doc_id") + 1).alias("post_id"), F.lit(None).cast("string").alias("content_hash"), F.col("doc_id").alias("seq"))
    steps = []
    log.append(labelled, "one")
    log.append(all_docs, "two")
    steps.append(("appended", log.read().count()))
    log.append(labelled, "two")  # a batch of the same name is replaced
    steps.append(("replaced", log.read().count()))
    log.truncate()
    steps.append(("truncated", log.read().count()))
    log.append(labelled, "three")
    steps.append(("anew", log.read().count()))
    return spark.createDataFrame(steps, "step string, entries long")


@query("SELECT CAST(doc_id AS VARCHAR) AS source_id, doc_id + 1 AS post_id FROM documents")
def target_ids(spark: SparkSession, sf: str) -> DataFrame:
    meta = F.create_map(F.lit(ledger.META_SOURCE_ID), q.id_text("doc_id"), F.lit(ledger.META_HASH), F.md5("text"))
    return ledger.source_ids(q.table(spark, sf, "documents").select((F.col("doc_id") + 1).alias("id"), meta.alias("meta")))


@query("SELECT count(*) AS deleted, 0 AS failed, 0 AS remaining, 0 AS entries FROM documents")
def purge_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = workspace(spark)
    target = published_table(spark, f"{folder}/posts")
    log = VersionedTable(spark, f"{folder}/ledger", LEDGER)
    posts = q.table(spark, sf, "documents").select((F.col("doc_id") + 1).alias("post_id"), q.id_text("doc_id").alias("source_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in runs.PUBLISHED.fields[2:]])
    target.append(posts, "one")
    log.append(q.published(spark, sf), "one")
    deleted, failed = runs.purge(target, log)
    left = [(deleted, failed, target.read().count(), log.read().count())]
    return spark.createDataFrame(left, "deleted long, failed long, remaining long, entries long")


def _reconciled(spark: SparkSession, sf: str, mode: str, empty: bool = False) -> DataFrame:
    log, target = q.order_sides(spark, sf)
    stored = VersionedTable(spark, workspace(spark), LEDGER)
    stored.append(log.limit(0) if empty else log, "one")
    known = ledger.reconcile(stored, target, mode, "two")
    after = ledger.latest(stored.read()).withColumnRenamed("post_id", "stored_id")
    return known.posts.join(after, "source_id", "full_outer").select("source_id", "post_id", "stored_id")


@query(f"SELECT source_id, post_id, post_id AS stored_id FROM {o.TARGET}")
def reconcile_verify(spark: SparkSession, sf: str) -> DataFrame:
    return _reconciled(spark, sf, "verify")


@query(f"SELECT source_id, post_id, post_id AS stored_id FROM {o.TARGET}")
def reconcile_fill(spark: SparkSession, sf: str) -> DataFrame:
    return _reconciled(spark, sf, "trust_ledger", empty=True)


@query(f"SELECT source_id, post_id, post_id AS stored_id FROM {o.LOG}")
def reconcile_trust(spark: SparkSession, sf: str) -> DataFrame:
    return _reconciled(spark, sf, "trust_ledger")


def _run_config(spark: SparkSession, sf: str, folder: str) -> dict:
    labels = [r.source for r in q.table(spark, sf, "documents").select("source").distinct().orderBy("source").collect()]
    return {
        "dataset": {"sample_size": "all", "seed": 42},
        "source": {"type": "table", "path": f"{sf}/documents.parquet", "field_map": q.FIELD_MAP},
        "transform": {"type": "passthrough", "category_field": "category", "category": {"labels": labels}},
        "load": {"dry_run": False, "target": f"{folder}/site"},
    }


_KEPT = f"(SELECT count(DISTINCT nullif(content_hash, '')) + count(*) FILTER (content_hash = '') FROM {o.DOCS})"


@query(f"""SELECT * FROM (VALUES ('live', (SELECT count(*) FROM documents), {_KEPT}, {_KEPT}),
    ('dedup off', (SELECT count(*) FROM documents), (SELECT count(*) FROM documents), (SELECT count(*) FROM documents)),
    ('dry', (SELECT count(*) FROM documents), (SELECT count(*) FROM documents), 0)) AS t(mode, rows_fetched, kept, created)""")
def run_summary_live(spark: SparkSession, sf: str) -> DataFrame:
    """The funnel that whole runs report: live, without dedup, and dry."""
    out = []
    for mode, change in (("live", {}), ("dedup off", {"dedup_content": False}), ("dry", {})):
        folder = workspace(spark)
        cfg = _run_config(spark, sf, folder)
        cfg["dataset"].update(change)
        cfg["load"]["dry_run"] = mode == "dry"
        s = runs.run(spark, cfg, f"{folder}/run", run_id="one").summary.first()
        out.append((mode, s.rows_fetched, s.rows_funnel.after_content_dedup, s.posts_created))
    return spark.createDataFrame(out, "mode string, rows_fetched long, kept long, created long")


@query(f"""SELECT * FROM (VALUES ('first', {_KEPT}, {_KEPT}, {_KEPT}), ('again', {_KEPT}, {_KEPT}, {_KEPT}),
    ('next', 0, {_KEPT}, {_KEPT})) AS t(attempt, created, on_target, top_id)""")
def run_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A run, the same run again, and the next one: posts and their ids stay."""
    folder, out = workspace(spark), []
    cfg = _run_config(spark, sf, folder)
    for attempt, run_id in (("first", "one"), ("again", "one"), ("next", "two")):
        s = runs.run(spark, cfg, f"{folder}/{attempt}", run_id=run_id).summary.first()
        there = published_table(spark, f"{folder}/site/posts").read().agg(F.count(F.lit(1)), F.max("post_id")).first()
        out.append((attempt, s.posts_created, *there))
    return spark.createDataFrame(out, "attempt string, created long, on_target long, top_id long")


@query("""WITH named AS (SELECT c_name AS name, CASE WHEN c_nationkey < 5 THEN 1 WHEN c_nationkey < 15 THEN 2 ELSE 3 END AS step,
        regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g') AS slug FROM customer)
    SELECT name, row_number() OVER (ORDER BY step, md5(slug), slug) AS id FROM named""")
def dims_repeat(spark: SparkSession, sf: str) -> DataFrame:
    """Categories by customers: those of some nations, of more, then the first batch again
    with all. Ids once given stay."""
    customers = q.table(spark, sf, "customer")
    stored = VersionedTable(spark, workspace(spark), DIMENSION)
    for batch, below in (("one", 5), ("two", 15), ("again", 99)):
        names = customers.where(F.col("c_nationkey") < below).select(F.col("c_name").alias("name"))
        found = dimensions.ensure_categories(stored.read(), names)
        stored.append(found.created, batch)
    return dimensions.ensure_categories(stored.read(), customers.select(F.col("c_name").alias("name"))).mapping.select("name", "id")


@query("""SELECT doc_id, substr(sha256('{"fields": ["title", "body", null], "source": "' ||
        replace('{"config": null, "field_map": null, "name": "' || source || '/' || doc_id || '", "path": null, "split": "' || lang || '", "type": "table"}', '"', '\\"')
        || '", "type": "passthrough"}'), 1, 16) AS sig FROM documents""")
def signature_column(spark: SparkSession, sf: str) -> DataFrame:
    """Signatures of transforms over sources that rows name."""
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    identity = source_identity_of(type=F.lit("table"), name=name, split=F.col("lang"))
    sig = signature_of(type=F.lit('"passthrough"'), fields=F.lit('["title", "body", null]'), source=json_text(identity))
    return q.table(spark, sf, "documents").select("doc_id", sig.alias("sig"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END
    + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 0 END AS problems FROM orders""")
def config_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Configurations made from orders, and how many settings are wrong in each."""
    key = F.col("o_orderkey")
    config = F.struct(
        F.struct(F.when(key % 7 == 0, -1).otherwise(key).alias("sample_size")).alias("dataset"),
        F.struct(F.lit("table").alias("type"), F.when(F.col("o_orderstatus") != "F", F.col("o_custkey").cast("string")).alias("name")).alias("source"),
        F.struct(F.lit("passthrough").alias("type"), F.when(key % 11 == 0, "x").alias("cleaners"), F.when(key % 11 == 0, -5).alias("prompt_chars")).alias("transform"),
        F.struct(F.when(F.col("o_orderpriority") == "1-URGENT", "unheard of").otherwise("verify").alias("mode")).alias("load"),
    )
    configs = q.table(spark, sf, "orders").select(key.alias("id"), F.to_json(config).alias("config"))
    return checks.config_problems(configs).select(F.col("id").alias("o_orderkey"), F.size("problems").cast("long").alias("problems"))


@query("SELECT event_id, k AS source_id, k FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE CAST(event_id AS VARCHAR) END AS k FROM events) WHERE event_id % 7 <> 0")
def lines_batch(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of events by byte ranges; lines that are no object go."""
    folder = workspace(spark)
    _event_lines(spark, sf).write.text(folder)
    rows = read_corpus(spark, {"type": "text_lines", "path": folder, "range_bytes": 100_000, "field_map": {"id": "k", "event": "event_id", "k": "k"}})
    return rows.select(F.col("event").cast("long").alias("event_id"), "source_id", "k")


def _event_lines(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("event_id")
    k = F.when(key % 5 == 0, "none").otherwise(key.cast("string"))
    line = F.when(key % 7 == 0, F.concat(F.lit("[1, "), key.cast("string"))).otherwise(F.to_json(F.struct(k.alias("k"), key.alias("event_id"))))
    return q.table(spark, sf, "events").select(line.alias("value"))


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS position FROM events")
def lines_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """The numbers of lines in one sorted set of files, found by ranges."""
    folder = workspace(spark)
    q.table(spark, sf, "events").select("event_id").orderBy("event_id").selectExpr("cast(event_id as string) as value").write.text(folder)
    rows = numbered(scan_lines(spark, folder, 10_000))
    return rows.select(F.col("value").cast("long").alias("event_id"), "position")


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE CAST(event_id AS VARCHAR) END AS source_id FROM events WHERE event_id % 7 <> 0")
def lines_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines as a stream of new files, in two starts."""
    folder = workspace(spark)
    for k in (0, 1):
        _event_lines(spark, sf).where(F.pmod(F.hash("value"), F.lit(2)) == k).write.mode("append").text(f"{folder}/in")
        rows = stream_ranges(spark, f"{folder}/in", {"id": "k", "event": "event_id"})
        job = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/ckpt").option("path", f"{folder}/out").trigger(availableNow=True).start()
        job.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.col("event").cast("long").alias("event_id"), "source_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS source_id, upper(lang) || '!' AS title FROM documents")
def custom_parts(spark: SparkSession, sf: str) -> DataFrame:
    """A source, a cleaner and a transform of one's own, used by name and taken out again."""

    class Shout:
        def posts(self, df: DataFrame) -> DataFrame:
            title = apply_cleaners(F.col("title"), [{"type": "own_shout"}])
            return df.select("source_id", title.alias("title"))

    cleaner("own_shout")(lambda c, spec: F.concat(F.upper(c), F.lit("!")))
    register_source("own_docs", lambda s, source: q.corpus(s, source["path"]))
    register_transform("own_titles", lambda transform, cfg, completing: Shout())
    try:
        rows = SOURCES["own_docs"](spark, {"path": sf})
        return TRANSFORMS["own_titles"]({}, {}, None).posts(rows)
    finally:
        for registry, name in ((CLEANERS, "own_shout"), (SOURCES, "own_docs"), (TRANSFORMS, "own_titles")):
            registry.pop(name)


def _order_index(spark: SparkSession, sf: str) -> KeyIndex:
    """The target's side of the orders, in an index that has doubled its buckets once."""
    _, target = q.order_sides(spark, sf)
    index = KeyIndex(spark, workspace(spark), 8)
    index.add(target.where("post_id % 2 = 0"), "one")
    index.rebuild()
    index.add(target.where("post_id % 2 = 1"), "two", index.greatest())
    return index


@query(f"""SELECT 'id' AS kind, source_id AS key, post_id FROM {o.TARGET} JOIN {o.LOG} l USING (source_id, post_id)
    UNION ALL SELECT 'hash', content_hash, t.post_id FROM {o.TARGET} t JOIN (SELECT content_hash FROM {o.LOG}) l USING (content_hash)""")
def key_index_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The log's ids and hashes asked of an index of the target, bucket to bucket. Ids of
    posts that moved are left out."""
    log, _ = q.order_sides(spark, sf)
    index, n = _order_index(spark, sf), log.count()
    ids = index.posts(log, n).join(log.select("source_id", "post_id"), ["source_id", "post_id"], "left_semi")
    hashes = index.hashes(log, n)
    ids = ids.select(F.lit("id").alias("kind"), F.col("source_id").alias("key"), "post_id")
    return ids.unionByName(hashes.select(F.lit("hash").alias("kind"), F.col("content_hash").alias("key"), "post_id"))


@query(f"""SELECT source_id, post_id FROM {o.TARGET} WHERE source_id IN (
    SELECT CAST(min(o_orderkey) AS VARCHAR) FROM orders GROUP BY o_orderpriority, o_orderstatus)""")
def key_index_few(spark: SparkSession, sf: str) -> DataFrame:
    """A few ids asked of an index of the target: literals of the scan."""
    few = q.table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.min("o_orderkey").cast("string").alias("source_id"))
    return _order_index(spark, sf).posts(few, 15)


@query(f"SELECT source_id, post_id FROM {o.TARGET} WHERE source_id = (SELECT CAST(max(o_orderkey) AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')")
def key_index_point(spark: SparkSession, sf: str) -> DataFrame:
    """The post of one id: one bucket, and its row groups that may have it."""
    last = q.table(spark, sf, "orders").where("o_orderstatus = 'F'").agg(F.max("o_orderkey").cast("string")).first()[0]
    return _order_index(spark, sf).find(last)


@query(f"SELECT DISTINCT content_hash FROM {o.DOCS} WHERE content_hash <> ''")
def stream_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Each text once, through a stream that asks a key index and is restarted."""
    target, _ = _stream_in_two(spark, sf, indexed=True)
    return target.read().where("content_hash <> ''").select("content_hash")


class _Unanswered:
    """A results table whose first write is lost."""

    def __init__(self, table: VersionedTable) -> None:
        self.table, self.lost = table, False

    def append(self, df: DataFrame, batch: str) -> None:
        if not self.lost:
            self.lost = True
            raise ConnectionError("no answer")
        self.table.append(df, batch)


@query(f"SELECT source_id, true AS recovered FROM ({o.kept(o.DOCS, 'source_id', False)})")
def stream_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes of a stream that died between the target and its outcomes, and went on:
    what had landed is recovered, and on the target once."""
    folder, docs = workspace(spark), q.table(spark, sf, "documents")
    docs.write.parquet(f"{folder}/in")
    ids = docs.groupBy(F.col("source").alias("name")).agg(F.min("doc_id").alias("id"))
    target, results = published_table(spark, f"{folder}/posts"), results_table(spark, f"{folder}/results")
    flaky = _Unanswered(results)
    for _ in range(2):
        rows = read_stream(spark, f"{folder}/in", q.FIELD_MAP, docs.schema)
        job = stream_publish(rows, target, f"{folder}/ckpt", q.CONFIG, q.PASSTHROUGH.posts, ids, results=flaky)
        try:
            job.awaitTermination()
        except StreamingQueryException as e:
            if "no answer" not in str(e):
                raise
    found = results.read().where("ok and skipped is null")
    return target.read().select("source_id").join(found, "source_id").select("source_id", F.coalesce("recovered_after_retry", F.lit(False)).alias("recovered"))


def _stream_in_two(spark: SparkSession, sf: str, indexed: bool = False) -> tuple[VersionedTable, list[tuple]]:
    """Documents in two drops, each followed by a (re)start of the same stream."""
    folder = workspace(spark)
    docs = q.table(spark, sf, "documents")
    target, seen = published_table(spark, f"{folder}/posts"), []
    ids = docs.groupBy(F.col("source").alias("name")).agg(F.min("doc_id").alias("id"))
    for k in (0, 1):
        docs.where(F.col("doc_id") % 2 == k).write.mode("append").parquet(f"{folder}/in")
        rows = read_stream(spark, f"{folder}/in", q.FIELD_MAP, docs.schema)
        job = stream_publish(rows, target, f"{folder}/ckpt", q.CONFIG, q.PASSTHROUGH.posts, ids, index=KeyIndex(spark, f"{folder}/keys", 8) if indexed else None)
        job.awaitTermination()
        fetched = sum(p.observedMetrics["rows"].fetched for p in job.recentProgress if "rows" in (p.observedMetrics or {}))
        seen.append((k, fetched, target.read().count()))
    return target, seen


@query(f"SELECT DISTINCT content_hash FROM {o.DOCS} WHERE content_hash <> ''")
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Each text once, though the stream was stopped and started again."""
    target, _ = _stream_in_two(spark, sf)
    return target.read().where("content_hash <> ''").select("content_hash")


@query(f"""SELECT k AS start, (SELECT count(*) FROM documents WHERE doc_id % 2 = k) AS fetched,
        (SELECT count(DISTINCT nullif(content_hash, '')) + count(*) FILTER (content_hash = '') FROM {o.DOCS} WHERE doc_id % 2 <= k) AS published
    FROM (VALUES (0), (1)) AS t(k)""")
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What each start reports to have fetched, and the posts then on the target."""
    _, seen = _stream_in_two(spark, sf)
    return spark.createDataFrame(seen, "start long, fetched long, published long")


