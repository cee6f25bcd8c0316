"""Where published keys are found: Spark bucketed tables by source id and by content hash.

A target grows with every batch, and every micro-batch asks it about a few keys. The index
keeps what it asks for, narrow and laid out for it: two tables whose files are bucketed by
the key's hash, sorted by it, and carry Bloom filters. A few keys go into the scan as
literals, so only their buckets are opened, and in them only row groups that may hold one of
them. Many keys are joined bucket to bucket: the batch is shuffled, the index never. Buckets
double when they get long, so the bytes read for a key stay level while the target grows.

The files are all there is; the tables are entered in the session's catalogue as they are
opened. The target stays the authority: batches it has and the index has not are entered by
``catch_up``. Entries carry the name of their batch, and a batch that is written again is not
asked about itself, so entries of an earlier attempt do no harm.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ledger import published_entries
from .store import VersionedTable, _read_if_exists

#: Distinct keys up to which they are literals of the scan.
LITERALS = 1_000
#: Entries per bucket, and batches since the last rebuild, from which on one is due.
BUCKET_ROWS, BATCHES = 1_000_000, 1_000
KINDS = {"ids": "source_id", "hashes": "content_hash"}
_TOP = T.StructType([T.StructField("top", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("batch", T.StringType())])
_STATE = T.StructType([T.StructField("generation", T.IntegerType()), T.StructField("buckets", T.IntegerType())])
#: Bloom filters as large as the keys of a row group need, up to a megabyte.
_WRITE = {
    "parquet.bloom.filter.enabled#key": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}


class KeyIndex:
    """The index in the folder ``path``; ``buckets`` counts for a new one. One writer at a
    time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        state = _read_if_exists(spark, f"{self.path}/generations", _STATE).orderBy(F.desc("generation")).first()
        self.generation, self.buckets = (state.generation, state.buckets) if state else (0, buckets)
        if state is None:
            self._enter(0, buckets)
        for kind in KINDS:
            self._open(kind)

    def _enter(self, generation: int, buckets: int) -> None:
        row = self.spark.createDataFrame([(generation, buckets)], _STATE)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/generations")

    def _name(self, kind: str) -> str:
        place = hashlib.md5(f"{self.path}/{self.generation}".encode()).hexdigest()[:16]
        return f"corpusflow_{kind}_{place}"

    def _open(self, kind: str) -> None:
        options = ", ".join(f"'{k}' '{v}'" for k, v in _WRITE.items())
        place = f"{self.path}/g={self.generation}/{kind}".replace("'", r"\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(kind)} (key STRING, post_id BIGINT, seq BIGINT, batch STRING) "
            f"USING parquet OPTIONS ({options}) CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        self.spark.catalog.refreshTable(self._name(kind))

    def table(self, kind: str) -> DataFrame:
        """All entries by key: those of ``ids`` or of ``hashes``."""
        return self.spark.table(self._name(kind))

    def _asked(self, kind: str, wanted: DataFrame, rows: int, without: str | None) -> DataFrame:
        entries = self.table(kind)
        if without is not None:
            entries = entries.where(F.col("batch") != without)
        keys = wanted.select(F.col(KINDS[kind]).alias("key")).where("key <> ''").distinct()
        if rows <= LITERALS:
            return entries.where(F.col("key").isin([r.key for r in keys.collect()]))
        return entries.join(keys, "key", "left_semi")

    def posts(self, wanted: DataFrame, rows: int, without: str | None = None) -> DataFrame:
        """``source_id -> post_id`` of the ids in ``wanted``, a frame of ``rows`` rows; the last
        entry wins. Entries of the batch ``without`` do not count."""
        asked = self._asked("ids", wanted, rows, without)
        return asked.groupBy("key").agg(F.max_by("post_id", "seq").alias("post_id")).withColumnRenamed("key", "source_id")

    def hashes(self, wanted: DataFrame, rows: int, without: str | None = None) -> DataFrame:
        """``content_hash -> post_id`` of the hashes in ``wanted``; the first entry wins."""
        asked = self._asked("hashes", wanted, rows, without)
        return asked.groupBy("key").agg(F.min_by("post_id", "seq").alias("post_id")).withColumnRenamed("key", "content_hash")

    def find(self, source_id: str) -> DataFrame:
        """The post of one source id: one bucket, and its row groups that may have the id."""
        one = self.table("ids").where(F.col("key") == source_id)
        return one.groupBy(F.col("key").alias("source_id")).agg(F.max_by("post_id", "seq").alias("post_id"))

    def add(self, entries: DataFrame, batch: str, top: int = 0) -> None:
        """Enter ledger entries of a batch. ``top`` is the greatest post id before it; the
        greatest after it is kept under the batch's name."""
        for kind, column in KINDS.items():
            rows = entries.where(F.coalesce(F.col(column), F.lit("")) != "")
            rows = rows.select(F.col(column).alias("key"), "post_id", "seq", F.lit(batch).alias("batch"))
            # a bucket's rows meet in one task, so a batch adds one file to it at most
            rows.repartition(self.buckets, "key").write.mode("append").insertInto(self._name(kind))
        last, n = entries.agg(F.max("post_id"), F.count(F.lit(1))).first()
        row = self.spark.createDataFrame([(max(top, last or 0), n)], "top long, rows long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tops/batch={batch}")

    def _tops(self) -> DataFrame:
        return _read_if_exists(self.spark, f"{self.path}/tops", _TOP)

    def top(self, batch: str) -> int | None:
        """The greatest post id after a batch, from its own record alone; None without one."""
        shape = T.StructType(_TOP.fields[:1])
        row = _read_if_exists(self.spark, f"{self.path}/tops/batch={batch}", shape).first()
        return row.top if row else None

    def greatest(self, without: str | None = None) -> int:
        """The greatest post id of all batches but one."""
        tops = self._tops()
        tops = tops if without is None else tops.where(F.col("batch") != without)
        return tops.agg(F.max("top")).first()[0] or 0

    def catch_up(self, target: VersionedTable, without: str | None = None) -> int:
        """Enter the batches of the target that are not here; how many there were. A new
        index over an old target is filled this way."""
        missing = target.batches().join(self._tops().select("batch"), "batch", "left_anti")
        names = sorted(r.batch for r in missing.collect() if r.batch != without)
        for name in names:
            self.add(published_entries(target.read(only=name)), name, self.greatest())
        return len(names)

    def is_due(self) -> bool:
        """Whether buckets got long, or files many, since the last rebuild."""
        entered = self._tops().agg(F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
        return entered.rows > self.buckets * BUCKET_ROWS or entered.batches >= BATCHES * (self.generation + 1)

    def rebuild(self, buckets: int | None = None) -> None:
        """Write the index anew, one file per bucket, into twice the buckets or as many as
        given. The one in place serves until the new one is whole."""
        old = {kind: self.table(kind) for kind in KINDS}
        self.generation, self.buckets = self.generation + 1, buckets or 2 * self.buckets
        for kind, rows in old.items():
            self._open(kind)
            rows.repartition(self.buckets, "key").write.mode("overwrite").insertInto(self._name(kind))
        self._enter(self.generation, self.buckets)
