"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import warnings

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.shipping import ship
from corpusflow.workdir import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers. Arrow batches are bounded by the
    session itself, in rows and in bytes (64 MB unless set otherwise)."""
    ship(spark)
    return spark


def texts_of(column, rows: int = 512):
    """The texts of an Arrow column, null ones empty, some rows at a time: a batch as
    Python strings at once would take a multiple of its bytes."""
    for low in range(0, len(column), rows):
        yield [t or "" for t in column.slice(low, rows).to_pylist()]


def give_back() -> None:
    """Give memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run):
    """``run`` over Arrow batches, at whose end a worker gives memory that it has freed back
    to the system: workers stay for later stages, and would hold it through these."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, read as often as
    needed, and there still when an executor is lost."""
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(doc_id):
    """crc32 of the id as text, modulo 3: remainder 1 is the held-out fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def first_by_hash(ids: DataFrame, group: str, most) -> DataFrame:
    """The ``most`` rows of each group whose ``doc_id`` hashes smallest. Groups are ranked
    in 256 parts first, so that few rows of a large one meet in a task."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    part = F.pmod(F.hash("doc_id"), F.lit(256))
    for keys in ([F.col(group), part], [F.col(group)]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ids = ids.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")
    return ids


def block_of(doc_id, text, longest: int):
    """The text, or of one of over ``longest`` characters a block of that length, which
    one being drawn by the id's hash."""
    blocks = F.ceil(F.char_length(text) / longest)
    start = F.pmod(F.xxhash64(doc_id), F.greatest(blocks, F.lit(1))) * longest + 1
    return F.substring(text, start.cast("int"), F.lit(longest))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int], longest: int
) -> DataFrame:
    """Up to so many labelled texts of class 0 and class 1, as (doc_id, text, label).

    The rows of smallest hash are taken, so the choice depends on neither order nor
    partitioning. Of a text of over ``longest`` characters one block serves. An id that
    repeats among documents counts once, with its text or block first in order. Ids that
    carry both labels, null ids and null texts are left out. Only ids are joined and
    ranked; the texts of the few chosen ids are fetched by a broadcast of at most
    ``sum(per_class)`` ids, and copies of one are reduced before they are shuffled.
    """
    marked = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_most"))
        .where(F.col("label") == F.col("_most"))
        .drop("_most")
    )
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id").distinct()
    most = F.when(F.col("label") == 0, per_class[0]).otherwise(per_class[1])
    chosen = first_by_hash(marked.join(known, "doc_id"), "label", most)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    text = block_of(F.col("doc_id"), F.col("text"), longest)
    return rows.groupBy("doc_id", "label").agg(F.min(text).alias("text")).select("doc_id", "text", "label")


def warn_of_missing_class(labels, what: str) -> bool:
    """Whether one of the two classes has no text to learn from, and a warning if so."""
    missing = [c for c in (0, 1) if c not in set(labels.tolist())]
    if missing:
        warnings.warn(f"no text labelled {what} = {' or '.join(map(str, missing))} to learn from", stacklevel=3)
    return bool(missing)
