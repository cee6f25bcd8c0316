"""Where a row stands in its files: stable row keys and running positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import checkpointed


#: Files whose offsets, 16 bytes each, are broadcast.
BROADCAST_FILES = 1_000_000


def row_key() -> Column:
    """A key that is unique per row of a Parquet scan and the same on every re-read,
    however the files are split among tasks."""
    path, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    return F.concat(F.hex(F.xxhash64(path)), F.lit(":"), index.cast("string"))


def place() -> Column:
    """File name and row number of a row of a Parquet scan; as an id it outlives a
    move of the dataset to another folder."""
    index = F.col("_metadata.row_index").cast("string")
    return F.concat(F.col("_metadata.file_name"), F.lit(":"), index)


def with_file_columns(scan: DataFrame) -> DataFrame:
    """Add the file and split of each row. ``scan`` must come straight from a reader."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def _offsets(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before each file or split, in file order. One row per file or split."""
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def parquet_position(scan: DataFrame, out: str = "position") -> DataFrame:
    """Number the rows of a Parquet scan from 0, by path and then place in the file.

    Files are counted, and each row adds its own index to the rows of the files before.
    Rows do not move as long as the table of files, 16 bytes each, can be broadcast.
    """
    path = F.col("_metadata.file_path").alias("_path")
    counts = scan.select(path).groupBy("_path").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = _offsets(counts, ["_path"]).select(F.xxhash64("_path").alias("_file"), "_offset")
    if counts.count() <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    indexed = scan.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    return (
        indexed.join(offsets, "_file")
        .withColumn(out, F.col("_offset") + F.col("_index"))
        .drop("_file", "_index", "_offset")
    )


def line_position(rows: DataFrame, out: str = "position") -> DataFrame:
    """Number rows of a text scan from 0 in file order, those filtered out not counted.

    ``rows`` carries file columns and has not been shuffled. A line has no index of
    its own, and files may be split otherwise when read again, so the rows are
    checkpointed with their place in their split; splits are then counted and
    summed up in file order.
    """
    keys = ["_path", "_block"]
    placed = checkpointed(rows.withColumn("_n", F.monotonically_increasing_id()))
    counts = placed.groupBy(*keys).agg(
        F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    return (
        placed.join(_offsets(counts, keys), keys)
        .withColumn(out, F.col("_offset") + F.col("_n") - F.col("_first"))
        .drop("_n", "_first", "_rows", "_offset", *keys)
    )
