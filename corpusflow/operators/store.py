"""Versioned append tables on plain Parquet folders.

Layout: ``<path>/data/v=<version>/batch=<name>/`` for rows and
``<path>/versions/`` for the history of current versions. A batch is written
under its own name, so writing it again after a crash replaces it instead of
adding to it. ``replace`` fills the next version first and then makes it current,
so no reader sees half a table and no file being read is overwritten.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # known to be empty when planned, so that joins with it move no rows of the other side
        return spark.createDataFrame([], schema).limit(0)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._version: int | None = None

    def version(self) -> int:
        """The current version as this object first saw it, or made it. Open the table
        anew to see a version another writer put in place."""
        if self._version is None:
            self._version = self._stored_version()
        return self._version

    def _stored_version(self) -> int:
        history = _read_if_exists(self.spark, f"{self.path}/versions", T.StructType().add("version", T.IntegerType()))
        return history.agg(F.max("version")).first()[0] or 0

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/v={version}"

    def _stored(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.StringType())])
        return _read_if_exists(self.spark, self._folder(self.version()), stored)

    def read(self, without: str | None = None, only: str | list[str] | None = None) -> DataFrame:
        """The current rows; ``without`` a batch or ``only`` some prunes folders."""
        df = self._stored()
        if without is not None:
            df = df.filter(F.col("batch") != without)
        if only is not None:
            df = df.filter(F.col("batch").isin(*([only] if isinstance(only, str) else only)))
        return df.drop("batch")

    def batches(self) -> DataFrame:
        """The names of the current batches, ``batch``; no rows are read."""
        return self._stored().select("batch").distinct()

    def next_seq(self) -> int:
        """A number above every ``seq`` stored here, whatever the driver's clock says."""
        last = self.read().agg(F.max("seq")).first()[0]
        return max(arrival(), (last or 0) + 1)

    def _write(self, df: DataFrame, version: int, batch: str, **options: str) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        df.select(*columns).write.mode("overwrite").options(**options).parquet(
            f"{self._folder(version)}/batch={batch}"
        )

    def append(self, df: DataFrame, batch: str, **options: str) -> None:
        """Write a batch; a batch of the same name is replaced.

        When ``df`` reads this table, read it ``without`` the batch. ``options`` go to the
        writer.
        """
        self._write(df, self.version(), batch, **options)

    def replace(self, df: DataFrame, batch: str = "replace") -> None:
        """Make ``df`` the whole table; it may read the current version."""
        version = self.version() + 1
        self._write(df, version, batch)
        row = self.spark.createDataFrame([(version,)], "version int")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        self._version = version

    def truncate(self) -> None:
        self.replace(self.spark.createDataFrame([], self.schema), "empty")


def arrival() -> int:
    """A number that grows from batch to batch: microseconds of driver time."""
    return time.time_ns() // 1000
