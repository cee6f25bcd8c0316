"""Dense global numbers without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame, digest: Column, ties: list[str], out: str, start: int = 0, digits: int = 3
) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the order of a hex digest.

    Rows are bucketed by the first ``digits`` of the digest, so a bucket is one
    range of the order. Each bucket numbers itself and adds the rows of the
    buckets before it: at most ``16 ** digits`` counts are broadcast, however
    many rows there are. ``digest`` should differ between rows (hash a unique key).
    """
    keyed = df.withColumn("_digest", digest).withColumn("_bucket", F.left("_digest", F.lit(digits)))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *ties))
    return (
        keyed.withColumn("_rank", inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (F.lit(start) + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_digest", "_bucket", "_rank", "_offset")
    )
