"""Seeded sampling without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.picks import sample_key
from .numbering import number_rows

#: Hex digits a level of prefixes adds, and the rows of one prefix that are few enough
#: to be put in order by themselves.
PREFIX_DIGITS, FEW_ROWS = 4, 100_000
DIGEST_DIGITS = 32


def _crossing(counts: DataFrame, key: str, n: int, base: int = 0) -> Row | None:
    """The first key, in key order, at which the running row count reaches ``n``."""
    upto = F.sum("_rows").over(Window.orderBy(key)) + F.lit(base)
    return (
        counts.withColumn("_upto", upto)
        .withColumn("_before", F.col("_upto") - F.col("_rows"))
        .filter((F.col("_before") < n) & (F.col("_upto") >= n))
        .first()
    )


def sample_rows(df: DataFrame, n: int, seed: int = 42, id_col: str = "source_id") -> DataFrame:
    """``min(n, total)`` rows, the same for a given seed; ``n = 0`` keeps all.

    Adds ``sample_key``, the seeded order of the rows. The sample is a prefix of
    that order, so a smaller sample is part of a larger one.

    No sort of all rows and no top-n in one task: small jobs over the ids find the key
    of the n-th row. Rows are counted per key prefix, at most ``16 ** 4`` of them, then
    inside the one prefix where the count crosses ``n`` per longer prefix, until it has
    few rows, and then per key. What comes back is a plain filter on the key, applied where rows are read.
    """
    keyed = df.withColumn("sample_key", sample_key(F.col(id_col), seed))
    if not n:
        return keyed
    count = F.count(F.lit(1)).alias("_rows")
    inside, before = keyed.select("sample_key"), 0
    for digits in range(PREFIX_DIGITS, DIGEST_DIGITS, PREFIX_DIGITS):
        start = F.left("sample_key", F.lit(digits)).alias("_prefix")
        found = _crossing(inside.groupBy(start).agg(count), "_prefix", n, before)
        if found is None:
            return keyed
        inside = inside.filter(F.col("sample_key").startswith(found["_prefix"]))
        before = found["_before"]
        if found["_rows"] <= FEW_ROWS:
            break
    cut = _crossing(inside.groupBy("sample_key").agg(count), "sample_key", n, before)
    if cut["_upto"] == n:
        return keyed.filter(F.col("sample_key") <= cut["sample_key"])
    # an id that occurs several times lies across the cut: keep only some copies
    content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    copies = number_rows(
        keyed.filter(F.col("sample_key") == cut["sample_key"]), content, [], "_copy"
    ).filter(F.col("_copy") <= n - cut["_before"])
    return keyed.filter(F.col("sample_key") < cut["sample_key"]).unionByName(copies.drop("_copy"))
