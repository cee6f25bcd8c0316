"""Category and author dimensions: find an entry for each name, or make one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_name, last_name, slugify, synthetic_email
from .numbering import number_rows

# Slugs of names without a letter or digit, and the first dry-run id.
CATEGORY_SLUG = "category"
AUTHOR_SLUG = "author"
DRY_RUN_BASE = 1000


@dataclass
class Resolved:
    """``mapping`` is name to id; ``created`` the dimension rows to add."""

    mapping: DataFrame
    created: DataFrame


def _resolve(dim: DataFrame, names: DataFrame, default_slug: str, slug_first: bool) -> Resolved:
    wanted = names.select("name").distinct().withColumn("slug", slugify(F.col("name"), default_slug))
    wanted = wanted.withColumn("_lower", F.lower("name"))
    # of several entries with one name or slug the last one listed counts
    by_name = dim.groupBy(F.lower("name").alias("_lower")).agg(F.max("id").alias("_by_name"))
    by_slug = dim.groupBy("slug").agg(F.max("id").alias("_by_slug"))
    found = wanted.join(by_name, "_lower", "left").join(by_slug, "slug", "left")
    order = ["_by_slug", "_by_name"] if slug_first else ["_by_name", "_by_slug"]
    found = found.withColumn("_id", F.coalesce(*order))
    missing = found.filter(F.col("_id").isNull())
    # names that share a slug share one new entry
    rows = missing.groupBy("slug").agg(F.min("name").alias("name"))
    top = dim.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top")).scalar()
    created = number_rows(rows, F.md5("slug"), ["slug"], "_n").select(
        (F.col("_n") + top).cast("bigint").alias("id"), "name", "slug"
    )
    new_id = created.select("slug", F.col("id").alias("_new"))
    mapping = found.join(new_id, "slug", "left").select(
        "name", F.coalesce("_id", "_new").cast("bigint").alias("id")
    )
    return Resolved(mapping, created)


def ensure_categories(dim: DataFrame, names: DataFrame) -> Resolved:
    """Match by name without case, then by slug; make the rest."""
    return _resolve(dim, names, CATEGORY_SLUG, slug_first=False)


def ensure_authors(
    dim: DataFrame, names: DataFrame, email_domain: str, role: str = "author"
) -> Resolved:
    """Match by slug, then by name without case; make the rest with login, address
    and a first and last name."""
    found = _resolve(dim, names, AUTHOR_SLUG, slug_first=True)
    name = F.col("name")
    created = found.created.select(
        "id",
        "name",
        "slug",
        F.col("slug").alias("username"),
        synthetic_email(F.col("slug"), email_domain).alias("email"),
        first_name(name).alias("first_name"),
        last_name(name).alias("last_name"),
        F.array(F.lit(role)).alias("roles"),
    )
    return Resolved(found.mapping, created)


def dry_run_categories(spark: SparkSession, labels: list[str]) -> DataFrame:
    """Stand-in ids ``1000, 1001, ...`` in label order."""
    rows = [(label, DRY_RUN_BASE + i) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "name string, id bigint")
