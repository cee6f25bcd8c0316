"""Token usage and what it costs."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import token_estimate
from ..schemas import PRICING

# US dollars per million input and output tokens.
DEFAULT_PRICING = {
    "gpt-5-nano": (0.05, 0.40),
    "gpt-5-mini": (0.25, 2.00),
    "gpt-4.1-nano": (0.10, 0.40),
    "gpt-4.1-mini": (0.40, 1.60),
    "gpt-4o-mini": (0.15, 0.60),
    "gpt-4o": (2.50, 10.00),
    "text-embedding-3-small": (0.02, 0.00),
    "text-embedding-3-large": (0.13, 0.00),
}


def pricing_table(spark: SparkSession, prices: dict | None = None) -> DataFrame:
    """``{model: (input, output)}`` or ``{model: {"input": .., "output": ..}}``."""
    rows = []
    for model, rate in (DEFAULT_PRICING if prices is None else prices).items():
        pair = (rate.get("input"), rate.get("output")) if isinstance(rate, dict) else rate
        rows.append((model, float(pair[0] or 0.0), float(pair[1] or 0.0)))
    return spark.createDataFrame(rows, PRICING)


def load_pricing(spark: SparkSession, path: str) -> DataFrame:
    """A pricing table from a small JSON file; a missing file prices nothing."""
    file = Path(path)
    return pricing_table(spark, json.loads(file.read_text()) if file.exists() else {})


def usage_totals(calls: DataFrame, by: str = "model") -> DataFrame:
    """Calls, tokens and retries per model; retries an endpoint's rate limit asked for
    are counted by themselves where the calls have them."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)

    names = ["input_tokens", "output_tokens", "retries", *(n for n in ["rate_limited"] if n in calls.columns)]
    return calls.groupBy(by).agg(F.count(F.lit(1)).alias("calls"), *[total(n) for n in names])


def match_rates(models: DataFrame, pricing: DataFrame) -> DataFrame:
    """The rates of each model: of the same name, of its lower-case name, or of the
    longest listed name that the model continues after a dash.

    Each model offers its own dash-separated prefixes as join keys, so this is an
    equality join and not a comparison of all pairs.
    """
    parts = F.split(F.lower("model"), "-")
    ends = F.sequence(F.lit(1), F.size(parts))
    prefixes = F.transform(ends, lambda n: F.array_join(F.slice(parts, 1, n), "-"))
    offers = models.select("model", F.explode(F.array_distinct(prefixes)).alias("_key"))
    listed = pricing.withColumnRenamed("model", "_listed").withColumn("_key", F.lower("_listed"))
    nearness = (
        F.when(F.col("_listed") == F.col("model"), F.lit(2))
        .when(F.col("_listed") == F.lower("model"), F.lit(1))
        .otherwise(F.lit(0))
    )
    best = F.max_by(
        F.struct("input_rate", "output_rate"), F.struct(nearness, F.length("_listed"), "_listed")
    )
    rates = offers.join(listed, "_key").groupBy("model").agg(best.alias("_rate"))
    return models.join(rates, "model", "left").select(
        *models.columns,
        F.coalesce("_rate.input_rate", F.lit(0.0)).alias("input_rate"),
        F.coalesce("_rate.output_rate", F.lit(0.0)).alias("output_rate"),
        F.col("_rate").isNotNull().alias("priced"),
    )


def chat_cost(usage: DataFrame, pricing: DataFrame) -> DataFrame:
    """``est_usd`` per model of a usage table (``model, input_tokens, output_tokens``)."""
    spent = F.col("input_tokens") * F.col("input_rate") + F.col("output_tokens") * F.col("output_rate")
    return match_rates(usage, pricing).select(
        "model",
        "input_tokens",
        "output_tokens",
        F.round(spent / F.lit(1_000_000), 6).alias("est_usd"),
        "priced",
        *[n for n in ("retries", "rate_limited") if n in usage.columns and "rate_limited" in usage.columns],
    )


def embedding_cost(
    posts: DataFrame,
    usd_per_1m_tokens: float,
    provider: str | None = None,
    model: str | None = None,
    dimensions: int | None = None,
) -> DataFrame:
    """One row: posts, tokens (all characters over four, rounded down once), dollars."""
    chars = F.coalesce(F.sum(F.length("content")), F.lit(0))
    totals = posts.agg(F.count(F.lit(1)).alias("posts"), token_estimate(chars).alias("est_tokens"))
    usd = F.col("est_tokens") * F.lit(float(usd_per_1m_tokens)) / F.lit(1_000_000)
    return totals.select(
        "posts",
        "est_tokens",
        F.lit(provider).cast("string").alias("provider"),
        F.lit(model).cast("string").alias("model"),
        F.lit(dimensions).cast("int").alias("dimensions"),
        F.round(usd, 4).alias("est_usd"),
    )
