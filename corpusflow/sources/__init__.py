"""Source registry: ``read_corpus(spark, {"type": ..., ...})``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .lines import read_ranges
from .readers import read_jsonl, read_table

SOURCES: dict[str, Callable[[SparkSession, dict], DataFrame]] = {
    "jsonl": read_jsonl,
    "table": read_table,
    "text_lines": read_ranges,
}


def register_source(name: str, fn: Callable[[SparkSession, dict], DataFrame]) -> None:
    """Add a source type. ``fn`` returns ``source_id`` plus one string column per
    logical field; formats Spark lacks can be read through a
    ``pyspark.sql.datasource.DataSource`` inside it, as ``text_lines`` does."""
    SOURCES[name] = fn


def read_corpus(spark: SparkSession, cfg: dict) -> DataFrame:
    kind = cfg.get("type")
    if kind not in SOURCES:
        known = ", ".join(sorted(SOURCES))
        raise ValueError(f"unknown source type {kind!r}; known: {known}")
    return SOURCES[kind](spark, cfg)
