"""Declarative text cleaners: a list of ``{"type": name, ...}`` steps.

Steps are plain Columns wherever Java's regex engine gives Python's result. A
chain is checked when the plan is built, never per row.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
from pyspark.errors import PySparkException as SparkException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import regex
from .text import py_strip

ColumnCleaner = Callable[[Column, dict], Column]

CLEANERS: dict[str, ColumnCleaner] = {}


def cleaner(name: str) -> Callable[[ColumnCleaner], ColumnCleaner]:
    """Register ``fn(column, spec) -> column`` under a step type."""

    def register(fn: ColumnCleaner) -> ColumnCleaner:
        CLEANERS[name] = fn
        return fn

    return register


def text_cleaner(name: str) -> Callable:
    """Register a plain ``fn(text, spec) -> text``; it runs in Arrow batches."""

    def register(fn: Callable[[str, dict], str]) -> Callable[[str, dict], str]:
        CLEANERS[name] = lambda c, spec: _batched(lambda text: fn(text, spec))(c)
        return fn

    return register


def _batched(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fn, na_action="ignore")

    return F.pandas_udf(run, "string")


def check_cleaners(specs: list[dict] | None) -> list[str]:
    """What is wrong with a chain; empty when it can run."""
    problems = []
    for i, spec in enumerate(specs or []):
        kind = spec.get("type") if isinstance(spec, dict) else None
        if not isinstance(kind, str) or not kind:
            problems.append(f"cleaners[{i}] must be a dict with a 'type' key")
        elif kind not in CLEANERS:
            known = ", ".join(sorted(CLEANERS))
            problems.append(f"cleaners[{i}]: unknown type {kind!r}; known: {known}")
    return problems


def apply_cleaners(c: Column, specs: list[dict] | None) -> Column:
    problems = check_cleaners(specs)
    if problems:
        raise ValueError("; ".join(problems))
    for spec in specs or []:
        c = CLEANERS[spec["type"]](c, spec)
    return c


@functools.cache
def _runs(java: str) -> bool:
    """Whether Spark's own engine takes a pattern; asked once, when the plan is built."""
    spark = SparkSession.active()
    try:
        spark.range(1).select(F.lit("").rlike(java)).collect()
    except SparkException:
        return False
    return True


def _substitute(c: Column, pattern: str, replacement: str, count: int, ignore_case: bool) -> Column:
    compiled = regex.compile_python(pattern, ignore_case)
    java = regex.to_java(pattern, ignore_case)
    if java and not _runs(java):
        java = None
    template = regex.template_to_java(replacement, compiled.groups)
    if java and template and not regex.may_match_empty(pattern):
        java_replacement, refers = template
        if count == 0:
            return F.regexp_replace(c, java, java_replacement)
        if not refers:
            # a split at the first `count` matches, joined by the replacement
            return F.array_join(F.split(c, java, count + 1), regex.literal_of(replacement))
    return _batched(lambda text: compiled.sub(replacement, text, count=count))(c)


@cleaner("regex_strip")
def regex_strip(c: Column, spec: dict) -> Column:
    """Delete the first ``count`` matches (one by default; 0 means all)."""
    return _substitute(
        c, spec["pattern"], "", int(spec.get("count", 1)), bool(spec.get("ignore_case"))
    )


@cleaner("regex_replace")
def regex_replace(c: Column, spec: dict) -> Column:
    """Replace ``count`` matches (all by default) with a template."""
    return _substitute(
        c,
        spec["pattern"],
        spec.get("replacement", ""),
        int(spec.get("count", 0)),
        bool(spec.get("ignore_case")),
    )


@cleaner("html_strip")
def html_strip(c: Column, spec: dict) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


@cleaner("trim")
def trim(c: Column, spec: dict) -> Column:
    return py_strip(c)


@cleaner("collapse_whitespace")
def collapse_whitespace(c: Column, spec: dict) -> Column:
    """Runs of spaces and tabs become one space; line ends stay."""
    return F.regexp_replace(c, "[ \t]+", " ")
