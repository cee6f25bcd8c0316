"""Scans that turn files or tables into ``source_id`` plus logical fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strict_json
from ..functions.text import or_empty, py_strip
from .positions import line_position, parquet_position, place, row_key, with_file_columns

ID_FALLBACKS = ("place", "hash", "position")
FILE_FORMATS = ("parquet", "orc")


def split_field_map(field_map: dict[str, str] | None) -> tuple[str, dict[str, str]]:
    """The id column and the logical-to-source map of the other fields."""
    mapping = dict(field_map or {})
    return mapping.pop("id", "id"), mapping


def _fallback_id(fields: list[str]) -> Column:
    packed = F.to_json(F.struct(*[F.col(f"`{name}`") for name in fields])) if fields else F.lit("")
    return F.md5(packed)


def _finish(df: DataFrame, fields: list[str], id_fallback: str) -> DataFrame:
    """Put an id on rows without one: their place in their file, a hash of their
    fields, or their position in the corpus."""
    if id_fallback not in ID_FALLBACKS:
        raise ValueError(f"id_fallback={id_fallback!r}; known: {', '.join(ID_FALLBACKS)}")
    if id_fallback == "hash":
        fallback = _fallback_id(fields)
    else:
        fallback = F.col(f"_{id_fallback}").cast("string")
    keep = ["row_key"] if "row_key" in df.columns else []
    id_ = F.coalesce(F.col("_id"), fallback).alias("source_id")
    return df.select(id_, *[F.col(f"`{name}`") for name in fields], *keep)


def parse_lines(lines: DataFrame, members: dict[str, str], value: str = "value") -> DataFrame:
    """Keep lines that are one JSON object and lift the named members to columns.

    ``members`` maps output columns to JSON keys. Values become strings; null,
    zero, false and empty values become ``""``, but a null id stays null. Blank
    and malformed lines and other JSON values are left out.
    """
    keys = list(dict.fromkeys(members.values()))
    shape = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in keys]))
    line = py_strip(F.col(value))
    parsed = (
        lines.withColumn("_line", line)
        .filter(F.startswith(F.col("_line"), F.lit("{")))
        .withColumn(
            "_parsed",
            F.from_json(
                F.concat(F.lit("["), F.col("_line"), F.lit("]")), shape, strict_json.STRICT
            ),
        )
        .filter(F.size("_parsed") == 1)
    )
    row = F.get(F.col("_parsed"), F.lit(0))
    columns = []
    for out, key in members.items():
        text = row.getField(key)
        columns.append(
            text.alias(out)
            if out == "_id"
            else strict_json.truthy(F.col("_line"), key, text).alias(out)
        )
    passed = [c for c in lines.columns if c != value]
    return parsed.select(*passed, *columns)


def line_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row: how many lines are blank, malformed (or no object), and usable."""
    line = py_strip(F.col(value))
    good = strict_json.is_json_object(line)
    return lines.agg(
        F.count_if(line == "").alias("blank"),
        F.count_if((line != "") & ~good).alias("malformed"),
        F.count_if((line != "") & good).alias("parsed"),
    )


def read_jsonl(spark: SparkSession, cfg: dict) -> DataFrame:
    """JSON lines under ``path``; one object per line, any schema."""
    id_field, fields = split_field_map(cfg.get("field_map"))
    fallback = cfg.get("id_fallback", "hash")
    scan = spark.read.text(cfg["path"])
    if fallback == "position":
        rows = parse_lines(with_file_columns(scan), {"_id": id_field, **fields})
        rows = line_position(rows, "_position")
    else:
        rows = parse_lines(scan, {"_id": id_field, **fields})
    return _finish(rows, list(fields), fallback)


def as_text(df: DataFrame, column: str) -> Column:
    """A typed column as text, with null and falsy values as ``""``."""
    field = next((f for f in df.schema.fields if f.name == column), None)
    if field is None:
        return F.lit("")
    c, kind = F.col(f"`{column}`"), field.dataType
    if isinstance(kind, T.StringType):
        return or_empty(c)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return or_empty(F.when(F.size(c) > 0, F.to_json(c)))
    if isinstance(kind, (T.StructType, T.VariantType)):
        return or_empty(F.to_json(c))
    text = c.cast("string")
    if isinstance(kind, T.NumericType):
        text = F.when(c != 0, text)
    elif isinstance(kind, T.BooleanType):
        text = F.when(c, text)
    return or_empty(text)


def map_fields(
    df: DataFrame, field_map: dict[str, str], keep: tuple[Column, ...] = ()
) -> DataFrame:
    """Project a typed table to ``_id`` plus logical text fields; drop the rest.

    A mapped column the table does not have reads as ``""``.
    """
    id_field, fields = split_field_map(field_map)
    id_text = F.col(f"`{id_field}`").cast("string") if id_field in df.columns else F.lit(None)
    return df.select(
        *keep,
        id_text.cast("string").alias("_id"),
        *[as_text(df, src).alias(name) for name, src in fields.items()],
    )


def is_parquet(cfg: dict) -> bool:
    """Whether a source is Parquet files, whose rows have stable places."""
    return (
        cfg.get("type") == "table"
        and bool(cfg.get("path"))
        and cfg.get("format", "parquet") == "parquet"
    )


def read_table(spark: SparkSession, cfg: dict) -> DataFrame:
    """A columnar dataset: ``path`` (with optional ``split`` folder) or catalog ``name``.

    ``row_key`` adds a unique key per row; it needs Parquet files, as do ids by place
    or position. A row without an id gets its place in its file, which unlike a hash
    does not make every scan for ids read the texts as well.
    """
    field_map = cfg.get("field_map") or {}
    _, fields = split_field_map(field_map)
    parquet = is_parquet({"type": "table", **cfg})
    fallback = cfg.get("id_fallback") or ("place" if parquet else "hash")
    if cfg.get("path"):
        file_format = cfg.get("format", "parquet")
        if file_format not in FILE_FORMATS:
            raise ValueError(f"format={file_format!r}; known: {', '.join(FILE_FORMATS)}")
        path = "/".join(p for p in (cfg["path"], cfg.get("split")) if p)
        scan = spark.read.format(file_format).load(path)
    else:
        scan = spark.table(cfg["name"])
        if cfg.get("split"):
            scan = scan.filter(F.col("split") == cfg["split"])
    if (cfg.get("row_key") or fallback != "hash") and not parquet:
        raise ValueError("row_key and ids by place or position need a Parquet path")
    keep = {}
    if cfg.get("row_key"):
        keep["row_key"] = row_key()
    if fallback == "place":
        keep["_place"] = place()
    if fallback == "position":
        # taken where the scan's metadata is at hand, before the join
        scan = parquet_position(scan.select("*", *[c.alias(n) for n, c in keep.items()]), "_position")
        keep = {name: F.col(name) for name in (*keep, "_position")}
    kept = tuple(c.alias(name) for name, c in keep.items())
    return _finish(map_fields(scan, field_map, kept), list(fields), fallback)
