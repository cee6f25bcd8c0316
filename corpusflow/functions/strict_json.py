"""Strict JSON on string columns, and the tolerant reader for model output.

Spark's JSON reader takes single quotes and ignores trailing text by default.
Wrapping a text in ``[...]`` and asking for exactly one element makes it strict:
trailing text then spoils the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import picks, text

STRICT = {"allowSingleQuotes": "false"}

# JSON values other than strings that count as missing.
FALSY_JSON = ("0", "0.0", "-0", "-0.0", "0e0", "false", "[]", "{}")

FENCE = "```"
INNERMOST = r"(?s)\{[^{}]*\}"


def _as_array(c: Column, element: str | T.DataType) -> Column:
    return F.from_json(F.concat(F.lit("["), c, F.lit("]")), T.ArrayType(_type(element)), STRICT)


def _type(element: str | T.DataType) -> T.DataType:
    return T.StringType() if element == "string" else element


def is_json(c: Column) -> Column:
    """True for one complete JSON value of any kind."""
    return F.coalesce(F.size(_as_array(c, "string")) == 1, F.lit(False)) & (
        text.py_strip(c) != ""
    )


def is_json_object(c: Column) -> Column:
    as_map = T.MapType(T.StringType(), T.StringType())
    return F.coalesce(
        (F.size(_as_array(c, as_map)) == 1) & F.startswith(text.py_lstrip(c), F.lit("{")),
        F.lit(False),
    )


def fields(c: Column, names: list[str]) -> Column:
    """The named members of a JSON object as a struct of strings, or null."""
    element = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return F.when(is_json_object(c), F.get(_as_array(c, element), F.lit(0)))


def is_text(c: Column, name: str) -> Column:
    path = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(c), path, "variant"))
    return F.coalesce(kind == "STRING", F.lit(False))


def truthy(c: Column, name: str, value: Column) -> Column:
    """``value`` of member ``name``, with null and falsy JSON values as ``""``.

    The text of a member does not tell ``0`` from ``"0"``, so the few values that
    look falsy are checked against the parsed document.
    """
    looks_falsy = value.isin(*FALSY_JSON)
    return F.when(looks_falsy & ~is_text(c, name), F.lit("")).otherwise(text.or_empty(value))


def match_label(category: Column, labels: list[str]) -> Column:
    """The first label equal to or contained in ``category``, ignoring case."""
    hit = F.filter(
        F.array(*[F.lit(label) for label in labels]),
        lambda label: F.contains(F.lower(category), F.lower(label)),
    )
    return F.when(category == "", F.lit("")).otherwise(text.or_empty(F.try_element_at(hit, F.lit(1))))


def parse_output(
    df: DataFrame, raw: str, labels: list[str], title_limit: int, out: str = "parsed"
) -> DataFrame:
    """Read model output in column ``raw`` into ``out``: struct(title, category, date_ym).

    Code fences, talk around the object and missing members are tolerated; each
    member is empty when it cannot be used, and nothing raises. Text that is not
    one JSON value as a whole falls back to the first innermost ``{...}`` in it.

    The steps are columns of their own, so that each text is parsed once and not
    once per use.
    """
    body = F.col("_body")
    names = ["title", "category", "date"]
    element = T.StructType([T.StructField(n, T.StringType()) for n in names])
    inner = F.trim(body, F.lit("`"))
    tagged = F.lower(F.left(F.col("_inner"), F.lit(4))) == "json"
    untagged = text.py_lstrip(F.substr(F.col("_inner"), F.lit(5)))
    staged = (
        df.withColumn("_body", text.py_strip(text.or_empty(F.col(raw))))
        .withColumn("_inner", F.when(F.startswith(body, F.lit(FENCE)), inner))
        .withColumn("_body", F.when(tagged, untagged).otherwise(F.coalesce("_inner", "_body")))
        .withColumn("_whole", is_json(body))
        .withColumn(
            "_src", F.when(F.col("_whole"), body).otherwise(F.regexp_extract(body, INNERMOST, 0))
        )
        .withColumn("_list", _as_array(F.col("_src"), element))
        .withColumn(
            "_object",
            F.when(
                (F.size("_list") == 1) & F.startswith(F.col("_src"), F.lit("{")),
                F.get(F.col("_list"), F.lit(0)),
            ),
        )
    )
    src = F.col("_src")
    for name in names:
        value = F.col("_object").getField(name)
        staged = staged.withColumn(f"_{name}", text.py_strip(truthy(src, name, value)))
    parsed = F.struct(
        text.clean_title(F.col("_title"), title_limit).alias("title"),
        match_label(F.col("_category"), labels).alias("category"),
        F.when(picks.is_year_month(F.col("_date")), F.col("_date")).otherwise("").alias("date_ym"),
    )
    return staged.select(*[F.col(f"`{c}`") for c in df.columns], parsed.alias(out))


def conforms(raw: Column, labels: list[str]) -> Column:
    """Whether an output keeps the response schema: all three members present as
    strings, a known label, a well-formed month, and nothing else."""
    members = fields(raw, ["title", "category", "date"])
    keys = F.json_object_keys(raw)
    return F.coalesce(
        is_json_object(raw)
        & (F.array_sort(keys) == F.array(F.lit("category"), F.lit("date"), F.lit("title")))
        & is_text(raw, "title")
        & is_text(raw, "category")
        & is_text(raw, "date")
        & members.getField("category").isin(*labels)
        & picks.is_year_month(members.getField("date")),
        F.lit(False),
    )
