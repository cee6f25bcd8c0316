"""Schemas of the tables that flow between operators."""

from __future__ import annotations

from pyspark.sql import types as T

STR, LONG, INT, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()

POST_FIELDS = ("title", "content", "category", "author", "date_gmt", "source_id", "content_hash")

#: A prepared post: seven strings. None is ever null, which files cannot promise.
POST = T.StructType([T.StructField(name, STR) for name in POST_FIELDS])

#: One cached transform result, valid only for the signature it was made under.
CACHE = T.StructType([T.StructField("sig", STR), T.StructField("post", POST)])

#: One publication record. ``seq`` carries arrival order, which files do not keep.
LEDGER = T.StructType(
    [
        T.StructField("source_id", STR),
        T.StructField("post_id", LONG),
        T.StructField("content_hash", STR),
        T.StructField("seq", LONG),
    ]
)

#: What happened to one post at the sink.
OUTCOME = T.StructType(
    [
        T.StructField("source_id", STR),
        T.StructField("ok", BOOL),
        T.StructField("post_id", LONG),
        T.StructField("skipped", BOOL),
        T.StructField("recovered_after_retry", BOOL),
        T.StructField("dry_run", BOOL),
        T.StructField("error", STR),
        T.StructField("status", INT),
    ]
)

#: What the completion step adds to a row.
COMPLETION = T.StructType(
    [
        T.StructField("raw", STR),
        T.StructField("input_tokens", LONG),
        T.StructField("output_tokens", LONG),
        T.StructField("retries", INT),
        T.StructField("rate_limited", INT),
        T.StructField("error", STR),
    ]
)

#: A category or author dimension.
DIMENSION = T.StructType(
    [T.StructField("id", LONG), T.StructField("name", STR), T.StructField("slug", STR)]
)

PRICING = T.StructType(
    [
        T.StructField("model", STR),
        T.StructField("input_rate", T.DoubleType()),
        T.StructField("output_rate", T.DoubleType()),
    ]
)
