"""Frames that every operator has to take: nulls, empty and long texts, ties, repeats."""

from pyspark.sql import functions as F

LONG = "many words and more words again " * 8000


def awkward(spark, more=()):
    rows = [(1, "A first text, of some words."), (2, None), (3, ""), (None, "no id here"), (4, "same"), (5, "same"), (5, "same"), (6, LONG), (7, "  \n\t "), *more]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "score": F.lit(None).cast("string"), "kept": F.lit(1)})


def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
