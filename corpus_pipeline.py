"""A corpus made ready for training, in five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns rows with the columns of
``documents``, the last one the pieces of packed sequences. Between stages rows are
written as Parquet and read again, so a lost executor costs at most one stage.

All stages treat null texts as empty and any number of rows per id as rows of their own;
an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm import packing, quality, secrets, similar, toxicity
from corpusflow.llm.common import give_back, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules or the quality model reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    give_back()  # the driver does not hold what it learned from while rows are judged
    return quality.keep_good(docs, model)


def toxicity_grammar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the grammar finds toxic."""
    words = public_tokenizers.path("word_bpe_49k.json")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), words)
    give_back()
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that a shingle similarity of 0.8 connects: that of the
    smallest id."""
    return similar.drop_similar(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With secrets in the texts replaced by a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_grammar),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: SQL has neither the models nor the tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
