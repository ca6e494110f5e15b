"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and reread as the
next stage's ``docs``. All but the last return the columns of documents.

1. quality: documents that the quality classifier rejects go.
2. exact_dedup: of equal texts one document stays.
3. near_dedup: of every group of near copies one document stays.
4. mix: sources are brought to their target weights; repeats are rows.
5. pack: texts become sequences of at most 4096 ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adsentry.llm.common import read_table, staged
from adsentry.llm.exact_dedup import drop_copies
from adsentry.llm.mixing import mixed_documents
from adsentry.llm.ngram_join import drop_near_copies
from adsentry.llm.packing import pack_documents
from adsentry.llm.quality_classifier import keep_good

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

# Stages 1, 3, 4 and 5 (a trained model, an iterative join, hashed sampling, a
# packing plan) have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written out for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
