"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next one.

A stage is ``f(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. Null, empty, repeated and very long
texts follow the rules of the operators. Empty input gives empty output in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import jaccard_join, langid, line_dedup, mixing, packing
from tallyline.llm.queries import public_vocabulary
from tallyline.sources.lake import Scratch

ORACLE_SQL = None  # compression, signatures and tokenizers are beyond SQL; tests compare the stages with brute force


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without a letter or with a narrow margin go. ``lang`` becomes the prediction."""
    found = langid.classify(docs.select(F.struct("*").alias("_doc"), "text"), langid.fit(docs)).filter("accepted")
    return found.select(*[(F.col("lang_pred") if c == "lang" else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat a kept one; a document left without words goes."""
    return line_dedup.remove(docs, Scratch(spark))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs, Scratch(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's word budget takes it."""
    return mixing.apply_mix(docs, Scratch(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of 1024 tokens; rows that repeat a document are packed each."""
    return packing.pack_documents(docs, public_vocabulary(), Scratch(spark))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_documents),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
