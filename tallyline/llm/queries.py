"""The registered query of each operator, on the whole tables of a folder, and the oracle SQL where SQL can express it.

A query is thin: it reads its tables, calls its operator with production settings and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    jaccard_join, katz, langid, line_dedup, mixing, multi_index, packing, page_diff, prefix_trie, quality_ftrl, quality_rules, revisits,
    turn_repair)
from tallyline.sources.lake import Scratch

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLES[fn.__name__] = sql
        return fn
    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(modulus: int, remainder: int) -> Column:
    """The contracts' split: remainder of crc32 of doc_id as text; rows without doc_id are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def public_vocabulary() -> packing.Vocabulary:
    """The byte-level BPE with 50k ids among the installed public tokenizers."""
    import public_tokenizers

    return packing.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN)


@query()
def op1_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return katz.score(table(spark, folder, "documents").withColumn("held_out", held_out(10, 0)), Scratch(spark))


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out(3, 1))
    model = langid.fit(docs.filter("NOT held_out"))
    return langid.classify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query()
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_rules.fit(quality_ftrl.labelled_sample(docs, table(spark, folder, "labels"), "quality", quality_rules.SAMPLE))
    return quality_rules.judge(docs, model).drop("text")


@query(jaccard_join.ORACLE)
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.clusters(table(spark, folder, "documents"), Scratch(spark))


@query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", held_out(3, 1).alias("held_out"), "text")
    labels = table(spark, folder, "labels").filter(~held_out(3, 1))
    model = quality_ftrl.fit(quality_ftrl.labelled_sample(docs.filter("NOT held_out"), labels, "quality"))
    return quality_ftrl.classify(docs, model).drop("text")


@query()
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_vocabulary(), Scratch(spark))


@query(revisits.ORACLE)
def op7_revisit_resolution(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(revisits.captures_of_pages(table(spark, folder, "pages")), Scratch(spark))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


@query()
def op8_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, Scratch(spark))


@query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.duplicates(table(spark, folder, "documents"), Scratch(spark))


@query()
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), Scratch(spark))


@query()
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, folder, "conversations")), Scratch(spark))


@query(prefix_trie.ORACLE)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, folder, "conversations"), scratch), scratch)


@query()
def op13_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.extract(table(spark, folder, "pages"), Scratch(spark))
