"""Corpus pipeline: filter, deduplicate, decontaminate and pack documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.decontaminate import decontaminate
from rankloom.llm.line_dedup import deduplicate_lines
from rankloom.llm.ngram_join import jaccard_components
from rankloom.llm.packing import pack
from rankloom.llm.quality import keep_good
from rankloom.session import fresh_path, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject, unchanged."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; those that lose lines and have no word left go."""
    done = deduplicate_lines(docs)
    kept = done.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, unchanged; rows without id stay.

    Rows of one id count as one document, of which the row that is first by its text (nulls last), then its other columns, stays.
    """
    chosen = jaccard_components(docs).filter("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(F.isnull("text").alias("__null"), "text", *others)
    rows = docs.join(chosen, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row"))
    named = rows.select("doc_id", *(F.col("row")[c].alias(c) for c in ("text", *others)))
    return named.unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates, unchanged."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in full sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained ranking and string tiling have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole ``documents``; each result is written and reread.

    What a stage stores meanwhile goes once its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
