"""The registered queries of this subpackage and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.decontaminate import benchmark_overlap
from rankloom.llm.exact_dedup import ORACLE as EXACT_SQL
from rankloom.llm.exact_dedup import exact_duplicates
from rankloom.llm.fill_middle import ORACLE as MIDDLE_SQL
from rankloom.llm.fill_middle import digests, fill_in_middle
from rankloom.llm.html_extract import main_text
from rankloom.llm.line_dedup import ORACLE as LINES_SQL
from rankloom.llm.line_dedup import deduplicate_lines
from rankloom.llm.ngram_join import ORACLE as JACCARD_SQL
from rankloom.llm.ngram_join import jaccard_components
from rankloom.llm.packing import pack
from rankloom.llm.pii import personal_data
from rankloom.llm.quality import quality_scores
from rankloom.llm.secrets import secret_spans
from rankloom.llm.spelling import spelling_forms
from rankloom.llm.token_counts import sentencepiece_pieces, token_counts
from rankloom.llm.warc import ORACLE as ARCHIVE_SQL
from rankloom.llm.warc import archived_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(JACCARD_SQL)
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = deduplicate_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", "text")


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(EXACT_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts(table(spark, sf_dir, "documents"), pieces)


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query()
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


@query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query()
def op11_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents"))


@query(MIDDLE_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(fill_in_middle(table(spark, sf_dir, "documents")))


@query(ARCHIVE_SQL)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))
