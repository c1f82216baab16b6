"""The recommendation tables, derived by Spark from the given star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankloom.operators import clean, split as splitting
from rankloom.session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(col: str) -> Column:
    return F.unix_seconds(F.col(col).cast("timestamp"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean fact; ``src1, src2`` identify the source row."""
    return (
        _order_lines(spark, sf_dir)
        .filter((F.col("o_custkey") > 0) & (F.col("l_partkey") > 0))
        .select(
            F.col("l_orderkey").alias("src1"),
            F.col("l_linenumber").cast("long").alias("src2"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("movie_id"),
            F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
            epoch("l_shipdate").alias("ts"),
        )
    )


def interactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact as text with faults: NULLs, bad tokens, unknown ids, bad ratings and times."""
    return _order_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("src1"),
        F.col("l_linenumber").cast("long").alias("src2"),
        F.expr(
            """CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'u' || CAST(o_custkey AS STRING)
            WHEN l_orderkey % 83 = 0 THEN CAST(o_custkey AS STRING) || '.5'
            WHEN l_orderkey % 79 = 0 THEN CAST(o_custkey + 1000000000 AS STRING)
            ELSE CAST(o_custkey AS STRING) END"""
        ).alias("user_id"),
        F.expr(
            """CASE WHEN l_suppkey % 41 = 7 THEN CAST(l_partkey + 1000000000 AS STRING)
            ELSE CAST(l_partkey AS STRING) END"""
        ).alias("movie_id"),
        F.expr(
            """CASE WHEN l_orderkey % 73 = 0 THEN '0' WHEN l_orderkey % 71 = 0 THEN '6'
            WHEN l_orderkey % 67 = 0 THEN 'bad' WHEN l_orderkey % 61 = 0 THEN NULL
            ELSE CAST(CAST(ceil(l_quantity / 10) AS INT) AS STRING) END"""
        ).alias("rating"),
        F.expr(
            """CASE WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 53 = 0 THEN 'x'
            WHEN l_orderkey % 47 = 0 THEN '-5' WHEN l_orderkey % 43 = 0 THEN '99999999999'
            WHEN l_orderkey % 37 = 0 THEN '4102444800'
            ELSE CAST(unix_seconds(CAST(l_shipdate AS TIMESTAMP)) AS STRING) END"""
        ).alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.expr(
            """CASE WHEN p_partkey % 101 = 0 THEN NULL
            ELSE p_name || ' (' || CAST(1990 + p_size % 20 AS STRING) || ')' END"""
        ).alias("title"),
        F.expr("CASE WHEN p_partkey % 103 = 0 THEN NULL ELSE p_type || '|' || p_brand END").alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.expr("CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END").alias("gender"),
        F.expr(
            """CAST(CASE c_custkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 18 WHEN 2 THEN 25 WHEN 3 THEN 35
            WHEN 4 THEN 45 WHEN 5 THEN 50 ELSE 56 END AS INT)"""
        ).alias("age"),
        F.expr("CAST(c_nationkey % 21 AS INT)").alias("occupation"),
        F.expr("right(c_name, 5)").alias("zip_code"),
    )


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    )
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "k",
        F.expr(
            "CASE event_type WHEN 'signup' THEN 'popularity_fallback' WHEN 'error' THEN 'error' ELSE 'bpr' END"
        ).alias("strategy"),
        F.col("value").alias("latency_ms"),
        F.expr("CASE WHEN k % 2 = 0 THEN 5 ELSE 10 END").alias("top_k"),
        F.expr("CASE WHEN event_type = 'error' THEN 500 WHEN k = 0 THEN NULL ELSE 200 END").alias("response_status"),
        F.expr(
            """CASE WHEN event_type = 'error' THEN CAST(array() AS ARRAY<BIGINT>)
            ELSE transform(sequence(0, CASE WHEN k % 2 = 0 THEN 4 ELSE 9 END),
                           j -> CAST((k * 7 + j * 13) % 200 + 1 AS BIGINT)) END"""
        ).alias("recommendations"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as ratings: two thirds newer than every base rating, one third older."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("src1"),
            "user_id",
            F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("movie_id"),
            (1 + F.least(F.lit(4), F.floor(F.col("value") / 25))).cast("double").alias("rating"),
            F.when(F.col("event_id") % 3 == 0, epoch("ts") - 946080000).otherwise(epoch("ts")).alias("ts"),
        )
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest interaction of each (user, movie)."""
    return clean.dedup_interactions(interactions(spark, sf_dir), ("ts", "src1", "src2"))


def labelled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(ratings(spark, sf_dir).select("user_id", "movie_id", "rating", "ts"), "ratings")
    return splitting.temporal_split(rows, "ts", val_ratio=0.1, test_ratio=0.2, min_interactions=3)


def part_of(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return labelled_split(spark, sf_dir).filter(F.col("split") == label).drop("split")


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_of(spark, sf_dir, "train")


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed factors: every embedding is a user vector ..."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("user_id"), F.col("embedding").alias("factors"), F.lit(0.0).alias("bias")
    )


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """... and every embedding is an item vector, with a bias from its label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("movie_id"),
        F.col("embedding").alias("factors"),
        (F.col("label").cast("double") / 10).alias("bias"),
    )
