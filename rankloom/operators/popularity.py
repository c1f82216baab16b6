"""Item popularity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _item_stats(ratings: DataFrame, time: str | None) -> DataFrame:
    aggs = [
        F.count("rating").alias("interaction_count"),
        F.avg("rating").alias("mean_rating"),
        F.sum("rating").alias("rating_sum"),
    ]
    if time:
        aggs.append(F.max(time).alias("last_seen"))
    return ratings.groupBy("movie_id").agg(*aggs)


def by_score(table: DataFrame) -> DataFrame:
    """Best first; every order ends in the unique id."""
    return table.orderBy(F.desc("score"), F.desc("interaction_count"), "movie_id")


def item_popularity(ratings: DataFrame, strategy: str = "most_popular", time: str | None = None) -> DataFrame:
    """Count, mean, sum and score per item. The score is the count, or mean * ln(1 + count)."""
    stats = _item_stats(ratings, time)
    if strategy == "most_popular":
        return stats.withColumn("score", F.col("interaction_count").cast("double"))
    if strategy == "weighted":
        return stats.withColumn("score", F.col("mean_rating") * F.log1p("interaction_count"))
    raise ValueError(f"unknown popularity strategy: {strategy}")


def bayesian_popularity(ratings: DataFrame, m: int = 50) -> DataFrame:
    """Item mean pulled towards the global mean by ``m`` imaginary ratings."""
    n = F.col("interaction_count")
    overall = ratings.agg(F.avg("rating")).scalar()
    return (
        _item_stats(ratings, None)
        .select("movie_id", "mean_rating", "interaction_count", overall.alias("_global"))
        .withColumn("score", n / (n + m) * F.col("mean_rating") + F.lit(m) / (n + m) * F.col("_global"))
        .drop("_global")
    )


def item_stats(ratings: DataFrame, time: str) -> DataFrame:
    """Stats used by the factor and content models; order by count, mean, id."""
    return _item_stats(ratings, time).drop("rating_sum").withColumn(
        "popularity_score", F.col("interaction_count").cast("double")
    )


def exposure_counts(pairs: DataFrame) -> DataFrame:
    """Distinct users per item."""
    return pairs.groupBy("movie_id").agg(F.countDistinct("user_id").alias("exposure"))


def normalized_popularity(table: DataFrame, score: str = "score") -> DataFrame:
    """Score scaled to 0..1 over all items; 0 where all scores are equal."""
    ends = table.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi"))).scalar()
    scaled = (F.col(score) - F.col("_e.lo")) / F.nullif(F.col("_e.hi") - F.col("_e.lo"), F.lit(0.0))
    return table.select("movie_id", score, ends.alias("_e")).select(
        "movie_id", F.coalesce(scaled, F.lit(0.0)).alias("score_norm")
    )


def seen_pairs(df: DataFrame) -> DataFrame:
    return df.select("user_id", "movie_id").distinct()
