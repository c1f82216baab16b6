"""Batch serving: one row per request, titles, user pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.operators.topk import first_k


def batch_recommend(requests: DataFrame, routed: DataFrame) -> DataFrame:
    """One array row per request row; repeated requests stay.

    Lists are built once per distinct user (at most K entries) and joined back.
    """
    lists = routed.groupBy("user_id").agg(
        F.first("strategy").alias("strategy"),
        F.first("model_version").alias("model_version"),
        F.array_sort(F.collect_list(F.struct("rank", "movie_id"))).alias("_l"),
    )
    return requests.join(lists, "user_id", "left").select(
        *requests.columns,
        "strategy",
        "model_version",
        F.coalesce(F.col("_l.movie_id"), F.array().cast("array<long>")).alias("recommendations"),
    )


def attach_titles(recs: DataFrame, movies: DataFrame) -> DataFrame:
    return recs.join(movies.select("movie_id", "title"), "movie_id", "left")


def predicted_rating_display(score: Column) -> Column:
    """Clipped to the rating scale, one digit."""
    return F.round(F.least(F.greatest(score, F.lit(1.0)), F.lit(5.0)), 1)


def watch_history(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """The n best rated items of each user with title and rating text."""
    top = first_k(ratings.select("user_id", "movie_id", "rating"), n, [F.desc("rating"), F.asc("movie_id")])
    return attach_titles(top, movies).select(
        "user_id",
        "rank",
        "movie_id",
        F.coalesce("title", F.lit("Unknown")).alias("title"),
        F.format_string("%.1f/5.0", F.col("rating").cast("double")).alias("user_rating"),
    )


def user_snapshot(history: DataFrame) -> DataFrame:
    """Watched items and mean shown rating per user."""
    shown = F.regexp_extract("user_rating", r"([\d.]+)", 1).cast("double")
    return history.groupBy("user_id").agg(F.count(F.lit(1)).alias("watched"), F.avg(shown).alias("mean_rating"))


def recommendation_listing(recs: DataFrame, movies: DataFrame) -> DataFrame:
    """Rank, title and score text."""
    return attach_titles(recs, movies).select(
        "user_id",
        "rank",
        F.coalesce("title", F.lit("Unknown")).alias("title"),
        F.when(F.col("score").isNull(), "N/A").otherwise(F.format_string("%.2f", "score")).alias("score_text"),
    )
