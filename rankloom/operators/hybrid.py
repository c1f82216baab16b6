"""Blend of a score and item popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rankloom.operators.cells import blend_scorer, dense_scorer, score_cells
from rankloom.operators.metrics import ranking_metrics
from rankloom.operators.topk import factor_item_columns, factor_user_columns
from rankloom.session import staged


def blended_top_k(
    users: DataFrame, items: DataFrame, seen: DataFrame, popularity: DataFrame, alphas: Sequence[float], k: int,
    digits: int | None = None, **blocks: int,
) -> DataFrame:
    """K best unseen items per user for every alpha.

    alpha * (score scaled to 0..1 over the user's unseen items) + (1 - alpha) * normalised
    popularity; an item without popularity has 0, a user with equal scores has 0.
    One pass finds each user's score range, one more blends all alphas at once.
    """
    left, right = factor_user_columns(users), factor_item_columns(items)
    ranges = score_cells(left, right, seen, dense_scorer, 1, digits, **blocks).select("user_id", "min_score", "max_score")
    ranged_users = staged(left.join(ranges, "user_id"), "ranges")
    priced = right.join(popularity.select("movie_id", "score_norm"), "movie_id", "left").fillna(0.0, ["score_norm"])
    alphas = [float(a) for a in alphas]
    ranked = score_cells(
        ranged_users, priced, seen, blend_scorer(alphas, digits), k, digits, variants=len(alphas), **blocks
    )
    number = F.col("variant") if len(alphas) > 1 else F.lit(0)
    alpha = F.element_at(F.array(*[F.lit(a) for a in alphas]), number + 1)
    return ranked.select("user_id", alpha.alias("alpha"), "rank", "movie_id", F.col("raw_score").alias("score"))


def alpha_sweep(recs: DataFrame, test: DataFrame, train: DataFrame, catalog: DataFrame, k: int, threshold: float = 4.0) -> DataFrame:
    """Metrics per alpha in one job."""
    return ranking_metrics(recs, test, train, catalog, k, threshold, by=("alpha",))


def best_alpha(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc("map_at_k"), F.desc("recall_at_k"), F.asc("alpha")).limit(1)
