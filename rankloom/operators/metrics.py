"""Ranking metrics, model comparison and promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def relevant_pairs(ratings: DataFrame, threshold: float = 4.0) -> DataFrame:
    return ratings.filter(F.col("rating") >= threshold).select("user_id", "movie_id").distinct()


def eligible_users(relevant: DataFrame, train: DataFrame) -> DataFrame:
    """Users with something relevant and a train history."""
    return relevant.select("user_id").distinct().join(train.select("user_id").distinct(), "user_id", "left_semi")


def user_metrics(
    recs: DataFrame, relevant: DataFrame, users: DataFrame, k: int, by: Sequence[str] = ()
) -> DataFrame:
    """Recall, average precision and hit per user (and per value of ``by``); users without hits count as 0.

    ``recs`` holds user_id, rank, movie_id. A user has at most K of them, so the running
    count of hits works on short lists.
    """
    wanted = relevant.join(users, "user_id", "left_semi").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("relevant_items")
    )
    key = [*by, "user_id"]
    hits = recs.filter(F.col("rank") <= k).join(relevant, ["user_id", "movie_id"], "left_semi")
    so_far = F.row_number().over(Window.partitionBy(*key).orderBy("rank"))
    scored = (
        hits.withColumn("_gain", so_far / F.col("rank"))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("hits"), F.sum("_gain").alias("_gains"))
    )
    if by:
        wanted = wanted.withColumn("_v", F.explode(recs.select(F.collect_set(F.struct(*by))).scalar()))
        wanted = wanted.select("user_id", "relevant_items", "_v.*")
    hit_count = F.coalesce("hits", F.lit(0))
    return wanted.join(scored, key, "left").select(
        *key,
        "relevant_items",
        hit_count.cast("long").alias("hits"),
        (hit_count / F.col("relevant_items")).alias("recall"),
        (F.coalesce("_gains", F.lit(0.0)) / F.least("relevant_items", F.lit(k))).alias("average_precision"),
        (hit_count > 0).cast("double").alias("hit"),
    )


def coverage(recs: DataFrame, users: DataFrame, catalog: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Share of the catalog that eligible users were shown."""
    pool = recs.filter(F.col("rank") <= k).join(users, "user_id", "left_semi")
    size = catalog.agg(F.countDistinct("movie_id")).scalar()
    shown = F.countDistinct("movie_id").alias("_shown")
    counted = pool.groupBy(*by).agg(shown) if by else pool.agg(shown)
    return counted.select(*by, (F.col("_shown") / F.greatest(size, F.lit(1))).alias("coverage"))


def ranking_metrics(
    recs: DataFrame,
    test: DataFrame,
    train: DataFrame,
    catalog: DataFrame,
    k: int,
    threshold: float = 4.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """One metric row (per value of ``by``); zeros where nobody can be evaluated."""
    relevant = relevant_pairs(test, threshold)
    users = eligible_users(relevant, train)
    per_user = user_metrics(recs, relevant, users, k, by)

    def mean(column: str, name: str):
        return F.coalesce(F.avg(column), F.lit(0.0)).alias(name)

    aggs = [
        F.count(F.lit(1)).alias("users_evaluated"),
        mean("recall", "recall_at_k"),
        mean("average_precision", "map_at_k"),
        mean("hit", "hit_rate_at_k"),
    ]
    covered = coverage(recs, users, catalog, k, by)
    if by:
        return per_user.groupBy(*by).agg(*aggs).join(covered, list(by), "left").fillna(0.0, ["coverage"])
    share = covered.select("coverage").scalar()
    return per_user.agg(*aggs).withColumn("coverage", F.coalesce(share, F.lit(0.0)))


def best_row(results: DataFrame, order: Sequence, tie: str) -> DataFrame:
    """The best row; the earliest by ``tie`` wins ties."""
    return results.orderBy(*order, F.asc(tie)).limit(1)


def compare_models(rows: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Model x metrics table."""
    named = [df.withColumn("model", F.lit(name)) for name, df in rows]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df)
    return out.select("model", "users_evaluated", "recall_at_k", "map_at_k", "hit_rate_at_k", "coverage")


def promotion(current: DataFrame, candidate: DataFrame, epsilon: float = 1e-9) -> DataFrame:
    """Metric deltas and the promotion decision for two one-row metric tables."""
    names = ("recall_at_k", "coverage")
    row = current.select(
        *[F.coalesce(n, F.lit(0.0)).alias(f"current_{n}") for n in names],
        candidate.select(F.struct(*names)).scalar().alias("_c"),
    ).select(
        *[f"current_{n}" for n in names],
        *[F.coalesce(f"_c.{n}", F.lit(0.0)).alias(f"candidate_{n}") for n in names],
    )
    recall, cover = F.col("candidate_recall_at_k"), F.col("candidate_coverage")
    old_recall, old_cover = F.col("current_recall_at_k"), F.col("current_coverage")
    better = recall > old_recall + epsilon
    wider = (F.abs(recall - old_recall) <= epsilon) & (cover > old_cover + epsilon)

    def text(pattern: str, *cols):
        return F.format_string(pattern, *cols)

    # fixed values: "recall_at_k improved", "coverage improved", "did not satisfy promotion rule"
    reason = (
        F.when(better, text("New model: recall_at_k improved (%.6f, then %.6f).", old_recall, recall))
        .when(wider, text("New model: same recall, coverage improved (%.6f, then %.6f).", old_cover, cover))
        .otherwise(
            text(
                "Old model: the new one did not satisfy promotion rule (recall %.6f against %.6f, coverage %.6f against %.6f).",
                recall, old_recall, cover, old_cover,
            )
        )
    )
    return row.withColumns(
        {
            "recall_at_k_delta": recall - old_recall,
            "coverage_delta": cover - old_cover,
            "promote": better | wider,
            "reason": reason,
        }
    )
