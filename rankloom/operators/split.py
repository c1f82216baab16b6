"""Per-user temporal holdout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.operators.skew import group_row_number


def holdout_sizes(n: Column, val_ratio: float, test_ratio: float) -> tuple[Column, Column]:
    """(val, test) rows held out of a history of ``n``; halves round to even."""
    test = F.greatest(F.lit(1), F.rint(n * test_ratio).cast("long"))
    val = F.greatest(F.lit(1), F.rint(n * val_ratio).cast("long"))
    crowded = test + val >= n
    test = F.when(n <= 1, 0).when(n == 2, 1).when(crowded, 1).otherwise(test)
    val = F.when(n <= 2, 0).when(crowded, 1).otherwise(val)
    return val.cast("long"), test.cast("long")


def temporal_split(
    df: DataFrame,
    time: str,
    val_ratio: float = 0.1,
    test_ratio: float = 0.2,
    min_interactions: int = 3,
    **skew: float,
) -> DataFrame:
    """Label every row train, val or test: oldest to train, newest to test, per user.

    Histories shorter than ``min_interactions`` stay in train.
    """
    ranked = group_row_number(df, "user_id", [time, "movie_id"], "_rank", "_n", **skew)
    n = F.col("_n")
    val, test = holdout_sizes(n, val_ratio, test_ratio)
    label = (
        F.when(n < min_interactions, "train")
        .when(F.col("_rank") > n - test, "test")
        .when(F.col("_rank") > n - test - val, "val")
        .otherwise("train")
    )
    return ranked.select(*df.columns, label.alias("split"))


def split_summary(labelled: DataFrame, min_interactions: int = 3) -> DataFrame:
    """Users and rows by eligibility and split, from one pre-aggregated pass."""
    per_user = labelled.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")],
    )
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.count_if(F.col("n") >= min_interactions).alias("eligible_users"),
        F.count_if(F.col("n") < min_interactions).alias("low_history_users"),
        *[F.coalesce(F.sum(s), F.lit(0)).cast("long").alias(f"{s}_rows") for s in ("train", "val", "test")],
    )


def refit_rows(train: DataFrame, val: DataFrame) -> DataFrame:
    """Train and validation rows together, nothing deduplicated."""
    return train.unionByName(val)
