"""Item distributions and their divergence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.session import staged

FLOOR = 1e-12


def normalize(counts: DataFrame, weight: str) -> DataFrame:
    """(movie_id, p): non-negative weights as shares; empty where they sum to nothing."""
    total = counts.agg(F.sum(weight)).scalar()
    return (
        counts.select("movie_id", F.col(weight).cast("double").alias("_w"), total.cast("double").alias("_t"))
        .filter(F.col("_t") > 0)
        .select("movie_id", (F.col("_w") / F.col("_t")).alias("p"))
    )


def train_distribution(sources: list[DataFrame | None]) -> DataFrame:
    """Shares from the first source with rows.

    Weight column by preference: exposure, interaction_count, score, else every item alike. Shares read the weights for
    their total and for the rows, so the weights are stored once.
    """
    chosen = None
    for source in sources:
        if source is None or "movie_id" not in source.columns:
            continue
        weight = next((c for c in ("exposure", "interaction_count", "score") if c in source.columns), None)
        weights = source.select("movie_id", (F.col(weight) if weight else F.lit(1.0)).alias("weight"))
        chosen = normalize(staged(weights, "weights"), "weight")
        if not chosen.isEmpty():
            return chosen
    if chosen is None:
        raise ValueError("no source for the training distribution")
    return chosen


def served_counts(logs: DataFrame) -> DataFrame:
    """How often each item was recommended; entries that are no whole number are ignored."""
    return (
        logs.select(F.explode("recommendations").alias("_r"))
        .select(F.col("_r").try_cast("long").alias("movie_id"))
        .filter(F.col("movie_id").isNotNull())
        .groupBy("movie_id")
        .agg(F.count(F.lit(1)).alias("served"))
    )


def production_distribution(logs: DataFrame) -> DataFrame:
    return normalize(served_counts(logs), "served")


def _clipped(col: str) -> Column:
    return F.least(F.greatest(F.coalesce(col, F.lit(0.0)), F.lit(FLOOR)), F.lit(1.0))


def divergence(train: DataFrame, production: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence (natural logarithm) over the union of items; 0 if a side is empty."""
    pairs = (
        train.select("movie_id", F.col("p").alias("_p"))
        .join(production.select("movie_id", F.col("p").alias("_q")), "movie_id", "full")
        .select("_p", "_q", F.lit(1).alias("_n"))
    )
    return divergence_of_pairs(pairs)


def divergence_of_pairs(pairs: DataFrame) -> DataFrame:
    """The same from rows (_p, _q, _n): ``_n`` items have these two shares, null where a side lacks them."""
    held = pairs.select(
        _clipped("_p").alias("p"), _clipped("_q").alias("q"), "_n",
        F.col("_p").isNotNull().alias("in_train"), F.col("_q").isNotNull().alias("in_production"),
    )
    sums = held.agg(F.struct(F.sum(F.col("p") * F.col("_n")).alias("p"), F.sum(F.col("q") * F.col("_n")).alias("q"))).scalar()
    shares = held.withColumn("_s", sums).select(
        (F.col("p") / F.col("_s.p")).alias("p"), (F.col("q") / F.col("_s.q")).alias("q"), "_n", "in_train", "in_production"
    )
    middle = (F.col("p") + F.col("q")) / 2
    gain = (F.col("p") * F.log(F.col("p") / middle) + F.col("q") * F.log(F.col("q") / middle)) / 2
    both = F.coalesce(F.bool_or("in_train") & F.bool_or("in_production"), F.lit(False))
    return shares.agg(F.when(both, F.sum(gain * F.col("_n"))).otherwise(0.0).alias("drift_score"))


def top_item_shift(train: DataFrame, production: DataFrame, n: int = 10) -> DataFrame:
    """The n most served items with both shares."""
    top = production.orderBy(F.desc("p"), "movie_id").limit(n).withColumnRenamed("p", "production_probability")
    return top.join(train.withColumnRenamed("p", "train_probability"), "movie_id", "left").select(
        "movie_id", F.coalesce("train_probability", F.lit(0.0)).alias("train_probability"), "production_probability"
    )
