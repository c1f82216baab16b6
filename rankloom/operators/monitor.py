"""Request-log metrics, alerts, retrain trigger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.operators import drift
from rankloom.operators.skew import exact_percentile
from rankloom.session import staged

FALLBACK = "popularity_fallback"

# Alert thresholds by metric.
THRESHOLDS = {
    "fallback_rate": 0.40,
    "avg_latency_ms": 1000.0,
    "error_rate": 0.02,
    "drift_score": 0.20,
    "unknown_user_rate": 0.40,
}


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def service_counts() -> dict[str, Column]:
    """A NULL status is neither success nor error."""
    n = F.count(F.lit(1))
    ok, bad = F.count_if(F.col("response_status") < 400), F.count_if(F.col("response_status") >= 400)
    return {
        "request_count": n,
        "success_count": ok,
        "error_count": bad,
        "success_rate": _rate(ok, n),
        "error_rate": _rate(bad, n),
    }


def strategy_counts() -> dict[str, Column]:
    n = F.count(F.lit(1))
    cold = F.count_if(F.col("strategy") == FALLBACK)
    return {
        "fallback_count": cold,
        "personalized_count": n - cold,
        "fallback_rate": _rate(cold, n),
        "personalized_rate": _rate(n - cold, n),
        "unknown_user_rate": _rate(cold, n),
    }


def user_behaviour() -> dict[str, Column]:
    """Mean requests per user = requests with a user / distinct users."""
    people = F.countDistinct("user_id")
    return {
        "unique_users": people,
        "requests_per_user": _rate(F.count("user_id"), people),
        "avg_top_k": F.coalesce(F.avg("top_k"), F.lit(0.0)),
    }


def _row(logs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return logs.agg(*[c.alias(n) for n, c in columns.items()])


def service_metrics(logs: DataFrame) -> DataFrame:
    return _row(logs, service_counts())


def strategy_metrics(logs: DataFrame) -> DataFrame:
    return _row(logs, strategy_counts())


def user_metrics(logs: DataFrame) -> DataFrame:
    return _row(logs, user_behaviour())


def latency(logs: DataFrame) -> DataFrame:
    """Mean and interpolated 95th percentile, both 0 without data."""
    p95 = exact_percentile(logs.select("latency_ms"), "latency_ms", 0.95)
    return logs.agg(
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        F.lit(p95 if p95 is not None else 0.0).alias("p95_latency_ms"),
    )


def requests_per_day(logs: DataFrame, time: str = "ts") -> DataFrame:
    return (
        logs.filter(F.col(time).isNotNull())
        .groupBy(F.date_format(time, "yyyy-MM-dd").alias("day"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def _long(row: DataFrame, names: list[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def alerts(metrics: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Metrics of a one-row table that exceed (strictly) their threshold."""
    limits = {**THRESHOLDS, **(thresholds or {})}
    names = [n for n in limits if n in metrics.columns]
    limit = F.element_at(F.create_map(*[x for n in names for x in (F.lit(n), F.lit(float(limits[n])))]), F.col("metric"))
    return _long(metrics, names).withColumn("threshold", limit).filter(F.col("value") > F.col("threshold"))


def service_alert_inputs(logs: DataFrame) -> DataFrame:
    return _row(
        logs,
        {
            "fallback_rate": strategy_counts()["fallback_rate"],
            "avg_latency_ms": F.coalesce(F.avg("latency_ms"), F.lit(0.0)),
            "error_rate": service_counts()["error_rate"],
        },
    )


def drift_alert_inputs(logs: DataFrame, train_share: DataFrame) -> DataFrame:
    score = drift.divergence(train_share, drift.production_distribution(logs))
    rates = _row(logs, {"unknown_user_rate": strategy_counts()["unknown_user_rate"]})
    return rates.select(score.scalar().alias("drift_score"), "unknown_user_rate")


def retrain_trigger(drift_row: DataFrame, strategy: str = "trigger", threshold: float = 0.20) -> DataFrame:
    """Schedule always retrains; trigger retrains at or above the threshold; a missing score does not."""
    score = F.col("drift_score")
    if strategy == "schedule":
        fire, reason = F.lit(True), F.lit("Schedule-based: this cycle retrains whatever the drift.")
    else:
        fire = F.coalesce(score >= threshold, F.lit(False))
        reason = (
            F.when(score.isNull(), F.lit("Retraining skipped, there is no drift score."))
            .when(
                fire,
                F.format_string("Retraining activated, drift %.4f reaches %.4f.", score, F.lit(threshold)),
            )
            .otherwise(
                F.format_string("Retraining skipped, drift %.4f is below %.4f.", score, F.lit(threshold))
            )
        )
    return drift_row.select("drift_score", fire.alias("retrain"), reason.alias("reason"))


def monitoring_summary(logs: DataFrame, train_share: DataFrame, time: str = "ts", shift_items: int = 10) -> DataFrame:
    """Everything as one nested row: service_metrics, data_behavior, drift, warnings."""
    behaviour = {**user_behaviour(), **strategy_counts()}
    served = staged(drift.production_distribution(logs), "served")  # one row per item, read three times
    shift = drift.top_item_shift(train_share, served, shift_items)
    # One entry per calendar day and at most shift_items items: both lists are short.
    days = requests_per_day(logs, time).agg(F.array_sort(F.collect_list(F.struct("day", "requests")))).scalar()
    items = shift.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("production_probability")).alias("o"), "movie_id", "train_probability", "production_probability"))
        ).alias("a")
    ).select(F.transform("a", lambda e: e.dropFields("o"))).scalar()
    p95 = exact_percentile(logs.select("latency_ms"), "latency_ms", 0.95)
    flat = _row(logs, {**service_counts(), **behaviour, "avg_latency_ms": F.coalesce(F.avg("latency_ms"), F.lit(0.0))})
    flat = flat.select("*", drift.divergence(train_share, served).scalar().alias("drift_score"))
    over = [F.when(F.col(n).cast("double") > limit, F.lit(n)) for n, limit in THRESHOLDS.items()]
    return flat.select(
        F.struct(*service_counts(), "avg_latency_ms", F.lit(p95 if p95 is not None else 0.0).alias("p95_latency_ms")).alias("service_metrics"),
        F.struct(*behaviour, days.alias("requests_per_day")).alias("data_behavior"),
        F.struct("drift_score", items.alias("top_item_shift")).alias("drift"),
        F.array_compact(F.array(*over)).alias("warnings"),
    )
