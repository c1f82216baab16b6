"""Queries: monitoring, drift, feedback, exploratory statistics, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankloom.operators import drift, eda, feedback, monitor, popularity
from rankloom.plans import views
from rankloom.plans.registry import query
from rankloom.plans.sql import with_views
from rankloom.plans.staging import rounded
from rankloom.plans.tables import NOW, TIE
from rankloom.session import fresh_path, staged
from rankloom.sources import writers


def _logs(spark, sf) -> DataFrame:
    return views.request_logs(spark, sf)


def _train_share(spark, sf) -> DataFrame:
    exposure = staged(popularity.exposure_counts(views.train(spark, sf)), "exposure")
    return drift.train_distribution([exposure])


# ---- service metrics

N = "CAST(nullif(count(*), 0) AS DOUBLE)"
SERVICE = f"""count(*) AS request_count, count(*) FILTER (WHERE response_status < 400) AS success_count,
count(*) FILTER (WHERE response_status >= 400) AS error_count,
round(coalesce(count(*) FILTER (WHERE response_status < 400) / {N}, 0), 6) AS success_rate,
round(coalesce(count(*) FILTER (WHERE response_status >= 400) / {N}, 0), 6) AS error_rate"""
COLD = "count(*) FILTER (WHERE strategy = 'popularity_fallback')"
STRATEGY = f"""{COLD} AS fallback_count, count(*) - {COLD} AS personalized_count, round(coalesce({COLD} / {N}, 0), 6) AS fallback_rate,
round(coalesce((count(*) - {COLD}) / {N}, 0), 6) AS personalized_rate, round(coalesce({COLD} / {N}, 0), 6) AS unknown_user_rate"""
USERS = """count(DISTINCT user_id) AS unique_users, round(count(user_id) / CAST(nullif(count(DISTINCT user_id), 0) AS DOUBLE), 6) AS requests_per_user,
round(avg(top_k), 6) AS avg_top_k"""
LATENCY = "round(avg(latency_ms), 6) AS avg_latency_ms, round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms"
RATES = ("success_rate", "error_rate")


@query("j1_service_counts", with_views(f"SELECT {SERVICE} FROM logs"))
def _(spark, sf):
    return rounded(monitor.service_metrics(_logs(spark, sf)), *RATES)


@query("j2_latency", with_views(f"SELECT {LATENCY} FROM logs"))
def _(spark, sf):
    return rounded(monitor.latency(_logs(spark, sf)), "avg_latency_ms", "p95_latency_ms")


@query("j3_strategy_rates", with_views(f"SELECT {STRATEGY} FROM logs"))
def _(spark, sf):
    return rounded(monitor.strategy_metrics(_logs(spark, sf)), "fallback_rate", "personalized_rate", "unknown_user_rate")


@query("j4_user_behaviour", with_views(f"SELECT {USERS} FROM logs"))
def _(spark, sf):
    return rounded(monitor.user_metrics(_logs(spark, sf)), "requests_per_user", "avg_top_k")


DAY_SQL = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS requests FROM logs WHERE ts IS NOT NULL GROUP BY 1"


@query("j5_requests_per_day", with_views(DAY_SQL))
def _(spark, sf):
    return monitor.requests_per_day(_logs(spark, sf))


# ---- drift

@query("j6_train_distribution", with_views("""
SELECT 'exposure' AS source, movie_id, round(p, 9) AS p FROM trainshare
UNION ALL SELECT 'interactions', movie_id, round(interaction_count / CAST(sum(interaction_count) OVER () AS DOUBLE), 9) FROM popularity
UNION ALL SELECT 'uniform', movie_id, round(1 / CAST(count(*) OVER () AS DOUBLE), 9) FROM movies"""))
def _(spark, sf):
    """Each kind of source, reached when the ones before it are absent or empty."""
    train = staged(views.train(spark, sf), "train")
    exposure, counts = popularity.exposure_counts(train), popularity.item_popularity(train)
    chains = {"exposure": [exposure, counts], "interactions": [None, exposure.filter(F.lit(False)), counts],
              "uniform": [views.movies(spark, sf).select("movie_id")]}
    rows = [drift.train_distribution(c).select(F.lit(n).alias("source"), "movie_id", "p") for n, c in chains.items()]
    return rounded(rows[0].unionByName(rows[1]).unionByName(rows[2]), "p", digits=9)


@query("j7_production_distribution", with_views("SELECT movie_id, round(p, 9) AS p FROM prodshare"))
def _(spark, sf):
    return rounded(drift.production_distribution(_logs(spark, sf)), "p", digits=9)


@query("j8_divergence", with_views("SELECT round(drift_score, 6) AS drift_score FROM driftscore"))
def _(spark, sf):
    return rounded(drift.divergence(_train_share(spark, sf), drift.production_distribution(_logs(spark, sf))), "drift_score")


SHIFT_SQL = """SELECT s.movie_id, round(coalesce(t.p, 0), 9) AS train_probability, round(s.p, 9) AS production_probability
FROM (SELECT * FROM prodshare ORDER BY p DESC, movie_id LIMIT 10) s LEFT JOIN trainshare t ON t.movie_id = s.movie_id"""


@query("j9_top_item_shift", with_views(SHIFT_SQL))
def _(spark, sf):
    rows = drift.top_item_shift(_train_share(spark, sf), drift.production_distribution(_logs(spark, sf)))
    return rounded(rows, "train_probability", "production_probability", digits=9)


ALERT_INPUT = {
    "rates": f"SELECT {COLD} / {N} AS fallback_rate, avg(latency_ms) AS avg_latency_ms, count(*) FILTER (WHERE response_status >= 400) / {N} AS error_rate FROM logs",
    "limits": """SELECT 'fallback_rate' AS metric, (SELECT fallback_rate FROM rates) AS value, CAST(0.40 AS DOUBLE) AS threshold
UNION ALL SELECT 'avg_latency_ms', (SELECT avg_latency_ms FROM rates), 1000.0 UNION ALL SELECT 'error_rate', (SELECT error_rate FROM rates), 0.02""",
    "driftlimits": """SELECT 'drift_score' AS metric, (SELECT drift_score FROM driftscore) AS value, CAST(0.20 AS DOUBLE) AS threshold
UNION ALL SELECT 'unknown_user_rate', (SELECT fallback_rate FROM rates), 0.40""",
}


@query("j10_service_alerts", with_views("SELECT metric, round(value, 6) AS value, threshold FROM limits WHERE value > threshold", **ALERT_INPUT))
def _(spark, sf):
    return rounded(monitor.alerts(monitor.service_alert_inputs(_logs(spark, sf))), "value")


@query("j11_drift_alerts", with_views("SELECT metric, round(value, 6) AS value, threshold FROM driftlimits WHERE value > threshold", **ALERT_INPUT))
def _(spark, sf):
    return rounded(monitor.alerts(monitor.drift_alert_inputs(_logs(spark, sf), _train_share(spark, sf))), "value")


@query("j12_retrain_trigger", with_views("""
SELECT 'schedule' AS strategy, round(drift_score, 6) AS drift_score, true AS retrain, 'Schedule-based: this cycle retrains whatever the drift.' AS reason FROM driftscore
UNION ALL SELECT 'trigger', round(drift_score, 6), drift_score >= 0.2, CASE WHEN drift_score >= 0.2
  THEN printf('Retraining activated, drift %.4f reaches 0.2000.', drift_score)
  ELSE printf('Retraining skipped, drift %.4f is below 0.2000.', drift_score) END FROM driftscore
UNION ALL SELECT 'missing', NULL, false, 'Retraining skipped, there is no drift score.'"""))
def _(spark, sf):
    score = staged(drift.divergence(_train_share(spark, sf), drift.production_distribution(_logs(spark, sf))), "score")
    none = score.withColumn("drift_score", F.lit(None).cast("double"))
    cases = {"schedule": (score, "schedule"), "trigger": (score, "trigger"), "missing": (none, "trigger")}
    rows = [monitor.retrain_trigger(df, how).select(F.lit(n).alias("strategy"), "*") for n, (df, how) in cases.items()]
    return rounded(rows[0].unionByName(rows[1]).unionByName(rows[2]), "drift_score")


SUMMARY_SQL = f"""
SELECT {SERVICE}, {STRATEGY}, {USERS}, {LATENCY}, (SELECT round(drift_score, 6) FROM driftscore) AS drift_score,
  (SELECT string_agg(metric, ',' ORDER BY o) FROM (SELECT *, 0 AS o FROM limits WHERE metric = 'fallback_rate' UNION ALL SELECT *, 1 FROM limits WHERE metric = 'avg_latency_ms'
   UNION ALL SELECT *, 2 FROM limits WHERE metric = 'error_rate' UNION ALL SELECT *, 3 FROM driftlimits WHERE metric = 'drift_score'
   UNION ALL SELECT *, 4 FROM driftlimits WHERE metric = 'unknown_user_rate') w WHERE value > threshold) AS warnings,
  (SELECT string_agg(day || '=' || requests, ',' ORDER BY day) FROM perday) AS requests_per_day,
  (SELECT string_agg(CAST(movie_id AS VARCHAR), ',' ORDER BY production_probability DESC, movie_id) FROM shift) AS top_items
FROM logs"""


def _flat_summary(row: DataFrame) -> DataFrame:
    flat = row.select("service_metrics.*", "data_behavior.*", "drift.*", "warnings").select(
        "*", F.concat_ws(",", "warnings").alias("w"),
        F.concat_ws(",", F.transform("requests_per_day", lambda d: F.concat_ws("=", d["day"], d["requests"].cast("string")))).alias("d"),
        F.concat_ws(",", F.transform("top_item_shift", lambda i: i["movie_id"].cast("string"))).alias("top_items"),
    )
    flat = flat.drop("warnings", "requests_per_day", "top_item_shift").withColumnsRenamed({"w": "warnings", "d": "requests_per_day"})
    return rounded(flat, *[n for n, t in flat.dtypes if t == "double"])


def _summary(spark, sf) -> DataFrame:
    return monitor.monitoring_summary(_logs(spark, sf), staged(_train_share(spark, sf), "share"))


@query("j13_monitoring_summary", with_views(SUMMARY_SQL, perday=DAY_SQL, shift=SHIFT_SQL, **ALERT_INPUT))
def _(spark, sf):
    return _flat_summary(_summary(spark, sf))


@query("a13_summary_sink", with_views(SUMMARY_SQL, perday=DAY_SQL, shift=SHIFT_SQL, **ALERT_INPUT))
def _(spark, sf):
    """The nested monitoring record as JSON and back."""
    row = _summary(spark, sf)
    path = writers.write_json(row, fresh_path(spark, "summary"))
    return _flat_summary(spark.read.schema(row.schema).json(path))


# ---- feedback

def _feedback(spark, sf) -> DataFrame:
    return views.feedback(spark, sf).withColumnRenamed("ts", "timestamp").withColumn("src2", F.lit(0).cast("long"))


FEED = {
    "news": "SELECT src1, CAST(0 AS BIGINT) AS src2, user_id, movie_id, rating, ts FROM feedback",
    "both_": "SELECT user_id, movie_id, rating, ts, src1, src2, 0 AS o FROM interactions UNION ALL SELECT user_id, movie_id, rating, ts, src1, src2, 1 FROM news",
    "merged": """SELECT user_id, movie_id, rating, ts AS "timestamp" FROM both_
QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY ts DESC, o DESC, src1 DESC, src2 DESC) = 1""",
}


@query("k1_normalize_feedback", with_views(f"""
SELECT CAST(TRY_CAST(user_id AS DOUBLE) AS BIGINT) AS user_id, CAST(trunc(TRY_CAST(movie_id AS DOUBLE)) AS BIGINT) AS movie_id, TRY_CAST(rating AS DOUBLE) AS rating, CAST({NOW} AS BIGINT) AS "timestamp"
FROM (SELECT CASE WHEN src1 % 7 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS user_id, CAST(movie_id AS VARCHAR) || '.7' AS movie_id,
      CASE WHEN src1 % 5 = 0 THEN NULL ELSE CAST(rating AS VARCHAR) END AS rating FROM feedback) f
WHERE TRY_CAST(user_id AS DOUBLE) IS NOT NULL AND rating IS NOT NULL"""))
def _(spark, sf):
    """Text feedback with faults and without times."""
    rows = views.feedback(spark, sf).select(
        F.when(F.col("src1") % 7 == 0, "x").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.col("movie_id").cast("string"), F.lit(".7")).alias("movie_id"),
        F.when(F.col("src1") % 5 != 0, F.col("rating").cast("string")).alias("rating"),
    )
    return feedback.normalize_feedback(rows, NOW)


def _merged(spark, sf) -> DataFrame:
    base = views.interactions(spark, sf).withColumnRenamed("ts", "timestamp")
    news = feedback.normalize_feedback(_feedback(spark, sf), NOW, TIE)
    return feedback.merge_feedback(base, news, NOW, TIE).select("user_id", "movie_id", "rating", "timestamp")


MERGED_SQL = with_views('SELECT user_id, movie_id, rating, "timestamp" FROM merged', **FEED)


@query("k2_merge_feedback", MERGED_SQL)
def _(spark, sf):
    return _merged(spark, sf)


@query("k3_merge_stats", with_views("SELECT (SELECT count(*) FROM news) AS new_feedback_rows, (SELECT count(*) FROM merged) AS updated_train_rows", **FEED))
def _(spark, sf):
    return feedback.merge_stats(views.interactions(spark, sf), feedback.normalize_feedback(_feedback(spark, sf), NOW, TIE))


# ---- exploratory statistics

HIST = {
    "byuser": "SELECT user_id, count(*) AS value FROM interactions GROUP BY user_id",
    "bymovie": "SELECT movie_id, count(*) AS value FROM interactions GROUP BY movie_id",
}


@query("l1_overview", with_views("""
SELECT (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM movies) AS movies, (SELECT count(*) FROM interactions) AS ratings,
 (SELECT count(DISTINCT user_id) FROM interactions) AS users_in_ratings, (SELECT count(DISTINCT movie_id) FROM interactions) AS movies_in_ratings,
 (SELECT count(*) FROM (SELECT DISTINCT user_id, movie_id FROM interactions) p) AS unique_pairs"""))
def _(spark, sf):
    return eda.overview(views.interactions(spark, sf), views.movies(spark, sf), views.users(spark, sf))


@query("l2_rating_distribution", with_views("SELECT rating, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM raw), 6) AS percentage FROM raw GROUP BY rating"))
def _(spark, sf):
    return rounded(eda.rating_distribution(views.interactions_raw(spark, sf)), "percentage")


@query("l3_rating_moments", with_views("SELECT round(avg(rating), 6) AS mean, median(rating) AS median, round(stddev_samp(rating), 6) AS std FROM interactions"))
def _(spark, sf):
    return rounded(eda.rating_moments(views.interactions(spark, sf)), "mean", "std")


def _describe(table: str, name: str) -> str:
    cuts = ", ".join(f"round(quantile_cont(value, {p}), 6) AS p{round(p * 100)}" for p in eda.PERCENTILES)
    return f"""SELECT '{name}' AS entity, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, {cuts}, max(value) AS max FROM {table}"""


@query("l4_activity_describe", with_views(_describe("byuser", "user") + " UNION ALL " + _describe("bymovie", "movie"), **HIST))
def _(spark, sf):
    rows = views.interactions(spark, sf)
    users = eda.describe_activity(eda.activity_histogram(rows, "user_id"), "user")
    movies = eda.describe_activity(eda.activity_histogram(rows, "movie_id"), "movie")
    both = users.unionByName(movies)
    return rounded(both, *[n for n, t in both.dtypes if t == "double"])


@query("l5_most_rated", with_views("""
SELECT t.movie_id, t.rating_count, m.title FROM (SELECT movie_id, count(*) AS rating_count FROM interactions GROUP BY movie_id ORDER BY rating_count DESC, movie_id LIMIT 10) t
LEFT JOIN movies m ON m.movie_id = t.movie_id"""))
def _(spark, sf):
    return eda.most_rated(views.interactions(spark, sf), views.movies(spark, sf))


@query("l6_density", with_views("""
SELECT observed, round(observed / possible, 9) AS density, round(1 - observed / possible, 9) AS sparsity
FROM (SELECT (SELECT count(*) FROM interactions) AS observed, CAST((SELECT count(*) FROM users) * (SELECT count(*) FROM movies) AS DOUBLE) AS possible) d"""))
def _(spark, sf):
    rows = eda.density(views.interactions(spark, sf), views.movies(spark, sf), views.users(spark, sf))
    return rounded(rows, "density", "sparsity", digits=9)


def _gini(table: str, name: str) -> str:
    return f"""SELECT '{name}' AS entity, round(CAST(sum((2.0 * i - n - 1) * value) / (max(n) * sum(value)) AS DOUBLE), 6) AS gini
FROM (SELECT CAST(value AS DOUBLE) AS value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM {table}) t"""


@query("l7_gini", with_views(_gini("byuser", "user") + " UNION ALL " + _gini("bymovie", "movie"), **HIST))
def _(spark, sf):
    rows = views.interactions(spark, sf)
    parts = [eda.gini(eda.activity_histogram(rows, k)).select(F.lit(n).alias("entity"), "gini") for n, k in (("user", "user_id"), ("movie", "movie_id"))]
    return rounded(parts[0].unionByName(parts[1]), "gini")


def _head(table: str, name: str) -> str:
    return f"""SELECT '{name}' AS entity, f AS share, round(sum(value) FILTER (WHERE i <= ceil(f * n)) / CAST(sum(value) AS DOUBLE), 6) AS head_share
FROM (SELECT value, row_number() OVER (ORDER BY value DESC) AS i, count(*) OVER () AS n FROM {table}) t CROSS JOIN (SELECT unnest([0.01, 0.05, 0.1, 0.2])::DOUBLE AS f) s GROUP BY f"""


@query("l8_head_share", with_views(_head("byuser", "user") + " UNION ALL " + _head("bymovie", "movie"), **HIST))
def _(spark, sf):
    rows = views.interactions(spark, sf)
    parts = [eda.head_share(eda.activity_histogram(rows, k)).select(F.lit(n).alias("entity"), "*") for n, k in (("user", "user_id"), ("movie", "movie_id"))]
    return rounded(parts[0].unionByName(parts[1]), "head_share")


def _cold(table: str, name: str) -> str:
    return f"""SELECT '{name}' AS entity, round(avg(CAST(value <= 1 AS INT)), 6) AS at_most_1, round(avg(CAST(value <= 5 AS INT)), 6) AS at_most_5 FROM {table}"""


@query("l9_cold_start_ratios", with_views(_cold("byuser", "user") + " UNION ALL " + _cold("bymovie", "movie"), **HIST))
def _(spark, sf):
    return rounded(eda.cold_start_ratios(views.interactions(spark, sf)), "at_most_1", "at_most_5")


@query("l10_threshold_ratios", with_views("""
SELECT 'movies_lt_10' AS metric, round(avg(CAST(value < 10 AS INT)), 6) AS ratio FROM bymovie
UNION ALL SELECT 'movies_lt_20', round(avg(CAST(value < 20 AS INT)), 6) FROM bymovie UNION ALL SELECT 'users_lt_50', round(avg(CAST(value < 50 AS INT)), 6) FROM byuser""", **HIST))
def _(spark, sf):
    return rounded(eda.threshold_ratios(views.interactions(spark, sf)), "ratio")


SPAN = "SELECT min(ts) AS min_ts, max(ts) AS max_ts, CAST((max(ts) - min(ts)) // 86400 AS BIGINT) AS span_days FROM interactions"


@query("l11_time_span", with_views("SELECT min_ts, max_ts, span_days, round(span_days / CAST(365.25 AS DOUBLE), 6) AS span_years FROM span", span=SPAN))
def _(spark, sf):
    return rounded(eda.time_span(views.interactions(spark, sf)), "span_years")


def _volume(unit: str) -> str:
    return f"""SELECT CAST(s.period AS DATE) AS period, coalesce(c.n, 0) AS rating_count, c.a AS avg_rating FROM (
 SELECT unnest(generate_series(min(p), max(p), INTERVAL 1 {unit})) AS period FROM (SELECT CAST(date_trunc('{unit}', make_timestamp(ts * 1000000)) AS TIMESTAMP) AS p FROM interactions) x) s
 LEFT JOIN (SELECT CAST(date_trunc('{unit}', make_timestamp(ts * 1000000)) AS TIMESTAMP) AS p, count(*) AS n, avg(rating) AS a FROM interactions GROUP BY 1) c ON c.p = s.period"""


VOLUMES = {"monthly": _volume("month"), "yearly": _volume("year")}


@query("l12_volume_resample", with_views("""
SELECT 'month' AS unit, period, rating_count, round(avg_rating, 6) AS avg_rating FROM monthly UNION ALL SELECT 'year', period, rating_count, round(avg_rating, 6) FROM yearly""", **VOLUMES))
def _(spark, sf):
    rows = views.interactions(spark, sf)
    parts = [eda.volume(rows, u).select(F.lit(u).alias("unit"), "*") for u in ("month", "year")]
    return rounded(parts[0].unionByName(parts[1]), "avg_rating")


VARIATION = "SELECT stddev_samp(rating_count) / avg(rating_count) AS volume_cv, max(avg_rating) - min(avg_rating) AS rating_range FROM yearly"


@query("l13_yearly_variation", with_views("SELECT round(volume_cv, 6) AS volume_cv, round(rating_range, 6) AS rating_range FROM variation", variation=VARIATION, **VOLUMES))
def _(spark, sf):
    return rounded(eda.yearly_variation(views.interactions(spark, sf)), "volume_cv", "rating_range")


@query("l14_rule_labels", with_views("""
SELECT CASE WHEN (SELECT span_days FROM span) / 365.25 >= 2 AND (volume_cv > 0.1 OR rating_range > 0.1) THEN 'split by time'
            ELSE 'split at random, validate by time' END AS split_recommendation,
 CASE WHEN s >= 0.99 THEN 'sparse: 99 %' WHEN s >= 0.95 THEN 'sparse: 95 %' WHEN s >= 0.9 THEN 'sparse: 90 %' ELSE 'below 90 %' END AS sparsity_label,
 CASE WHEN h >= 0.7 THEN 'most ratings on few items' WHEN h >= 0.55 THEN 'many ratings on few items'
      ELSE 'ratings spread over items' END AS concentration_label,
 CASE WHEN m >= 0.3 OR u >= 0.3 THEN 'significant' WHEN m >= 0.15 OR u >= 0.15 THEN 'moderate' ELSE 'limited' END AS cold_start_label
FROM (SELECT v.volume_cv, v.rating_range, 1 - (SELECT count(*) FROM interactions) / CAST((SELECT count(*) FROM users) * (SELECT count(*) FROM movies) AS DOUBLE) AS s,
 (SELECT head_share FROM heads WHERE share = 0.2) AS h, (SELECT avg(CAST(value <= 5 AS INT)) FROM bymovie) AS m, (SELECT avg(CAST(value <= 5 AS INT)) FROM byuser) AS u
 FROM variation v) q""", span=SPAN, variation=VARIATION, heads=_head("bymovie", "movie"), **VOLUMES, **HIST))
def _(spark, sf):
    return eda.rule_labels(views.interactions(spark, sf), views.movies(spark, sf), views.users(spark, sf))
