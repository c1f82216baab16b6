"""Queries: streams run to the end of their input and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators.drift import train_distribution
from rankloom.operators.popularity import exposure_counts
from rankloom.plans import views
from rankloom.plans.monitoring import COLD, MERGED_SQL, N
from rankloom.plans.registry import query
from rankloom.plans.sql import with_views
from rankloom.plans.staging import rounded
from rankloom.plans.tables import LOG_ROWS_SQL, NOW, TIE, flat_logs, json_lines
from rankloom.session import fresh_path, staged
from rankloom.streaming import logs, state


@query("m1_log_ingest_stream", with_views(LOG_ROWS_SQL))
def _(spark, sf):
    source, target = json_lines(spark, sf), fresh_path(spark, "ingested")
    logs.ingest(logs.log_stream(spark, source, 2), target, fresh_path(spark, "offsets")).awaitTermination()
    return flat_logs(spark.read.parquet(target))


@query("m2_windowed_metrics_stream", with_views(f"""
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS request_count, count(*) FILTER (WHERE response_status < 400) AS success_count,
 count(*) FILTER (WHERE response_status >= 400) AS error_count, round(count(*) FILTER (WHERE response_status >= 400) / {N}, 6) AS error_rate,
 {COLD} AS fallback_count, round({COLD} / {N}, 6) AS fallback_rate, round(avg(latency_ms), 6) AS avg_latency_ms FROM logs GROUP BY 1"""))
def _(spark, sf):
    """Daily windows; the files arrive in several batches and in no order of time."""
    source, target = json_lines(spark, sf), fresh_path(spark, "windows")
    logs.write_windows(logs.log_stream(spark, source, 2), target, fresh_path(spark, "offsets")).awaitTermination()
    rows = logs.read_windows(spark, target).drop("window_end", "p95_latency_ms")
    return rounded(rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "error_rate", "fallback_rate", "avg_latency_ms")


@query("m3_feedback_upsert_stream", MERGED_SQL)
def _(spark, sf):
    """Feedback in several micro-batches equals one merge of all of it."""
    root, source = fresh_path(spark, "table"), fresh_path(spark, "feedback")
    base = views.interactions(spark, sf).withColumnRenamed("ts", "timestamp")
    base.write.parquet(f"{root}/base")
    news = views.feedback(spark, sf).withColumnRenamed("ts", "timestamp").withColumn("src2", F.lit(0).cast("long"))
    news.write.option("maxRecordsPerFile", 200_000).parquet(source)
    stream = spark.readStream.schema(news.schema).option("maxFilesPerTrigger", 2).parquet(source)
    state.append_feedback(stream, root, fresh_path(spark, "offsets"), NOW, TIE).awaitTermination()
    return state.read_merged(spark, root, NOW, TIE).select("user_id", "movie_id", "rating", "timestamp")


@query("m4_drift_stream", with_views("SELECT round(drift_score, 6) AS drift_score FROM driftscore"))
def _(spark, sf):
    """Divergence after the last micro-batch equals the batch value."""
    source, root = json_lines(spark, sf), fresh_path(spark, "drift")
    exposure = staged(exposure_counts(views.train(spark, sf)), "exposure")
    share = staged(train_distribution([exposure]), "share")
    run = state.track_drift(logs.log_stream(spark, source, 2), share, root, fresh_path(spark, "offsets"))
    run.awaitTermination()
    last = state.latest_version(spark, f"{root}/drift", run.lastProgress["batchId"] + 1)
    return rounded(spark.read.parquet(last).select("drift_score"), "drift_score")
