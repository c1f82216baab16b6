"""Request logs as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rankloom.operators.monitor import service_counts, strategy_counts
from rankloom.sources.readers import LOG_COLUMNS, typed_logs


def log_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Typed events of a growing JSON-lines folder; broken lines are dropped."""
    text = T.StringType()
    schema = T.StructType(
        [T.StructField(c, T.ArrayType(text) if c == "recommendations" else text) for c in LOG_COLUMNS]
    )
    raw = (
        spark.readStream.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return typed_logs(raw)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append events to Parquet partitioned by day; exactly once per file."""
    return (
        stream.withColumn("day", F.to_date("timestamp"))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_windows(stream: DataFrame, target: str, checkpoint: str, width: str = "1 day") -> StreamingQuery:
    """Every micro-batch adds partial counts of its windows in a folder of its own.

    No watermark is kept, so rows may come in any order and none is dropped. A replayed batch
    overwrites its folder, so nothing is counted twice.
    """
    parts = {**service_counts(), **strategy_counts()}

    def save(batch: DataFrame, batch_id: int) -> None:
        counts = (
            batch.filter(F.col("timestamp").isNotNull())
            .groupBy(F.window("timestamp", width).alias("w"), "latency_ms")
            .agg(*[parts[n].alias(n) for n in _COUNTS])
        )
        rows = counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "latency_ms", *_COUNTS)
        rows.write.mode("overwrite").parquet(f"{target}/update-{batch_id}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
    )


_COUNTS = ("request_count", "success_count", "error_count", "fallback_count")


def read_windows(spark: SparkSession, target: str) -> DataFrame:
    """Service metrics per window from all partial counts; the 95th percentile is exact."""
    rows = spark.read.parquet(f"{target}/update-*")
    timed = F.when(F.col("latency_ms").isNotNull(), F.col("request_count"))
    sums = rows.groupBy("window_start", "window_end").agg(
        *[F.sum(n).alias(n) for n in _COUNTS],
        (F.sum(F.col("latency_ms") * F.col("request_count")) / F.sum(timed)).alias("avg_latency_ms"),
        F.percentile("latency_ms", 0.95, F.col("request_count")).alias("p95_latency_ms"),
    )
    return sums.select(
        "window_start", "window_end", "request_count", "success_count", "error_count",
        (F.col("error_count") / F.col("request_count")).alias("error_rate"), "fallback_count",
        (F.col("fallback_count") / F.col("request_count")).alias("fallback_rate"), "avg_latency_ms", "p95_latency_ms",
    )
