"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


# ISO time with microseconds, as log events carry it.
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_cleaned_csv(df: DataFrame, folder: str, name: str) -> str:
    path = f"{folder}/{name}_cleaned.csv"
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One object per row; also the sink of one-row summaries."""
    df.write.mode("overwrite").json(path)
    return path


def append_request_logs(df: DataFrame, path: str, time: str = "timestamp") -> str:
    """Append-only, by day; a missing recommendation list is written as an empty one."""
    rows = df.withColumn(
        "recommendations", F.coalesce("recommendations", F.array().cast(df.schema["recommendations"].dataType))
    ).withColumn("day", F.to_date(time))
    rows.write.mode("append").partitionBy("day").json(path, timestampFormat=LOG_TIME)
    return path
