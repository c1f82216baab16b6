"""The split as a stored table, and the rounding used for comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankloom.session import fresh_path


def staged_split(labelled: DataFrame) -> dict[str, DataFrame]:
    """The labelled rows written once, partitioned by label; each part reads its own files."""
    path = fresh_path(labelled.sparkSession, "split")
    labelled.write.partitionBy("split").parquet(path)
    rows = labelled.sparkSession.read.parquet(path)
    return {name: rows.filter(F.col("split") == name).drop("split") for name in ("train", "val", "test")}


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
