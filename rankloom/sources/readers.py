"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rankloom.functions.columns import canonicalize_names, numeric, require_columns

# File and column names of the raw layer.
RAW_FILES = {"ratings": "ratings.dat", "movies": "movies.dat", "users": "users.dat"}
RAW_COLUMNS = {
    "ratings": ["UserID", "MovieID", "Rating", "Timestamp"],
    "movies": ["MovieID", "Title", "Genres"],
    "users": ["UserID", "Gender", "Age", "Occupation", "Zip-code"],
}
# Fields of a request log event.
LOG_COLUMNS = [
    "timestamp", "user_id", "strategy", "latency_ms", "top_k", "response_status", "recommendations",
]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def require_files(spark: SparkSession, paths: Sequence[str]) -> None:
    """One error that lists every missing path."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError("missing input files: " + ", ".join(missing))


def _strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``::``-separated, Latin-1, no header. Everything is text, so bad tokens reach the quality checks."""
    return spark.read.csv(path, schema=_strings(columns), sep="::", encoding="ISO-8859-1", quote="", header=False)


def read_raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    paths = {name: f"{folder}/{file}" for name, file in RAW_FILES.items()}
    require_files(spark, list(paths.values()))
    return {n: canonicalize_names(read_delimited(spark, p, RAW_COLUMNS[n])) for n, p in paths.items()}


def read_cleaned_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV of the cleaned layer, as text; casts come later."""
    require_files(spark, [path])
    return spark.read.csv(path, schema=_strings(columns), header=True, enforceSchema=False, escape='"')


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    require_files(spark, [path])
    return spark.read.parquet(path)


def read_request_logs(spark: SparkSession, path: str) -> DataFrame:
    """Typed log events; blank and broken lines are skipped, a missing path is an empty table."""
    text = T.StringType()
    schema = T.StructType(
        [T.StructField(c, T.ArrayType(text) if c == "recommendations" else text) for c in LOG_COLUMNS]
    )
    if path_exists(spark, path):
        raw = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    else:
        raw = spark.createDataFrame([], schema)
    return typed_logs(raw)


def typed_logs(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("timestamp").try_cast("timestamp").alias("timestamp"),
        numeric(F.col("user_id")).cast("long").alias("user_id"),
        "strategy",
        numeric(F.col("latency_ms")).alias("latency_ms"),
        numeric(F.col("top_k")).cast("long").alias("top_k"),
        numeric(F.col("response_status")).cast("long").alias("response_status"),
        F.filter(F.transform("recommendations", lambda r: r.try_cast("long")), lambda r: r.isNotNull()).alias("recommendations"),
    )


def read_by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """Feedback files: ``.parquet`` or ``.csv``, nothing else."""
    require_files(spark, [path])
    lower = path.lower()
    if lower.endswith(".parquet"):
        return spark.read.parquet(path)
    if lower.endswith(".csv"):
        return spark.read.csv(path, header=True)
    raise ValueError("feedback must be a .csv or .parquet path")


def read_user_list(spark: SparkSession, path: str) -> DataFrame:
    """Requests for batch serving; repeated users stay."""
    require_files(spark, [path])
    df = spark.read.parquet(path) if path.lower().endswith(".parquet") else spark.read.csv(path, header=True)
    require_columns({"users": (df, ["user_id"])})
    return df.withColumn("user_id", numeric(F.col("user_id")).cast("long"))


def read_first_existing(spark: SparkSession, groups: Sequence[tuple[str, Sequence[str], object]], force: str | None = None) -> tuple[str, object]:
    """``groups``: (label, paths, reader). The first group whose paths all exist is read.

    ``force`` names the only group to try.
    """
    tried = []
    for label, paths, reader in groups:
        if force is not None and label != force:
            continue
        if all(path_exists(spark, p) for p in paths):
            return label, reader()
        tried += list(paths)
    raise FileNotFoundError("no complete source among: " + ", ".join(tried))
