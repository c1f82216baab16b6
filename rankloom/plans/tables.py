"""Queries: sources, sinks, schema, quality, cleaning, splits, popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankloom.functions import columns as cols
from rankloom.operators import clean, popularity, quality, split as splitting
from rankloom.plans import views
from rankloom.plans.registry import query
from rankloom.plans.sql import with_views
from rankloom.plans.staging import rounded, staged_split
from rankloom.session import fresh_path, staged
from rankloom.sources import model_store, readers, writers

# 2026-01-01, the "now" of the future-timestamp check.
NOW = 1767225600
TIE = ("src1", "src2")


def ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def raw_layer(spark, sf) -> DataFrame:
    """The faulty text rows as stored by an ingest step."""
    return staged(views.interactions_raw(spark, sf), "raw")


def raw_ratings(spark, sf) -> DataFrame:
    return raw_layer(spark, sf).drop("src1", "src2")


def list_text(col: str):
    return F.concat_ws(",", F.transform(col, lambda x: x.cast("string")))


# ---- sources and sinks

@query("a1_delimited_scan", with_views('SELECT user_id, movie_id, rating, "timestamp" FROM raw'))
def _(spark, sf):
    path = fresh_path(spark, "ratings.dat")
    raw_ratings(spark, sf).write.csv(path, sep="::", encoding="ISO-8859-1", quote="")
    return cols.canonicalize_names(readers.read_delimited(spark, path, readers.RAW_COLUMNS["ratings"]))


def _raw_folder(spark, sf) -> str:
    folder = fresh_path(spark, "raw")
    tables = {"ratings": raw_ratings(spark, sf), "movies": views.movies(spark, sf), "users": views.users(spark, sf)}
    for name, df in tables.items():
        df.write.csv(f"{folder}/{readers.RAW_FILES[name]}", sep="::", encoding="ISO-8859-1", quote="")
    return folder


@query("a2_input_files", with_views("""
SELECT 'ratings' AS "table", (SELECT count(*) FROM raw) AS rows, CAST(4 AS BIGINT) AS columns
UNION ALL SELECT 'movies', (SELECT count(*) FROM movies), 3 UNION ALL SELECT 'users', (SELECT count(*) FROM users), 5"""))
def _(spark, sf):
    """All three raw files must exist before any is read."""
    return quality.table_shapes(readers.read_raw_tables(spark, _raw_folder(spark, sf)))


@query("a3_cleaned_csv_scan", with_views("SELECT CAST(movie_id AS VARCHAR) AS movie_id, title, genres FROM movies"))
def _(spark, sf):
    path = writers.write_cleaned_csv(views.movies(spark, sf), fresh_path(spark, "cleaned"), "movies")
    return readers.read_cleaned_csv(spark, path, ["movie_id", "title", "genres"])


@query("a4_parquet_scan", with_views("SELECT user_id, movie_id, rating, ts FROM interactions"))
def _(spark, sf):
    path = writers.write_parquet(views.interactions(spark, sf), fresh_path(spark, "ratings"))
    return readers.read_parquet(spark, path).select("user_id", "movie_id", "rating", "ts")


def log_events(spark, sf) -> DataFrame:
    return views.request_logs(spark, sf).select(
        F.col("ts").cast("timestamp").alias("timestamp"), "user_id", "strategy", "latency_ms", "top_k",
        "response_status", "recommendations",
    )


LOG_ROWS_SQL = """
SELECT ts AS "timestamp", user_id, strategy, latency_ms, CAST(top_k AS BIGINT) AS top_k,
       CAST(response_status AS BIGINT) AS response_status, array_to_string(recommendations, ',') AS recommendations FROM logs"""


def flat_logs(df: DataFrame) -> DataFrame:
    return ntz(df.select(*readers.LOG_COLUMNS), "timestamp").withColumn("recommendations", list_text("recommendations"))


def json_lines(spark, sf) -> str:
    """Log events as JSON lines, with a blank and a broken line behind every file."""
    path = fresh_path(spark, "logs")
    events = log_events(spark, sf).withColumn("timestamp", F.date_format("timestamp", writers.LOG_TIME))
    lines = events.select(F.to_json(F.struct(*events.columns)).alias("value"))
    noise = spark.createDataFrame([("",), ('{"timestamp": "2024-01-01T00:00:00+00:00", "user_id": ',)], "value string")
    lines.write.option("maxRecordsPerFile", 200_000).text(path)
    noise.coalesce(1).write.mode("append").text(path)
    return path


@query("a5_jsonl_log_scan", with_views(LOG_ROWS_SQL))
def _(spark, sf):
    return flat_logs(readers.read_request_logs(spark, json_lines(spark, sf)))


@query("a6_feedback_scan", with_views("""
SELECT 'csv' AS format, user_id, movie_id, rating, ts FROM feedback
UNION ALL SELECT 'parquet', user_id, movie_id, rating, ts FROM feedback"""))
def _(spark, sf):
    rows = views.feedback(spark, sf).select("user_id", "movie_id", "rating", "ts")
    root = fresh_path(spark, "feedback")
    rows.write.option("header", True).csv(f"{root}.csv")
    rows.write.parquet(f"{root}.parquet")

    def load(suffix: str) -> DataFrame:
        df = readers.read_by_suffix(spark, f"{root}.{suffix}")
        typed = df.select(*[cols.numeric(F.col(c)).cast(t).alias(c) for c, t in
                            (("user_id", "long"), ("movie_id", "long"), ("rating", "double"), ("ts", "long"))])
        return typed.select(F.lit(suffix).alias("format"), "*")

    return load("csv").unionByName(load("parquet"))


@query("a7_user_list_scan", "SELECT user_id FROM events")
def _(spark, sf):
    path = fresh_path(spark, "users") + ".csv"
    views.table(spark, sf, "events").select("user_id").write.option("header", True).csv(path)
    return readers.read_user_list(spark, path)


@query("a8_source_chain", with_views("""
SELECT 'cleaned' AS source_label, CAST(movie_id AS VARCHAR) AS movie_id, title, genres FROM movies
UNION ALL SELECT 'raw', CAST(movie_id AS VARCHAR), title, genres FROM movies"""))
def _(spark, sf):
    """Cleaned layer if complete; raw where the cleaned layer is missing or raw is forced."""
    raw = _raw_folder(spark, sf)
    cleaned = writers.write_cleaned_csv(views.movies(spark, sf), fresh_path(spark, "cleaned"), "movies")
    groups = [
        ("cleaned", [cleaned], lambda: readers.read_cleaned_csv(spark, cleaned, ["movie_id", "title", "genres"])),
        ("raw", [f"{raw}/{f}" for f in readers.RAW_FILES.values()], lambda: readers.read_raw_tables(spark, raw)["movies"]),
    ]
    broken = [("cleaned", [cleaned, cleaned + ".gone"], groups[0][2]), groups[1]]
    parts = [readers.read_first_existing(spark, groups), readers.read_first_existing(spark, broken)]
    first, second = (df.select(F.lit(label).alias("source_label"), "*") for label, df in parts)
    return first.unionByName(second)


@query("a9_csv_sink", with_views("SELECT CAST(user_id AS VARCHAR) AS user_id, gender, CAST(age AS VARCHAR) AS age, CAST(occupation AS VARCHAR) AS occupation, zip_code FROM users"))
def _(spark, sf):
    users = views.users(spark, sf)
    path = writers.write_cleaned_csv(users, fresh_path(spark, "cleaned"), "users")
    return readers.read_cleaned_csv(spark, path, users.columns)


@query("a10_parquet_sink", with_views("SELECT user_id, movie_id, rating, ts, split FROM split"))
def _(spark, sf):
    """The split as one table partitioned by label."""
    path = writers.write_parquet(views.labelled_split(spark, sf), fresh_path(spark, "split"), ["split"])
    return readers.read_parquet(spark, path)


@query("a12_log_append_sink", with_views(LOG_ROWS_SQL + " UNION ALL " + LOG_ROWS_SQL.replace("recommendations, ','", "CAST([] AS BIGINT[]), ','")))
def _(spark, sf):
    """Two appends; the second has no lists, which are stored as empty ones."""
    path = fresh_path(spark, "log")
    events = log_events(spark, sf)
    writers.append_request_logs(events, path)
    writers.append_request_logs(events.withColumn("recommendations", F.lit(None).cast("array<long>")), path)
    return flat_logs(readers.read_request_logs(spark, path))


@query("a15_id_map_sink", with_views("""
SELECT 'user' AS entity, user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM ratings) u
UNION ALL SELECT 'movie', movie_id, row_number() OVER (ORDER BY movie_id) - 1 FROM (SELECT DISTINCT movie_id FROM ratings) m"""))
def _(spark, sf):
    ratings = views.interactions(spark, sf)
    root = fresh_path(spark, "maps")
    out = []
    for entity, key in (("user", "user_id"), ("movie", "movie_id")):
        path = writers.write_parquet(clean.id_map(ratings, key, "idx"), f"{root}/{entity}")
        out.append(readers.read_parquet(spark, path).select(F.lit(entity).alias("entity"), F.col(key).alias("id"), "idx"))
    return out[0].unionByName(out[1])


# ---- schema

@query("b1_standard_names", 'SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment FROM customer')
def _(spark, sf):
    dirty = views.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment").toDF("User-ID", " Name!!! ", "SEGMENT")
    return cols.standardize_names(dirty)


@query("b2_canonical_names", "SELECT c_custkey AS user_id, c_nationkey AS zip_code, c_name AS name FROM customer")
def _(spark, sf):
    """Aliases, and the first of several spellings of one name."""
    dirty = views.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_name")
    return cols.canonicalize_names(dirty.toDF("UserID", "  ZIPCode ", "user_id", "Name"))


@query("b3_required_columns", with_views("SELECT count(*) AS ratings FROM interactions"))
def _(spark, sf):
    ratings, movies = views.interactions(spark, sf), views.movies(spark, sf)
    cols.require_columns({"ratings": (ratings, ["user_id", "movie_id", "rating"]), "movies": (movies, ["movie_id", "title", "genres"])})
    return ratings.agg(F.count(F.lit(1)).alias("ratings"))


@query("b4_stable_casts", with_views('SELECT src1, src2, user_id, movie_id, rating, "timestamp", timestamp_dt FROM typed'))
def _(spark, sf):
    return ntz(clean.cast_ratings(raw_layer(spark, sf)), "timestamp_dt")


@query("b5_time_column", with_views("SELECT 'timestamp_dt' AS time_column, max(timestamp_dt) AS last_seen FROM cleaned"))
def _(spark, sf):
    rows = clean.clean_ratings(raw_layer(spark, sf), views.movies(spark, sf), views.users(spark, sf), TIE)
    name = cols.time_column(rows)
    return ntz(rows.agg(F.lit(name).alias("time_column"), F.max(name).alias("last_seen")), "last_seen")


@query("b6_non_empty_split", with_views("SELECT split, count(*) AS rows FROM split GROUP BY split"))
def _(spark, sf):
    parts = staged_split(views.labelled_split(spark, sf))
    cols.require_rows(parts)
    out = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("split"), "rows") for n, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("b7_interaction_projection", with_views("SELECT user_id, movie_id, rating FROM interactions"))
def _(spark, sf):
    return cols.interaction_projection(views.interactions(spark, sf))


# ---- quality

def _missing_sql(table: str, names: list[str]) -> str:
    rows = [f"""SELECT '{table}' AS "table", '{n}' AS "column", count(*) FILTER (WHERE "{n}" IS NULL) AS missing FROM {{0}}""" for n in names]
    total = " + ".join(f'count(*) FILTER (WHERE "{n}" IS NULL)' for n in names)
    rows.append(f"""SELECT '{table}', '(all)', {total} FROM {{0}}""")
    return " UNION ALL ".join(rows)


RATING_COLUMNS = ["user_id", "movie_id", "rating", "timestamp"]


@query("c1_missing_cells", with_views(
    _missing_sql("ratings", RATING_COLUMNS).replace("{0}", "raw") + " UNION ALL "
    + _missing_sql("movies", ["movie_id", "title", "genres"]).replace("{0}", "movies") + " UNION ALL "
    + _missing_sql("users", ["user_id", "gender", "age", "occupation", "zip_code"]).replace("{0}", "users")))
def _(spark, sf):
    return (
        quality.missing_cells(raw_ratings(spark, sf), "ratings")
        .unionByName(quality.missing_cells(views.movies(spark, sf), "movies"))
        .unionByName(quality.missing_cells(views.users(spark, sf), "users"))
    )


DUP_SQL = "(SELECT coalesce(CAST(sum(n - 1) AS BIGINT), 0) FROM (SELECT count(*) AS n FROM {0} GROUP BY {1}) d)"


@query("c2_exact_duplicates", with_views(f"""
SELECT 'ratings' AS "table", {DUP_SQL.format('raw', 'user_id, movie_id, rating, "timestamp"')} AS duplicates
UNION ALL SELECT 'movies', {DUP_SQL.format('movies', 'movie_id, title, genres')}
UNION ALL SELECT 'parts_text', {DUP_SQL.format('movies', 'title, genres')}"""))
def _(spark, sf):
    movies = views.movies(spark, sf)
    tables = {"ratings": raw_ratings(spark, sf), "movies": movies, "parts_text": movies.drop("movie_id")}
    rows = [quality.duplicate_rows(df).select(F.lit(n).alias("table"), "duplicates") for n, df in tables.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("c3_id_masks", with_views("""
SELECT src1, src2, user_id IS NULL AS is_null, user_id IS NOT NULL AND v IS NULL AS non_numeric,
       coalesce(v % 1 <> 0, false) AS non_integer, coalesce(v <= 0, false) AS non_positive, coalesce(v % 1 = 0 AND v > 0, false) AS valid
FROM (SELECT *, TRY_CAST(user_id AS DOUBLE) AS v FROM raw) r"""))
def _(spark, sf):
    masks = quality.id_masks(raw_layer(spark, sf), "user_id")
    return masks.select("src1", "src2", "is_null", "non_numeric", "non_integer", "non_positive", "valid")


@query("c4_valid_ids", with_views("""
SELECT DISTINCT CAST(v AS BIGINT) AS user_id FROM (SELECT TRY_CAST(user_id AS DOUBLE) AS v FROM raw) r WHERE v % 1 = 0 AND v > 0"""))
def _(spark, sf):
    return quality.valid_ids(raw_layer(spark, sf), "user_id")


UNKNOWN_SQL = """(SELECT CASE WHEN EXISTS (SELECT 1 FROM {1} WHERE {0} > 0) THEN count(*) ELSE 0 END FROM (SELECT TRY_CAST({0} AS DOUBLE) AS v FROM raw) r
WHERE v % 1 = 0 AND v > 0 AND CAST(v AS BIGINT) NOT IN (SELECT {0} FROM {1} WHERE {0} > 0))"""


@query("c5_unknown_references", with_views(f"""
SELECT 'user_id' AS reference, {UNKNOWN_SQL.format('user_id', 'users')} AS unknown
UNION ALL SELECT 'movie_id', {UNKNOWN_SQL.format('movie_id', 'movies')} UNION ALL SELECT 'empty', CAST(0 AS BIGINT)"""))
def _(spark, sf):
    raw, users = raw_layer(spark, sf), views.users(spark, sf)
    parts = {
        "user_id": quality.unknown_references(raw, "user_id", users),
        "movie_id": quality.unknown_references(raw, "movie_id", views.movies(spark, sf)),
        "empty": quality.unknown_references(raw, "user_id", users.filter(F.col("gender").isNull())),
    }
    rows = [df.select(F.lit(n).alias("reference"), "unknown") for n, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


RATING_CHECK_SQL = """
count(*) FILTER (WHERE TRY_CAST(rating AS DOUBLE) < 1 OR TRY_CAST(rating AS DOUBLE) > 5) AS rating_out_of_range_rows,
count(*) FILTER (WHERE rating IS NOT NULL AND TRY_CAST(rating AS DOUBLE) IS NULL) AS rating_non_numeric_rows,
count(*) FILTER (WHERE rating IS NULL) AS rating_null_rows"""
_T = 'TRY_CAST("timestamp" AS DOUBLE)'
TIME_CHECK_SQL = f"""
count(*) FILTER (WHERE "timestamp" IS NULL) AS timestamp_null_rows,
count(*) FILTER (WHERE "timestamp" IS NOT NULL AND {_T} IS NULL) AS timestamp_non_numeric_rows,
count(*) FILTER (WHERE {_T} <= 0) AS timestamp_non_positive_rows,
count(*) FILTER (WHERE {_T} > 9223372036) AS timestamp_unparsable_rows,
count(*) FILTER (WHERE {_T} <= 9223372036 AND {_T} > {NOW}) AS timestamp_future_rows"""


@query("c6_rating_checks", with_views(f"SELECT {RATING_CHECK_SQL} FROM raw"))
def _(spark, sf):
    rows = cols.with_numbers(raw_ratings(spark, sf), ["rating"])
    return rows.agg(*[c.alias(n) for n, c in quality.rating_checks().items()])


@query("c7_timestamp_checks", with_views(f"SELECT {TIME_CHECK_SQL} FROM raw"))
def _(spark, sf):
    rows = cols.with_numbers(raw_ratings(spark, sf), ["timestamp"])
    return rows.agg(*[c.alias(n) for n, c in quality.timestamp_checks(NOW).items()])


@query("c8_duplicate_pairs", with_views(f"SELECT {DUP_SQL.format('raw', 'user_id, movie_id')} AS duplicates"))
def _(spark, sf):
    return quality.duplicate_rows(raw_ratings(spark, sf), ["user_id", "movie_id"])


def _null_cells(names: list[str]) -> str:
    return " + ".join(f'count(*) FILTER (WHERE "{n}" IS NULL)' for n in names)


_BAD = "count(*) FILTER (WHERE NOT coalesce(TRY_CAST({0} AS DOUBLE) % 1 = 0 AND TRY_CAST({0} AS DOUBLE) > 0, false))"


@query("c9_quality_summary", with_views(f"""
SELECT {_null_cells(RATING_COLUMNS)} AS ratings_missing_cells, {_BAD.format('user_id')} AS invalid_user_id_rows,
       {_BAD.format('movie_id')} AS invalid_movie_id_rows, {RATING_CHECK_SQL}, {TIME_CHECK_SQL},
       (SELECT {_null_cells(['movie_id', 'title', 'genres'])} FROM movies) AS movies_missing_cells,
       (SELECT {_null_cells(['user_id', 'gender', 'age', 'occupation', 'zip_code'])} FROM users) AS users_missing_cells,
       {DUP_SQL.format('raw', 'user_id, movie_id, rating, "timestamp"')} AS ratings_exact_duplicates,
       {DUP_SQL.format('movies', 'movie_id, title, genres')} AS movies_exact_duplicates,
       {DUP_SQL.format('users', 'user_id, gender, age, occupation, zip_code')} AS users_exact_duplicates,
       {UNKNOWN_SQL.format('user_id', 'users')} AS unknown_user_id_rows,
       {UNKNOWN_SQL.format('movie_id', 'movies')} AS unknown_movie_id_rows,
       {DUP_SQL.format('raw', 'user_id, movie_id')} AS duplicate_user_movie_rows
FROM raw"""))
def _(spark, sf):
    return quality.quality_summary(raw_ratings(spark, sf), views.movies(spark, sf), views.users(spark, sf), NOW)


@query("c10_table_shapes", with_views("""
SELECT 'ratings' AS "table", (SELECT count(*) FROM raw) AS rows, CAST(4 AS BIGINT) AS columns
UNION ALL SELECT 'movies', (SELECT count(*) FROM movies), 3 UNION ALL SELECT 'users', (SELECT count(*) FROM users), 5"""))
def _(spark, sf):
    return quality.table_shapes(
        {"ratings": raw_ratings(spark, sf), "movies": views.movies(spark, sf), "users": views.users(spark, sf)}
    )


# ---- cleaning

CLEAN_COLUMNS = 'src1, src2, user_id, movie_id, rating, "timestamp", timestamp_dt'


def _typed(spark, sf):
    return clean.cast_ratings(raw_layer(spark, sf))


def _known(spark, sf):
    valid = clean.narrow_types(clean.range_filter(clean.drop_null_rows(_typed(spark, sf))))
    return clean.referential_filter(valid, clean.cast_movies(views.movies(spark, sf)), clean.cast_users(views.users(spark, sf)))


def _cleaned(spark, sf):
    return clean.clean_ratings(raw_layer(spark, sf), views.movies(spark, sf), views.users(spark, sf), TIE)


@query("d1_null_row_drop", with_views(f"SELECT {CLEAN_COLUMNS} FROM nonnull"))
def _(spark, sf):
    return ntz(clean.drop_null_rows(_typed(spark, sf)), "timestamp_dt")


@query("d2_range_filter", with_views(f"SELECT {CLEAN_COLUMNS} FROM ranged"))
def _(spark, sf):
    return ntz(clean.range_filter(clean.drop_null_rows(_typed(spark, sf))), "timestamp_dt")


@query("d3_type_narrowing", with_views(f"SELECT {CLEAN_COLUMNS} FROM narrowed"))
def _(spark, sf):
    return ntz(clean.narrow_types(clean.range_filter(clean.drop_null_rows(_typed(spark, sf)))), "timestamp_dt")


@query("d4_referential_filter", with_views(f"SELECT {CLEAN_COLUMNS} FROM known"))
def _(spark, sf):
    return ntz(_known(spark, sf), "timestamp_dt")


@query("d5_dedup_latest", with_views(f"SELECT {CLEAN_COLUMNS} FROM cleaned"))
def _(spark, sf):
    return ntz(_cleaned(spark, sf), "timestamp_dt")


@query("d5_dedup_first", with_views("""
SELECT src1, src2, user_id, movie_id, rating, ts FROM interactions
QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY ts, src1, src2) = 1"""))
def _(spark, sf):
    return clean.dedup_interactions(views.interactions(spark, sf), ("ts", *TIE), "first")


AUDIT_SQL = """
SELECT (SELECT count(*) FROM raw) AS ratings_rows_before_filter, (SELECT count(*) FROM cleaned) AS ratings_rows_after_filter,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM nonnull) AS ratings_rows_removed_null,
       (SELECT count(*) FROM nonnull) - (SELECT count(*) FROM ranged) AS ratings_rows_removed_invalid_values,
       (SELECT count(*) FROM ranged) - (SELECT count(*) FROM known) AS ratings_rows_removed_unknown_reference,
       (SELECT count(*) FROM known) - (SELECT count(*) FROM cleaned) AS ratings_duplicate_user_movie_rows_removed,
       'latest' AS duplicate_strategy"""


@query("d6_cleaning_audit", with_views(AUDIT_SQL))
def _(spark, sf):
    return clean.cleaning_audit(raw_ratings(spark, sf), views.movies(spark, sf), views.users(spark, sf))


def _core_ctes(user_least: int, movie_least: int, passes: int = 12, base: str = "ratings") -> dict[str, str]:
    out = {"pass0": f"SELECT user_id, movie_id FROM {base}"}
    for i in range(1, passes + 1):
        out[f"half{i}"] = f"SELECT * FROM pass{i - 1} QUALIFY count(*) OVER (PARTITION BY user_id) >= {user_least}"
        out[f"pass{i}"] = f"SELECT * FROM half{i} QUALIFY count(*) OVER (PARTITION BY movie_id) >= {movie_least}"
    return out


def _core_audit_sql(passes: int = 12) -> str:
    users = " + ".join(
        f"((SELECT count(DISTINCT user_id) FROM pass{i - 1}) - (SELECT count(DISTINCT user_id) FROM half{i}))" for i in range(1, passes + 1)
    )
    movies = " + ".join(
        f"((SELECT count(DISTINCT movie_id) FROM half{i}) - (SELECT count(DISTINCT movie_id) FROM pass{i}))" for i in range(1, passes + 1)
    )
    rounds = " + ".join(f"CASE WHEN (SELECT count(*) FROM pass{i}) < (SELECT count(*) FROM pass{i - 1}) THEN 1 ELSE 0 END" for i in range(1, passes + 1))
    return f"""(SELECT count(*) FROM pass0) - (SELECT count(*) FROM pass{passes}) AS ratings_rows_removed_by_frequency_filter,
    {users} AS users_removed_by_frequency_filter, {movies} AS movies_removed_by_frequency_filter,
    CAST({rounds} + 1 AS BIGINT) AS frequency_filter_iterations"""


@query("d7_frequency_filter", with_views(
    "SELECT r.user_id, r.movie_id, r.rating, r.ts FROM ratings r JOIN pass12 p ON p.user_id = r.user_id AND p.movie_id = r.movie_id",
    **_core_ctes(25, 20)))
def _(spark, sf):
    rows = staged(views.ratings(spark, sf).select("user_id", "movie_id", "rating", "ts"), "ratings")
    return clean.frequency_filter(rows, 25, 20)[0]


@query("d7_frequency_audit", with_views(f"SELECT CAST(20 AS BIGINT) AS min_user_interactions, CAST(20 AS BIGINT) AS min_movie_interactions, {_core_audit_sql()}", **_core_ctes(20, 20)))
def _(spark, sf):
    rows = views.ratings(spark, sf).select("user_id", "movie_id")
    audit = clean.frequency_filter(rows, 20, 20)[1]
    return spark.createDataFrame([tuple(audit.values())], ", ".join(f"{n} long" for n in audit))


@query("d8_dimension_pruning", with_views("""
SELECT 'movie' AS dimension, movie_id AS id FROM movies WHERE movie_id IN (SELECT movie_id FROM cleaned)
UNION ALL SELECT 'user', user_id FROM users WHERE user_id IN (SELECT user_id FROM cleaned)"""))
def _(spark, sf):
    facts = _cleaned(spark, sf)
    movies = clean.prune_dimension(views.movies(spark, sf), facts, "movie_id")
    users = clean.prune_dimension(views.users(spark, sf), facts, "user_id")
    return movies.select(F.lit("movie").alias("dimension"), F.col("movie_id").alias("id")).unionByName(
        users.select(F.lit("user").alias("dimension"), F.col("user_id").alias("id"))
    )


@query("d9_metadata_merge", with_views("""
SELECT r.user_id, r.movie_id, r.rating, r.ts, m.title, m.genres, u.gender, u.age, u.occupation, u.zip_code, u.user_id % 10 AS title_user
FROM ratings r LEFT JOIN movies m ON m.movie_id = r.movie_id LEFT JOIN users u ON u.user_id = r.user_id"""))
def _(spark, sf):
    users = views.users(spark, sf).withColumn("title", F.col("user_id") % 10)
    return clean.merge_metadata(views.ratings(spark, sf).drop(*TIE), views.movies(spark, sf), users)


@query("d10_id_map", with_views("SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM interactions) u"))
def _(spark, sf):
    return clean.id_map(views.interactions(spark, sf), "user_id", "user_idx")


@query("d11_encode_ids", with_views("""
SELECT user_id, movie_id, rating, ts, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx, dense_rank() OVER (ORDER BY movie_id) - 1 AS movie_idx FROM ratings"""))
def _(spark, sf):
    rows = staged(views.ratings(spark, sf).drop(*TIE), "ratings")
    return clean.encode_ids(
        rows, user_id=clean.id_map(rows, "user_id", "user_idx"), movie_id=clean.id_map(rows, "movie_id", "movie_idx")
    )


@query("d12_preprocess_summary", with_views(f"""
SELECT a.*, s.*, (SELECT count(*) FROM pass12) AS ratings_rows, (SELECT count(DISTINCT user_id) FROM pass12) AS users_rows,
       (SELECT count(DISTINCT movie_id) FROM pass12) AS movies_rows
FROM ({AUDIT_SQL}) a CROSS JOIN (SELECT CAST(5 AS BIGINT) AS min_user_interactions, CAST(5 AS BIGINT) AS min_movie_interactions, {_core_audit_sql()}) s""",
    **_core_ctes(5, 5, base="cleaned")))
def _(spark, sf):
    audit = clean.cleaning_audit(raw_ratings(spark, sf), views.movies(spark, sf), views.users(spark, sf))
    kept, frequency = clean.frequency_filter(staged(_cleaned(spark, sf), "cleaned"), 5, 5)
    sizes = kept.agg(
        F.count(F.lit(1)).alias("ratings_rows"), F.countDistinct("user_id").alias("users_rows"), F.countDistinct("movie_id").alias("movies_rows")
    )
    return sizes.select(
        audit.select(F.struct("*")).scalar().alias("a"), *[F.lit(v).cast("long").alias(n) for n, v in frequency.items()], "*"
    ).select("a.*", *frequency, *sizes.columns)


# ---- temporal split

@query("e1_temporal_split", with_views("SELECT user_id, movie_id, rating, ts, split FROM split"))
def _(spark, sf):
    return views.labelled_split(spark, sf)


@query("e2_holdout_sizes", with_views("""
SELECT user_id, n, CAST(count(*) FILTER (WHERE split = 'val') AS BIGINT) AS val_size, CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_size
FROM split GROUP BY user_id, n"""))
def _(spark, sf):
    n = views.ratings(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    val, test = splitting.holdout_sizes(F.col("n"), 0.1, 0.2)
    low = F.col("n") < 3
    return n.select("user_id", "n", F.when(low, 0).otherwise(val).cast("long").alias("val_size"),
                    F.when(low, 0).otherwise(test).cast("long").alias("test_size"))


@query("e3_low_history", with_views("""
SELECT user_id, movie_id, CASE WHEN n < 40 THEN 'train' ELSE split END AS split FROM split"""))
def _(spark, sf):
    """Users with fewer than 40 interactions stay in train."""
    rows = staged(views.ratings(spark, sf).select("user_id", "movie_id", "ts"), "ratings")
    return splitting.temporal_split(rows, "ts", 0.1, 0.2, min_interactions=40).drop("ts")


@query("e4_split_summary", with_views("""
SELECT count(*) AS rows, count(DISTINCT user_id) FILTER (WHERE n >= 3) AS eligible_users, count(DISTINCT user_id) FILTER (WHERE n < 3) AS low_history_users,
       count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows, count(*) FILTER (WHERE split = 'test') AS test_rows
FROM split"""))
def _(spark, sf):
    return splitting.split_summary(views.labelled_split(spark, sf))


@query("e5_refit_rows", with_views("SELECT user_id, movie_id, rating, ts FROM split WHERE split <> 'test'"))
def _(spark, sf):
    parts = staged_split(views.labelled_split(spark, sf))
    return splitting.refit_rows(parts["train"], parts["val"])


# ---- popularity

POP_SQL = "movie_id, interaction_count, round(mean_rating, 6) AS mean_rating, rating_sum, last_seen"


@query("f1_most_popular", with_views(f"SELECT {POP_SQL}, score FROM popularity"))
def _(spark, sf):
    return popularity.by_score(rounded(popularity.item_popularity(views.train(spark, sf), time="ts"), "mean_rating"))


@query("f2_weighted_popularity", with_views(f"SELECT {POP_SQL}, round(mean_rating * ln(1 + interaction_count), 6) AS score FROM popularity"))
def _(spark, sf):
    table = popularity.item_popularity(views.train(spark, sf), "weighted", "ts")
    return popularity.by_score(rounded(table, "mean_rating", "score"))


BAYES = "interaction_count / (interaction_count + 50.0) * mean_rating + 50 / (interaction_count + 50.0) * (SELECT avg(rating) FROM train)"


@query("f3_bayesian_average", with_views(f"""
SELECT movie_id, round(mean_rating, 6) AS mean_rating, interaction_count, round(CAST({BAYES} AS DOUBLE), 6) AS score FROM popularity"""))
def _(spark, sf):
    train = staged(views.train(spark, sf), "train")
    return popularity.by_score(rounded(popularity.bayesian_popularity(train), "mean_rating", "score"))


@query("f4_item_stats", with_views("SELECT movie_id, interaction_count, round(mean_rating, 6) AS mean_rating, last_seen, score AS popularity_score FROM popularity"))
def _(spark, sf):
    stats = popularity.item_stats(views.train(spark, sf), "ts")
    return rounded(stats, "mean_rating").orderBy(F.desc("popularity_score"), F.desc("mean_rating"), "movie_id")


@query("f5_exposure_counts", with_views("SELECT movie_id, count(DISTINCT user_id) AS exposure FROM interactions GROUP BY movie_id"))
def _(spark, sf):
    return popularity.exposure_counts(views.interactions(spark, sf)).orderBy(F.desc("exposure"), "movie_id")


@query("f6_normalized_popularity", with_views("SELECT movie_id, round(CAST(score_norm AS DOUBLE), 6) AS score_norm FROM popnorm"))
def _(spark, sf):
    train = staged(views.train(spark, sf), "train")
    return rounded(popularity.normalized_popularity(popularity.item_popularity(train)), "score_norm")


@query("f7_seen_pairs", with_views("SELECT DISTINCT user_id, movie_id FROM interactions"))
def _(spark, sf):
    return popularity.seen_pairs(views.interactions(spark, sf))


@query("a14_model_store", with_views("""
SELECT 'popularity' AS "table", count(*) AS rows FROM popularity UNION ALL SELECT 'seen', count(*) FROM seen"""))
def _(spark, sf):
    """A model saved as tables and loaded again."""
    train = staged(views.train(spark, sf), "train")
    path = fresh_path(spark, "model")
    tables = {"popularity": popularity.item_popularity(train), "seen": popularity.seen_pairs(train)}
    model_store.save_model(path, tables, {"algorithm": "popularity", "top_k": "10"})
    loaded, _meta = model_store.load_model(spark, path)
    rows = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in loaded.items()]
    return rows[0].unionByName(rows[1])
