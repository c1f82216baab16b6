"""Cleaning, referential and frequency filters, id encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rankloom.functions.columns import epoch_timestamp, numeric_column, with_numbers
from rankloom.operators.skew import global_position, latest_per_key
from rankloom.session import fresh_path, staged

REQUIRED = ("user_id", "movie_id", "rating", "timestamp", "timestamp_dt")
LOST_NULL, LOST_VALUE, LOST_REFERENCE, PASSED = "null", "invalid_value", "unknown_reference", "passed"


def cast_ratings(df: DataFrame) -> DataFrame:
    """Stable types; text that is no number becomes NULL."""
    names = ("user_id", "movie_id", "rating", "timestamp")
    parsed = with_numbers(df, names, whole=True)
    out = parsed.select(*[F.col(f"{c}_number").alias(c) if c in names else F.col(c) for c in df.columns])
    return out.withColumn("timestamp_dt", epoch_timestamp(F.col("timestamp")))


def cast_movies(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"movie_id": numeric_column(df, "movie_id"), **{c: F.col(c).cast("string") for c in ("title", "genres")}}
    )


def cast_users(df: DataFrame) -> DataFrame:
    """Optional columns are cast only where they exist."""
    casts = {"user_id": numeric_column(df, "user_id")}
    for name in ("age", "occupation"):
        if name in df.columns:
            casts[name] = numeric_column(df, name)
    for name in ("gender", "zip_code"):
        if name in df.columns:
            casts[name] = F.col(name).cast("string")
    return df.withColumns(casts)


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(REQUIRED))


def _in_range() -> Column:
    return (
        (F.col("user_id") > 0)
        & (F.col("movie_id") > 0)
        & F.col("rating").between(1, 5)
        & (F.col("timestamp") > 0)
    )


def range_filter(df: DataFrame) -> DataFrame:
    return df.filter(_in_range())


def narrow_types(df: DataFrame) -> DataFrame:
    """Whole ids and times (fractions are cut off), single-precision ratings."""
    return df.withColumns(
        {
            "user_id": F.col("user_id").cast("long"),
            "movie_id": F.col("movie_id").cast("long"),
            "timestamp": F.col("timestamp").cast("long"),
            "rating": F.col("rating").cast("float"),
        }
    )


def _ids(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).cast("long").alias(name)).dropna().distinct()


def referential_filter(df: DataFrame, movies: DataFrame, users: DataFrame) -> DataFrame:
    return df.join(_ids(movies, "movie_id"), "movie_id", "left_semi").join(
        _ids(users, "user_id"), "user_id", "left_semi"
    )


def dedup_interactions(df: DataFrame, order: Sequence[str], keep: str = "latest") -> DataFrame:
    """One row per (user, movie)."""
    return latest_per_key(df, ("user_id", "movie_id"), order, keep)


def clean_ratings(
    ratings: DataFrame, movies: DataFrame, users: DataFrame, tie_break: Sequence[str] = (), keep: str = "latest"
) -> DataFrame:
    """Cast, drop NULLs, range check, narrow, referential check, one row per (user, movie)."""
    valid = narrow_types(range_filter(drop_null_rows(cast_ratings(ratings))))
    known = referential_filter(valid, cast_movies(movies), cast_users(users))
    return dedup_interactions(known, ("timestamp", *tie_break), keep)


def cleaning_audit(
    ratings: DataFrame, movies: DataFrame, users: DataFrame, keep: str = "latest"
) -> DataFrame:
    """Rows lost at each cleaning stage, as one row.

    Every row is tagged with the first stage that rejects it, so the table is read once.
    Passed rows are counted per (user, movie) pair; copies beyond the first are duplicates.
    """
    if keep not in ("latest", "first"):
        raise ValueError(f"unknown keep strategy: {keep}")
    typed = cast_ratings(ratings)
    missing = F.lit(False)
    for name in REQUIRED:
        missing = missing | F.col(name).isNull()
    known_movies = _ids(cast_movies(movies), "movie_id").withColumn("_m", F.lit(True))
    known_users = _ids(cast_users(users), "user_id").withColumn("_u", F.lit(True))
    tagged = (
        typed.select(
            F.when(missing, LOST_NULL).when(~_in_range(), LOST_VALUE).alias("stage"),
            F.col("user_id").try_cast("long").alias("user_id"),
            F.col("movie_id").try_cast("long").alias("movie_id"),
        )
        # Rejected rows need no pair: one key per stage lets the map side combine them.
        .withColumns({c: F.when(F.col("stage").isNull(), F.col(c)) for c in ("user_id", "movie_id")})
        .groupBy("stage", "user_id", "movie_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(known_movies, "movie_id", "left")
        .join(known_users, "user_id", "left")
        .withColumn(
            "stage",
            F.coalesce("stage", F.when(F.col("_m") & F.col("_u"), PASSED).otherwise(LOST_REFERENCE)),
        )
    )

    def rows(stage: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage") == stage, F.col("n"))), F.lit(0)).cast("long")

    pairs = F.count_if(F.col("stage") == PASSED)
    return tagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("ratings_rows_before_filter"),
        pairs.alias("ratings_rows_after_filter"),
        rows(LOST_NULL).alias("ratings_rows_removed_null"),
        rows(LOST_VALUE).alias("ratings_rows_removed_invalid_values"),
        rows(LOST_REFERENCE).alias("ratings_rows_removed_unknown_reference"),
        (rows(PASSED) - pairs).alias("ratings_duplicate_user_movie_rows_removed"),
        F.lit(keep).alias("duplicate_strategy"),
    )


#: Edges of one part of a stored adjacency, and the number of parts at least and at most.
PART_EDGES, LEAST_PARTS, MOST_PARTS = 1_000_000, 16, 4096


class _Side:
    """One kind of id: its edges by part, its first counts, the counts that changed since, and the ids that went."""

    def __init__(self, edges: DataFrame, key: str, other: str, least: int, parts: int) -> None:
        self.spark, self.root, self.key, self.least, self.parts = edges.sparkSession, fresh_path(edges.sparkSession, "core"), key, least, parts
        self.first = self.store(edges.groupBy(key).agg(F.sum("weight").alias("_n")), "counts", f"{key} long, _n long")
        self.gone: list[DataFrame] = []
        self.changed: DataFrame | None = None
        if least > 0:
            # dealt by range, so that the edges of a hot id are spread over tasks and files
            dealt = edges.select(_part(key, parts), key, other, "weight").repartitionByRange("part", other)
            dealt.write.partitionBy("part").parquet(f"{self.root}/edges")
            self.edges = self.spark.read.schema(f"{key} long, {other} long, weight long, part int").parquet(f"{self.root}/edges")

    def store(self, rows: DataFrame, name: str, schema: str) -> DataFrame:
        rows.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def without_gone(self, rows: DataFrame) -> DataFrame:
        """The rows whose id has not gone."""
        for ids in self.gone:
            rows = rows.join(ids, self.key, "left_anti")
        return rows

    def counts(self, turn: int) -> DataFrame | None:
        """Counts that may have become rare since the last look: all in the first pass, then those that changed."""
        if self.changed is None:
            return self.first if turn == 1 else None
        if turn > 1:
            return self.changed.filter("_lost > 0")
        return self.first.join(self.changed, self.key, "left_anti").unionByName(self.changed.drop("_lost"))

    def leave(self, turn: int) -> tuple[DataFrame | None, int, list[int]]:
        """The ids that go now; how many there are, and the parts that hold their edges."""
        counts = self.counts(turn)
        if counts is None:
            return None, 0, []
        rare = self.without_gone(counts.filter((F.col("_n") < self.least) & (F.col("_n") > 0)))
        ids = self.store(rare.select(self.key), f"gone-{turn}", f"{self.key} long")
        sizes = ids.groupBy(_part(self.key, self.parts)).count().collect()  # a row per part
        if sizes:
            self.gone.append(ids)
        return ids, sum(r["count"] for r in sizes), [r["part"] for r in sizes]


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")


def _lower(a: _Side, b: _Side, ids: DataFrame, touched: list[int], turn: int) -> int:
    """Takes the edges of ids that went from ``a`` out of the counts of ``b``; returns the rows they stand for.

    Only the parts that hold edges of these ids are read, and only counts of their neighbours change.
    """
    edges = b.without_gone(a.edges.filter(F.col("part").isin(touched)).join(ids, a.key, "left_semi"))
    now = edges.groupBy(b.key).agg(F.sum("weight").alias("_lost"))
    if b.changed is not None:
        now = now.join(b.changed.select(b.key, F.col("_n").alias("_later")), b.key, "full").join(b.first, b.key)
        now = now.withColumn("_n", F.coalesce("_later", "_n")).withColumn("_lost", F.coalesce("_lost", F.lit(0)))
    else:
        now = now.join(b.first, b.key)
    seen = Observation()
    now = now.select(b.key, (F.col("_n") - F.col("_lost")).alias("_n"), "_lost")
    now = now.observe(seen, F.coalesce(F.sum("_lost"), F.lit(0)).alias("rows"))
    b.changed = b.store(now, f"changed-{turn}", f"{b.key} long, _n long, _lost long")
    return seen.get["rows"]


def frequency_filter(df: DataFrame, min_user: int, min_movie: int) -> tuple[DataFrame, dict[str, int]]:
    """Drop rare users, then rare movies, until a pass removes nothing.

    (user, movie, weight) edges are stored twice, by user and by movie, in parts of bounded size. A pass is driven by the ids
    that went in the one before: their edges lower the counts of their neighbours, and only those can become rare.
    So a late pass reads the parts of a few ids and writes the counts that ever changed, not the edges.
    """
    # fixed values: the field names of the audit
    audit = {
        "min_user_interactions": min_user,
        "min_movie_interactions": min_movie,
        "ratings_rows_removed_by_frequency_filter": 0,
        "users_removed_by_frequency_filter": 0,
        "movies_removed_by_frequency_filter": 0,
        "frequency_filter_iterations": 0,
    }
    if min_user <= 0 and min_movie <= 0:
        return df, audit
    ids = [F.col(c).cast("long").alias(c) for c in ("user_id", "movie_id")]
    edges = staged(df.select(*ids).groupBy("user_id", "movie_id").agg(F.count(F.lit(1)).alias("weight")), "edges")
    parts = max(LEAST_PARTS, min(MOST_PARTS, edges.count() // PART_EDGES))
    users = _Side(edges, "user_id", "movie_id", min_user, parts)
    movies = _Side(edges, "movie_id", "user_id", min_movie, parts)
    while True:
        audit["frequency_filter_iterations"] += 1
        turn, lost = audit["frequency_filter_iterations"], 0
        for side, other, name in ((users, movies, "users"), (movies, users, "movies")):
            gone, number, touched = side.leave(turn) if side.least > 0 else (None, 0, [])
            if number:
                audit[f"{name}_removed_by_frequency_filter"] += number
                lost += _lower(side, other, gone, touched, turn)
        audit["ratings_rows_removed_by_frequency_filter"] += lost
        if not lost:
            break
    if not audit["ratings_rows_removed_by_frequency_filter"]:
        return df, audit
    return movies.without_gone(users.without_gone(df)).select(*df.columns), audit


def prune_dimension(dimension: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    return dimension.join(facts.select(key).distinct(), key, "left_semi")


def require_unique(df: DataFrame, key: str) -> None:
    if not df.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"duplicate {key} in a dimension table")


def merge_metadata(ratings: DataFrame, movies: DataFrame, users: DataFrame) -> DataFrame:
    """Facts left-joined to both dimensions; a user column that clashes gets ``_user``."""
    require_unique(movies, "movie_id")
    require_unique(users, "user_id")
    merged = ratings.join(movies, "movie_id", "left")
    clashes = {c: f"{c}_user" for c in users.columns if c != "user_id" and c in merged.columns}
    return merged.join(users.withColumnsRenamed(clashes), "user_id", "left")


def id_map(df: DataFrame, key: str, index: str) -> DataFrame:
    """Raw id -> 0..n-1 in raw-id order."""
    return global_position(df.select(key).distinct(), [key], index)


def encode_ids(df: DataFrame, **maps: DataFrame) -> DataFrame:
    """Attach index columns; each mapping is named by the id column it encodes."""
    for key, mapping in maps.items():
        df = df.join(mapping, key)
    return df
