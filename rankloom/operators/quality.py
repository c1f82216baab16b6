"""Data-quality counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.functions.columns import MAX_EPOCH_SECOND, with_numbers


def missing_cells(df: DataFrame, table: str) -> DataFrame:
    """NULL cells per column and in total, one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0).cast("long"))
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    entries.append(F.struct(F.lit("(all)").alias("column"), total.alias("missing")))
    return counted.select(F.lit(table).alias("table"), F.explode(F.array(*entries)).alias("e")).select("table", "e.*")


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical row (or key); NULLs are equal."""
    copies = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def id_masks(df: DataFrame, column: str) -> DataFrame:
    """Why an id is unusable, as boolean columns."""
    raw = F.col(column)
    return with_numbers(df, [column]).withColumnRenamed(f"{column}_number", "numeric_id").withColumns(
        {
            "is_null": raw.isNull(),
            "non_numeric": raw.isNotNull() & F.col("numeric_id").isNull(),
            "non_integer": F.coalesce(F.col("numeric_id") % 1 != 0, F.lit(False)),
            "non_positive": F.coalesce(F.col("numeric_id") <= 0, F.lit(False)),
            "valid": valid_id(F.col("numeric_id")),
        }
    )


def valid_id(value: Column) -> Column:
    return value.isNotNull() & F.coalesce((value % 1 == 0) & (value > 0), F.lit(False))


def valid_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct usable ids of a reference table."""
    value = F.col(f"{column}_number")
    return with_numbers(df.select(column), [column]).filter(valid_id(value)).select(value.cast("long").alias(column)).distinct()


def unknown_references(df: DataFrame, column: str, reference: DataFrame) -> DataFrame:
    """Rows with a usable id that the reference lacks; none if the reference has no usable id.

    Rows are counted per id before the join, so a hot unknown id is one row.
    """
    value = F.col(f"{column}_number")
    usable = with_numbers(df.select(column), [column]).filter(valid_id(value))
    counts = usable.groupBy(value.cast("long").alias(column)).agg(F.count(F.lit(1)).alias("n"))
    known = valid_ids(reference, column)
    lost = counts.join(known, column, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    return lost.select(
        F.when(known.limit(1).agg(F.count(F.lit(1))).scalar() > 0, F.col("n")).otherwise(0).cast("long").alias("unknown")
    )


def rating_checks() -> dict[str, Column]:
    """Aggregates over a table ``with_numbers`` of rating."""
    value = F.col("rating_number")
    raw = F.col("rating")
    return {
        "rating_out_of_range_rows": F.count_if(value.isNotNull() & ((value < 1) | (value > 5))),
        "rating_non_numeric_rows": F.count_if(raw.isNotNull() & value.isNull()),
        "rating_null_rows": F.count_if(raw.isNull()),
    }


def timestamp_checks(now: int) -> dict[str, Column]:
    """Aggregates over a table ``with_numbers`` of timestamp; ``now`` is an epoch second."""
    value = F.col("timestamp_number")
    raw = F.col("timestamp")
    return {
        "timestamp_null_rows": F.count_if(raw.isNull()),
        "timestamp_non_numeric_rows": F.count_if(raw.isNotNull() & value.isNull()),
        "timestamp_non_positive_rows": F.count_if(value <= 0),
        "timestamp_unparsable_rows": F.count_if(value > MAX_EPOCH_SECOND),
        "timestamp_future_rows": F.count_if((value <= MAX_EPOCH_SECOND) & (value > now)),
    }


def _missing_total(df: DataFrame) -> Column:
    return sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("long"))


def quality_summary(ratings: DataFrame, movies: DataFrame, users: DataFrame, now: int) -> DataFrame:
    """All counters as one row; scalar results of other tables enter as subqueries."""

    def invalid(column: str) -> Column:
        return F.count_if(~valid_id(F.col(f"{column}_number")))

    row = with_numbers(ratings, ["user_id", "movie_id", "rating", "timestamp"]).agg(
        _missing_total(ratings).alias("ratings_missing_cells"),
        invalid("user_id").alias("invalid_user_id_rows"),
        invalid("movie_id").alias("invalid_movie_id_rows"),
        *[c.alias(n) for n, c in {**rating_checks(), **timestamp_checks(now)}.items()],
    )
    rest = {
        "movies_missing_cells": movies.agg(_missing_total(movies)),
        "users_missing_cells": users.agg(_missing_total(users)),
        "ratings_exact_duplicates": duplicate_rows(ratings),
        "movies_exact_duplicates": duplicate_rows(movies),
        "users_exact_duplicates": duplicate_rows(users),
        "unknown_user_id_rows": unknown_references(ratings, "user_id", users),
        "unknown_movie_id_rows": unknown_references(ratings, "movie_id", movies),
        "duplicate_user_movie_rows": duplicate_rows(ratings, ["user_id", "movie_id"]),
    }
    return row.select("*", *[df.scalar().alias(name) for name, df in rest.items()])


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    shapes = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
        )
        for name, df in tables.items()
    ]
    out = shapes[0]
    for shape in shapes[1:]:
        out = out.unionByName(shape)
    return out
