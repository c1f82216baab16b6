"""Names, casts, cleaning, splits, skew paths."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom import session
from rankloom.functions import columns as cols
from rankloom.operators import clean, quality, skew, split
from rankloom.session import fresh_path
from rankloom.sources import readers


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("raw, name", [("MovieID", "movieid"), ("User-ID", "user_id"), ("  ZIP Code  ", "zip_code"), ("Gender!!!", "gender")])
def test_snake_name(raw, name):
    assert cols.snake_name(raw) == name


def test_first_of_equal_names_wins(spark):
    df = spark.createDataFrame([(1, 2, "a")], ["UserID", "userid", "Zip-code"])
    out = cols.canonicalize_names(df)
    assert out.columns == ["user_id", "zip_code"] and rows(out) == [(1, "a")]


def test_required_columns_lists_all_gaps(spark):
    df = spark.createDataFrame([(1,)], ["user_id"])
    with pytest.raises(ValueError, match="a: movie_id, rating; b: title"):
        cols.require_columns({"a": (df, ["user_id", "rating", "movie_id"]), "b": (df, ["title"])})


def test_missing_files_are_listed_together(spark):
    with pytest.raises(FileNotFoundError) as error:
        readers.require_files(spark, ["/nowhere/movies.dat", "/nowhere/users.dat"])
    assert "movies.dat" in str(error.value) and "users.dat" in str(error.value)


def test_feedback_suffix_and_missing_log(spark):
    path = fresh_path(spark, "x") + ".txt"
    spark.range(1).select(F.lit("a")).write.text(path)
    with pytest.raises(ValueError):
        readers.read_by_suffix(spark, path)
    empty = readers.read_request_logs(spark, path + ".gone")
    assert empty.columns == readers.LOG_COLUMNS and empty.count() == 0


@pytest.mark.parametrize(
    "text, value",
    [("12", 12.0), (" 7 ", 7.0), ("1e3", 1000.0), ("-5", -5.0), ("3.", 3.0), (".5", 0.5), ("1d", None), ("2f", None),
     ("0x1p3", None), ("NaN", None), ("Infinity", None), ("u1", None), ("", None), (None, None)],
)
def test_numeric(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cols.numeric(F.col("t"))).first()[0] == value


def test_time_column(spark):
    df = spark.createDataFrame([(1, 2)], ["timestamp", "timestamp_dt"])
    assert cols.time_column(df) == "timestamp_dt" and cols.time_column(df.drop("timestamp_dt")) == "timestamp"
    with pytest.raises(ValueError):
        cols.time_column(df.select(F.lit(1).alias("x")))


def test_fraction_is_flagged_but_cut(spark):
    df = spark.createDataFrame([("3.7", "1", "4", "10")], "user_id string, movie_id string, rating string, timestamp string")
    assert quality.id_masks(df, "user_id").select("non_integer", "valid").first() == (True, False)
    assert clean.narrow_types(clean.cast_ratings(df)).select("user_id").first()[0] == 3


def test_far_future_second_is_unparsable(spark):
    df = spark.createDataFrame([("1", "1", "4", "99999999999")], "user_id string, movie_id string, rating string, timestamp string")
    assert clean.drop_null_rows(clean.cast_ratings(df)).count() == 0


def test_unknown_references_with_empty_reference(spark):
    df = spark.createDataFrame([("1",), ("2",)], "user_id string")
    reference = spark.createDataFrame([("x",)], "user_id string")
    assert quality.unknown_references(df, "user_id", reference).first()[0] == 0
    assert quality.unknown_references(df, "user_id", df.limit(1)).first()[0] == 1


def test_dedup_keeps_latest_or_first(spark):
    df = spark.createDataFrame([(1, 1, 3.0, 5, 1), (1, 1, 4.0, 5, 2), (1, 1, 2.0, 4, 3)], "user_id long, movie_id long, rating double, ts long, src long")
    assert clean.dedup_interactions(df, ("ts", "src")).select("rating").first()[0] == 4.0
    assert clean.dedup_interactions(df, ("ts", "src"), "first").select("rating").first()[0] == 2.0
    with pytest.raises(ValueError):
        clean.dedup_interactions(df, ("ts",), "any")


def brute_core(pairs, least_user, least_movie):
    rounds = users = movies = 0
    while True:
        rounds += 1
        start = len(pairs)
        n = Counter(u for u, _ in pairs)
        users += sum(c < least_user for c in n.values())
        pairs = [p for p in pairs if n[p[0]] >= least_user]
        n = Counter(m for _, m in pairs)
        movies += sum(c < least_movie for c in n.values())
        pairs = [p for p in pairs if n[p[1]] >= least_movie]
        if len(pairs) == start:
            return sorted(pairs), rounds, users, movies


@pytest.mark.parametrize("least_user, least_movie", [(2, 2), (3, 2), (4, 4), (0, 3), (30, 30)])
def test_frequency_filter_against_brute_force(spark, least_user, least_movie):
    rng = random.Random(least_user * 10 + least_movie)
    pairs = sorted({(int(20 * rng.random() ** 2), int(20 * rng.random() ** 2)) for _ in range(120)})
    df = spark.createDataFrame(pairs, "user_id long, movie_id long")
    kept, audit = clean.frequency_filter(df, least_user, least_movie)
    expected, rounds, users, movies = brute_core(pairs, least_user, least_movie)
    assert rows(kept) == sorted(expected, key=repr)
    assert (audit["frequency_filter_iterations"], audit["users_removed_by_frequency_filter"], audit["movies_removed_by_frequency_filter"]) == (rounds, users, movies)
    assert audit["ratings_rows_removed_by_frequency_filter"] == len(pairs) - len(expected)


def test_late_passes_read_only_parts_of_the_worklist(spark, monkeypatch):
    """A chain that peels off one end id a pass."""
    chain = [(i, i) for i in range(12)] + [(i, i + 1) for i in range(12)] + [(100 + i, 100 + j) for i in range(6) for j in range(6)]
    df = spark.createDataFrame(chain, "user_id long, movie_id long")
    read, lower = [], clean._lower
    monkeypatch.setattr(clean, "_lower", lambda *a: read.append(len(a[3])) or lower(*a))
    kept, audit = clean.frequency_filter(df, 2, 2)
    expected, rounds, users, movies = brute_core(chain, 2, 2)
    assert rows(kept) == sorted(expected, key=repr) and audit["frequency_filter_iterations"] == rounds > 5
    assert (audit["users_removed_by_frequency_filter"], audit["movies_removed_by_frequency_filter"]) == (users, movies)
    assert max(read[1:]) <= 2 < clean.LEAST_PARTS


def test_range_filter_reaches_the_scan(spark):
    path = fresh_path(spark, "numbers")
    data = [(1, 2, 3.0, 10), (0, 2, 3.0, 10), (1, 2, float("nan"), 10), (1, None, 3.0, 10), (1, 2, 6.0, 10), (3, 4, 5.0, 11)]
    spark.createDataFrame(data, "user_id long, movie_id int, rating double, timestamp long").write.parquet(path)
    kept = clean.range_filter(clean.cast_ratings(spark.read.parquet(path)))
    assert sorted(r["user_id"] for r in kept.collect()) == [1, 3]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = clean.range_filter(clean.cast_ratings(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters:") :].split("]")[0]
    assert all(f"GreaterThan({c},0)" in pushed for c in ("user_id", "movie_id", "timestamp")) and "Generate" not in plan


def test_frequency_filter_passthrough(spark):
    df = spark.createDataFrame([(1, 1)], "user_id long, movie_id long")
    kept, audit = clean.frequency_filter(df, 0, 0)
    assert kept is df and audit["frequency_filter_iterations"] == 0


def test_merge_rejects_repeated_dimension_key(spark):
    facts = spark.createDataFrame([(1, 1)], "user_id long, movie_id long")
    movies = spark.createDataFrame([(1, "a"), (1, "b")], "movie_id long, title string")
    users = spark.createDataFrame([(1, "F")], "user_id long, gender string")
    with pytest.raises(ValueError):
        clean.merge_metadata(facts, movies, users)


@pytest.mark.parametrize("n, sizes", [(1, (0, 0)), (2, (1, 0)), (3, (1, 1)), (5, (1, 1)), (10, (2, 1)), (13, (3, 1)), (15, (3, 2)), (25, (5, 2)), (35, (7, 4))])
def test_holdout_sizes(spark, n, sizes):
    val, test = split.holdout_sizes(F.col("n"), 0.1, 0.2)
    assert spark.range(1).select(F.lit(n).alias("n")).select(test, val).first() == sizes


def test_short_histories(spark):
    data = [(1, 1, 1), (2, 1, 1), (2, 2, 2), (3, 1, 1), (3, 2, 2), (3, 3, 3)]
    df = spark.createDataFrame(data, "user_id long, movie_id long, ts long")
    labels = {(u, m): s for u, m, _, s in split.temporal_split(df, "ts", 0.1, 0.2, 1).collect()}
    assert labels == {(1, 1): "train", (2, 1): "train", (2, 2): "test", (3, 1): "train", (3, 2): "val", (3, 3): "test"}
    low = split.temporal_split(df, "ts", 0.1, 0.2, 3).filter("user_id < 3 AND split <> 'train'")
    assert low.count() == 0


def test_hot_user_is_split_like_any_other(spark):
    """One user holds a third of all rows; many of them share one time."""
    rng = random.Random(3)
    data = [(0, m, 7 if m % 2 else rng.randrange(50)) for m in range(2000)]
    data += [(1 + i % 40, i, rng.randrange(50)) for i in range(4000)]
    df = spark.createDataFrame(data, "user_id long, movie_id long, ts long")
    plain = split.temporal_split(df, "ts")
    hot = split.temporal_split(df, "ts", hot_floor=200, hot_share=0.01)
    assert rows(hot) == rows(plain)


def test_global_position(spark):
    values = list(range(0, 3000, 3))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = skew.global_position(df, ["v"]).collect()
    assert sorted((r["v"], r["position"]) for r in got) == [(v, i) for i, v in enumerate(sorted(values))]
    down = skew.global_position(df, [F.desc("v")]).collect()
    assert sorted((-r["v"], r["position"]) for r in down) == [(-v, i) for i, v in enumerate(sorted(values, reverse=True))]


@pytest.mark.parametrize("q", [0.0, 0.3, 0.95, 1.0])
@pytest.mark.parametrize("n", [1, 2, 17, 500])
def test_exact_percentile(spark, q, n):
    rng = random.Random(n)
    values = sorted(round(rng.random() * 20, 1) if n > 100 else rng.random() for _ in range(n))
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    at = q * (n - 1)
    low, high = values[int(at)], values[min(int(at) + 1, n - 1)]
    assert skew.exact_percentile(df, "v", q) == pytest.approx(low + (high - low) * (at - int(at)))


def test_percentile_of_nothing(spark):
    assert skew.exact_percentile(spark.createDataFrame([], "v double"), "v", 0.95) is None


def test_scratch_removes_its_intermediates(spark):
    from rankloom.session import fresh_path, scratch, staged

    kept = fresh_path(spark, "kept")
    with scratch(spark) as root:
        staged(spark.range(5), "inner").write.parquet(kept)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        assert files.exists(path)
    assert not files.exists(path) and spark.read.parquet(kept).count() == 5


def test_a_task_reads_a_bounded_part_of_a_shuffle(spark):
    """The default of adaptive execution is lowered, a smaller setting stays."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        for given, want in (("64MB", f"{session.READ_BYTES}b"), ("1m", "1m")):
            spark.conf.set(name, given)
            session.configure(spark)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("keep, want", [("latest", 5.0), ("first", 1.0)])
def test_rows_of_equal_order_are_told_by_the_other_columns(spark, keep, want):
    values = [3.0, 5.0, 2.0, 1.0, 4.0]
    for rows in (values, values[::-1]):
        df = spark.createDataFrame([(1, 7, r, 10) for r in rows], "user_id long, movie_id long, rating double, timestamp long").repartition(5)
        kept = clean.dedup_interactions(df, ("user_id", "timestamp"), keep).collect()
        assert [tuple(r) for r in kept] == [(1, 7, want, 10)]
