"""Monitoring goldens, feedback merge, streams."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import drift, feedback, monitor
from rankloom.session import fresh_path
from rankloom.sources import model_store
from rankloom.streaming import logs as log_streams, state

EXPOSURE = [(10, 5), (11, 4), (12, 3), (13, 2), (14, 1)]


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("2026-03-01 10:00:00", 1, "bpr", 12.3, 3, 200, [10, 11, 12]),
        ("2026-03-02 10:00:00", 2, "popularity_fallback", 18.9, 3, 200, [10, 13, 14]),
    ]
    df = spark.createDataFrame(
        rows, "ts string, user_id long, strategy string, latency_ms double, top_k int, response_status int, recommendations array<long>"
    )
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture(scope="module")
def share(spark):
    return drift.train_distribution([spark.createDataFrame(EXPOSURE, "movie_id long, exposure long")])


def test_summary_golden(events, share):
    row = monitor.monitoring_summary(events, share).first()
    service, data = row["service_metrics"], row["data_behavior"]
    assert (service["request_count"], service["error_count"], service["error_rate"]) == (2, 0, 0.0)
    assert service["avg_latency_ms"] == pytest.approx(15.6) and service["p95_latency_ms"] == pytest.approx(18.57)
    assert (data["unique_users"], data["fallback_rate"], data["requests_per_user"]) == (2, 0.5, 1.0)
    assert [(d["day"], d["requests"]) for d in data["requests_per_day"]] == [("2026-03-01", 1), ("2026-03-02", 1)]
    assert row["drift"]["drift_score"] == pytest.approx(0.0185770756, abs=1e-9)
    assert row["warnings"] == ["fallback_rate", "unknown_user_rate"]


def test_summary_without_events(events, share):
    row = monitor.monitoring_summary(events.limit(0), share).first()
    assert row["service_metrics"]["request_count"] == 0 and row["service_metrics"]["p95_latency_ms"] == 0.0
    assert row["drift"]["drift_score"] == 0.0 and row["warnings"] == []


def test_null_status_is_neither(events):
    row = monitor.service_metrics(events.withColumn("response_status", F.lit(None).cast("int"))).first()
    assert (row["request_count"], row["success_count"], row["error_count"]) == (2, 0, 0)


def test_alert_is_strict_and_trigger_is_not(spark):
    row = spark.createDataFrame([(0.2,)], "drift_score double")
    assert monitor.alerts(row).count() == 0
    assert monitor.retrain_trigger(row).first()["retrain"] is True
    missing = spark.createDataFrame([(None,)], "drift_score double")
    assert monitor.retrain_trigger(missing).first()["retrain"] is False
    assert monitor.retrain_trigger(missing, "schedule").first()["retrain"] is True


def test_latest_wins_and_feedback_beats_base(spark):
    schema = "user_id long, movie_id long, rating double, timestamp long"
    base = spark.createDataFrame([(1, 1, 1.0, 10), (1, 2, 1.0, 99), (2, 2, 1.0, None)], schema)
    news = spark.createDataFrame([(1, 1, 5.0, 10), (1, 2, 5.0, 98), (3, 3, 5.0, 1)], schema)
    merged = feedback.merge_feedback(base, news, 0)
    assert sorted((r["user_id"], r["movie_id"], r["rating"], r["timestamp"]) for r in merged.collect()) == [
        (1, 1, 5.0, 10), (1, 2, 1.0, 99), (2, 2, 1.0, 0), (3, 3, 5.0, 1)]
    twice = base.unionByName(base)
    assert feedback.merge_feedback(twice, None, 0).count() == 6


def test_feedback_without_valid_rows(spark):
    bad = spark.createDataFrame([("x", "1", "5")], "user_id string, movie_id string, rating string")
    with pytest.raises(ValueError):
        feedback.normalize_feedback(bad, 0)
    with pytest.raises(ValueError):
        feedback.normalize_feedback(bad.drop("rating"), 0)


def test_feedback_stream_survives_a_repeated_batch(spark):
    schema = "user_id long, movie_id long, rating double, timestamp long"
    root, source = fresh_path(spark, "t"), fresh_path(spark, "s")
    spark.createDataFrame([(1, 1, 1.0, 10), (5, 5, 2.0, 10)], schema).write.parquet(f"{root}/base")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    spark.createDataFrame([(1, 1, 3.0, 11), (1, 1, 2.0, 9)], schema).coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame([(1, 1, 4.0, 12), (2, 2, 5.0, 1)], schema).coalesce(1).write.mode("append").parquet(source)
    # Two runs with fresh offsets write the same batches again.
    for _ in range(2):
        state.append_feedback(stream(), root, fresh_path(spark, "o"), 0).awaitTermination()
    want = [(1, 1, 4.0, 12), (2, 2, 5.0, 1), (5, 5, 2.0, 10)]
    columns = ["user_id", "movie_id", "rating", "timestamp"]
    assert sorted(tuple(r) for r in state.read_merged(spark, root, 0).select(*columns).collect()) == want
    target = fresh_path(spark, "compacted")
    state.compact(spark, root, target, 0)
    assert sorted(tuple(r) for r in state.read_merged(spark, target, 0).select(*columns).collect()) == want


@pytest.mark.parametrize("files", [1, 1000])
def test_windows_over_several_batches(spark, events, files):
    """The same windows however the files are cut into batches; older rows come last."""
    source, target = fresh_path(spark, "l"), fresh_path(spark, "w")
    renamed = events.withColumnRenamed("ts", "timestamp")
    for _ in range(3):
        renamed.coalesce(1).write.mode("append").json(source)
    older = renamed.withColumn("timestamp", F.col("timestamp").cast("timestamp") - F.expr("INTERVAL 300 DAYS"))
    older.coalesce(1).write.mode("append").json(source)
    log_streams.write_windows(log_streams.log_stream(spark, source, files), target, fresh_path(spark, "o")).awaitTermination()
    got = log_streams.read_windows(spark, target).orderBy("window_start").collect()
    assert [(r["request_count"], r["fallback_count"]) for r in got] == [(1, 0), (1, 1), (3, 0), (3, 3)]


def test_model_store_needs_meta(spark):
    path = fresh_path(spark, "m")
    with pytest.raises(FileNotFoundError):
        model_store.load_model(spark, path)
    model_store.save_model(path, {"a": spark.range(3)}, {"best_epoch": "2"})
    tables, meta = model_store.load_model(spark, path)
    assert tables["a"].count() == 3 and meta == {"best_epoch": "2"}


def test_drift_stream_equals_batch_and_reads_the_share_for_new_items_only(spark):
    """After every batch the divergence of all logs so far; an id with two shares, one without, a null id and a null share."""
    source, root, offsets = fresh_path(spark, "l"), fresh_path(spark, "d"), fresh_path(spark, "o")
    schema = "strategy string, recommendations array<long>"
    served = [[10, 11], [10, 10], [11], [10, 99]]
    rows = [(10, 0.25), (10, 0.15), (11, 0.3), (12, 0.1), (13, 0.1), (14, None), (None, 0.1)]
    share = spark.createDataFrame(rows, "movie_id long, p double")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def run():
        seen = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
        state.track_drift(seen, share.mapInArrow(counted, share.schema), root, offsets).awaitTermination()

    def want(n):
        logs = spark.createDataFrame([("bpr", s) for s in served[:n]], schema)
        return drift.divergence(share, drift.production_distribution(logs)).first()["drift_score"]

    for items in served[:3]:
        spark.createDataFrame([("bpr", items)], schema).coalesce(1).write.mode("append").json(source)
    run()
    assert read.value == 2 * len(rows)  # for the histogram and for the first batch
    spark.createDataFrame([("bpr", served[3])], schema).coalesce(1).write.mode("append").json(source)
    run()
    got = [spark.read.parquet(state.version_path(f"{root}/drift", i)).first()["drift_score"] for i in range(4)]
    last = {r["movie_id"]: r["served"] for r in spark.read.parquet(state.version_path(f"{root}/counts", 3)).collect()}
    assert got[2:] == pytest.approx([want(3), want(4)], abs=1e-12) and last == {10: 4, 11: 2, 99: 1}


def test_training_shares_read_their_source_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame(EXPOSURE, "movie_id long, exposure long")
    rows = drift.train_distribution([table.mapInArrow(counted, table.schema)]).collect()
    assert read.value == len(EXPOSURE) and sum(r["p"] for r in rows) == pytest.approx(1.0)
