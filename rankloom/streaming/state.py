"""Stream-maintained tables: feedback upsert and served-item counts.

Every micro-batch writes only what belongs to it, into a folder named by the batch. A batch that
is run again after a failure overwrites its own folder, so the result is the same however often
it is run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rankloom.operators.drift import divergence_of_pairs, served_counts
from rankloom.operators.feedback import merge_feedback, normalize_feedback
from rankloom.session import remove
from rankloom.sources.readers import path_exists


def version_path(root: str, batch_id: int) -> str:
    return f"{root}/v{batch_id:010d}"


def _is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def latest_version(spark: SparkSession, root: str, before: int) -> str | None:
    """The newest complete version older than batch ``before``."""
    for batch_id in range(before - 1, -1, -1):
        path = version_path(root, batch_id)
        if _is_complete(spark, path):
            return path
    return None


def _each_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    )


def append_feedback(
    stream: DataFrame, root: str, checkpoint: str, now: int, tie_break: tuple[str, ...] = ()
) -> StreamingQuery:
    """Feedback batches next to the table ``root/base``; the table itself is not rewritten.

    A batch shrinks to its latest row per (user, movie) before it is stored, so its cost grows
    with the batch, not with the table.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        news = normalize_feedback(batch, now, tie_break, check_empty=False)
        merge_feedback(news.limit(0), news, now, tie_break).write.mode("overwrite").parquet(
            version_path(f"{root}/news", batch_id)
        )

    return _each_batch(stream, checkpoint, step)


def read_merged(spark: SparkSession, root: str, now: int, tie_break: tuple[str, ...] = (), upto: int | None = None) -> DataFrame:
    """Base and all feedback batches (up to batch ``upto``) as one table, latest row per (user, movie)."""
    base = spark.read.parquet(f"{root}/base")
    if upto is None:
        stored = f"{root}/news/v*" if path_exists(spark, f"{root}/news") else None
        news = spark.read.parquet(stored) if stored else None
    else:
        paths = [p for p in (version_path(f"{root}/news", i) for i in range(upto + 1)) if _is_complete(spark, p)]
        news = spark.read.parquet(*paths) if paths else None
    return merge_feedback(base, news, now, tie_break)


def compact(spark: SparkSession, root: str, target: str, now: int, tie_break: tuple[str, ...] = ()) -> None:
    """The merged table as the base of a new root; the old root stays readable until readers have moved."""
    read_merged(spark, root, now, tie_break).write.mode("overwrite").parquet(f"{target}/base")


#: A served item: how often, and its rows of the training share; null until they are looked up.
_COUNTS = "movie_id long, served long, shares array<struct<p: double>>"


def _pairs(counts: DataFrame, histogram: DataFrame) -> DataFrame:
    """(_p, _q, _n) of all items: served ones a row each, the others by training share."""
    total = counts.agg(F.sum("served")).scalar()
    served = counts.select(F.explode_outer("shares").alias("_s"), (F.col("served") / total).alias("_q")).select(
        F.col("_s.p").alias("_p"), "_q", F.lit(1).cast("long").alias("_n"), F.col("_s").isNotNull().alias("_shared")
    )
    gone = served.filter("_shared").select(F.col("_p").alias("p"), (-F.col("_n")).alias("_n"))
    left = histogram.unionByName(gone).groupBy("p").agg(F.sum("_n").alias("_n")).filter("_n > 0")
    return served.drop("_shared").unionByName(left.select(F.col("p").alias("_p"), F.lit(None).cast("double").alias("_q"), "_n"))


def track_drift(stream: DataFrame, train_share: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Running served-item counts (one row per item) and, per micro-batch, their divergence from training.

    An item's training share is looked up when it is first served and kept with its count. Items not served yet differ in
    nothing but that share, so they enter as a histogram made once: shares of counts have few distinct values. A batch
    costs what was served so far, not the training catalog. ``train_share`` is read for the histogram and for every batch with
    new items: give it as a stored table.
    """
    histogram = f"{root}/histogram"
    train_share.groupBy("p").agg(F.count(F.lit(1)).alias("_n")).write.mode("overwrite").parquet(histogram)
    mine: set[str] = set()

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old, here = latest_version(spark, f"{root}/counts", batch_id), version_path(f"{root}/counts", batch_id)
        counts = served_counts(batch).withColumn("shares", F.lit(None).cast("array<struct<p: double>>"))
        if old is not None:
            before = spark.read.schema(_COUNTS).parquet(old)
            # an earlier start may have had another training share
            before = before if old in mine else before.withColumn("shares", F.lit(None).cast("array<struct<p: double>>"))
            counts = before.unionByName(counts).groupBy("movie_id").agg(F.sum("served").alias("served"), F.max("shares").alias("shares"))
        summed = version_path(f"{root}/summed", batch_id)
        counts.write.mode("overwrite").parquet(summed)
        counts = spark.read.schema(_COUNTS).parquet(summed)
        new = counts.filter("shares is null").select("movie_id", "served")
        if not new.isEmpty():
            found = train_share.join(new, "movie_id").groupBy("movie_id").agg(F.collect_list(F.struct("p")).alias("_found"))
            none = F.array().cast("array<struct<p: double>>")
            looked_up = new.join(found, "movie_id", "left").select("movie_id", "served", F.coalesce("_found", none).alias("shares"))
            counts = counts.filter("shares is not null").unionByName(looked_up)
        counts.write.mode("overwrite").parquet(here)
        mine.add(here)
        remove(spark, summed)
        score = divergence_of_pairs(_pairs(spark.read.schema(_COUNTS).parquet(here), spark.read.parquet(histogram)))
        score.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(version_path(f"{root}/drift", batch_id))

    return _each_batch(stream.select("recommendations"), checkpoint, step)
