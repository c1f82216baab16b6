"""Total orders, ranks and quantiles that never put one key or one column into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rankloom.session import shared_dir

# A group is hot when it holds more than this share of all rows, so there are at
# most 1 / HOT_SHARE hot groups and their key list may always be broadcast.
HOT_SHARE = 0.001
# Groups up to this many rows stay in one window task whatever their share.
HOT_FLOOR = 1_000_000

_LOCAL_BITS = 33


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows dealt out to all cores if the input has fewer partitions than cores.

    For CPU-heavy steps on a few large files; a table of many files passes unchanged. With ``key`` rows are always dealt, by
    that key: groups that contain it need no further shuffle, however many rows a step makes of each.
    """
    if key:
        return df.repartition(key)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partitioned, sorted and checkpointed, with partition id and local row position.

    The checkpoint pins rows to partitions; a re-run after a lost executor reads the same
    files, so positions cannot move.
    """
    spark = df.sparkSession
    shared_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pinned = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).checkpoint()
    marked = pinned.withColumn("_mid", F.monotonically_increasing_id())
    return marked.select(
        *pinned.columns,
        F.shiftright("_mid", _LOCAL_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_local"),
    )


def _running_offsets(sized: list) -> list[tuple[int, int]]:
    offsets, start = [], 0
    for row in sorted(sized, key=lambda r: r[0]):
        offsets.append((int(row[0]), start))
        start += int(row[1])
    return offsets


def global_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Zero-based position of every row in the total order given by unique ``order`` keys.

    Only one row per partition reaches the driver.
    """
    ranged = _ranged(df, order)
    offsets = _running_offsets(ranged.groupBy("_pid").agg(F.count(F.lit(1))).collect())
    pids, starts = zip(*offsets or [(0, 0)])
    # an Arrow table is a local relation: no job and no Python worker to make it
    table = df.sparkSession.createDataFrame(pa.table({"_pid": pa.array(pids, pa.int64()), "_start": pa.array(starts, pa.int64())}))
    return ranged.join(F.broadcast(table), "_pid").select(
        *df.columns, (F.col("_start") + F.col("_local")).alias(name)
    )


def hot_groups(df: DataFrame, group: str, hot_floor: int = HOT_FLOOR, hot_share: float = HOT_SHARE) -> DataFrame | None:
    """The groups that hold more rows than one task may get, to be broadcast; None if there are none."""
    total = df.count()
    limit = max(hot_floor, total * hot_share)
    if total <= limit:
        return None
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    if counts.agg(F.max("_size")).first()[0] <= limit:
        return None
    return F.broadcast(counts.filter(F.col("_size") > limit).select(group))


def group_row_number(
    df: DataFrame,
    group: str,
    order: Sequence[Column | str],
    rank: str = "row_number",
    size: str = "group_size",
    hot_floor: int = HOT_FLOOR,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """``row_number`` and row count per group, exact under any skew.

    Ordinary groups use one window. Hot groups, found by a pre-aggregated count, are
    ranked by a range-partitioned total order, so their rows spread over all tasks. ``df`` is
    read for the counts and again for the ranks: give it as a stored table.
    """
    window = Window.partitionBy(group)
    in_window = [
        F.row_number().over(window.orderBy(*order)).cast("long").alias(rank),
        F.count(F.lit(1)).over(window).alias(size),
    ]
    hot = hot_groups(df, group, hot_floor, hot_share)
    if hot is None:
        return df.select("*", *in_window)
    cold_rows = df.join(hot, group, "left_anti").select(*df.columns, *in_window)
    placed = global_position(df.join(hot, group, "left_semi"), [group, *order], "_pos")
    starts = placed.groupBy(group).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias(size))
    hot_rows = placed.join(F.broadcast(starts), group).select(
        *df.columns, (F.col("_pos") - F.col("_first") + 1).alias(rank), size
    )
    return cold_rows.unionByName(hot_rows)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "latest"
) -> DataFrame:
    """One row per key: the greatest (``latest``) or smallest (``first``) by ``order``, then by the other columns.

    An aggregate with map-side combine instead of a window: copies of one key shrink to
    one row per map task before the shuffle. A row travels as one struct, its order columns first.
    """
    pick = {"latest": F.max, "first": F.min}.get(keep)
    if pick is None:
        raise ValueError(f"unknown keep strategy: {keep}")
    # a key orders nothing among the rows of that key
    first = [c for c in dict.fromkeys(order) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    best = pick(F.struct(*first, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def exact_percentile(df: DataFrame, value: str, q: float) -> float | None:
    """Linearly interpolated percentile of a column of any size.

    Equal values are counted first, the distinct values are range-partitioned, and only the
    one or two partitions that hold the wanted positions are ranked.
    """
    hist = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _ranged(hist, [value])
    sized = ranged.groupBy("_pid").agg(F.sum("_n")).collect()
    total = sum(int(r[1]) for r in sized)
    if total == 0:
        return None
    target = q * (total - 1)
    wanted = {math.floor(target), math.ceil(target)}
    offsets = _running_offsets(sized)
    ends = {pid: start for pid, start in zip([p for p, _ in offsets], [s for _, s in offsets[1:]] + [total])}
    holding = [(p, s) for p, s in offsets if any(s <= w < ends[p] for w in wanted)]
    table = df.sparkSession.createDataFrame(holding, "_pid long, _start long")
    run = Window.partitionBy("_pid").orderBy(value)
    spans = (
        ranged.join(F.broadcast(table), "_pid")
        .withColumn("_end", F.col("_start") + F.sum("_n").over(run))
        .withColumn("_begin", F.col("_end") - F.col("_n"))
    )
    hit = F.lit(False)
    for position in wanted:
        hit = hit | ((F.col("_begin") <= position) & (F.lit(position) < F.col("_end")))
    rows = spans.filter(hit).select(value, "_begin", "_end").collect()
    at = {p: float(v) for p in wanted for v, b, e in rows if b <= p < e}
    low, high = at[math.floor(target)], at[math.ceil(target)]
    return low + (high - low) * (target - math.floor(target))
