"""Top-K lists: by global order, by factor score, cold start, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankloom.operators.cells import dense_scorer, score_cells
from rankloom.operators.skew import global_position
from rankloom.session import staged

# Popularity ranks up to this one are joined by broadcast; the head has this many rows at most.
HEAD_ROWS = 50_000


def ranked_items(popularity: DataFrame) -> DataFrame:
    """Item id and 1-based rank by score, count and id."""
    order = [F.desc("score"), F.desc("interaction_count"), F.asc("movie_id")]
    placed = global_position(popularity.select("movie_id", "score", "interaction_count"), order, "_pos")
    return staged(placed.select("movie_id", (F.col("_pos") + 1).alias("item_rank")), "ranked")


def popular_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, head_rows: int = HEAD_ROWS
) -> DataFrame:
    """The first K unseen items of a global order, for every user.

    Of a user's seen ranks in order, only those before the K-th gap matter. The longest history bounds them for all users: a
    rank beyond it + K is never reached. So mostly few of the seen pairs are left to be sorted by user, and the gaps give the
    lists. ``items`` is read several times: give it as a stored table.
    """
    longest = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_s")).agg(F.coalesce(F.max("_s"), F.lit(0))).scalar()
    near = items.filter(F.col("item_rank") <= longest + k)
    head, tail = F.col("item_rank") <= head_rows, F.col("item_rank") > head_rows
    pairs = seen.select("user_id", "movie_id").dropna()
    # The size of the tail is not known to the planner: shuffle, never broadcast it.
    taken = pairs.join(F.broadcast(near.filter(head)), "movie_id").unionByName(pairs.join(near.filter(tail).hint("merge"), "movie_id"))
    begins = users.select("user_id").distinct().withColumn("item_rank", F.lit(0).cast("long"))
    who = Window.partitionBy("user_id")
    along = who.orderBy("item_rank")
    gaps = begins.unionByName(taken.select("user_id", "item_rank")).select(
        "user_id",
        "item_rank",
        (F.dense_rank().over(along) - 1).alias("_i"),
        F.lead("item_rank").over(along).alias("_next"),
        F.min("item_rank").over(who).alias("_first"),
    )
    # a free rank x after i seen ones is the user's (x - i)-th; who was not asked has no rank 0
    last = F.least(F.col("_i") + k, F.col("_next") - 1)
    free = (
        gaps.filter((F.col("_first") == 0) & (last > F.col("item_rank")))
        .select("user_id", "_i", F.explode(F.sequence(F.col("item_rank") + 1, last)).alias("item_rank"))
        .select("user_id", (F.col("item_rank") - F.col("_i")).cast("int").alias("rank"), "item_rank")
    )
    found = free.filter(head).join(F.broadcast(items.filter(head)), "item_rank").unionByName(
        free.filter(tail).join(items.filter(tail).hint("merge"), "item_rank")
    )
    return found.select("user_id", "rank", "movie_id", "item_rank")


def first_k(df: DataFrame, k: int, order: list[Column], by: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """K rows per group; the limit runs once before and once after the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= k)


def top_k(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    return first_k(scores, k, [F.desc(score), F.asc("movie_id")])


def exclude_seen(scores: DataFrame, seen: DataFrame) -> DataFrame:
    return scores.join(seen.select("user_id", "movie_id"), ["user_id", "movie_id"], "left_anti")


def dot(left: str, right: str) -> Column:
    """Dot product of two array columns, in doubles."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Factor score of given (user, item) pairs; NULL where either has no vector."""
    left = users.select("user_id", F.col("factors").alias("_u"), F.col("bias").alias("_ub"))
    right = items.select("movie_id", F.col("factors").alias("_i"), F.col("bias").alias("_ib"))
    joined = pairs.join(left, "user_id", "left").join(right, "movie_id", "left")
    return joined.withColumn("raw_score", dot("_i", "_u") + F.col("_ib") + F.col("_ub")).drop("_u", "_ub", "_i", "_ib")


def factor_user_columns(users: DataFrame) -> DataFrame:
    return users.select("user_id", F.col("factors").alias("user_vector"), F.col("bias").alias("user_bias"))


def factor_item_columns(items: DataFrame) -> DataFrame:
    return items.select("movie_id", F.col("factors").alias("item_vector"), F.col("bias").alias("item_bias"))


def factor_top_k(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int, digits: int | None = None, ranged: bool = True, **blocks: int
) -> DataFrame:
    """K best unseen items per user by factor score, if ``ranged`` with the user's unseen score range.

    Without it the items of greatest bias and length come first, so that most of the others need no product.
    """
    left, right = factor_user_columns(users), factor_item_columns(items)
    first = None
    if not ranged:
        usual = F.coalesce(left.agg(F.avg(F.sqrt(dot("user_vector", "user_vector")))).scalar(), F.lit(0.0))
        first = F.col("item_bias") + usual * F.sqrt(dot("item_vector", "item_vector"))
    return score_cells(left, right, seen, dense_scorer, k, digits, ranged=ranged, first=first, **blocks)


def rating_scale(score: Column, low: Column, high: Column, least: float = 1.0, most: float = 5.0) -> Column:
    """Score mapped linearly from [low, high] to the rating range; the middle where both ends are close."""
    close = F.abs(high - low) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(low)
    span = F.nullif(high - low, F.lit(0.0))
    return F.when(close, F.lit((least + most) / 2)).otherwise((score - low) / span * (most - least) + least)


def with_display_score(ranked: DataFrame, score_type: str = "normalized_ranking") -> DataFrame:
    """Recommendation rows: rank, raw score, display score, type, fallback flag."""
    return ranked.select(
        "user_id",
        "rank",
        "movie_id",
        "raw_score",
        rating_scale(F.col("raw_score"), F.col("min_score"), F.col("max_score")).alias("score"),
        F.lit(score_type).alias("score_type"),
        F.lit(False).alias("is_fallback"),
    )


def _fallback(rows: DataFrame, raw: Column, shown: Column) -> DataFrame:
    return rows.select(
        "user_id",
        "rank",
        "movie_id",
        raw.cast("double").alias("raw_score"),
        shown.cast("double").alias("score"),
        F.lit("popularity_rating").alias("score_type"),
        F.lit(True).alias("is_fallback"),
    )


def _head_for_all(users: DataFrame, head: DataFrame) -> DataFrame:
    """Every user gets the same K rows: the bounded list travels as one array, not as a join."""
    rows = F.array_sort(F.collect_list(F.struct("rank", *[c for c in head.columns if c != "rank"])))
    whole = head.agg(rows).scalar()
    return users.select("user_id", F.explode(whole).alias("_r")).select("user_id", "_r.*")


def _take(ranked: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first k rows of a small ordered result, numbered."""
    return (
        ranked.orderBy(*order).limit(k)
        .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    )


def cold_start_order(users: DataFrame, popularity: DataFrame, k: int) -> DataFrame:
    """Popularity order; raw score counts down from K."""
    order = [F.desc("score"), F.desc("interaction_count"), F.asc("movie_id")]
    head = _take(popularity, k, order).select("rank", "movie_id")
    down = F.lit(k) + 1 - F.col("rank")
    return _fallback(_head_for_all(users, head), down, down)


def cold_start_bayesian(users: DataFrame, bayesian: DataFrame, k: int) -> DataFrame:
    """Bayesian table; shown rounded to one digit."""
    order = [F.desc("score"), F.desc("interaction_count"), F.asc("movie_id")]
    head = _take(bayesian, k, order).select("rank", "movie_id", "score")
    return _fallback(_head_for_all(users, head), F.col("score"), F.round("score", 1))


def cold_start_unseen(users: DataFrame, items: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """Popularity order without seen items; always shown as the middle rating."""
    rows = popular_unseen(users, items, seen, k)
    return _fallback(rows, F.lit(k) + 1 - F.col("rank"), F.lit(3.0))


def cold_start_bias(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Item-bias order."""
    head = _take(items, k, [F.desc("bias"), F.asc("movie_id")]).select("rank", "movie_id", "bias")
    return _fallback(_head_for_all(users, head), F.col("bias"), F.col("bias"))


def fallback_order(sources: list[DataFrame | None]) -> DataFrame:
    """The first source that exists and has rows, in its own order by the columns it has.

    Sort columns are matched by name: score and interaction_count fall, movie_id rises.
    """
    for source in sources:
        if source is None or "movie_id" not in source.columns or source.isEmpty():
            continue
        falling = [c for c in ("score", "interaction_count", "exposure") if c in source.columns]
        placed = global_position(source, [*[F.desc(c) for c in falling], F.asc("movie_id")], "_pos")
        return placed.select("movie_id", (F.col("_pos") + 1).alias("item_rank"))
    raise ValueError("no fallback source has rows")


def route_users(
    users: DataFrame, known: DataFrame, personal: DataFrame, fallback: DataFrame, k: int, model: str, version: str
) -> DataFrame:
    """Model list for users with history and a list, popularity head for all others; K is held in 1..100.

    ``personal`` holds user_id, rank, movie_id; ``fallback`` holds movie_id, item_rank.
    """
    k = min(max(1, k), 100)
    asked = users.select("user_id").distinct()
    has_history = known.select("user_id").distinct()
    mine = staged(
        personal.join(asked, "user_id", "left_semi")
        .join(has_history, "user_id", "left_semi")
        .filter(F.col("rank") <= k)
        .select("user_id", "rank", "movie_id", F.lit(model).alias("strategy")),
        "lists",
    )
    head = fallback.filter(F.col("item_rank") <= k).select(F.col("item_rank").cast("int").alias("rank"), "movie_id")
    others = _head_for_all(asked.join(mine.select("user_id").distinct(), "user_id", "left_anti"), head).select(
        "user_id", "rank", "movie_id", F.lit("popularity_fallback").alias("strategy")
    )
    return mine.unionByName(others).withColumn("model_version", F.lit(version))
