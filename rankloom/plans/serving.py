"""Queries: top-K lists, serving, hybrid, ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankloom.operators import hybrid, metrics, popularity, serve, topk
from rankloom.plans import views
from rankloom.plans.registry import query
from rankloom.plans.sql import metric_ctes, prefixed, scale_sql, with_views
from rankloom.plans.staging import rounded, staged_split
from rankloom.plans.tables import list_text
from rankloom.session import fresh_path, side_by_side, staged
from rankloom.sources import readers, writers

K = 10


class Shop:
    """The split and what every list needs from it, computed once per query."""

    def __init__(self, spark, sf):
        parts = staged_split(views.labelled_split(spark, sf))
        self.train, self.val, self.test = parts["train"], parts["val"], parts["test"]
        self.seen = staged(popularity.seen_pairs(self.train), "seen")
        self.popularity = popularity.item_popularity(self.train, time="ts")
        self.users = self.train.select("user_id").distinct()


class FactorShop(Shop):
    def __init__(self, spark, sf):
        super().__init__(spark, sf)
        self.user_factors, self.item_factors = views.user_factors(spark, sf), views.item_factors(spark, sf)

    def lists(self, k: int = K) -> DataFrame:
        return topk.factor_top_k(self.user_factors, self.item_factors, self.seen, k, digits=6)


def popular_lists(shop: Shop, k: int = K) -> DataFrame:
    return topk.popular_unseen(shop.users, topk.ranked_items(shop.popularity), shop.seen, k)


@query("g1_popular_unseen", with_views("SELECT user_id, rank, movie_id, item_rank FROM poprecs"))
def _(spark, sf):
    return popular_lists(Shop(spark, sf))


@query("g2_factor_scoring", with_views("""
SELECT i.user_id, i.movie_id, round(list_dot_product(u.factors, m.factors) + m.bias + u.bias, 6) AS raw_score
FROM train i LEFT JOIN ufactors u ON u.user_id = i.user_id LEFT JOIN ifactors m ON m.movie_id = i.movie_id"""))
def _(spark, sf):
    """Factor score of every train pair; NULL where the model lacks the user or item."""
    pairs = views.train(spark, sf).select("user_id", "movie_id")
    return rounded(topk.score_pairs(pairs, views.user_factors(spark, sf), views.item_factors(spark, sf)), "raw_score")


@query("g2_factor_top_k", with_views("SELECT user_id, rank, movie_id, raw_score FROM facrecs"))
def _(spark, sf):
    """All users against all items by blocked cells."""
    return FactorShop(spark, sf).lists().select("user_id", "rank", "movie_id", "raw_score")


@query("g3_exclude_seen", with_views("""
SELECT user_id, movie_id, rating FROM test t WHERE rating >= 4 AND NOT EXISTS (SELECT 1 FROM val s WHERE s.user_id = t.user_id AND s.movie_id = t.movie_id)
UNION ALL SELECT user_id, movie_id, rating FROM interactions t WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = t.user_id AND s.movie_id = t.movie_id)"""))
def _(spark, sf):
    shop = Shop(spark, sf)
    liked = shop.test.filter(F.col("rating") >= 4).select("user_id", "movie_id", "rating")
    every = views.interactions(spark, sf).select("user_id", "movie_id", "rating")
    return topk.exclude_seen(liked, shop.val).unionByName(topk.exclude_seen(every, shop.seen))


@query("g4_top_k_per_user", with_views("""
SELECT user_id, movie_id, rating, ts, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, movie_id) AS INT) AS rank FROM ratings
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, movie_id) <= 10"""))
def _(spark, sf):
    rows = views.ratings(spark, sf).drop("src1", "src2")
    return topk.top_k(rows, K, "rating")


DISPLAY_SQL = f"""
SELECT user_id, rank, movie_id, raw_score, round(CAST({scale_sql()} AS DOUBLE), 6) AS score,
       'normalized_ranking' AS score_type, false AS is_fallback FROM facrecs"""


@query("g5_display_scale", with_views(DISPLAY_SQL))
def _(spark, sf):
    return rounded(topk.with_display_score(FactorShop(spark, sf).lists()), "score")


COLD = "'popularity_rating' AS score_type, true AS is_fallback"


@query("g6_cold_start_order", with_views(f"""
SELECT u.user_id, CAST(p.item_rank AS INT) AS rank, p.movie_id, CAST(11 - p.item_rank AS DOUBLE) AS raw_score, CAST(11 - p.item_rank AS DOUBLE) AS score, {COLD}
FROM users u CROSS JOIN popranked p WHERE p.item_rank <= 10 AND u.user_id NOT IN (SELECT user_id FROM train)"""))
def _(spark, sf):
    shop = Shop(spark, sf)
    strangers = views.users(spark, sf).select("user_id").join(shop.users, "user_id", "left_anti")
    return topk.cold_start_order(strangers, shop.popularity, K)


@query("g6_cold_start_bayesian", with_views(f"""
SELECT u.user_id, CAST(p.rank AS INT) AS rank, p.movie_id, round(p.s, 6) AS raw_score, round(p.s, 1) AS score, {COLD}
FROM users u CROSS JOIN (SELECT movie_id, s, row_number() OVER (ORDER BY s DESC, interaction_count DESC, movie_id) AS rank
  FROM (SELECT movie_id, interaction_count, CAST(interaction_count / (interaction_count + 50.0) * mean_rating + 50 / (interaction_count + 50.0) * (SELECT avg(rating) FROM train) AS DOUBLE) AS s FROM popularity) b) p
WHERE p.rank <= 10"""))
def _(spark, sf):
    shop = Shop(spark, sf)
    rows = topk.cold_start_bayesian(views.users(spark, sf).select("user_id"), popularity.bayesian_popularity(shop.train), K)
    return rounded(rows, "raw_score")


@query("g6_cold_start_unseen", with_views(f"""
SELECT user_id, rank, movie_id, CAST(11 - rank AS DOUBLE) AS raw_score, CAST(3.0 AS DOUBLE) AS score, {COLD} FROM poprecs"""))
def _(spark, sf):
    shop = Shop(spark, sf)
    return topk.cold_start_unseen(shop.users, topk.ranked_items(shop.popularity), shop.seen, K)


@query("g6_cold_start_bias", with_views(f"""
SELECT u.user_id, CAST(p.rank AS INT) AS rank, p.movie_id, p.bias AS raw_score, p.bias AS score, {COLD}
FROM users u CROSS JOIN (SELECT movie_id, bias, row_number() OVER (ORDER BY bias DESC, movie_id) AS rank FROM ifactors) p WHERE p.rank <= 10"""))
def _(spark, sf):
    return topk.cold_start_bias(views.users(spark, sf).select("user_id"), views.item_factors(spark, sf), K)


ROUTED = {
    "asked": "SELECT DISTINCT user_id FROM events UNION SELECT vec_id FROM embeddings",
    "routed": """
SELECT f.user_id, f.rank, f.movie_id, 'bpr' AS strategy, 'v1' AS model_version FROM facrecs f
WHERE f.user_id IN (SELECT user_id FROM asked) AND f.user_id IN (SELECT user_id FROM train)
UNION ALL SELECT a.user_id, CAST(p.item_rank AS INT), p.movie_id, 'popularity_fallback', 'v1' FROM asked a CROSS JOIN popranked p
WHERE p.item_rank <= 10 AND a.user_id NOT IN (SELECT user_id FROM facrecs WHERE user_id IN (SELECT user_id FROM train))""",
}


def routed(spark, sf, shop: FactorShop, asked: DataFrame) -> DataFrame:
    return topk.route_users(asked, shop.seen, shop.lists(), topk.ranked_items(shop.popularity), K, "bpr", "v1")


@query("g7_route_users", with_views("SELECT user_id, rank, movie_id, strategy, model_version FROM routed", **ROUTED))
def _(spark, sf):
    """Every user who sent an event or has a vector."""
    shop = FactorShop(spark, sf)
    asked = views.table(spark, sf, "events").select("user_id").unionByName(shop.user_factors.select("user_id"))
    return routed(spark, sf, shop, asked)


@query("g8_fallback_order", with_views("""
SELECT 'baseline' AS source, movie_id, row_number() OVER (ORDER BY score DESC, interaction_count DESC, movie_id) AS item_rank FROM popularity
UNION ALL SELECT 'exposure', movie_id, row_number() OVER (ORDER BY exposure DESC, movie_id) FROM (SELECT movie_id, count(DISTINCT user_id) AS exposure FROM train GROUP BY movie_id) e
UNION ALL SELECT 'ids', movie_id, row_number() OVER (ORDER BY movie_id) FROM movies"""))
def _(spark, sf):
    """The order from each kind of source, reached when the ones before are absent or empty."""
    shop = Shop(spark, sf)
    exposure, ids = popularity.exposure_counts(shop.seen), views.movies(spark, sf).select("movie_id")
    empty = shop.popularity.filter(F.lit(False))
    chains = {"baseline": [shop.popularity, exposure, ids], "exposure": [None, exposure, ids], "ids": [empty, None, ids]}
    rows = [topk.fallback_order(c).select(F.lit(n).alias("source"), "movie_id", "item_rank") for n, c in chains.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


BATCH_SQL = with_views("""
SELECT e.event_id, e.user_id, l.strategy, l.model_version, l.recommendations FROM events e LEFT JOIN (
  SELECT user_id, min(strategy) AS strategy, min(model_version) AS model_version, string_agg(CAST(movie_id AS VARCHAR), ',' ORDER BY rank) AS recommendations
  FROM routed GROUP BY user_id) l ON l.user_id = e.user_id""", **ROUTED)


def batch_rows(spark, sf) -> DataFrame:
    shop = FactorShop(spark, sf)
    requests = views.table(spark, sf, "events").select("event_id", "user_id")
    return serve.batch_recommend(requests, routed(spark, sf, shop, requests))


@query("g9_batch_recommend", BATCH_SQL)
def _(spark, sf):
    return batch_rows(spark, sf).withColumn("recommendations", list_text("recommendations"))


@query("a11_batch_json_sink", BATCH_SQL)
def _(spark, sf):
    rows = batch_rows(spark, sf)
    path = writers.write_json(rows, fresh_path(spark, "batch"))
    return spark.read.schema(rows.schema).json(path).withColumn("recommendations", list_text("recommendations"))


@query("g10_attach_titles", with_views("SELECT r.user_id, r.rank, r.movie_id, m.title FROM poprecs r LEFT JOIN movies m ON m.movie_id = r.movie_id"))
def _(spark, sf):
    lists = popular_lists(Shop(spark, sf)).select("user_id", "rank", "movie_id")
    return serve.attach_titles(lists, views.movies(spark, sf))


ALPHAS = [0.0, 0.25, 0.5, 0.75, 1.0]
BLEND = {
    "alphas": "SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS alpha",
    "blended": """
SELECT s.user_id, a.alpha, s.movie_id, round(a.alpha * CASE WHEN s.max_score > s.min_score THEN (s.raw_score - s.min_score) / (s.max_score - s.min_score) ELSE 0 END
       + (1 - a.alpha) * coalesce(p.score_norm, 0), 6) AS score
FROM spread s CROSS JOIN alphas a LEFT JOIN popnorm p ON p.movie_id = s.movie_id""",
    "blendrecs": """
SELECT user_id, alpha, CAST(row_number() OVER (PARTITION BY user_id, alpha ORDER BY score DESC, movie_id) AS INT) AS rank, movie_id, score FROM blended
QUALIFY row_number() OVER (PARTITION BY user_id, alpha ORDER BY score DESC, movie_id) <= 10""",
    "modeltrain": "SELECT * FROM train WHERE user_id IN (SELECT user_id FROM ufactors)",
}


def blended(shop: FactorShop, alphas: list[float]) -> DataFrame:
    norm = popularity.normalized_popularity(shop.popularity)
    return hybrid.blended_top_k(shop.user_factors, shop.item_factors, shop.seen, norm, alphas, K, digits=6)


@query("g11_hybrid_blend", with_views("SELECT user_id, alpha, rank, movie_id, score FROM blendrecs", **BLEND))
def _(spark, sf):
    return blended(FactorShop(spark, sf), ALPHAS)


@query("g12_rating_display", with_views("""
SELECT user_id, rank, movie_id, round(CAST(least(greatest(raw_score + 3, 1), 5) AS DOUBLE), 1) AS score FROM facrecs"""))
def _(spark, sf):
    rows = FactorShop(spark, sf).lists()
    shown = serve.predicted_rating_display(F.col("raw_score") + 3)
    return rows.select("user_id", "rank", "movie_id", shown.alias("score"))


@query("g13_score_types", with_views("""
SELECT score_type, is_fallback, count(*) AS rows FROM (
  SELECT 'normalized_ranking' AS score_type, false AS is_fallback FROM facrecs
  UNION ALL SELECT 'predicted_rating', false FROM facrecs UNION ALL SELECT 'popularity_rating', true FROM poprecs) t GROUP BY score_type, is_fallback"""))
def _(spark, sf):
    shop = FactorShop(spark, sf)
    ranked = staged(shop.lists(), "lists")
    cold = topk.cold_start_unseen(shop.users, topk.ranked_items(shop.popularity), shop.seen, K)
    parts = [topk.with_display_score(ranked), topk.with_display_score(ranked, "predicted_rating"), cold]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("score_type", "is_fallback").agg(F.count(F.lit(1)).alias("rows"))


def history_sql(n: int) -> str:
    return f"""
SELECT t.user_id, t.rank, t.movie_id, coalesce(m.title, 'Unknown') AS title, printf('%.1f/5.0', t.rating) AS user_rating FROM (
  SELECT user_id, movie_id, rating, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, movie_id) AS INT) AS rank FROM ratings) t
LEFT JOIN movies m ON m.movie_id = t.movie_id WHERE t.rank <= {n}"""


@query("g14_watch_history", with_views(history_sql(10)))
def _(spark, sf):
    return serve.watch_history(views.ratings(spark, sf), views.movies(spark, sf), 10)


@query("g15_user_snapshot", with_views("""
SELECT user_id, count(*) AS watched, round(avg(CAST(regexp_extract(user_rating, '([0-9.]+)', 1) AS DOUBLE)), 6) AS mean_rating FROM history GROUP BY user_id""",
    history=history_sql(100)))
def _(spark, sf):
    history = serve.watch_history(views.ratings(spark, sf), views.movies(spark, sf), 100)
    return rounded(serve.user_snapshot(history), "mean_rating")


@query("g16_recommendation_listing", with_views(f"""
SELECT d.user_id, d.rank, coalesce(m.title, 'Unknown') AS title, coalesce(printf('%.2f', CASE WHEN d.movie_id % 7 = 0 THEN NULL ELSE d.score END), 'N/A') AS score_text
FROM shown d LEFT JOIN movies m ON m.movie_id = d.movie_id""", shown=DISPLAY_SQL))
def _(spark, sf):
    """Some scores are blanked to show the N/A text."""
    rows = rounded(topk.with_display_score(FactorShop(spark, sf).lists()), "score")
    blanked = rows.withColumn("score", F.when(F.col("movie_id") % 7 != 0, F.col("score")))
    return serve.recommendation_listing(blanked, views.movies(spark, sf))


# ---- metrics

METRIC_SQL = """users_evaluated, round(CAST(recall_at_k AS DOUBLE), 6) AS recall_at_k, round(CAST(map_at_k AS DOUBLE), 6) AS map_at_k,
round(CAST(hit_rate_at_k AS DOUBLE), 6) AS hit_rate_at_k, round(CAST(coverage AS DOUBLE), 6) AS coverage"""
METRIC_NAMES = ("recall_at_k", "map_at_k", "hit_rate_at_k", "coverage")
POP_METRICS = metric_ctes("poprecs")


@query("i1_relevant_sets", with_views("SELECT user_id, movie_id FROM relevant"))
def _(spark, sf):
    return metrics.relevant_pairs(views.part_of(spark, sf, "test"))


@query("i2_eligible_users", with_views("SELECT user_id FROM eligible", **POP_METRICS))
def _(spark, sf):
    shop = Shop(spark, sf)
    return metrics.eligible_users(metrics.relevant_pairs(shop.test), shop.train)


def _per_user(spark, sf) -> DataFrame:
    shop = Shop(spark, sf)
    relevant = metrics.relevant_pairs(shop.test)
    return metrics.user_metrics(popular_lists(shop), relevant, metrics.eligible_users(relevant, shop.train), K)


@query("i3_recall", with_views("SELECT user_id, relevant_items, hits, round(recall, 6) AS recall FROM peruser", **POP_METRICS))
def _(spark, sf):
    return rounded(_per_user(spark, sf).select("user_id", "relevant_items", "hits", "recall"), "recall")


@query("i4_average_precision", with_views("SELECT user_id, round(CAST(average_precision AS DOUBLE), 6) AS average_precision FROM peruser", **POP_METRICS))
def _(spark, sf):
    return rounded(_per_user(spark, sf).select("user_id", "average_precision"), "average_precision")


@query("i5_hit_rate", with_views("SELECT count(*) AS users, round(CAST(avg(hit) AS DOUBLE), 6) AS hit_rate FROM peruser", **POP_METRICS))
def _(spark, sf):
    rows = _per_user(spark, sf).agg(F.count(F.lit(1)).alias("users"), F.avg("hit").alias("hit_rate"))
    return rounded(rows, "hit_rate")


@query("i6_coverage", with_views("""
SELECT 'train' AS catalog, round(count(DISTINCT movie_id) / CAST((SELECT count(DISTINCT movie_id) FROM train) AS DOUBLE), 6) AS coverage FROM poprecs WHERE user_id IN (SELECT user_id FROM eligible)
UNION ALL SELECT 'metadata', round(count(DISTINCT movie_id) / CAST((SELECT count(DISTINCT movie_id) FROM movies) AS DOUBLE), 6) FROM poprecs WHERE user_id IN (SELECT user_id FROM eligible)""",
    **POP_METRICS))
def _(spark, sf):
    shop = Shop(spark, sf)
    users = metrics.eligible_users(metrics.relevant_pairs(shop.test), shop.train)
    lists = staged(popular_lists(shop), "lists")
    catalogs = {"train": shop.train, "metadata": views.movies(spark, sf)}
    rows = [metrics.coverage(lists, users, c, K).select(F.lit(n).alias("catalog"), "coverage") for n, c in catalogs.items()]
    return rounded(rows[0].unionByName(rows[1]), "coverage")


@query("i7_metric_record", with_views(f"SELECT {METRIC_SQL} FROM metrics", **POP_METRICS))
def _(spark, sf):
    shop = Shop(spark, sf)
    row = metrics.ranking_metrics(staged(popular_lists(shop), "lists"), shop.test, shop.train, shop.train, K)
    return rounded(row, *METRIC_NAMES)


def _strategy_sql(score: str, prefix: str) -> dict[str, str]:
    ctes = {
        "pop": f"SELECT movie_id, interaction_count, {score} AS score FROM popularity",
        "ranked": "SELECT *, row_number() OVER (ORDER BY score DESC, interaction_count DESC, movie_id) AS item_rank FROM pop",
        "recs": """SELECT u.user_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p.item_rank) AS rank, p.movie_id FROM trainusers u CROSS JOIN ranked p
          WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.movie_id = p.movie_id) QUALIFY row_number() OVER (PARTITION BY u.user_id ORDER BY p.item_rank) <= 10""",
        **metric_ctes("recs", "relevantval"),
    }
    return prefixed(prefix, ctes)


def strategy_metrics(spark, sf) -> list[tuple[str, DataFrame]]:
    shop = Shop(spark, sf)
    shop.users = staged(shop.users, "users")

    def lists(name: str) -> DataFrame:
        table = rounded(popularity.item_popularity(shop.train, name), "score", digits=9)
        return staged(topk.popular_unseen(shop.users, topk.ranked_items(table), shop.seen, K), "lists")

    names = ("most_popular", "weighted")
    found = side_by_side(spark, [lambda n=n: lists(n) for n in names])
    return [(n, metrics.ranking_metrics(df, shop.val, shop.train, shop.train, K)) for n, df in zip(names, found)]


STRATEGIES = {
    **_strategy_sql("CAST(interaction_count AS DOUBLE)", "a_"),
    **_strategy_sql("round(mean_rating * ln(1 + interaction_count), 9)", "b_"),
    "strategies": "SELECT 0 AS o, 'most_popular' AS model, * FROM a_metrics UNION ALL SELECT 1, 'weighted', * FROM b_metrics",
}


@query("i8_strategy_selection", with_views(f"SELECT model, {METRIC_SQL} FROM (SELECT * FROM strategies ORDER BY map_at_k DESC, o LIMIT 1) s", **STRATEGIES))
def _(spark, sf):
    """The popularity strategy with the best validation MAP; the first wins ties."""
    named = strategy_metrics(spark, sf)
    rows = metrics.compare_models(named).withColumn("o", F.when(F.col("model") == named[0][0], 0).otherwise(1))
    return rounded(metrics.best_row(rows, [F.desc("map_at_k")], "o").drop("o"), *METRIC_NAMES)


SWEEP = {**BLEND, **metric_ctes("blendrecs", "relevant", "ifactors", "alpha", "modeltrain")}
SWEEP_SQL = f"SELECT m.alpha, {METRIC_SQL} FROM metrics m JOIN covered c ON c.alpha = m.alpha"


def sweep(spark, sf) -> DataFrame:
    shop = FactorShop(spark, sf)
    lists = staged(blended(shop, ALPHAS), "lists")
    known = shop.train.join(shop.user_factors.select("user_id"), "user_id", "left_semi")
    return hybrid.alpha_sweep(lists, shop.test, known, shop.item_factors, K)


@query("i9_alpha_sweep", with_views(SWEEP_SQL, **SWEEP))
def _(spark, sf):
    return rounded(sweep(spark, sf), *METRIC_NAMES)


@query("i9_best_alpha", with_views(f"SELECT * FROM swept ORDER BY map_at_k DESC, recall_at_k DESC, alpha LIMIT 1", swept=SWEEP_SQL, **SWEEP))
def _(spark, sf):
    return hybrid.best_alpha(rounded(sweep(spark, sf), *METRIC_NAMES))


@query("i10_model_comparison", with_views(f"SELECT model, {METRIC_SQL} FROM strategies", **STRATEGIES))
def _(spark, sf):
    return rounded(metrics.compare_models(strategy_metrics(spark, sf)), *METRIC_NAMES)


def decision_ctes(current: str, candidate: str) -> dict[str, str]:
    """CTE ``decided`` over two one-row metric CTEs."""
    return {
        "paired": f"""SELECT round(a.recall_at_k, 9) AS current_recall_at_k, round(a.coverage, 9) AS current_coverage, round(b.recall_at_k, 9) AS candidate_recall_at_k, round(b.coverage, 9) AS candidate_coverage
FROM {current} a CROSS JOIN {candidate} b""",
        "decided": """SELECT *, candidate_recall_at_k - current_recall_at_k AS recall_at_k_delta, candidate_coverage - current_coverage AS coverage_delta,
 candidate_recall_at_k > current_recall_at_k + 1e-9 AS better,
 abs(candidate_recall_at_k - current_recall_at_k) <= 1e-9 AND candidate_coverage > current_coverage + 1e-9 AS wider FROM paired""",
    }


PAIR = {**STRATEGIES, **decision_ctes("a_metrics", "b_metrics")}


def promotion_row(spark, sf) -> DataFrame:
    (_a, current), (_b, candidate) = strategy_metrics(spark, sf)
    return metrics.promotion(rounded(current, "recall_at_k", "coverage", digits=9), rounded(candidate, "recall_at_k", "coverage", digits=9))


@query("i11_metric_deltas", with_views("SELECT round(CAST(recall_at_k_delta AS DOUBLE), 6) AS recall_at_k_delta, round(CAST(coverage_delta AS DOUBLE), 6) AS coverage_delta FROM decided", **PAIR))
def _(spark, sf):
    row = promotion_row(spark, sf).select("recall_at_k_delta", "coverage_delta")
    return rounded(row, "recall_at_k_delta", "coverage_delta")


REASON_SQL = """CASE WHEN better THEN printf('New model: recall_at_k improved (%.6f, then %.6f).', CAST(current_recall_at_k AS DOUBLE), CAST(candidate_recall_at_k AS DOUBLE))
 WHEN wider THEN printf('New model: same recall, coverage improved (%.6f, then %.6f).', CAST(current_coverage AS DOUBLE), CAST(candidate_coverage AS DOUBLE))
 ELSE printf('Old model: the new one did not satisfy promotion rule (recall %.6f against %.6f, coverage %.6f against %.6f).',
   CAST(candidate_recall_at_k AS DOUBLE), CAST(current_recall_at_k AS DOUBLE), CAST(candidate_coverage AS DOUBLE), CAST(current_coverage AS DOUBLE)) END AS reason"""


@query("i12_promotion_decision", with_views(f"SELECT better OR wider AS promote, {REASON_SQL} FROM decided", **PAIR))
def _(spark, sf):
    return promotion_row(spark, sf).select("promote", "reason")


FROZEN = {
    "modeltrain": BLEND["modeltrain"],
    **prefixed("p_", metric_ctes("poprecs", known="modeltrain")),
    **prefixed("f_", metric_ctes("facrecs", "relevant", "ifactors", known="modeltrain")),
    **decision_ctes("p_metrics", "f_metrics"),
}
DECISION_COLUMNS = ["current_recall_at_k", "current_coverage", "candidate_recall_at_k", "candidate_coverage", "recall_at_k_delta", "coverage_delta"]


@query("i13_candidate_evaluation", with_views(
    "SELECT " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in DECISION_COLUMNS) + f", better OR wider AS promote, {REASON_SQL} FROM decided", **FROZEN))
def _(spark, sf):
    """Factor model against popularity on the frozen test rows of the model's users, with the decision."""
    shop = FactorShop(spark, sf)
    known = shop.train.join(shop.user_factors.select("user_id"), "user_id", "left_semi")
    old = metrics.ranking_metrics(staged(popular_lists(shop), "lists"), shop.test, known, shop.train, K)
    new = metrics.ranking_metrics(staged(shop.lists(), "lists"), shop.test, known, shop.item_factors, K)
    names = ("recall_at_k", "coverage")
    row = metrics.promotion(rounded(old, *names, digits=9), rounded(new, *names, digits=9))
    return rounded(row, *DECISION_COLUMNS)
