"""Queries: bias and factor models, pairwise ranking, content model."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, functions as F

from rankloom.functions.text import item_text, terms, tokens
from rankloom.operators import bpr, clean, content, mf, metrics, search, sgd, topk
from rankloom.operators.skew import spread
from rankloom.plans import views
from rankloom.plans.registry import query
from rankloom.plans.serving import K, METRIC_NAMES, METRIC_SQL, Shop
from rankloom.plans.sql import materialized, metric_ctes, scale_sql, term_rows, token_sql, with_views
from rankloom.plans.staging import rounded
from rankloom.session import side_by_side, staged

# ---- bias model and factorisation

BIAS = {
    "mu": "SELECT avg(rating) AS mean FROM train",
    "itembias": "SELECT movie_id, sum(rating - (SELECT mean FROM mu)) / (count(*) + 10.0) AS b FROM train GROUP BY movie_id",
    "userbias": """SELECT t.user_id, sum(t.rating - (SELECT mean FROM mu) - i.b) / (count(*) + 10.0) AS b
FROM train t JOIN itembias i ON i.movie_id = t.movie_id GROUP BY t.user_id""",
    "baselined": """SELECT v.user_id, v.movie_id, v.rating, (SELECT mean FROM mu) + coalesce(u.b, 0) + coalesce(i.b, 0) AS baseline
FROM val v LEFT JOIN userbias u ON u.user_id = v.user_id LEFT JOIN itembias i ON i.movie_id = v.movie_id""",
}


@query("h1_bias_predictor", materialized(with_views("SELECT user_id, movie_id, rating, round(CAST(baseline AS DOUBLE), 6) AS baseline FROM baselined", **BIAS)))
def _(spark, sf):
    shop = Shop(spark, sf)
    return rounded(mf.with_biases(shop.val.select("user_id", "movie_id", "rating"), mf.fit_biases(shop.train)), "baseline")


SIZES = "(SELECT count(DISTINCT user_id) FROM train) AS users, (SELECT count(DISTINCT movie_id) FROM train) AS items"


def _sizes(model_users: DataFrame, model_items: DataFrame) -> DataFrame:
    return model_users.agg(F.count(F.lit(1)).alias("users")).withColumn("items", model_items.agg(F.count(F.lit(1))).scalar())


@query("h2_factorization", with_views(f"SELECT {SIZES}, true AS rmse_in_scale"))
def _(spark, sf):
    """Alternating fit on train: ids with factors, and whether the RMSE of validation predictions lies within the scale."""
    shop = Shop(spark, sf)
    model = mf.fit_factors(shop.train, rank=50, iterations=20)
    error = mf.rmse(mf.predict(shop.val, model.users, model.items, model.biases.mean))
    return _sizes(model.users, model.items).withColumn("rmse_in_scale", error.select(F.col("rmse").between(0.0, 4.0)).scalar())


@query("h2_stochastic_factorization", with_views(f"SELECT {SIZES}, 100 AS least_rank, 100 AS most_rank, true AS learned"))
def _(spark, sf):
    """Stochastic fit on train with the default settings: ids with factors, their ranks, and whether it beats the mean on train."""
    train = staged(views.part_of(spark, sf, "train"), "train")
    layout = sgd.lay_out(train)
    state = sgd.fit_sgd(layout, rank=100, epochs=25, rate=0.005, reg=0.02)
    users = staged(sgd.factor_table(state, sgd.USERS, "user_id", layout.mean).drop("epoch"), "users")
    items = staged(sgd.factor_table(state, sgd.ITEMS, "movie_id").drop("epoch"), "items")
    sgd.discard(spark, layout)
    error = mf.rmse(mf.predict(train, users, items, layout.mean)).scalar()
    ranks = users.select(F.size("factors").alias("n")).unionByName(items.select(F.size("factors").alias("n")))
    ranks = ranks.agg(F.struct(F.min("n").alias("least"), F.max("n").alias("most"))).scalar()
    row = _sizes(users, items).withColumns({"_r": ranks, "learned": error < train.agg(F.stddev_pop("rating")).scalar()})
    return row.select("users", "items", F.col("_r.least").alias("least_rank"), F.col("_r.most").alias("most_rank"), "learned")


PREDICTED = {
    "predicted": """SELECT v.user_id, v.movie_id, v.rating, least(greatest(3.0 * CAST(u.user_id IS NULL AS INT) + coalesce(u.bias + 3.0, 0) + coalesce(i.bias, 0)
  + coalesce(list_dot_product(u.factors, i.factors), 0), 1), 5) AS prediction
FROM val v LEFT JOIN ufactors u ON u.user_id = v.user_id LEFT JOIN ifactors i ON i.movie_id = v.movie_id""",
}


def _predicted(spark, sf) -> DataFrame:
    users = views.user_factors(spark, sf).withColumn("bias", F.col("bias") + 3.0)
    val = views.part_of(spark, sf, "val").select("user_id", "movie_id", "rating")
    return mf.predict(val, users, views.item_factors(spark, sf), 3.0)


@query("h3_rating_prediction", with_views("SELECT user_id, movie_id, rating, round(CAST(prediction AS DOUBLE), 6) AS prediction FROM predicted", **PREDICTED))
def _(spark, sf):
    return rounded(_predicted(spark, sf), "prediction")


@query("h4_rmse", with_views("SELECT round(CAST(coalesce(sqrt(avg((rating - prediction) ** 2)), 0) AS DOUBLE), 6) AS rmse FROM predicted", **PREDICTED))
def _(spark, sf):
    return rounded(mf.rmse(_predicted(spark, sf)), "rmse")


DAMPING = [1.0, 5.0, 10.0, 25.0]
GRID = {
    "mu": BIAS["mu"],
    "grid": "SELECT unnest([1.0, 5.0, 10.0, 25.0])::DOUBLE AS damping",
    "itembias": "SELECT g.damping, movie_id, sum(rating - (SELECT mean FROM mu)) / (count(*) + g.damping) AS b FROM train CROSS JOIN grid g GROUP BY g.damping, movie_id",
    "userbias": """SELECT i.damping, t.user_id, sum(t.rating - (SELECT mean FROM mu) - i.b) / (count(*) + i.damping) AS b
FROM train t JOIN itembias i ON i.movie_id = t.movie_id GROUP BY i.damping, t.user_id""",
    "gridscored": """SELECT g.damping, sqrt(avg((v.rating - least(greatest((SELECT mean FROM mu) + coalesce(u.b, 0) + coalesce(i.b, 0), 1), 5)) ** 2)) AS rmse
FROM val v CROSS JOIN grid g LEFT JOIN userbias u ON u.user_id = v.user_id AND u.damping = g.damping
LEFT JOIN itembias i ON i.movie_id = v.movie_id AND i.damping = g.damping GROUP BY g.damping""",
}


def _grid_scores(spark, sf) -> DataFrame:
    shop = Shop(spark, sf)
    out = None
    for settings in mf.candidate_grid({"damping": DAMPING}, {"damping": 10.0}):
        guess = mf.with_biases(shop.val.select("user_id", "movie_id", "rating"), mf.fit_biases(shop.train, **settings))
        clipped = F.least(F.greatest(F.col("baseline"), F.lit(1.0)), F.lit(5.0))
        row = mf.rmse(guess.withColumn("prediction", clipped)).withColumn("damping", F.lit(settings["damping"]))
        out = row if out is None else out.unionByName(row)
    return rounded(out, "rmse")


@query("h5_candidate_grid", with_views("SELECT damping, round(CAST(rmse AS DOUBLE), 6) AS rmse FROM gridscored", **GRID))
def _(spark, sf):
    """Every grid setting of the bias model with its validation RMSE."""
    return _grid_scores(spark, sf)


@query("h6_candidate_selection", with_views("SELECT damping, round(CAST(rmse AS DOUBLE), 6) AS rmse FROM gridscored ORDER BY 2, 1 LIMIT 1", **GRID))
def _(spark, sf):
    return metrics.best_row(_grid_scores(spark, sf), [F.asc("rmse")], "damping")


# The grid of the search and its base setting.
SEARCH_SPACE = {"n_factors": [20, 50, 100, 150], "n_epochs": [20, 40, 60], "lr_all": [0.002, 0.003, 0.005, 0.007], "reg_all": [0.02, 0.05, 0.08]}
SEARCH_BASE = {"n_factors": 100, "n_epochs": 25, "lr_all": 0.005, "reg_all": 0.02}
_AXES = {name: f"SELECT unnest({values}) AS {name}, unnest(range({len(values)})) AS i_{name}" for name, values in SEARCH_SPACE.items()}
SEARCH = {
    **{f"axis_{name}": sql for name, sql in _AXES.items()},
    "fullgrid": f"""SELECT row_number() OVER (ORDER BY {', '.join(f'i_{n}' for n in SEARCH_SPACE)}) - 1 AS candidate, {', '.join(SEARCH_SPACE)}
FROM axis_n_factors CROSS JOIN axis_n_epochs CROSS JOIN axis_lr_all CROSS JOIN axis_reg_all
UNION ALL SELECT 144, {', '.join(str(v) for v in SEARCH_BASE.values())}""",
    "evaluated": "SELECT count(DISTINCT user_id) AS n FROM relevantval WHERE user_id IN (SELECT user_id FROM train)",
}


@query("h6_factor_search", with_views("""
SELECT CAST(candidate AS INTEGER) AS candidate, CAST(n_factors AS INTEGER) AS n_factors, CAST(n_epochs AS INTEGER) AS n_epochs,
       CAST(lr_all AS DOUBLE) AS lr_all, CAST(reg_all AS DOUBLE) AS reg_all, e.n AS users_evaluated, true AS measured
FROM fullgrid CROSS JOIN evaluated e""", **SEARCH))
def _(spark, sf):
    """Every candidate of the grid, fitted and scored; whether its measures are all there and within their ranges."""
    shop = Shop(spark, sf)
    found = search.search_factors(shop.train, shop.val, SEARCH_SPACE, SEARCH_BASE, K)
    inside = F.col("rmse").between(1e-9, 4.0)
    for name in search.METRICS:
        inside = inside & F.col(name).between(0.0, 1.0)
    return found.select("candidate", *SEARCH_SPACE, "users_evaluated", F.coalesce(inside, F.lit(False)).alias("measured"))


# ---- pairwise ranking

#: The rounds of the candidate mixing; a round refers to the column before it.
MIX = [
    f"(h{i} * h{i} + h{i} * 48271 + ({value}) % 2147483647 + 12345) % 2147483647"
    for i, value in enumerate(("p.movie_id", "t.t", "0", "0", "0"))
]

NEGATIVES = {
    "pos": "SELECT DISTINCT user_id, movie_id FROM train WHERE rating >= 4",
    "items": "SELECT movie_id, row_number() OVER (ORDER BY movie_id) - 1 AS idx FROM (SELECT DISTINCT movie_id FROM train) m",
    "posidx": "SELECT p.user_id, i.idx FROM pos p JOIN items i ON i.movie_id = p.movie_id",
    "candidates": """SELECT p.user_id, p.movie_id, p.t, h % (SELECT count(*) FROM items) AS c
FROM (SELECT p.user_id, p.movie_id, t.t, p.user_id % 2147483647 AS h0, {0} AS h1, {1} AS h2, {2} AS h3, {3} AS h4, {4} AS h
FROM pos p CROSS JOIN (SELECT unnest(range(100)) AS t) t) p""".format(*MIX),
    "free": """SELECT user_id, movie_id, arg_min(c, t) AS c FROM candidates k
WHERE NOT EXISTS (SELECT 1 FROM posidx x WHERE x.user_id = k.user_id AND x.idx = k.c) GROUP BY user_id, movie_id""",
    "neg": "SELECT f.user_id, f.movie_id, i.movie_id AS negative FROM free f JOIN items i ON i.idx = f.c",
}


def _negatives(spark, sf) -> DataFrame:
    train = staged(views.train(spark, sf), "train")
    liked = bpr.positives(train)
    items = staged(clean.id_map(train, "movie_id", "movie_idx"), "items")
    return bpr.sample_negatives(liked, liked, items, items.count())


@query("h7_positives", with_views("SELECT user_id, movie_id FROM pos", **NEGATIVES))
def _(spark, sf):
    return bpr.positives(staged(views.train(spark, sf), "train"))


@query("h8_negative_sampling", with_views("SELECT user_id, movie_id, negative FROM neg", **NEGATIVES))
def _(spark, sf):
    return _negatives(spark, sf)


DRAWS = {
    **NEGATIVES,
    "placed": "SELECT user_id, movie_id, row_number() OVER (ORDER BY user_id, movie_id) - 1 AS place FROM pos",
    "size": "SELECT count(*) AS n FROM pos",
    "drawn": """SELECT h4 % n AS place, count(*) AS copies FROM (
  SELECT n, id % 2147483647 AS h0, (h0 * h0 + h0 * 48271 + 42 + 12345) % 2147483647 AS h1, (h1 * h1 + h1 * 48271 + 1 + 12345) % 2147483647 AS h2,
         (h2 * h2 + h2 * 48271 + 12345) % 2147483647 AS h3, (h3 * h3 + h3 * 48271 + 12345) % 2147483647 AS h4
  FROM size CROSS JOIN LATERAL (SELECT unnest(range(greatest(5000, n))) AS id) r) d GROUP BY 1""",
}


@query("h9_triplet_sampling", with_views("SELECT p.user_id, p.movie_id, d.copies FROM drawn d JOIN placed p ON p.place = d.place", **DRAWS))
def _(spark, sf):
    """One epoch's draws with replacement: as many as there are positives, at least 5,000."""
    liked = staged(bpr.positives(staged(views.train(spark, sf), "train")), "liked")
    placed = staged(bpr.global_position(liked, ["user_id", "movie_id"], "_pos"), "placed")
    total = placed.count()
    return bpr.draw_positives(placed, total, max(5000, total), seed=42, epoch=1)


LOSS = {
    **NEGATIVES,
    "triplets": """SELECT n.user_id, n.movie_id, n.negative, list_dot_product(u.factors, i.factors) - list_dot_product(u.factors, j.factors) + i.bias - j.bias AS x,
  u.factors AS uf, i.factors AS pf, j.factors AS nf
FROM neg n JOIN ufactors u ON u.user_id = n.user_id JOIN ifactors i ON i.movie_id = n.movie_id JOIN ifactors j ON j.movie_id = n.negative""",
    "stepped": "SELECT *, 1.0 / (exp(-x) + 1) AS sig FROM triplets",
}


@query("h10_bpr_loss", with_views("""
SELECT user_id, movie_id, negative, round(x, 6) AS margin, round(-ln(greatest(sig, 1e-12)), 6) AS loss, round(1 - sig, 6) AS step,
       round(sqrt(list_sum(list_transform(range(1, len(uf) + 1), lambda d: ((1 - sig) * (pf[d] - nf[d]) - 0.001 * uf[d]) ** 2))), 6) AS user_gradient_norm
FROM stepped""", **LOSS))
def _(spark, sf):
    rows = bpr.triplet_loss(_negatives(spark, sf), views.user_factors(spark, sf), views.item_factors(spark, sf))
    return rounded(rows, "margin", "loss", "step", "user_gradient_norm")


@query("h11_bpr_fit", with_views(f"""SELECT {SIZES}, (SELECT n FROM evaluated) AS users_evaluated, true AS best_is_first_maximum,
       true AS stopped_in_time, CAST(0 AS BIGINT) AS seen_in_lists""", **SEARCH))
def _(spark, sf):
    """Training until validation stops improving, at most 30 epochs: what must hold of the model and its history.

    ``best_is_first_maximum``: the factors are those of the earliest epoch of greatest MAP; ``stopped_in_time``: epochs 1 to the
    last one are there and it is the 30th or the fifth after the best; ``seen_in_lists``: recommended items that were seen.
    """
    shop = Shop(spark, sf)
    epochs, patience = 30, 5
    model = bpr.fit_bpr(shop.train, shop.val, rank=64, rate=0.03, reg=0.001, epochs=epochs, samples=200_000, patience=patience)
    best = model.history.agg(F.max_by("epoch", F.struct("map_at_k", -F.col("epoch"))).alias("best"), F.max("epoch").alias("last"), F.count(F.lit(1)).alias("n"), F.max("users_evaluated").alias("users_evaluated"))
    users, items = staged(model.users, "users"), staged(model.items, "items")
    counted = metrics.eligible_users(metrics.relevant_pairs(shop.val), shop.train)
    recs = topk.factor_top_k(users.join(counted, "user_id", "left_semi"), items, shop.seen, K)
    known = recs.join(shop.seen, ["user_id", "movie_id"], "left_semi").agg(F.count(F.lit(1))).scalar()
    facts = best.select(
        "users_evaluated", (F.col("best") == model.best_epoch).alias("best_is_first_maximum"),
        ((F.col("last") == F.col("n")) & (F.col("last") == F.least(F.lit(epochs), F.lit(model.best_epoch + patience)))).alias("stopped_in_time"),
    )
    return _sizes(users, items).crossJoin(facts).withColumn("seen_in_lists", known)


# ---- content model

@query("h12_item_text", with_views("SELECT movie_id, text FROM itemtext"))
def _(spark, sf):
    return content.build_item_text(views.movies(spark, sf))


@query("h13_tokens", with_views(f"""
SELECT movie_id, array_to_string(w, '|') AS tokens, CAST(len(w) AS INT) AS n_tokens FROM (SELECT movie_id, {token_sql('text')} AS w FROM itemtext) t"""))
def _(spark, sf):
    movies = views.movies(spark, sf)
    words = tokens(item_text(F.col("title"), F.col("genres")))
    return movies.select("movie_id", words.alias("w")).select("movie_id", F.concat_ws("|", "w").alias("tokens"), F.size("w").alias("n_tokens"))


@query("h13_document_terms", f"""
SELECT doc_id, CAST(len(w) AS INT) AS n_tokens, CAST(len(w) + greatest(len(w) - 1, 0) AS INT) AS n_terms, md5(array_to_string(w, ' ')) AS digest
FROM (SELECT doc_id, {token_sql('text')} AS w FROM documents) t""")
def _(spark, sf):
    """Whole documents: token and term counts and a digest of the tokens."""
    docs = spread(views.table(spark, sf, "documents")).select("doc_id", tokens(F.col("text")).alias("w"))
    return docs.select("doc_id", F.size("w").alias("n_tokens"), F.size(terms(F.col("w"))).alias("n_terms"), F.md5(F.concat_ws(" ", "w")).alias("digest"))


@query("h14_vocabulary", with_views("SELECT term, df, corpus_count FROM vocab"))
def _(spark, sf):
    return content.vocabulary(content.term_counts(content.build_item_text(views.movies(spark, sf))), max_features=TERMS)


#: Fixed value: size of the vocabulary these queries reproduce.
TERMS = 12000

DOCUMENTS = {
    "docterms": term_rows("documents", "doc_id", "text"),
    "docvocab": "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS corpus_count FROM docterms GROUP BY term HAVING count(*) >= 2 ORDER BY corpus_count DESC, term LIMIT 12000",
    "docraw": "SELECT c.doc_id, c.term, c.tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + v.df)) + 1) AS raw FROM docterms c JOIN docvocab v ON c.term = v.term",
}


@query("h14_document_vocabulary", with_views("SELECT term, df, corpus_count FROM docvocab", **DOCUMENTS))
def _(spark, sf):
    docs = views.table(spark, sf, "documents").select("doc_id", "text")
    return content.vocabulary(content.term_counts(spread(docs, "doc_id"), "doc_id"), max_features=TERMS)


@query("h15_tfidf", with_views("SELECT movie_id, term, round(CAST(weight AS DOUBLE), 6) AS weight FROM weights"))
def _(spark, sf):
    vectors = content.item_vectors(views.movies(spark, sf), max_features=TERMS)
    return rounded(vectors.weights.select("movie_id", "term", "weight"), "weight")


@query("h15_document_tfidf", with_views("SELECT doc_id, term, round(CAST(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS DOUBLE), 6) AS weight FROM docraw", **DOCUMENTS))
def _(spark, sf):
    docs = views.table(spark, sf, "documents")
    counts = staged(content.term_counts(spread(docs.select("doc_id", "text"), "doc_id"), "doc_id"), "terms")
    vocabulary = staged(content.vocabulary(counts, max_features=TERMS), "vocabulary")
    return rounded(content.tfidf(counts, vocabulary, docs.count(), "doc_id", bounded=True), "weight")


class ContentShop(Shop):
    """``beside``: what else to compute while the profiles are made; the results are in ``others``."""

    def __init__(self, spark, sf, *beside: Callable[[Shop], Any]):
        def vectors() -> tuple[DataFrame, DataFrame]:
            made = content.item_vectors(views.movies(spark, sf), max_features=TERMS)
            return made.vocabulary, staged(made.packed, "items")

        # the split and the item vectors share nothing
        shop = super()
        _, (self.vocabulary, self.items) = side_by_side(spark, [lambda: shop.__init__(spark, sf), vectors])
        self.profiles, *self.others = side_by_side(
            spark, [lambda: staged(content.user_profiles(self.train, self.items), "profiles"), *(lambda f=f: f(self) for f in beside)]
        )

    def lists(self, k: int = K) -> DataFrame:
        return content.similar_top_k(self.profiles, self.items, self.seen, k, digits=6, ranged=False)


@query("h16_user_profile", with_views("SELECT user_id, term, round(CAST(weight AS DOUBLE), 6) AS weight FROM profile"))
def _(spark, sf):
    shop = ContentShop(spark, sf)
    entries = shop.profiles.select("user_id", F.explode(F.arrays_zip("user_terms", "user_weights")).alias("e"))
    named = entries.join(F.broadcast(shop.vocabulary), F.col("e.user_terms") == F.col("term_idx"))
    return rounded(named.select("user_id", "term", F.col("e.user_weights").alias("weight")), "weight")


@query("h17_similarity_top_k", with_views(f"""
SELECT user_id, rank, movie_id, raw_score, round(CAST({scale_sql()} AS DOUBLE), 1) AS score, 'normalized_similarity' AS score_type, false AS is_fallback FROM simrecs
UNION ALL SELECT r.user_id, r.rank, r.movie_id, CAST(11 - r.rank AS DOUBLE), 3.0, 'popularity_rating', true FROM poprecs r WHERE r.user_id NOT IN (SELECT user_id FROM profile)"""))
def _(spark, sf):
    shop = ContentShop(spark, sf)
    ranked = topk.ranked_items(shop.popularity)
    return content.content_recommendations(shop.profiles, shop.items, shop.seen, ranked, shop.users, K, digits=6)


@query("h17_content_metrics", with_views(f"SELECT {METRIC_SQL} FROM metrics", **metric_ctes("simrecs", "relevant", "movies")))
def _(spark, sf):
    """The content model's metric record; its catalog is all metadata items."""
    shop = ContentShop(spark, sf)
    lists = staged(shop.lists().select("user_id", "rank", "movie_id"), "lists")
    return rounded(metrics.ranking_metrics(lists, shop.test, shop.train, views.movies(spark, sf), K), *METRIC_NAMES)
