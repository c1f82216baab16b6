"""Learned models on planted data; sampling and loss."""

import math

import pytest
from pyspark.sql import functions as F

from rankloom.operators import bpr, clean, content, metrics, mf, popularity, topk
from rankloom.operators.skew import spread


@pytest.fixture(scope="module")
def planted(spark):
    """Users like items of their own group; one liked item per user is held out."""
    train, held = [], []
    for u in range(40):
        mine = [m for m in range(32) if m % 4 == u % 4]
        hidden = mine[u // 4 % len(mine)]
        for m in range(32):
            if m == hidden:
                held.append((u, m, 5.0))
            elif m % 4 == u % 4:
                train.append((u, m, 5.0))
            elif (u * 5 + m * 3) % 7 < 2:
                train.append((u, m, 2.0))
    schema = "user_id long, movie_id long, rating double"
    return spark.createDataFrame(train, schema), spark.createDataFrame(held, schema)


def map_of(recs, held, train):
    return metrics.ranking_metrics(recs, held, train, train, 10).first()["map_at_k"]


def popular_map(train, held):
    items = topk.ranked_items(popularity.item_popularity(train))
    recs = topk.popular_unseen(train.select("user_id").distinct(), items, popularity.seen_pairs(train), 10)
    return map_of(recs, held, train)


def test_bpr_beats_popularity_and_repeats(planted):
    train, held = planted
    settings = dict(rank=8, rate=0.1, epochs=5, samples=6000, patience=5, block_triplets=3000)
    model = bpr.fit_bpr(train, held, **settings)
    history = [r["map_at_k"] for r in model.history.orderBy("epoch").collect()]
    recs = topk.factor_top_k(model.users, model.items, popularity.seen_pairs(train), 10)
    best = map_of(recs, held, train)
    assert best == pytest.approx(max(history)) and best >= history[0]
    assert best > popular_map(train, held) + 0.1
    seen = train.select("user_id", "movie_id")
    assert recs.join(seen, ["user_id", "movie_id"], "left_semi").count() == 0
    again = bpr.fit_bpr(train, held, **{**settings, "epochs": 1})
    assert [r["map_at_k"] for r in again.history.collect()] == history[:1]


def test_factorisation_beats_popularity(planted):
    train, held = planted
    model = mf.fit_factors(train, rank=4, iterations=8, reg=0.05)
    recs = topk.factor_top_k(model.users, model.items, popularity.seen_pairs(train), 10)
    assert map_of(recs, held, train) > popular_map(train, held)
    error = mf.rmse(mf.predict(held, model.users, model.items, model.biases.mean)).first()[0]
    flat = mf.rmse(held.withColumn("prediction", F.lit(model.biases.mean))).first()[0]
    assert error < flat


def test_unknown_ids_get_the_mean(spark, planted):
    model = mf.fit_biases(planted[0])
    pair = spark.createDataFrame([(999, 999)], "user_id long, movie_id long")
    assert mf.with_biases(pair, model).first()["baseline"] == pytest.approx(model.mean)
    empty = mf.rmse(planted[0].limit(0).withColumn("prediction", F.lit(1.0)))
    assert empty.first()[0] == 0.0


def test_no_positive_is_an_error(planted):
    with pytest.raises(ValueError):
        bpr.positives(planted[0], threshold=6.0)


def brute_negative(u, m, liked, n, tries):
    for t in range(tries):
        h, p = u, 2**31 - 1
        for value in (m, t, 0, 0, 0):
            h = (h * h + h * 48271 + value + 12345) % p
        c = h % n
        if (u, c) not in liked:
            return c
    return next((c for c in range(n) if (u, c) not in liked), 0)


@pytest.mark.parametrize("tries", [1, 3, 6, 100])
def test_negatives_against_brute_force(spark, tries):
    """User 0 likes everything, user 1 all but the last item."""
    n = 12
    liked = {(0, m) for m in range(n)} | {(1, m) for m in range(n - 1)} | {(u, m) for u in range(2, 9) for m in range(n) if (u + m) % 3}
    pairs = spark.createDataFrame(sorted(liked), "user_id long, movie_id long")
    items = clean.id_map(spark.createDataFrame([(m,) for m in range(n)], "movie_id long"), "movie_id", "movie_idx")
    got = {(r[0], r[1]): r[2] for r in bpr.sample_negatives(pairs, pairs, items, n, tries=tries).collect()}
    assert got == {(u, m): brute_negative(u, m, liked, n, tries) for u, m in liked}


@pytest.mark.parametrize("n", [1000, 7919, 104729])
def test_candidates_spread_for_any_catalog_size(spark, n):
    index = bpr.candidate_index(F.col("id"), F.lit(5).cast("long"), F.lit(0).cast("long"), n, 1, F.lit(2).cast("long"))
    counts = spark.range(20_000).select((index * 10 / n).cast("int").alias("part")).groupBy("part").count().collect()
    assert len(counts) == 10 and all(1700 < r["count"] < 2300 for r in counts)
    assert spark.range(200).select(index).distinct().count() > 170


def test_every_draw_has_its_own_negative(spark):
    liked = spark.createDataFrame([(1, 0)], "user_id long, movie_id long")
    items = clean.id_map(spark.createDataFrame([(m,) for m in range(500)], "movie_id long"), "movie_id", "movie_idx")
    draws = spark.range(100).select(F.lit(1).cast("long").alias("user_id"), F.lit(0).cast("long").alias("movie_id"), F.col("id").alias("draw"))
    got = bpr.sample_negatives(draws, liked, items, 500)
    assert got.count() == 100 and got.select("negative").distinct().count() > 70


def test_draws_add_up(spark):
    placed = spark.createDataFrame([(u, u, u) for u in range(20)], "user_id long, movie_id long, _pos long")
    drawn = bpr.draw_positives(placed, 20, 500, 1, 1)
    assert drawn.agg(F.sum("copies")).first()[0] == 500
    assert sorted(drawn.collect()) == sorted(bpr.draw_positives(placed, 20, 500, 1, 1).collect())


def test_loss_at_zero_margin(spark):
    zero = spark.createDataFrame([(1, [0.0, 0.0], 0.0)], "user_id long, factors array<double>, bias double")
    items = spark.createDataFrame([(1, [1.0, 2.0], 0.0), (2, [3.0, 1.0], 0.0)], "movie_id long, factors array<double>, bias double")
    triplet = spark.createDataFrame([(1, 1, 2)], "user_id long, movie_id long, negative long")
    assert bpr.triplet_loss(triplet, zero, items).first()["loss"] == pytest.approx(math.log(2))


def test_tfidf_against_hand_values(spark):
    texts = spark.createDataFrame([(1, "red fox"), (2, "red red dog"), (3, "the dog")], "movie_id long, text string")
    counts = content.term_counts(texts)
    vocab = content.vocabulary(counts, 2, None)
    assert {(r["term"], r["df"], r["corpus_count"]) for r in vocab.collect()} == {("red", 2, 3), ("dog", 2, 2)}
    idf = math.log(4 / 3) + 1
    weight = {(r[0], r[1]): r[2] for r in content.tfidf(counts, vocab, 3).collect()}
    norm = math.hypot(2 * idf, idf)
    assert weight[(1, "red")] == pytest.approx(1.0)
    assert weight[(2, "red")] == pytest.approx(2 * idf / norm) and weight[(2, "dog")] == pytest.approx(idf / norm)


def test_unbounded_vocabulary_gives_the_same_vectors(spark):
    movies = spark.createDataFrame([(i, f"red fox {i % 3}x", "A|B") for i in range(9)], "movie_id long, title string, genres string")
    small, whole = content.item_vectors(movies, 2, 1000), content.item_vectors(movies, 2, None)
    pick = lambda v: sorted((r["movie_id"], r["term"], r["term_idx"], round(r["weight"], 9)) for r in v.weights.collect())
    assert pick(small) == pick(whole)


def test_user_without_liked_items_uses_all(spark):
    rated = spark.createDataFrame([(1, 1, 5.0), (1, 2, 2.0), (2, 1, 3.0), (2, 2, 1.0)], "user_id long, movie_id long, rating double")
    assert sorted(tuple(r) for r in content.liked_ratings(rated).select("user_id", "movie_id").collect()) == [(1, 1), (2, 1), (2, 2)]


def test_items_without_common_terms_fill_the_list(spark):
    profiles = spark.createDataFrame([(1, [0], [1.0])], "user_id long, user_terms array<long>, user_weights array<double>")
    items = spark.createDataFrame(
        [(1, [0], [1.0]), (2, [0], [0.5]), (3, [], []), (4, [1], [1.0])], "movie_id long, item_terms array<long>, item_weights array<double>"
    )
    seen = spark.createDataFrame([(1, 1)], "user_id long, movie_id long")
    got = [(r["movie_id"], r["raw_score"], r["min_score"]) for r in content.similar_top_k(profiles, items, seen, 3).orderBy("rank").collect()]
    assert got == [(2, 0.5, 0.0), (3, 0.0, 0.0), (4, 0.0, 0.0)]


def test_registered_fits_use_the_settings_of_the_reference(spark, sf_dir, monkeypatch):
    from rankloom.plans import models
    from rankloom.plans.registry import QUERIES

    class Seen(Exception):
        pass

    def stop(*args, **settings):
        raise Seen(args, settings)

    monkeypatch.setattr(models.bpr, "fit_bpr", stop)
    monkeypatch.setattr(models.mf, "fit_factors", stop)
    monkeypatch.setattr(models.sgd, "fit_sgd", stop)
    monkeypatch.setattr(models.search, "search_factors", stop)
    found = {}
    for name in ("h2_factorization", "h2_stochastic_factorization", "h6_factor_search", "h11_bpr_fit"):
        with pytest.raises(Seen) as caught:
            QUERIES[name](spark, sf_dir)
        found[name] = caught.value.args
    assert found["h11_bpr_fit"][1] == dict(rank=64, rate=0.03, reg=0.001, epochs=30, samples=200_000, patience=5)
    assert found["h2_factorization"][1] == dict(rank=50, iterations=20)
    assert found["h2_stochastic_factorization"][1] == dict(rank=100, epochs=25, rate=0.005, reg=0.02)
    grid = mf.candidate_grid(*found["h6_factor_search"][0][2:4])
    assert len(grid) == 4 * 3 * 4 * 3 + 1 and grid[-1] == dict(n_factors=100, n_epochs=25, lr_all=0.005, reg_all=0.02)


def test_terms_of_dealt_documents_are_counted_without_a_shuffle_of_terms(spark):
    """Ids may repeat or be null: their texts count as one document."""
    rows = [(1, "aa bb aa"), (1, "bb cc"), (None, "aa"), (None, "aa dd"), (2, "dd"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = content.term_counts(spread(docs, "doc_id"), "doc_id")
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(counts.collect(), key=str) == sorted(content.term_counts(docs, "doc_id").collect(), key=str)
    found = {r["term"]: (r["df"], r["corpus_count"]) for r in content.vocabulary(counts).collect()}
    assert found == {"aa": (2, 4), "dd": (2, 2)}
