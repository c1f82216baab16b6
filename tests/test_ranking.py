"""Popularity, top-K, metrics, hybrid: goldens and brute force."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom.operators import cells, content, dispatch, eda, hybrid, metrics, mf, popularity, serve, topk

TRAIN = [(1, 10, 5), (1, 11, 4), (1, 12, 2), (2, 10, 5), (2, 13, 4), (2, 14, 2), (3, 11, 5), (3, 13, 4), (3, 15, 2)]
VAL = [(1, 13, 5), (2, 11, 5), (3, 10, 5)]


def frame(spark, data):
    return spark.createDataFrame([(u, m, float(r)) for u, m, r in data], "user_id long, movie_id long, rating double")


@pytest.fixture(scope="module")
def train(spark):
    return frame(spark, TRAIN)


@pytest.fixture(scope="module")
def factors(spark):
    """Two users, four items, two factors."""
    users = spark.createDataFrame([(1, [0.4, 0.1], 0.0), (2, [0.2, 0.3], 0.0)], "user_id long, factors array<double>, bias double")
    items = spark.createDataFrame(
        [(10, [0.1, 0.2], 0.0), (11, [0.3, 0.1], 0.1), (12, [0.2, 0.4], 0.2), (13, [0.5, 0.6], 0.1)],
        "movie_id long, factors array<double>, bias double",
    )
    seen = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (2, 12)], "user_id long, movie_id long")
    return users, items, seen


def test_most_popular_order(train):
    order = [r["movie_id"] for r in popularity.by_score(popularity.item_popularity(train)).collect()]
    assert order == [10, 11, 13, 12, 14, 15]


def test_weighted_popularity(train):
    score = {r["movie_id"]: r["score"] for r in popularity.item_popularity(train, "weighted").collect()}
    assert score[10] == pytest.approx(5 * math.log(3)) and score[11] == pytest.approx(4.5 * math.log(3))
    with pytest.raises(ValueError):
        popularity.item_popularity(train, "other")


def test_bayesian_average(spark):
    rated = frame(spark, [(u, 1, 4) for u in range(50)] + [(u, 2, 2) for u in range(50)])
    assert {r["movie_id"]: r["score"] for r in popularity.bayesian_popularity(rated, 50).collect()}[1] == pytest.approx(3.5)


def test_equal_scores_normalise_to_zero(spark):
    table = spark.createDataFrame([(1, 2.0), (2, 2.0)], "movie_id long, score double")
    assert [r["score_norm"] for r in popularity.normalized_popularity(table).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("k, expected", [(3, (3, 1.0, 1.0, 1.0, 1.0)), (1, (3, 1.0, 1.0, 1.0, 0.5))])
def test_popularity_metrics(spark, train, k, expected):
    items = topk.ranked_items(popularity.item_popularity(train))
    recs = topk.popular_unseen(train.select("user_id").distinct(), items, popularity.seen_pairs(train), k)
    row = metrics.ranking_metrics(recs, frame(spark, VAL), train, train, k).first()
    assert tuple(row) == pytest.approx(expected)


def test_metrics_without_users_are_zero(spark, train):
    items = topk.ranked_items(popularity.item_popularity(train))
    recs = topk.popular_unseen(train.select("user_id").distinct(), items, popularity.seen_pairs(train), 2)
    row = metrics.ranking_metrics(recs, frame(spark, [(9, 10, 5)]), train, train, 2).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("head_rows", [1, 7, 1000])
def test_popular_unseen_against_brute_force(spark, head_rows):
    """Includes a user who has seen everything and one who has seen the whole head."""
    rng = random.Random(5)
    seen = {(u, m) for u in range(12) for m in range(30) if rng.random() < 0.4}
    seen |= {(50, m) for m in range(30)} | {(51, m) for m in range(25)}
    items = spark.createDataFrame([(m, m + 1) for m in range(30)], "movie_id long, item_rank long")
    users = spark.createDataFrame([(u,) for u in [*range(12), 50, 51, 52]], "user_id long")
    pairs = spark.createDataFrame(sorted(seen), "user_id long, movie_id long")
    got = {}
    for r in topk.popular_unseen(users, items, pairs, 4, head_rows).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["movie_id"])
    want = {u: [m for m in range(30) if (u, m) not in seen][:4] for u in [*range(12), 50, 51, 52]}
    assert got == {u: m for u, m in want.items() if m}


def test_factor_golden(factors):
    users, items, seen = factors
    shown = topk.with_display_score(topk.factor_top_k(users, items, seen, 3)).orderBy("user_id", "rank").collect()
    mine = [(r["user_id"], r["movie_id"], round(r["raw_score"], 6), round(r["score"], 6)) for r in shown]
    one = {10: 0.06, 11: 0.23, 12: 0.32, 13: 0.36}
    two = {10: 0.08, 11: 0.19, 12: 0.36, 13: 0.38}
    assert mine == [(1, 13, one[13], 5.0), (1, 12, one[12], 1.0), (2, 13, two[13], 5.0), (2, 10, two[10], 1.0)]


@pytest.mark.parametrize("blocks", [(3, 4), (100, 5), (7, 100)])
def test_cells_against_brute_force(spark, blocks):
    rng = np.random.default_rng(8)
    u, i = rng.normal(size=(20, 3)).round(1), rng.normal(size=(30, 3)).round(1)
    users = spark.createDataFrame([(n, v.tolist(), 0.0) for n, v in enumerate(u)], "user_id long, factors array<double>, bias double")
    items = spark.createDataFrame([(n, v.tolist(), 0.1) for n, v in enumerate(i)], "movie_id long, factors array<double>, bias double")
    pairs = [(a, b) for a in range(20) for b in range(30) if (a * 7 + b) % 5 == 0 or a == 3]
    seen = spark.createDataFrame(pairs, "user_id long, movie_id long")
    ranked = topk.factor_top_k(users, items, seen, 4, users_per_block=blocks[0], items_per_block=blocks[1])
    got = {(r["user_id"], r["rank"]): (r["movie_id"], r["raw_score"], r["min_score"], r["max_score"]) for r in ranked.collect()}
    scores = np.round(u @ i.T + 0.1, 6)
    want = {}
    for a in range(20):
        free = sorted((-scores[a, b], b) for b in range(30) if (a, b) not in set(pairs))
        for place, (s, b) in enumerate(free[:4], 1):
            want[a, place] = (b, -s, -free[-1][0], -free[0][0])
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_users_are_shuffled_once_whatever_the_item_blocks(spark, monkeypatch):
    """The kernel meets users and seen pairs, not a copy of every user for every item block."""
    def counting(*_):
        def run(key, cell):
            row = {"user_id": key[0].as_py(), "variant": 0, "lo": float(cell.num_rows), "hi": 0.0, "ids": [0], "scores": [0.0]}
            return pa.Table.from_pylist([row], schema=schema)

        return run

    schema = cells._RESULT
    monkeypatch.setattr(cells, "_cell_kernel", counting)
    users = spark.createDataFrame([(n, [1.0], 0.0) for n in range(2000)], "user_id long, factors array<double>, bias double")
    items = spark.createDataFrame([(n, [1.0], 0.0) for n in range(60)], "movie_id long, factors array<double>, bias double")
    seen = spark.createDataFrame([(1, 59)], "user_id long, movie_id long")
    met = topk.factor_top_k(users, items, seen, 3, users_per_block=50, items_per_block=2).agg(F.sum("min_score")).first()[0]
    assert met == 2001


@pytest.mark.parametrize("sparse", [False, True])
def test_scan_in_single_precision_equals_plain_scores(monkeypatch, sparse):
    """Candidates of the inexact pass lose nothing: ties, near ties, seen pairs, users whose numbers are not finite."""
    monkeypatch.setattr(cells, "SLICE_SCORES", 3000)
    rng = np.random.default_rng(3)
    n, m, k = 40, 700, 5
    if sparse:
        left = [np.sort(rng.choice(60, rng.integers(0, 12), replace=False)).tolist() for _ in range(n)]
        right = [np.sort(rng.choice(60, rng.integers(0, 6), replace=False)).tolist() for _ in range(m)]
        u = pa.table({"user_id": range(n), "user_terms": left, "user_weights": [rng.random(len(x)).tolist() for x in left]})
        i = pa.table({"movie_id": range(m), "item_terms": right, "item_weights": [(1 + 1e-7 * rng.random(len(x))).tolist() for x in right]})
        scorer = cells.sparse_scorer
    else:
        v = rng.normal(size=(m, 4)).round(1) + 1e-7 * rng.integers(0, 3, (m, 1))
        w = rng.normal(size=(n, 4)).round(1)
        w[7, 2] = np.nan
        u = pa.table({"user_id": range(n), "user_vector": w.tolist(), "user_bias": [0.0] * n})
        i = pa.table({"movie_id": range(m), "item_vector": v.tolist(), "item_bias": [0.5] * m})
        scorer = cells.dense_scorer
    rows, items = np.sort(rng.integers(0, n, 900)), rng.integers(0, m, 900)
    found, whole = cells.Found(1, n, k), scorer(u)
    parts = [whole(i.slice(at, 100).combine_chunks()) for at in range(0, m, 100)]
    for part in parts:
        cells._scan(part, found, rows, items, k, 6)
    scores = np.round(np.concatenate([part.exact(0, n)[0] for part in parts], axis=1), 6)
    scores[rows, items] = -np.inf
    for user in range(n):
        free = sorted((-s, b) for b, s in enumerate(scores[user]) if np.isfinite(s))
        got = [(-s, b) for s, b in zip(found.scores[0, user], found.ids[0, user]) if s > -np.inf]
        assert got == free[:k]
        assert not free or found.low[user] == -free[-1][0]


def test_ties_go_to_the_smaller_id():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, -np.inf], [-np.inf] * 5])
    counts, columns, values = cells._best(scores, 2)
    assert counts.tolist() == [2, 0] and columns.tolist() == [1, 2] and values.tolist() == [3.0, 3.0]


def test_flat_scores_show_the_middle(spark):
    assert spark.range(1).select(topk.rating_scale(F.lit(2.0), F.lit(2.0), F.lit(2.0))).first()[0] == 3.0


def test_average_precision(spark):
    recs = spark.createDataFrame([(1, 1, 100), (1, 2, 101), (1, 3, 102)], "user_id long, rank int, movie_id long")
    relevant = spark.createDataFrame([(1, 100), (1, 102)], "user_id long, movie_id long")
    row = metrics.user_metrics(recs, relevant, relevant.select("user_id").distinct(), 3).first()
    assert row["average_precision"] == pytest.approx((1 + 2 / 3) / 2) and row["recall"] == 1.0


def test_routing(spark, factors, train):
    users, items, seen = factors
    fallback = spark.createDataFrame([(13, 1), (12, 2), (11, 3), (10, 4)], "movie_id long, item_rank long")
    asked = spark.createDataFrame([(1,), (999,), (999,)], "user_id long")
    routed = topk.route_users(asked, seen, topk.factor_top_k(users, items, seen, 2), fallback, 2, "bpr", "v1")
    lists = {r["user_id"]: (r["strategy"], r["recommendations"]) for r in serve.batch_recommend(asked, routed).collect()}
    assert lists == {1: ("bpr", [13, 12]), 999: ("popularity_fallback", [13, 12])}
    assert serve.batch_recommend(asked, routed).count() == 3


def test_fallback_chain_needs_a_source():
    with pytest.raises(ValueError):
        topk.fallback_order([None])


def row_of(spark, recall, cover):
    return spark.createDataFrame([(recall, cover)], "recall_at_k double, coverage double")


# The fragments of a reason that callers look for.
IMPROVED, WIDER, KEPT = "recall_at_k improved", "coverage improved", "did not satisfy promotion rule"


@pytest.mark.parametrize("new, promote, fragment", [
    ((0.12, 0.22), True, IMPROVED), ((0.10, 0.26), True, WIDER), ((0.099, 0.5), False, KEPT), ((0.10, 0.22), False, KEPT),
])
def test_promotion(spark, new, promote, fragment):
    row = metrics.promotion(row_of(spark, 0.10, 0.22), row_of(spark, *new)).first()
    assert row["promote"] is promote and row["recall_at_k_delta"] == pytest.approx(new[0] - 0.10)
    assert fragment in row["reason"]


def test_blend_against_brute_force(spark, factors):
    users, items, seen = factors
    norm = spark.createDataFrame([(10, 1.0), (11, 0.5), (12, 0.2)], "movie_id long, score_norm double")
    got = {(r["user_id"], r["alpha"], r["rank"]): r["movie_id"] for r in hybrid.blended_top_k(users, items, seen, norm, [0.0, 1.0], 1).collect()}
    assert got == {(1, 0.0, 1): 12, (1, 1.0, 1): 13, (2, 0.0, 1): 10, (2, 1.0, 1): 13}
    single = hybrid.blended_top_k(users, items, seen, norm, [0.0], 1).collect()
    assert {(r["user_id"], r["movie_id"]) for r in single} == {(1, 12), (2, 10)}


def test_grid_keeps_order_and_adds_base_once():
    space = {"rank": [4, 8], "reg": [0.1, 0.2]}
    assert len(mf.candidate_grid(space, {"rank": 4, "reg": 0.1})) == 4
    assert mf.candidate_grid(space, {"rank": 5, "reg": 0.1})[-1] == {"rank": 5, "reg": 0.1}


def histogram(spark, counts):
    values = sorted(set(counts))
    return spark.createDataFrame([(v, counts.count(v)) for v in values], "value long, n long")


@pytest.mark.parametrize("counts, value", [([1, 1, 1, 1], 0.0), ([0, 0, 0, 1], 0.75), ([0, 0], 0.0)])
def test_gini(spark, counts, value):
    assert eda.gini(histogram(spark, counts)).first()[0] == pytest.approx(value)


def test_gini_of_nothing(spark):
    assert eda.gini(spark.createDataFrame([], "value long, n long")).first()[0] == 0.0


def test_head_share(spark):
    assert eda.head_share(histogram(spark, [5, 3, 2, 1, 1]), [0.2]).first()["head_share"] == pytest.approx(5 / 12)
    assert eda.head_share(histogram(spark, [2, 2, 2, 2]), [0.5]).first()["head_share"] == pytest.approx(0.5)


def test_known_user_without_a_list_gets_popularity(spark):
    """Users 1 and 2 have history, the model has a list for 1 only; 3 is a stranger."""
    asked = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    known = spark.createDataFrame([(1,), (2,)], "user_id long")
    personal = spark.createDataFrame([(1, 1, 50), (1, 2, 51)], "user_id long, rank int, movie_id long")
    fallback = spark.createDataFrame([(10 + i, i) for i in range(1, 151)], "movie_id long, item_rank long")
    rows = topk.route_users(asked, known, personal, fallback, 2, "bpr", "v1").collect()
    assert {(r["user_id"], r["strategy"]) for r in rows} == {(1, "bpr"), (2, "popularity_fallback"), (3, "popularity_fallback")}
    assert all(sum(r["user_id"] == u for r in rows) == 2 for u in (1, 2, 3))
    assert topk.route_users(asked, known, personal, fallback, 500, "bpr", "v1").filter("user_id = 3").count() == 100


def test_small_scores_keep_their_order(spark):
    users = spark.createDataFrame([(1, [1e-7], 0.0)], "user_id long, factors array<double>, bias double")
    items = spark.createDataFrame([(1, [1.0], 0.0), (2, [3.0], 0.0)], "movie_id long, factors array<double>, bias double")
    none = spark.createDataFrame([], "user_id long, movie_id long")
    assert [r["movie_id"] for r in topk.factor_top_k(users, items, none, 2).orderBy("rank").collect()] == [2, 1]


def test_popular_unseen_reads_gaps_of_histories(spark):
    """Candidates are not written out and compared with all seen pairs; ids may be null, pairs and users repeat."""
    items = spark.createDataFrame([(m, r) for r, m in enumerate([7, 3, None, 9, 1, 4], 1)], "movie_id long, item_rank long")
    seen = spark.createDataFrame([(1, 7), (1, 7), (1, 9), (2, 5), (None, 7), (3, None), (8, 3), (4, 7), (4, 3), (4, 9), (4, 1), (4, 4)], "user_id long, movie_id long")
    users = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "user_id long")
    for head_rows in (2, 50):
        recs = topk.popular_unseen(users, items, seen, 3, head_rows)
        assert "LeftAnti" not in recs._jdf.queryExecution().optimizedPlan().toString()
        found = {}
        for r in recs.orderBy("user_id", "rank").collect():
            found.setdefault(r["user_id"], []).append((r["rank"], r["movie_id"], r["item_rank"]))
        first = [(1, 7, 1), (2, 3, 2), (3, None, 3)]
        assert found == {None: first, 1: [(1, 3, 2), (2, None, 3), (3, 1, 5)], 2: first, 3: first, 4: [(1, None, 3)]}


@pytest.mark.parametrize("skew", [{}, {"hot_floor": 3, "hot_share": 0.2}])
def test_profiles_are_summed_after_the_deal_by_user(spark, skew):
    """Against brute force, a hot user included. Entries of a user are not shuffled a second time."""
    items = {1: {0: 0.6, 2: 0.8}, 2: {2: 1.0}, 3: {}, 4: {1: 0.28, 5: 0.96}}
    rated = [(7, 1, 5.0), (7, 2, 4.0), (7, 4, 4.0), (7, 2, 5.0), (7, 9, 5.0), (8, 1, 2.0), (8, 4, 1.0), (9, 1, 1.0), (9, 2, 4.0), (5, 3, 5.0)]
    ratings = spark.createDataFrame(rated, "user_id long, movie_id long, rating double")
    packed = spark.createDataFrame([(m, sorted(e), [e[t] for t in sorted(e)]) for m, e in items.items()],
                                   "movie_id long, item_terms array<long>, item_weights array<double>")
    want = {}
    for user, movie, rating in rated:
        if rating >= 4 or user == 8:
            for term, weight in items.get(movie, {}).items():
                entries = want.setdefault(user, {})
                entries[term] = entries.get(term, 0.0) + rating * weight
    profiles = content.user_profiles(ratings, packed, **skew)
    got = {r["user_id"]: dict(zip(r["user_terms"], r["user_weights"])) for r in profiles.collect()}
    assert got.keys() == want.keys()
    for user, entries in want.items():
        norm = sum(w * w for w in entries.values()) ** 0.5
        assert got[user] == pytest.approx({t: w / norm for t, w in entries.items()})
    if not skew:
        assert "hashpartitioning(user_id#" in (plan := profiles._jdf.queryExecution().toString()) and ", t#" not in "".join(
            line for line in plan.splitlines() if "Exchange" in line)


def test_profiles_go_on_across_batches_without_unrolled_rows(spark):
    """As the aggregate of unrolled entries has them, null ratings included; no row is made per entry."""
    rated = [(u, m, None if (u, m) == (3, 2) else float(1 + (u * m) % 5)) for u in range(9) for m in range(1, 12)] + [(20, 1, 1.0), (20, 4, None)]
    ratings = spark.createDataFrame(rated, "user_id long, movie_id long, rating double")
    packed = spark.createDataFrame(
        [(m, [t for t in range(12) if t % m == 0 and m != 7], [0.1 * (t + m) for t in range(12) if t % m == 0 and m != 7]) for m in range(1, 12)],
        "movie_id long, item_terms array<long>, item_weights array<double>")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        profiles = content.user_profiles(ratings, packed, threshold=2.0)
        got = {r["user_id"]: dict(zip(r["user_terms"], r["user_weights"])) for r in profiles.collect()}
    finally:
        spark.conf.set(name, before)
    assert "Generate" not in profiles._jdf.queryExecution().toString()
    liked = content.liked_ratings(ratings, 2.0).select("user_id", "movie_id", F.col("rating").alias("r"))
    rows = content._summed_profiles(liked.join(packed, "movie_id")).collect()
    want = {r["user_id"]: dict(zip(r["user_terms"], r["user_weights"])) for r in rows}
    assert got.keys() == want.keys() and len(got) == 10
    for user, entries in want.items():
        assert list(got[user]) == sorted(entries)
        assert [got[user][t] for t in sorted(entries)] == [w if w is None else pytest.approx(w) for _, w in sorted(entries.items())]


def test_only_pairs_of_scored_users_are_dealt_to_cells(spark, factors, monkeypatch):
    users, items, seen = factors
    others = spark.createDataFrame([(u, m) for u in range(100, 150) for m in (10, 13)], "user_id long, movie_id long")
    every = seen.unionByName(others)
    few = topk.factor_top_k(users, items, every, 2)
    assert "LeftSemi" in few._jdf.queryExecution().toString()
    rows = sorted(map(tuple, few.collect()))
    assert rows == sorted(map(tuple, topk.factor_top_k(users, items, seen, 2).collect())) and {r[0] for r in rows} == {1, 2}
    monkeypatch.setattr(cells, "BROADCAST_USERS", 1)
    many = topk.factor_top_k(users, items, every, 2)
    assert "LeftSemi" not in many._jdf.queryExecution().toString() and sorted(map(tuple, many.collect())) == rows


def sparse_world(seed=5, n=60, m=640, terms=48):
    """Items in eight families of terms; every user knows terms of one family, and a term that some items of all families have."""
    rng = np.random.default_rng(seed)
    family = np.arange(m) % 8
    right = [sorted({*(1 + 6 * f + rng.choice(5, 2, replace=False)), *([0] if rng.random() < 0.5 else [])}) for f in family]
    left = [sorted({0, *(1 + 6 * (u % 8) + rng.choice(5, 3, replace=False))}) for u in range(n)]
    weights = lambda rows: [rng.integers(1, 4, len(x)).astype(float).tolist() for x in rows]
    users = pa.table({"user_id": range(n), "user_terms": [[int(t) for t in x] for x in left], "user_weights": weights(left)})
    items = pa.table({"movie_id": range(m), "item_terms": [[int(t) for t in x] for x in right], "item_weights": weights(right)})
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, n, 2000), rng.integers(0, m, 2000))})
    dense = [np.zeros((len(t), terms)) for t in (users, items)]
    for matrix, table, side in zip(dense, (users, items), ("user", "item")):
        for row, r in enumerate(table.to_pylist()):
            matrix[row, r[f"{side}_terms"]] = r[f"{side}_weights"]
    scores = dense[0] @ dense[1].T
    scores[tuple(np.array(pairs).T)] = np.nan
    want = []
    for row in scores:
        free = np.flatnonzero(~np.isnan(row))
        best = free[np.lexsort((free, -row[free]))][:5]
        want.append(([(int(b), float(row[b])) for b in best], float(row[free].min()), float(row[free].max())))
    return users, items, pairs, want


@pytest.mark.parametrize("size", [(30, 640), (100, 100)])
def test_similarity_lists_in_groups_against_brute_force(spark, size):
    users, items, pairs, want = sparse_world()
    tables = [spark.createDataFrame(t.to_pandas()) for t in (users, items)]
    seen = spark.createDataFrame(pairs, "user_id long, movie_id long")
    for ranged in (True, False):
        rows = content.similar_top_k(*tables, seen, 5, 6, ranged=ranged, users_per_block=size[0], items_per_block=size[1]).collect()
        assert ("min_score" in rows[0]) == ranged
        for user, (best, low, high) in enumerate(want):
            mine = sorted((r for r in rows if r["user_id"] == user), key=lambda r: r["rank"])
            assert [(r["movie_id"], r["raw_score"]) for r in mine] == best
            assert not ranged or {(r["min_score"], r["max_score"]) for r in mine} == {(low, high)}


def test_groups_out_of_reach_are_not_multiplied(monkeypatch):
    """Items stored by their terms: a user meets the groups of own terms only, and finds the same."""
    users, items, pairs, want = sparse_world()
    rows, seen = (np.array(c) for c in zip(*pairs))
    place = np.lexsort((np.arange(items.num_rows), np.arange(items.num_rows) % 8))
    items = items.append_column("place", pa.array(np.argsort(place)))
    met, hits = [], cells.Tile.hits
    monkeypatch.setattr(cells.Tile, "hits", lambda self, todo, *a, **k: met.append(int(todo.sum())) or hits(self, todo, *a, **k))
    found, block = cells.Found(1, users.num_rows, 5), cells.sparse_scorer(users)(items)
    block.ranged = False
    cells._scan(block, found, rows, seen, 5, 6)
    for user, (best, _low, _high) in enumerate(want):
        assert list(zip(found.ids[0, user].tolist(), found.scores[0, user].tolist())) == best
    assert 0 < sum(met) <= users.num_rows * block.groups / 4


def test_dense_lists_without_range_leave_out_items_of_low_bias(monkeypatch):
    """Items whose bias and length cannot reach a list are not multiplied: later blocks shrink, lists stay those of all scores."""
    rng = np.random.default_rng(11)
    n, m = 50, 800
    w, v, b = rng.normal(size=(n, 4)) * 0.2, rng.normal(size=(m, 4)) * 0.2, rng.normal(size=m).round(1)
    users = cells.DenseUsers(w, np.zeros(n))
    wide, some = [], cells.DenseBlock.guess_some
    monkeypatch.setattr(cells.DenseBlock, "guess_some", lambda self, start, stop, at: wide.append(len(at)) or some(self, start, stop, at))
    rows, items = np.sort(rng.integers(0, n, 500)), rng.integers(0, m, 500)
    found = cells.Found(1, n, 5)
    for at in range(0, m, 200):
        block = cells.DenseBlock(users, np.arange(at, at + 200), v[at : at + 200], b[at : at + 200])
        block.ranged = False
        cells.scan(block, found, rows, items, 5, None)
    scores = w @ v.T + b
    scores[rows, items] = -np.inf
    for user in range(n):
        assert found.ids[0, user].tolist() == sorted(range(m), key=lambda i: (-scores[user, i], i))[:5]
    assert len(wide) == 3 and max(wide) <= 100


def test_families_are_served_without_score_ranges(spark, factors, monkeypatch):
    users, items, seen = factors
    asked, popular = users.select("user_id"), items.select("movie_id", F.col("movie_id").alias("item_rank"))
    model = {"users": users, "items": items, "seen": seen, "popular": popular}
    met, plain = [], dispatch.factor_top_k
    monkeypatch.setattr(dispatch, "factor_top_k", lambda *a, **k: met.append(plain(*a, **k)) or met[-1])
    rows = dispatch.recommend("bpr", model, asked, 2).collect()
    want = topk.factor_top_k(users, items, seen, 2).select("user_id", "rank", "movie_id", "raw_score").collect()
    assert met[0].columns == ["user_id", "rank", "movie_id", "raw_score"] and set(want) <= set(rows)
