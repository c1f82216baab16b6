"""The derived tables of ``views`` as SQL, for the oracle queries."""

from __future__ import annotations

import re

from rankloom.functions.text import STOP_WORDS

EPOCH = "CAST(floor(epoch({0})) AS BIGINT)"


def is_number(col: str) -> str:
    """Text to double or NULL."""
    return f"TRY_CAST({col} AS DOUBLE)"


VIEWS: dict[str, str] = {
    "interactions": f"""
SELECT l_orderkey AS src1, CAST(l_linenumber AS BIGINT) AS src2, o_custkey AS user_id, l_partkey AS movie_id,
       CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating, {EPOCH.format('l_shipdate')} AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey > 0 AND l_partkey > 0""",
    "raw": f"""
SELECT l_orderkey AS src1, CAST(l_linenumber AS BIGINT) AS src2,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'u' || CAST(o_custkey AS VARCHAR)
            WHEN l_orderkey % 83 = 0 THEN CAST(o_custkey AS VARCHAR) || '.5'
            WHEN l_orderkey % 79 = 0 THEN CAST(o_custkey + 1000000000 AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
       CASE WHEN l_suppkey % 41 = 7 THEN CAST(l_partkey + 1000000000 AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS movie_id,
       CASE WHEN l_orderkey % 73 = 0 THEN '0' WHEN l_orderkey % 71 = 0 THEN '6' WHEN l_orderkey % 67 = 0 THEN 'bad'
            WHEN l_orderkey % 61 = 0 THEN NULL ELSE CAST(CAST(ceil(l_quantity / 10) AS INT) AS VARCHAR) END AS rating,
       CASE WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 53 = 0 THEN 'x' WHEN l_orderkey % 47 = 0 THEN '-5'
            WHEN l_orderkey % 43 = 0 THEN '99999999999' WHEN l_orderkey % 37 = 0 THEN '4102444800'
            ELSE CAST({EPOCH.format('l_shipdate')} AS VARCHAR) END AS "timestamp"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movies": """
SELECT p_partkey AS movie_id,
       CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE p_name || ' (' || CAST(1990 + p_size % 20 AS VARCHAR) || ')' END AS title,
       CASE WHEN p_partkey % 103 = 0 THEN NULL ELSE p_type || '|' || p_brand END AS genres
FROM part""",
    "users": """
SELECT c_custkey AS user_id, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       CAST(CASE c_custkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 18 WHEN 2 THEN 25 WHEN 3 THEN 35 WHEN 4 THEN 45 WHEN 5 THEN 50 ELSE 56 END AS INT) AS age,
       CAST(c_nationkey % 21 AS INT) AS occupation, right(c_name, 5) AS zip_code
FROM customer""",
    "logs": """
SELECT event_id, ts, user_id, k,
       CASE event_type WHEN 'signup' THEN 'popularity_fallback' WHEN 'error' THEN 'error' ELSE 'bpr' END AS strategy,
       value AS latency_ms, CASE WHEN k % 2 = 0 THEN 5 ELSE 10 END AS top_k,
       CASE WHEN event_type = 'error' THEN 500 WHEN k = 0 THEN NULL ELSE 200 END AS response_status,
       CASE WHEN event_type = 'error' THEN CAST([] AS BIGINT[])
            ELSE list_transform(range(CASE WHEN k % 2 = 0 THEN 5 ELSE 10 END), lambda j: CAST((k * 7 + j * 13) % 200 + 1 AS BIGINT)) END AS recommendations
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e""",
    "feedback": f"""
SELECT event_id AS src1, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS movie_id,
       CAST(1 + least(4, floor(value / 25)) AS DOUBLE) AS rating,
       CASE WHEN event_id % 3 = 0 THEN {EPOCH.format('ts')} - 946080000 ELSE {EPOCH.format('ts')} END AS ts
FROM events WHERE event_type = 'purchase'""",
    "typed": """
SELECT src1, src2, TRY_CAST(user_id AS DOUBLE) AS user_id, TRY_CAST(movie_id AS DOUBLE) AS movie_id,
       TRY_CAST(rating AS DOUBLE) AS rating, TRY_CAST("timestamp" AS DOUBLE) AS "timestamp",
       CASE WHEN abs(TRY_CAST("timestamp" AS DOUBLE)) <= 9223372036
            THEN make_timestamp(CAST(TRY_CAST("timestamp" AS DOUBLE) * 1000000 AS BIGINT)) END AS timestamp_dt
FROM raw""",
    "nonnull": """
SELECT * FROM typed WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL
   AND "timestamp" IS NOT NULL AND timestamp_dt IS NOT NULL""",
    "ranged": """
SELECT * FROM nonnull WHERE user_id > 0 AND movie_id > 0 AND rating BETWEEN 1 AND 5 AND "timestamp" > 0""",
    "narrowed": """
SELECT src1, src2, CAST(trunc(user_id) AS BIGINT) AS user_id, CAST(trunc(movie_id) AS BIGINT) AS movie_id,
       CAST(rating AS FLOAT) AS rating, CAST(trunc("timestamp") AS BIGINT) AS "timestamp", timestamp_dt FROM ranged""",
    "known": """
SELECT * FROM narrowed WHERE user_id IN (SELECT user_id FROM users) AND movie_id IN (SELECT movie_id FROM movies)""",
    "cleaned": """
SELECT * FROM known
QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY "timestamp" DESC, src1 DESC, src2 DESC) = 1""",
    "ratings": """
SELECT * FROM interactions
QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY ts DESC, src1 DESC, src2 DESC) = 1""",
    "sized": """
SELECT user_id, movie_id, rating, ts, count(*) OVER (PARTITION BY user_id) AS n,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, movie_id) AS rn FROM ratings""",
    "held": """
SELECT *, greatest(1, CAST(round_even(n * 0.2, 0) AS BIGINT)) AS t0, greatest(1, CAST(round_even(n * 0.1, 0) AS BIGINT)) AS v0 FROM sized""",
    "split": """
SELECT user_id, movie_id, rating, ts, n, CASE WHEN n < 3 THEN 'train'
       WHEN rn > n - (CASE WHEN t0 + v0 >= n THEN 1 ELSE t0 END) THEN 'test'
       WHEN rn > n - (CASE WHEN t0 + v0 >= n THEN 2 ELSE t0 + v0 END) THEN 'val' ELSE 'train' END AS split
FROM held""",
    "train": "SELECT user_id, movie_id, rating, ts FROM split WHERE split = 'train'",
    "val": "SELECT user_id, movie_id, rating, ts FROM split WHERE split = 'val'",
    "test": "SELECT user_id, movie_id, rating, ts FROM split WHERE split = 'test'",
    "seen": "SELECT DISTINCT user_id, movie_id FROM train",
    "popularity": """
SELECT movie_id, count(*) AS interaction_count, avg(rating) AS mean_rating, sum(rating) AS rating_sum,
       max(ts) AS last_seen, CAST(count(*) AS DOUBLE) AS score FROM train GROUP BY movie_id""",
    "popranked": """
SELECT *, row_number() OVER (ORDER BY score DESC, interaction_count DESC, movie_id) AS item_rank FROM popularity""",
    "popnorm": """
SELECT movie_id, CASE WHEN max(score) OVER () > min(score) OVER ()
       THEN (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) ELSE 0 END AS score_norm FROM popularity""",
    "trainusers": "SELECT DISTINCT user_id FROM train",
    "poprecs": """
SELECT u.user_id, CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY p.item_rank) AS INT) AS rank, p.movie_id, p.item_rank
FROM trainusers u CROSS JOIN popranked p
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.movie_id = p.movie_id)
QUALIFY row_number() OVER (PARTITION BY u.user_id ORDER BY p.item_rank) <= 10""",
    "ufactors": "SELECT vec_id AS user_id, embedding::DOUBLE[] AS factors, 0.0::DOUBLE AS bias FROM embeddings",
    "ifactors": "SELECT vec_id AS movie_id, embedding::DOUBLE[] AS factors, CAST(label AS DOUBLE) / 10 AS bias FROM embeddings",
    "scored": """
SELECT u.user_id, i.movie_id, round(list_dot_product(u.factors, i.factors) + i.bias + u.bias, 6) AS raw_score
FROM ufactors u CROSS JOIN ifactors i
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.movie_id = i.movie_id)""",
    "spread": """
SELECT *, min(raw_score) OVER (PARTITION BY user_id) AS min_score, max(raw_score) OVER (PARTITION BY user_id) AS max_score FROM scored""",
    "facrecs": """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY raw_score DESC, movie_id) AS INT) AS rank,
       movie_id, raw_score, min_score, max_score FROM spread
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY raw_score DESC, movie_id) <= 10""",
    "relevant": "SELECT DISTINCT user_id, movie_id FROM test WHERE rating >= 4",
    "relevantval": "SELECT DISTINCT user_id, movie_id FROM val WHERE rating >= 4",
    "itemtext": """
SELECT movie_id, trim(concat_ws(' ', title, replace(genres, '|', ' '))) AS text FROM movies""",
    "itemtokens": None,
    "trainshare": """
SELECT movie_id, exposure / CAST(sum(exposure) OVER () AS DOUBLE) AS p
FROM (SELECT movie_id, count(DISTINCT user_id) AS exposure FROM train GROUP BY movie_id) e""",
    "served": """
SELECT movie_id, count(*) AS served FROM (SELECT unnest(recommendations) AS movie_id FROM logs) r GROUP BY movie_id""",
    "prodshare": "SELECT movie_id, served / CAST(sum(served) OVER () AS DOUBLE) AS p FROM served",
    "clippedshare": """
SELECT least(greatest(coalesce(t.p, 0), 1e-12), 1.0) AS p, least(greatest(coalesce(s.p, 0), 1e-12), 1.0) AS q
FROM trainshare t FULL JOIN prodshare s ON t.movie_id = s.movie_id""",
    "driftscore": """
SELECT sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2 AS drift_score
FROM (SELECT p / sum(p) OVER () AS p, q / sum(q) OVER () AS q FROM clippedshare) c""",
}

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def token_sql(text: str) -> str:
    """List of tokens of a text column."""
    words = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
    return f"list_filter({words}, lambda w: NOT list_contains({_STOP}, w))"


def term_rows(source: str, key: str, text: str) -> str:
    """CTE bodies that lead from texts to (key, term, tf)."""
    return f"""
SELECT {key}, term, count(*) AS tf FROM (
  SELECT {key}, unnest(w) AS term FROM (SELECT {key}, {token_sql(text)} AS w FROM {source}) a
  UNION ALL
  SELECT {key}, unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS term
  FROM (SELECT {key}, {token_sql(text)} AS w FROM {source}) b) t GROUP BY {key}, term"""


VIEWS["termcounts"] = term_rows("itemtext", "movie_id", "text")
VIEWS["vocab"] = """
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS corpus_count FROM termcounts GROUP BY term HAVING count(*) >= 2
ORDER BY corpus_count DESC, term LIMIT 12000"""
VIEWS["rawweights"] = """
SELECT c.movie_id, c.term, c.tf * (ln((1.0 + (SELECT count(*) FROM itemtext)) / (1 + v.df)) + 1) AS raw
FROM termcounts c JOIN vocab v ON c.term = v.term"""
VIEWS["weights"] = "SELECT movie_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY movie_id)) AS weight FROM rawweights"
VIEWS["liked"] = """
SELECT user_id, movie_id, rating FROM train QUALIFY rating >= 4 OR max(rating) OVER (PARTITION BY user_id) < 4"""
VIEWS["rawprofile"] = """
SELECT l.user_id, w.term, sum(l.rating * w.weight) AS s FROM liked l JOIN weights w ON l.movie_id = w.movie_id GROUP BY l.user_id, w.term"""
VIEWS["profile"] = "SELECT user_id, term, s / sqrt(sum(s * s) OVER (PARTITION BY user_id)) AS weight FROM rawprofile"
VIEWS["alike"] = """
SELECT p.user_id, w.movie_id, sum(p.weight * w.weight) AS s FROM profile p JOIN weights w ON p.term = w.term GROUP BY p.user_id, w.movie_id"""
VIEWS["simscored"] = """
SELECT u.user_id, m.movie_id, round(coalesce(s.s, 0), 6) AS raw_score
FROM (SELECT DISTINCT user_id FROM profile) u CROSS JOIN itemtext m LEFT JOIN alike s ON s.user_id = u.user_id AND s.movie_id = m.movie_id
WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.user_id = u.user_id AND x.movie_id = m.movie_id)"""
VIEWS["simrecs"] = """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY raw_score DESC, movie_id) AS INT) AS rank, movie_id, raw_score,
       min(raw_score) OVER (PARTITION BY user_id) AS min_score, max(raw_score) OVER (PARTITION BY user_id) AS max_score FROM simscored
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY raw_score DESC, movie_id) <= 10"""
del VIEWS["itemtokens"]


def with_views(body: str, **extra: str) -> str:
    """``body`` behind the CTEs it needs, in dependency order. ``extra`` adds query-specific CTEs."""
    known = {**VIEWS, **extra}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN)\s+\(?([A-Za-z_0-9]+)", text):
            if word in known and word not in ordered:
                visit(known[word])
                if word not in ordered:
                    ordered.append(word)

    visit(body)
    ctes = ",\n".join(f"{name} AS ({known[name].strip()})" for name in ordered)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


def materialized(sql: str) -> str:
    """The same query with every CTE computed once."""
    return re.sub(r"(?m)^(WITH )?([a-z_0-9]+) AS \(", r"\1\2 AS MATERIALIZED (", sql)


def scale_sql(score: str = "raw_score", low: str = "min_score", high: str = "max_score") -> str:
    return (
        f"CASE WHEN abs({high} - {low}) <= 1e-8 + 1e-5 * abs({low}) THEN 3.0 "
        f"ELSE ({score} - {low}) / nullif({high} - {low}, 0) * 4 + 1 END"
    )


def metric_ctes(recs: str, relevant: str = "relevant", catalog: str = "train", by: str = "", known: str = "train") -> dict[str, str]:
    """CTEs ``eligible``, ``peruser`` and ``metrics`` over a recommendation CTE."""
    b = f"{by}, " if by else ""
    on = f" AND g.{by} = w.{by}" if by else ""
    variants = f" CROSS JOIN (SELECT DISTINCT {by} FROM {recs}) v" if by else ""
    return {
        "eligible": f"SELECT DISTINCT user_id FROM {relevant} WHERE user_id IN (SELECT user_id FROM {known})",
        "wanted": f"SELECT {b}r.user_id, count(*) AS relevant_items FROM {relevant} r JOIN eligible e ON e.user_id = r.user_id{variants} GROUP BY {b}r.user_id",
        "hitrows": f"""SELECT {b}c.user_id, c.rank, row_number() OVER (PARTITION BY {b}c.user_id ORDER BY c.rank) AS sofar
            FROM {recs} c JOIN {relevant} r ON r.user_id = c.user_id AND r.movie_id = c.movie_id""",
        "gains": f"SELECT {b}user_id, count(*) AS hits, sum(sofar / CAST(rank AS DOUBLE)) AS gain FROM hitrows GROUP BY {b}user_id",
        "peruser": f"""SELECT {('w.' + by + ', ') if by else ''}w.user_id, w.relevant_items, CAST(coalesce(g.hits, 0) AS BIGINT) AS hits,
            coalesce(g.hits, 0) / CAST(w.relevant_items AS DOUBLE) AS recall,
            coalesce(g.gain, 0) / least(w.relevant_items, 10) AS average_precision,
            CASE WHEN coalesce(g.hits, 0) > 0 THEN 1.0 ELSE 0.0 END AS hit
            FROM wanted w LEFT JOIN gains g ON g.user_id = w.user_id{on}""",
        "covered": f"""SELECT {b}count(DISTINCT movie_id) / CAST(greatest((SELECT count(DISTINCT movie_id) FROM {catalog}), 1) AS DOUBLE) AS coverage
            FROM {recs} WHERE user_id IN (SELECT user_id FROM eligible){f' GROUP BY {by}' if by else ''}""",
        "metrics": f"""SELECT {b}count(*) AS users_evaluated, coalesce(avg(recall), 0) AS recall_at_k, coalesce(avg(average_precision), 0) AS map_at_k,
            coalesce(avg(hit), 0) AS hit_rate_at_k{'' if by else ', (SELECT coverage FROM covered) AS coverage'} FROM peruser{f' GROUP BY {by}' if by else ''}""",
    }


def prefixed(prefix: str, ctes: dict[str, str]) -> dict[str, str]:
    """The same CTEs under names with a prefix, so one query can hold two sets."""
    names = "|".join(sorted(ctes, key=len, reverse=True))
    return {
        f"{prefix}{name}": re.sub(rf"\b(FROM|JOIN)(\s+\(?)({names})\b", rf"\1\2{prefix}\3", body)
        for name, body in ctes.items()
    }
