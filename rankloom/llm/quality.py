"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document's strength is linear in features of its whole text. Each training pair is a document
labelled 1 and one labelled 0; the loss is the logistic loss on the difference of their features, so
only differences count and no class share is learned. The strengths of the training documents
are then cut at the quantile that separates the labels best, and the score is the logistic function
of the distance to that cut.

Features are shares of byte classes, word shapes and repetitions. Each enters by its place among
``BINS`` quantile bins, since both ends of a share can be bad.

Defined results: null counts as empty and is scored like any text; rows with a null label or id are not
learned from; a document with contradicting labels takes their majority, or none in a tie; without
training rows of both labels every score is 0.5. A repeated row is scored each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rankloom.llm.textbatch import lowered, passes, prepare, span_hashes, spread, text_buffers, word_spans

#: Labelled documents the ranking is fitted on, at most; those with the smallest id hash.
SAMPLE_ROWS = 20_000
PAIRS = 40_000
BINS = 8
RIDGE = 1.0
NEWTON_STEPS = 12
#: Pairs whose differences are held at once.
BLOCK = 4_000

#: Byte classes; every byte outside them is of the last class.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?", b"|",
            b"%", b"$", b"#", b"*", b"&", b"'\"-()", b":;/", b"<>{}[]=_\\~^`@+", bytes(range(128, 256))]


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)
    for k, members in enumerate(_CLASSES):
        table[list(members)] = k
    return table


_TABLE = _class_table()
_WIDTH = len(_CLASSES) + 1


def _per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=rows)


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers per text, from all of its bytes and words."""
    data, bounds = text_buffers(column)
    rows, size = len(bounds) - 1, np.maximum(np.diff(bounds), 1)
    row = spread(bounds)
    kinds = _TABLE[data]
    shares = np.bincount(row * _WIDTH + kinds, minlength=rows * _WIDTH).reshape(rows, _WIDTH) / size[:, None]
    starts, ends, first = word_spans(data, bounds)
    count = np.maximum(np.diff(first), 1)
    of = spread(first)
    words = span_hashes(lowered(data), starts, ends)
    length = (ends - starts).astype(float)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((words, of))
    new = np.ones(len(order), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    most = np.zeros(rows)
    np.maximum.at(most, of[order[at]], times)
    distinct = np.bincount(of[order[at]], minlength=rows)
    upper = np.concatenate(([0], np.cumsum(kinds == 1)))
    mark = np.concatenate(([0], np.cumsum((kinds >= 7) & (kinds <= 14))))
    shout = (upper[ends] - upper[starts]) * 2 > length
    marked = mark[ends] > mark[starts]
    per_word = [same, length, shout & (length > 1), marked, length > 15, length <= 2, kinds[starts] == 1, kinds[ends - 1] == 5]
    parts = [_per_row(np.asarray(v, float), of, rows) / count for v in per_word] if len(words) else [np.zeros(rows)] * 8
    return np.column_stack(
        [shares, *parts, distinct / count, most / count, np.log1p(np.diff(bounds)), np.log1p(np.diff(first)), distinct / np.sqrt(count)]
    )


@dataclass
class Ranking:
    """Bin edges (features x BINS - 1), a weight for each bin, and the cut."""

    edges: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(binned(features(column), self.edges) @ self.weights - self.cut, -500, 500)))


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each feature and inner edge, whether the value lies above the edge, and one linear term."""
    steps = x[:, :, None] > edges[None]
    return np.concatenate((steps.reshape(len(x), edges.size).astype(np.float32), np.clip(x, -10, 20).astype(np.float32)), axis=1)


def fit_ranking(x: np.ndarray, label: np.ndarray, seed: int = 7) -> Ranking:
    """Newton steps on the penalised logistic loss of feature differences."""
    levels = np.arange(1, BINS) / BINS
    edges = np.quantile(x, levels, axis=0).T if len(x) else np.zeros((x.shape[1], BINS - 1))
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranking(edges, np.zeros(x.shape[1] * BINS), 0.0)
    # also the extremes of the bad ones, which may lie inside one bin of all documents
    edges = np.sort(np.concatenate((edges, np.quantile(x[bad], levels, axis=0).T), axis=1), axis=1)
    z = binned(x, edges)
    random = np.random.default_rng(seed)
    better, worse = random.choice(good, PAIRS), random.choice(bad, PAIRS)
    w = np.zeros(z.shape[1])
    for _ in range(NEWTON_STEPS):
        slope, bend = -RIDGE * w, RIDGE * np.eye(len(w))
        for i in range(0, PAIRS, BLOCK):
            difference = z[better[i : i + BLOCK]].astype(float) - z[worse[i : i + BLOCK]]
            p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
            slope += difference.T @ p
            bend += (difference * (p * (1 - p))[:, None]).T @ difference
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return Ranking(edges, w, best_cut(z @ w, label))


def best_cut(strength: np.ndarray, label: np.ndarray) -> float:
    """The quantile of the strengths with most labels on their side; the middle of equals."""
    order = np.argsort(strength, kind="stable")
    s, y = strength[order], label[order]
    right = np.concatenate(([0], np.cumsum(y == 0))) + np.concatenate((np.cumsum((y == 1)[::-1])[::-1], [0]))
    open_ = np.concatenate(([True], s[1:] > s[:-1], [True]))
    at = np.flatnonzero(open_ & (right == right[open_].max()))
    at = at[len(at) // 2]
    low, high = s[max(at - 1, 0)], s[min(at, len(s) - 1)]
    return float(low - 1 if at == 0 else high + 1 if at == len(s) else (low + high) / 2)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Ranking:
    """A ranking from at most ``SAMPLE_ROWS`` labelled documents outside the held-out part."""
    prepare(docs.sparkSession)
    known = (
        labels.select(F.col(doc_id).cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
        .filter("_id is not null and _y in (0, 1)").filter(~held_out(F.col("_id")))
        .groupBy("_id").agg(F.avg("_y").alias("_y")).filter("_y <> 0.5")
        .orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_ROWS)
        .select("_id", F.round("_y").cast("int").alias("_y"))
    )
    source = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    rows = source.join(F.broadcast(known), "_id").select("_id", "_y", "_text")
    learned = rows.mapInArrow(_feature_rows, "_id long, _y int, x binary").orderBy("_id", "x").limit(2 * SAMPLE_ROWS).toArrow()
    y = learned.column("_y").to_numpy()
    width = features(pa.array([""])).shape[1]
    x = np.frombuffer(b"".join(learned.column("x").to_pylist()), np.float64).reshape(len(y), width)
    return fit_ranking(x, y)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in passes(batch, "_text"):
            x = np.ascontiguousarray(features(part.column(2)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["_id", "_y", "x"]
            )


def with_scores(docs: DataFrame, ranking: Ranking, *, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the column ``score``, in one pass without a shuffle; a column of that name is replaced."""
    prepare(docs.sparkSession)
    names = [c for c in docs.columns if c != score]
    place = names.index(text)
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, f"c{place}"):
                yield part.append_column("score", pa.array(ranking.score(part.column(place))))

    done = plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("score", DoubleType())]))
    return done.toDF(*names, score)


def quality_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    ranking = fit(docs, labels, doc_id=doc_id, text=text)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return with_scores(source, ranking).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    ranking = fit(docs, labels, doc_id=doc_id, text=text)
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    scored = with_scores(plain, ranking, text=f"c{names.index(text)}", score="_score")
    return scored.filter("_score >= 0.5").drop("_score").toDF(*names)
