"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Runs of words are ordered by document frequency, rarest first. Two documents whose sets overlap
by at least ``need = ceil(threshold * n)`` share at least ``l`` of the first ``n - need + l`` runs
of each, for every ``l``. Each document takes the ``l`` whose estimated cost is least: postings read
plus candidates to verify, of which each needs ``l`` shared prefix runs. A pair of near sizes is verified when it
shares at least the smaller ``l`` of its two documents and enough prefix runs for the overlap that their two sizes
ask for, were all runs behind the prefix shared as well.

Runs that occur in one document only fill a prefix without producing candidates, and a document
with too few other runs has no partner, so after one exchange of hashes only documents that may
have a near copy go on.

Defined results: null text counts as empty; empty texts link with nothing; equal sets are one class
before any pair is formed; a repeated row joins its own copy; rows without an id keep their row and
never name a component unless the whole component has none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.exchange import Columns, by_bucket, gather, scatter, schema
from rankloom.llm.graph import components
from rankloom.llm.textbatch import (
    gram_hashes, lowered, mix, passes, prepare, span_hashes, spread, text_buffers, word_spans,
)
from rankloom.session import dropped_shuffles, staged

WORDS = 5
PERCENT = 75
#: Hashes that one task of an exchange holds on average, and those it sorts at once.
BUCKET_ENTRIES = 6_000_000
SORTED_ENTRIES = 500_000
#: Bytes of text whose runs are made at once.
SET_BYTES = 1 << 19
#: Most runs that may be routed past the exchange because a large share of all documents has them.
HOT_RUNS = 1 << 18
#: Fewer documents than this do not make a run hot.
HOT_FLOOR = 1000
#: Longest extension of a prefix.
MOST_MATCHES = 8
#: Cost of verifying one candidate, in postings read.
VERIFY_COST = 20
#: Pivots that each list of postings offers its members before all remaining cross pairs.
PIVOTS = 4

_CLASS = "doc_id long, class long, n_shingles long, hot binary"
_I64, _U64, _I32 = "<i8", "<u8", "<i4"


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    return (n.astype(np.int64) * percent + 99) // 100


def document_sets(batch: pa.RecordBatch, size: int, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct run hashes of each row (sorted), their bounds, and a key of each whole set."""
    data, bounds = text_buffers(batch.column(batch.schema.get_field_index(text)))
    data = lowered(data)
    starts, ends, first = word_spans(data, bounds)
    grams, rows = gram_hashes(span_hashes(data, starts, ends), first, size)
    row = spread(rows)
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[keep], row[keep]
    sets = np.searchsorted(row, np.arange(len(rows)))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    key = mix(sums[sets[1:]] - sums[sets[:-1]] + np.diff(sets).astype(np.uint64))
    return grams, sets, key


def _classes(size: int, doc_id: str, text: str):
    """Per document its class and set size; once per pass the runs that many of its documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, text, SET_BYTES):
                grams, sets, key = document_sets(part, size, text)
                counts = np.diff(sets)
                _, one = np.unique(key, return_index=True)
                own = np.zeros(len(counts), bool)
                own[one] = True
                values, times = np.unique(grams[own[spread(sets)]], return_counts=True)
                many = times >= max(4, len(one) // 1024)
                hot = values[many].tobytes() + times[many].astype(_I64).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index(doc_id)).cast(pa.int64()),
                        pa.array(key.view(np.int64), mask=counts == 0),
                        pa.array(counts.astype(np.int64)),
                        pa.array([hot] + [None] * (len(counts) - 1), pa.binary()),
                    ],
                    names=["doc_id", "class", "n_shingles", "hot"],
                )

    return run


def _hot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0).to_pylist():
            half = len(value) // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(value[:half], _I64)), pa.array(np.frombuffer(value[half:], _I64))], names=["run", "times"]
            )


def _hot_runs(classes: DataFrame, documents: int, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of more than about 1/1024 of the documents and, as their frequency, the sum of the passes.

    At most ``HOT_RUNS`` entries: no more than runs / least runs can occur ``least`` times.
    """
    least = max(documents // 1024, runs // HOT_RUNS, HOT_FLOOR)
    found = (
        classes.filter("hot is not null").select("hot").mapInArrow(_hot_rows, "run long, times long")
        .groupBy("run").agg(F.sum("times").alias("times")).filter(F.col("times") >= least)
        .orderBy("run").toArrow()
    )
    values = found.column("run").to_numpy().view(np.uint64)
    values = _named(values, (values & np.uint64(0xFFFF)) % np.uint64(buckets))
    values, first = np.unique(values, return_index=True)
    return values, found.column("times").to_numpy()[first]


def _ragged(k: np.ndarray, n: np.ndarray, bucket: np.ndarray, columns: Columns) -> Iterator[pa.RecordBatch]:
    """Entries to their buckets; a class with several in a bucket is named once for all of them."""
    order = np.lexsort((k, bucket))
    bucket, k, n = bucket[order], k[order], n[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (bucket[1:] != bucket[:-1])
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(k))).astype(np.int32)
    heads = scatter(bucket[at], {"k": k[at], "n": n[at].astype(np.int32), "len": length})
    tails = scatter(bucket, {name: values[order] for name, values in columns.items()})
    for head, tail in zip(heads, tails, strict=True):
        yield pa.RecordBatch.from_arrays([*head.columns, *tail.columns[1:]], names=[*head.schema.names, *tail.schema.names[1:]])


def _to_runs(size: int, text: str, buckets: int, hot: np.ndarray):
    """Every distinct set of a pass, hash by hash, to the bucket of the hash: the upper 48 bits, and of
    the others what the bucket tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, text, SET_BYTES):
                grams, sets, key = document_sets(part, size, text)
                _, one = np.unique(key, return_index=True)
                own = _mask(one, len(key))
                row = spread(sets)
                grams, row = grams[own[row]], row[own[row]]
                bucket = ((grams & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int32)
                grams = _named(grams, bucket)
                if len(hot):  # these need no count: any bucket will do
                    known = _among(hot, grams)[0]
                    cold, warm = np.flatnonzero(~known), np.flatnonzero(known)
                else:
                    cold, warm = np.arange(len(grams)), np.empty(0, np.int64)
                sizes = np.diff(sets)
                cut = {"low": (grams[cold] >> np.uint64(16)).astype(np.uint32), "high": (grams[cold] >> np.uint64(48)).astype(np.uint16)}
                for made in _ragged(key[row[cold]], sizes[row[cold]], bucket[cold], cut):
                    yield _completed(made)
                away = (key[row[warm]] % np.uint64(buckets)).astype(np.int32)
                for made in _ragged(key[row[warm]], sizes[row[warm]], away, {"run": grams[warm]}):
                    yield _completed(made)

    return run


def _named(grams: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Upper 48 bits and the bucket: what travels of a run's hash."""
    return (grams & ~np.uint64(0xFFFF)) | (bucket.astype(np.uint64) & np.uint64(0xFFFF))


def _completed(made: pa.RecordBatch) -> pa.RecordBatch:
    """Null where a kind of entry lacks a column."""
    names = ["bucket", "k", "n", "len", "low", "high", "run"]
    empty = pa.nulls(made.num_rows, pa.binary())
    return pa.RecordBatch.from_arrays([made.column(n) if n in made.schema.names else empty for n in names], names=names)


def _among(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value occurs, and where."""
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values, at


def _count_runs(buckets: int, hot: np.ndarray, times: np.ndarray):
    """Frequency of every run of a bucket; those of two documents or more go to their documents."""

    def work(bucket: int, c: Columns) -> Iterator[pa.RecordBatch]:
        low, high = c["low"], c["high"]
        owner = np.repeat(np.arange(len(c["len"]), dtype=np.int32), c["len"])
        parts = max(1, -(-len(low) // SORTED_ENTRIES))
        which = ((low >> np.uint32(1)) % np.uint32(parts)).astype(np.uint16)
        owners, runs, dfs = [], [], []
        for part in range(parts):
            at = np.flatnonzero(which == part)
            run = (high[at].astype(np.uint64) << np.uint64(48)) | (low[at].astype(np.uint64) << np.uint64(16))
            order = np.argsort(run)
            value, at = run[order], at[order]
            same = value[1:] == value[:-1]
            twice = np.zeros(len(value), bool)
            twice[1:] |= same
            twice[:-1] |= same
            at, value = at[twice], value[twice]
            k = c["k"][owner[at]]
            order = np.lexsort((k, value))  # a class may come from several passes
            at, value, k = at[order], value[order], k[order]
            new = np.ones(len(at), bool)
            new[1:] = (value[1:] != value[:-1]) | (k[1:] != k[:-1])
            at, value = at[new], value[new]
            if not len(at):
                continue
            start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            length = np.diff(np.append(start, len(value)))
            df = np.repeat(length, length)
            owners.append(owner[at[df > 1]])
            runs.append(_named(value[df > 1], np.full(1, bucket)))
            dfs.append(df[df > 1].astype(np.int32))
        if owners:
            yield from _to_profiles(c, np.concatenate(owners), np.concatenate(runs), np.concatenate(dfs), buckets)

    def all_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, hot_rows = table.column("bucket")[0].as_py(), table.column("run").is_valid()
        warm = table.filter(hot_rows) if table.column("run").null_count < table.num_rows else None
        cold = table if warm is None else table.filter(pc.invert(hot_rows))
        if cold.num_rows:
            yield from work(bucket, gather(cold, {"k": _U64, "n": _I32, "len": _I32, "low": "<u4", "high": "<u2"}))
        if warm is not None:
            c = gather(warm, {"k": _U64, "n": _I32, "len": _I32, "run": _U64})
            owner = np.repeat(np.arange(len(c["len"]), dtype=np.int32), c["len"])
            yield from _to_profiles(c, owner, c["run"], times[_among(hot, c["run"])[1]], buckets)

    return all_of


def _to_profiles(c: Columns, owner: np.ndarray, run: np.ndarray, df: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    k = c["k"][owner]
    bucket = (k % np.uint64(buckets)).astype(np.int32)
    yield from _ragged(k, c["n"][owner], bucket, {"run": run, "df": np.minimum(df, 2**31 - 1).astype(np.int32)})


def _mask(index: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, bool)
    out[index] = True
    return out


_PROFILE = "class long, n int, runs binary, dfs binary"


def _profiles(percent: int):
    """The shared runs of each class, rarest first; classes with too few for a partner go."""

    def work(c: Columns) -> Iterator[pa.RecordBatch]:
        k, n, run, df = np.repeat(c["k"], c["len"]), np.repeat(c["n"], c["len"]), c["run"], c["df"]
        order = np.lexsort((run, df, k))
        new = np.ones(len(order), bool)
        new[1:] = (run[order][1:] != run[order][:-1]) | (k[order][1:] != k[order][:-1])
        order = order[new]
        start = np.flatnonzero(np.concatenate(([True], k[order][1:] != k[order][:-1]))) if len(order) else np.empty(0, np.int64)
        length = np.diff(np.append(start, len(order)))
        n = n[order[start]]
        fit = np.flatnonzero(length >= _need(n, percent))
        runs, dfs = run[order], df[order]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(k[order[start[fit]]].view(np.int64) if len(fit) else np.empty(0, np.int64)),
                pa.array(n[fit]),
                pa.array([runs[a : a + b].tobytes() for a, b in zip(start[fit], length[fit], strict=True)], pa.binary()),
                pa.array([dfs[a : a + b].tobytes() for a, b in zip(start[fit], length[fit], strict=True)], pa.binary()),
            ],
            names=["class", "n", "runs", "dfs"],
        )

    return work


def adaptive_matches(n: int, df: np.ndarray, percent: int) -> int:
    """The number of shared prefix runs to ask for: least postings plus expected verifications.

    ``df``: frequencies of the runs that other documents have too, ascending. A candidate uses up
    ``l`` postings at least, so there are at most postings / l candidates.
    """
    need = (n * percent + 99) // 100
    shortest = n - need + 1 - (n - len(df))
    most = min(MOST_MATCHES, need)
    read = np.cumsum(df.astype(np.int64))[shortest - 1 : shortest - 1 + most]
    matches = np.arange(1, len(read) + 1)
    return int(matches[np.argmin(read + VERIFY_COST * (read - np.arange(shortest, shortest + len(read))) / matches)])


def _postings(percent: int, buckets: int):
    """Each class's prefix, posted at its runs; the label is the component found so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []  # class, label, matches, prefix, size
            for k, n, runs, dfs, label in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                df = np.frombuffer(dfs, _I32)
                matches = adaptive_matches(n, df, percent)
                need = (n * percent + 99) // 100
                prefix = np.frombuffer(runs, _U64)[: n - need + matches - (n - len(df))]
                parts.append((k, label if label is not None else k, matches, prefix, n))
            if not parts:
                continue
            sizes = [len(p[3]) for p in parts]
            run_ = np.concatenate([p[3] for p in parts])
            yield from scatter(
                (mix(run_) % np.uint64(buckets)).astype(np.int32),
                {
                    "run": run_,
                    "k": np.repeat(np.array([p[0] for p in parts], np.int64), sizes),
                    "label": np.repeat(np.array([p[1] for p in parts], np.int64), sizes),
                    "l": np.repeat(np.array([p[2] for p in parts], np.int32), sizes),
                    "n": np.repeat(np.array([p[4] for p in parts], np.int32), sizes),
                },
            )

    return run


def _lists(c: Columns, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by run, then ``second``; starts and ends of the lists with several labels."""
    order = np.lexsort((second, c["run"]))
    run = c["run"][order]
    start = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.empty(0, np.int64)
    end = np.append(start[1:], len(run))
    label = c["label"][order]
    low, high = (f.reduceat(label, start) if len(start) else label for f in (np.minimum, np.maximum))
    several = low != high
    return order, start[several], end[several]


def _stars(buckets: int):
    """Every member of a list with each of the list's pivots, its first in ``PIVOTS`` random orders."""

    def work(c: Columns) -> Iterator[pa.RecordBatch]:
        for turn in range(PIVOTS):
            turned = mix(c["k"].view(np.uint64) + np.uint64(turn))
            order, start, end = _lists(c, turned)
            at = np.repeat(start, end - start)
            member = at + (np.arange(len(at)) - np.repeat(np.cumsum(end - start) - (end - start), end - start))
            a, b = c["k"][order[member]], c["k"][order[at]]
            pairs, count = _pair_counts(a[a != b], b[a != b])
            yield from scatter(
                (mix(pairs[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int32),
                {"a": pairs[:, 0], "b": pairs[:, 1], "count": count.astype(np.int32), "turn": np.full(len(count), turn, np.int32)},
            )

    return work


def _pair_counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return np.stack((a[at], b[at]), 1).reshape(-1, 2).copy(), np.diff(np.append(at, len(a)))


def _best_star(c: Columns) -> Iterator[pa.RecordBatch]:
    """For each order, of a class's pivots the one it shares most prefix runs with."""
    best = []
    for turn in range(PIVOTS):
        mine = c["turn"] == turn
        order = np.lexsort((c["b"][mine], c["a"][mine]))
        a, b, count = (c[name][mine][order] for name in ("a", "b", "count"))
        if not len(a):
            continue
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(count, at)
        a, b = a[at], b[at]
        order = np.lexsort((b, -total, a))
        first = np.ones(len(order), bool)
        first[1:] = a[order][1:] != a[order][:-1]
        best.append(np.stack((a[order][first], b[order][first]), 1))
    pairs = np.unique(np.concatenate(best), axis=0) if best else np.empty((0, 2), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"])


#: Pairs made at once from the lists of a bucket, before equal pairs are counted together.
_CHUNK = 1 << 20


def shared_prefix(n: np.ndarray, m: np.ndarray, l: np.ndarray, o: np.ndarray, percent: int) -> np.ndarray:
    """Prefix runs that linked sets of ``n`` and ``m`` runs share at least, for demands ``l`` and ``o``.

    Of the two prefixes one ends first in the common order. What the sets share up to there lies in both prefixes; what they
    share after it is among the ``need - l`` runs behind that prefix.
    """
    overlap = -(-percent * (n.astype(np.int64) + m) // (100 + percent))
    behind = np.maximum(_need(n, percent) - l, _need(m, percent) - o)
    return np.maximum(overlap - behind, np.minimum(l, o))


def _crosses(buckets: int, percent: int):
    """All pairs of a list whose labels differ and whose sizes allow a link, counted per pair within the bucket."""

    def work(c: Columns) -> Iterator[pa.RecordBatch]:
        order, start, end = _lists(c, c["label"].view(np.uint64))
        label, k, l, n = c["label"][order], c["k"][order], c["l"][order], c["n"][order].astype(np.int64)
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            i, j = np.concatenate(left), np.concatenate(right)
            near = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[near], j[near]
            swap = k[i] > k[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            pairs, count = _pair_counts(k[i], k[j])
            asked = _first_of(k[i], k[j], shared_prefix(n[i], n[j], l[i], l[j], percent))
            bucket = (mix(mix(pairs[:, 0].view(np.uint64)) + pairs[:, 1].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield from scatter(bucket, {"a": pairs[:, 0], "b": pairs[:, 1], "count": count.astype(np.int32), "l": asked})

        for s, e in zip(start, end, strict=True):
            groups = s + np.flatnonzero(np.concatenate(([True], label[s + 1 : e] != label[s : e - 1])))
            for g, h in zip(groups, np.append(groups[1:], e), strict=True):
                # members g..h of one label against all members after them in the list
                rest = e - h
                for one in range(g, h) if rest else ():
                    left.append(np.full(rest, one))
                    right.append(np.arange(h, e))
                    size += rest
                    if size >= _CHUNK:
                        yield from flush()
                        left.clear()
                        right.clear()
                        size = 0
        if size:
            yield from flush()

    return work


def _first_of(a: np.ndarray, b: np.ndarray, value: np.ndarray) -> np.ndarray:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return value[order[new]].astype(np.int32)


def _matched(c: Columns) -> Iterator[pa.RecordBatch]:
    """Pairs that share as many prefix runs as a link asks of them."""
    order = np.lexsort((c["b"], c["a"]))
    a, b = c["a"][order], c["b"][order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(c["count"][order], at) if len(at) else np.empty(0, np.int32)
    keep = at[total >= c["l"][order[at]]]
    yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            linked = []
            for a, b, n, m, left, right in rows:
                merged = np.concatenate((np.frombuffer(left, _U64), np.frombuffer(right, _U64)))
                merged.sort()
                shared = int(np.count_nonzero(merged[1:] == merged[:-1]))
                if 100 * shared >= percent * (n + m - shared):
                    linked.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in linked], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _linked(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    side = profiles.select("class", "n", "runs")
    a = side.select(F.col("class").alias("a"), F.col("n").alias("n"), F.col("runs").alias("left"))
    b = side.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col("runs").alias("right"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "n", "m", "left", "right")
    return both.mapInArrow(_verify(percent), "a long, b long")


def jaccard_components(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two rows link when their sets of ``words``-word runs have a Jaccard similarity of
    ``percent`` / 100 or more; component_id is the smallest id reachable by links.
    """
    spark = prepare(docs.sparkSession)
    with dropped_shuffles(spark):
        source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        classes = staged(source.mapInArrow(_classes(words, "doc_id", "text"), _CLASS), "classes")
        seen = classes.agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("runs")).first()
        runs = seen["runs"] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs // BUCKET_ENTRIES))
        hot, times = _hot_runs(classes, seen["docs"], runs, buckets)

        posted = source.select("text").mapInArrow(_to_runs(words, "text", buckets, hot), schema(["k", "n", "len", "low", "high", "run"]))
        counted = by_bucket(posted, buckets, None, _count_runs(buckets, hot, times), schema(["k", "n", "len", "run", "df"]))
        profiles = staged(
            by_bucket(counted, buckets, {"k": _U64, "n": _I32, "len": _I32, "run": _U64, "df": _I32}, _profiles(percent), _PROFILE),
            "profiles",
        )

        entries = {"run": _U64, "k": _I64, "label": _I64, "l": _I32, "n": _I32}
        alone = profiles.select("class", "n", "runs", "dfs", F.lit(None).cast("long").alias("component"))
        postings = alone.mapInArrow(_postings(percent, buckets), schema(["run", "k", "label", "l", "n"]))
        met = by_bucket(postings, buckets, entries, _stars(buckets), schema(["a", "b", "count", "turn"]))
        stars = by_bucket(met, buckets, {"a": _I64, "b": _I64, "count": _I32, "turn": _I32}, _best_star, "a long, b long")
        links = staged(_linked(stars, profiles, percent), "links")
        labels = components(links)

        labelled = profiles.join(labels, F.col("class") == F.col("node"), "left").select("class", "n", "runs", "dfs", "component")
        postings = labelled.mapInArrow(_postings(percent, buckets), schema(["run", "k", "label", "l", "n"]))
        met = by_bucket(postings, buckets, entries, _crosses(buckets, percent), schema(["a", "b", "count", "l"]))
        crosses = by_bucket(met, buckets, {"a": _I64, "b": _I64, "count": _I32, "l": _I32}, _matched, "a long, b long")
        found = staged(_linked(crosses, profiles, percent), "links")
        labels = components(links.unionByName(found))

    named = (
        classes.join(labels, F.col("class") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "class").alias("c"))
    )
    least = named.filter("c is not null").groupBy("c").agg(F.min("doc_id").alias("least"))
    return named.join(least, "c", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


#: The same rows in SQL, for unique ids.
ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS runs
  FROM split
), entries AS MATERIALIZED (SELECT doc_id, hash(unnest(runs)) AS run FROM sets),
sizes AS MATERIALIZED (SELECT doc_id, CAST(len(runs) AS BIGINT) AS n FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM entries a JOIN entries b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM shared s JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * s.n >= 75 * (p.n + q.n - s.n)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT l.x, r.other FROM reach r JOIN links l ON l.y = r.doc_id
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""
