"""Removal of repeated lines by a deletion-neighbourhood join.

The unit is a line with a word, compared as its sequence of words (A-Z in lower
case, any white space between them). For a line of at least ``min_words`` words the edit distance counts inserted, deleted and replaced
words and its bound is 1; a shorter line, where one word is much of it, is a repeated line only when an earlier
line has the same words (bound 0), and it is never near a longer one. Every longer line emits hashes of all variants within the bound: itself and itself
without one word. Two lines are within the bound exactly when one equals a variant of the other or
both give the same variant by a deletion at the same place, so the positions verify the distance.

An occurrence stays when it is the earliest (smallest doc_id, then line number) of its words and no
line that starts earlier is within the bound. The relation is not closed: a line goes if an earlier
near line exists, even if that one goes too.

Only lines that can have a neighbour emit variants: two lines within the bound share their first or
their last half (of the longer one's length less one word), so halves are counted first.

Only repeated lines go: every other line, blank ones too, stays as it is. Defined results: null and empty text stay as
they are. Rows of one doc_id count as one document. Rows without doc_id stay unchanged and repeat nothing. A text
of which every line goes becomes empty. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.exchange import Columns, by_bucket, scatter, schema
from rankloom.llm.textbatch import (
    _power_tables, lowered, mix, passes, prepare, span_hashes, text_buffers, word_spans,
)
from rankloom.session import staged

MIN_WORDS = 5
#: Bytes of text per bucket. A word and its separator take two at least, so there are fewer entries than bytes.
BUCKET_BYTES = 16 << 20
_U = np.uint64


class Lines:
    """The lines of a pass with at least so many words: document row, line number, first and last word, prefix sums."""

    def __init__(self, column: pa.Array, min_words: int) -> None:
        data, bounds = text_buffers(column)
        data = lowered(data)
        breaks = np.flatnonzero(data == 10) + 1
        line_starts = np.union1d(bounds[:-1], breaks) if len(bounds) > 1 else breaks
        # an empty text shares its start with the next one and has no words
        starts, ends, first = word_spans(data, np.append(line_starts, len(data)))
        count = np.diff(first)
        at = np.flatnonzero(count >= min_words)
        self.row = np.searchsorted(bounds, line_starts[at], side="right") - 1
        before = np.searchsorted(breaks, bounds[self.row], side="right")
        self.number = np.searchsorted(breaks, line_starts[at], side="right") - before
        self.s, self.e, self.n = first[at], first[at] + count[at], count[at]
        words = span_hashes(data, starts, ends)
        up, self.down = _power_tables(len(words) + 2)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)))

    def part(self, s: np.ndarray, e: np.ndarray, shift: np.ndarray | int = 0) -> np.ndarray:
        """Hash of words s..e, as if ``shift`` words further on."""
        value = (self.sums[e] - self.sums[s]) * self.down[s]
        return value if isinstance(shift, int) else value * _power_tables(int(shift.max(initial=0)) + 1)[0][shift]

    def whole(self) -> np.ndarray:
        return mix(self.part(self.s, self.e) ^ self.n.astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def halves(self) -> list[np.ndarray]:
        """Keys of the first and last half, for a longest line of n and of n + 1 words."""
        keys = []
        for longest in (self.n, self.n + 1):
            half = longest // 2
            tag = half.astype(np.uint64) * _U(0xA0761D6478BD642F)
            keys.append(mix(self.part(self.s, self.s + half) ^ tag))
            keys.append(mix(mix(self.part(self.e - half, self.e) ^ tag) + _U(1)))
        return keys


def _first_lines(min_words: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                lines = Lines(part.column(1), 1)
                doc = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[lines.row]
                h = lines.whole()
                at = _earliest(h, doc, lines.number)
                columns = {"h": h[at], "doc": doc[at], "line": lines.number[at].astype(np.int32)}
                near = lines.n[at] >= min_words
                # keys of 0: compared as a whole only
                columns |= {f"k{i}": np.where(near, key[at], _U(0)) for i, key in enumerate(lines.halves())}
                yield from scatter((h[at] % _U(buckets)).astype(np.int32), columns)

    return run


def _earliest(key: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Index of the earliest (doc, line) of each key."""
    order = np.lexsort((line, doc, key))
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    return order[new]


def _first_of_all(c: Columns) -> Iterator[pa.RecordBatch]:
    at = _earliest(c["h"], c["doc"], c["line"])
    yield pa.RecordBatch.from_arrays(
        [pa.array(c["h"][at].view(np.int64)), pa.array(c["doc"][at]), pa.array(c["line"][at])]
        + [pa.array(c[f"k{i}"][at].view(np.int64)) for i in range(4)],
        names=["h", "doc", "line", "k0", "k1", "k2", "k3"],
    )


def _half_keys(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, line, *keys = (batch.column(i).to_numpy() for i in range(7))
            near = (keys[0] != 0) | (keys[1] != 0)
            h, doc, line, *keys = (values[near] for values in (h, doc, line, *keys))
            # n // 2 and (n + 1) // 2 are equal for even n: then the second pair repeats the first
            odd = keys[0] != keys[2]
            key = np.concatenate((keys[0], keys[1], keys[2][odd], keys[3][odd])).view(np.uint64)
            take = np.concatenate((np.arange(len(h)), np.arange(len(h)), np.flatnonzero(odd), np.flatnonzero(odd)))
            yield from scatter((key % _U(buckets)).astype(np.int32), {"key": key, "doc": doc[take], "line": line[take]})

    return run


def _shared_halves(c: Columns) -> Iterator[pa.RecordBatch]:
    """Places of lines that share a half with another line."""
    order = np.argsort(c["key"])
    key = c["key"][order]
    same = key[1:] == key[:-1]
    twice = np.zeros(len(key), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = order[twice]
    place = np.unique(np.stack((c["doc"][at], c["line"][at].astype(np.int64)), 1), axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(place[:, 0])), pa.array(place[:, 1].astype(np.int32))], names=["doc", "line"]
    )


_VARIANT = {"v": "<u8", "doc": "<i8", "line": "<i4", "pos": "<i4"}


def _variants(min_words: int, buckets: int):
    """All variants of the marked lines: per pass and (variant, position) the earliest place.

    A line that is not the earliest of such a group in its pass is late already and is sent as
    a row of bucket -1 - its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                lines = Lines(part.column(1), min_words)
                ids = part.column(0).to_numpy().astype(np.int64)
                marks = part.column(2)
                marked_row = np.repeat(np.arange(len(ids)), np.diff(marks.offsets.to_numpy()))
                marked = np.sort(marked_row * (1 << 40) + marks.flatten().to_numpy().astype(np.int64))
                place = lines.row.astype(np.int64) * (1 << 40) + lines.number
                at = np.flatnonzero(np.isin(place, marked))
                if not len(at):
                    continue
                doc, line = ids[lines.row[at]], lines.number[at].astype(np.int32)
                s, e, n = lines.s[at], lines.e[at], lines.n[at]
                owner = np.repeat(np.arange(len(at)), n)
                pos = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                cut = s[owner] + pos
                rest = lines.part(s[owner], cut) + lines.part(cut + 1, e[owner], pos)
                rest = mix(rest ^ (n[owner] - 1).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
                v = np.concatenate((lines.whole()[at], rest))
                own = np.concatenate((np.arange(len(at)), owner))
                where = np.concatenate((np.full(len(at), -1), pos)).astype(np.int32)
                order, new = _groups(v, where, doc[own], line[own])
                late = own[_later(order, new, doc[own], line[own])]
                first = order[new]
                yield from scatter(
                    (v[first] % _U(buckets)).astype(np.int32),
                    {"v": v[first], "doc": doc[own[first]], "line": line[own[first]], "pos": where[first]},
                )
                late = np.unique(late)
                yield from scatter(
                    (mix(doc[late].view(np.uint64)) % _U(buckets)).astype(np.int32),
                    {"v": np.zeros(len(late), np.uint64), "doc": doc[late], "line": line[late], "pos": np.full(len(late), -2, np.int32)},
                )

    return run


def _groups(v: np.ndarray, pos: np.ndarray, doc: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (variant, position, place) and the mask of each group's first."""
    order = np.lexsort((line, doc, pos, v))
    new = np.ones(len(order), bool)
    new[1:] = (v[order][1:] != v[order][:-1]) | (pos[order][1:] != pos[order][:-1])
    return order, new


def _later(order: np.ndarray, new: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Members of the groups at another place than the group's first (a repeated row is at the same)."""
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(order) else order
    return order[(doc[order] != doc[first]) | (line[order] != line[first])]


def _late_lines(c: Columns) -> Iterator[pa.RecordBatch]:
    """Places of lines with an earlier line within the bound."""
    known = c["pos"] == -2
    done = np.stack((c["doc"][known], c["line"][known].astype(np.int64)), 1)
    v, doc, line, pos = (c[name][~known] for name in ("v", "doc", "line", "pos"))
    order, new = _groups(v, pos, doc, line)
    late = [_later(order, new, doc, line)]
    # a line that is itself the variant (-1) against those that are a word longer
    v, pos = v[order], pos[order]
    start = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.empty(0, np.int64)
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(v))))
    whole = np.flatnonzero(pos == -1)
    has = np.full(len(start), -1, np.int64)
    has[group[whole[::-1]]] = whole[::-1]
    longer = np.flatnonzero((pos >= 0) & (has[group] >= 0) & new)
    if len(longer):
        base = order[has[group[longer]]]
        other = order[longer]
        later = (doc[base] < doc[other]) | ((doc[base] == doc[other]) & (line[base] < line[other]))
        late += [other[later], base[~later]]
    at = np.concatenate(late)
    place = np.unique(np.concatenate((done, np.stack((doc[at], line[at].astype(np.int64)), 1))), axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(place[:, 0])), pa.array(place[:, 1].astype(np.int32))], names=["doc", "line"]
    )


def _rewrite():
    word = re.compile(r"[^\x20\x09-\x0D]")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, out, total, gone = batch.column(names.index("text")).to_pylist(), [], [], []
            keeps = batch.column(names.index("_kept")).to_pylist()
            ids = batch.column(names.index("_id")).to_pylist()
            for text, keep, doc in zip(texts, keeps, ids, strict=True):
                lines = (text or "").split("\n")
                worded = [i for i, line in enumerate(lines) if word.search(line)]
                stay = set(keep or ())
                drop = {i for i in worded if i not in stay} if doc is not None else set()
                total.append(len(worded))
                gone.append(len(drop))
                if not drop:
                    out.append(text)
                else:
                    out.append("\n".join(line for i, line in enumerate(lines) if i not in drop))
            columns = [batch.column(i) for i, name in enumerate(names) if name not in ("text", "_kept", "_id")]
            rest = [name for name in names if name not in ("text", "_kept", "_id")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                names=[*rest, "text", "_lines", "_removed"],
            )

    return run


def deduplicate_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus ``n_lines`` (lines with a word) and ``n_removed``.

    Columns of these two names in ``docs`` are replaced.
    """
    spark = prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).filter("doc is not null")
    size = source.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    names = ["h", "doc", "line", "k0", "k1", "k2", "k3"]
    posted = source.mapInArrow(_first_lines(min_words, buckets), schema(names))
    types = {name: "<u8" for name in names} | {"doc": "<i8", "line": "<i4"}
    firsts = staged(
        by_bucket(posted, buckets, types, _first_of_all, "h long, doc long, line int, k0 long, k1 long, k2 long, k3 long"), "lines"
    )
    keyed = firsts.mapInArrow(_half_keys(buckets), schema(["key", "doc", "line"]))
    shared = by_bucket(keyed, buckets, {"key": "<u8", "doc": "<i8", "line": "<i4"}, _shared_halves, "doc long, line int")
    marks = shared.groupBy("doc").agg(F.collect_set("line").alias("marks"))
    marked = source.join(marks, "doc").select("doc", "text", "marks")
    emitted = marked.mapInArrow(_variants(min_words, buckets), schema(list(_VARIANT)))
    late = by_bucket(emitted, buckets, _VARIANT, _late_lines, "doc long, line int").distinct()
    kept = (
        firsts.select("doc", "line").join(late, ["doc", "line"], "left_anti")
        .groupBy("doc").agg(F.collect_list("line").alias("_kept"))
    )
    others = [c for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    inner = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text).alias("text"), F.col(doc_id).cast("long").alias("_id"))
    joined = inner.join(kept.withColumnRenamed("doc", "_id"), "_id", "left").select(
        *[f"c{i}" for i in range(len(others))], "text", "_kept", "_id"
    )
    kinds = dict(docs.dtypes)
    out = ", ".join([*(f"c{i} {kinds[c]}" for i, c in enumerate(others)), "text string", "_lines long", "_removed long"])
    done = joined.mapInArrow(_rewrite(), out)
    by_name = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(others)} | {text: F.col("text").alias(text)}
    return done.select(
        *[by_name[c] for c in docs.columns if c in by_name], F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed")
    )


#: (doc_id, n_lines, n_removed, text) in SQL, for unique ids.
ORACLE = r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
  FROM documents
), lines AS MATERIALIZED (
  SELECT doc_id, n, line, list_filter(string_split_regex(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM parts
), firsts AS MATERIALIZED (
  SELECT words, min({'d': doc_id, 'n': n}) AS place FROM lines WHERE len(words) > 0 GROUP BY words
), variants AS MATERIALIZED (
  SELECT place, 0 AS pos, md5(array_to_string(words, ' ')) AS v FROM firsts WHERE len(words) >= 5
  UNION ALL
  SELECT place, i AS pos, md5(array_to_string(list_concat(words[1:i - 1], words[i + 1:]), ' ')) AS v
  FROM (SELECT place, words, unnest(range(1, len(words) + 1)) AS i FROM firsts WHERE len(words) >= 5)
), late AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY v, pos) AS least FROM variants) WHERE least < place
  UNION
  SELECT greatest(a.place, b.place) FROM variants a JOIN variants b ON a.v = b.v AND a.pos = 0 AND b.pos > 0
), marked AS (
  SELECT l.doc_id, l.n, l.line, len(l.words) > 0 AS countable,
    len(l.words) > 0 AND (f.place <> {'d': l.doc_id, 'n': l.n} OR f.place IN (SELECT place FROM late)) AS gone
  FROM lines l LEFT JOIN firsts f ON f.words = l.words
), rebuilt AS (
  SELECT doc_id, count(*) FILTER (WHERE countable) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone) AS rest
  FROM marked GROUP BY doc_id
)
SELECT r.doc_id, n_lines, n_removed, CASE WHEN n_removed = 0 THEN d.text ELSE coalesce(rest, '') END AS text
FROM rebuilt r JOIN documents d ON d.doc_id = r.doc_id
"""
