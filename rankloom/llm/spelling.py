"""Spelling variants: words within one edit of each other, found in a trie of letter-group counts.

Every word is the vector of its counts per letter group, and the words lie in a trie by successive counts.
One edit takes one unit from one group, gives one to another, or both; so the near words of a word
are found by a depth-first search that may go one count too high once and one count too low once.
The words of the leaves it reaches are verified letter by letter.

1. Words are cut, counted and filtered in DataFrame operations.
2. Letter groups follow the frequencies of letters in the vocabulary, so that counts tell words apart.
3. The top of the trie deals the work: a node of at most ``shard_words`` words is a shard. Each word visits,
   with its budgets, every shard that may hold a near word; shards with many visitors are cut by visitor.
4. A task builds the trie of its shard and lets the visitors search it, block by block.

The top of the trie has at most ``TOP_SHARE`` inner nodes a level, each of at most ``CLIP + 1`` children, whatever the
size of the vocabulary; it is the only thing that passes through the driver. A task holds one shard, at most the greater of
``SHARD_WORDS`` words and the vocabulary's ``1 / TOP_SHARE``, or the words whose counts are equal in all groups.

Defined results: null and empty texts have no words; a null doc_id counts as an empty one; repeated rows
count each time; other columns are not read. An empty table gives an empty result. Of equally frequent near words
the smallest in code-point order is the form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.textbatch import release, text_buffers
from rankloom.session import configure, staged

GROUPS = 24
#: Counts from here on are one: the search loses nothing, as clipped counts differ by no more than true ones.
CLIP = 7
SHARD_WORDS = 32_768
#: A shard holds the vocabulary's thousandth at least, so a level of the top has at most a thousand inner nodes.
TOP_SHARE = 1000
#: Visitors that one task takes to one shard.
VISITORS = 50_000
#: A trie node of at most this many words is a leaf.
LEAF_WORDS = 8
#: Visitors that search at once, and the most states of a search that are expanded at once.
BLOCK = 2048
FRONTIER = 200_000
#: Words up to this length are verified as rows of a matrix, longer ones one by one.
WIDTH = 40
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
FIELDS = "word string, form string, root string, n long, n_near long, form_n long"


def words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_chars: int = 6, divisor: int = 199) -> DataFrame:
    """One row per occurrence of a word: a maximal run of Latin letters, A-Z in lower case.

    A run whose crc32 together with its document's id is divisible by ``divisor`` loses one letter.
    """
    run = F.regexp_extract_all(F.col(text), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least_chars},}})"), F.lit(1))
    rows = docs.select(F.col(doc_id).cast("string").alias("doc"), F.explode(run).alias("word"))
    rows = rows.withColumn("word", F.translate("word", _UPPER, _LOWER))
    h = F.crc32(F.concat(F.coalesce("doc", F.lit("")), F.lit(":"), F.col("word")))
    at = (F.col("h") % F.char_length("word")).cast("int")
    shorter = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    changed = F.when(F.col("h") % divisor == 0, shorter).otherwise(F.col("word"))
    return rows.withColumn("h", h).select(changed.alias("word")).filter(F.char_length("word") >= least_chars)


def vocabulary(occurrences: DataFrame, least_count: int = 5) -> DataFrame:
    return occurrences.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def letter_groups(vocab: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of each group, the most frequent group first; there are at most 90 letters.

    A letter goes, in order of frequency, to the group with the fewest occurrences so far.
    """
    letter = F.explode(F.split("word", "")).alias("letter")
    counted = vocab.select(letter).filter("letter <> ''").groupBy("letter").count().collect()
    members, weight = [""] * groups, [0] * groups
    for row in sorted(counted, key=lambda r: (-r["count"], r["letter"])):
        least = min(range(groups), key=lambda g: (weight[g], g))
        members[least] += row["letter"]
        weight[least] += row["count"]
    return [members[g] for g in sorted(range(groups), key=lambda g: (-weight[g], g))]


def signature(word: Column, groups: list[str]) -> Column:
    """The clipped counts of all groups, a digit each."""
    size = F.char_length(word)
    digits = [F.least(F.lit(CLIP), size - F.char_length(F.translate(word, g, ""))).cast("string") if g else F.lit("0") for g in groups]
    return F.concat(*digits)


class Top:
    """The top of the trie: inner nodes, and the shards that hang from them."""

    def __init__(self) -> None:
        self.child = np.full((0, CLIP + 1), -1, np.int64)
        self.shard = np.full((0, CLIP + 1), False)

    @classmethod
    def of(cls, vectors: DataFrame, total: int, least: int) -> Top:
        """Counts prefixes level by level while a node holds more than a shard may."""
        top, limit = cls(), max(least, -(-total // TOP_SHARE))
        inner = {"": 0} if total > limit else {}
        level = 0
        while inner:
            level += 1
            prefix = F.substring("sig", 1, level).alias("prefix")
            rows = vectors.groupBy(prefix).agg(F.count(F.lit(1)).alias("size"))
            parents = vectors.sparkSession.createDataFrame([(p,) for p in inner], "parent string")
            rows = rows.join(parents, F.expr(f"left(prefix, {level - 1})") == F.col("parent"), "left_semi")
            base = len(top.child) + len(inner)
            top.child = np.vstack([top.child, np.full((len(inner), CLIP + 1), -1, np.int64)])
            top.shard = np.vstack([top.shard, np.full((len(inner), CLIP + 1), False)])
            following: dict[str, int] = {}
            for found, size in sorted((r["prefix"], r["size"]) for r in rows.collect()):
                node, value = inner[found[:-1]], int(found[-1])
                if size > limit and level < GROUPS:
                    following[found] = top.child[node, value] = base + len(following)
                else:
                    top.shard[node, value] = True
            inner = following
        return top

    def visits(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, shard, whether the word lives there) of all shards within each word's budgets."""
        q = np.arange(len(counts))
        if not len(self.child):
            return q, np.zeros(len(q), np.int64), np.ones(len(q), bool)
        node, up, down = np.zeros(len(q), np.int64), np.ones(len(q), bool), np.ones(len(q), bool)
        out, level = [], 0
        while len(q):
            parts = []
            for q2, n2, v2, u2, d2 in _branches(q, node, up, down, counts[q, level]):
                here = self.shard[n2, v2]
                out.append((q2[here], n2[here] * (CLIP + 1) + v2[here] + 1, (u2 & d2)[here]))
                to = self.child[n2, v2]
                on = to >= 0
                parts.append((q2[on], to[on], u2[on], d2[on]))
            q, node, up, down = (np.concatenate(c) for c in zip(*parts))
            level += 1
        return tuple(np.concatenate(c) for c in zip(*out))


def _branches(q, node, up, down, own):
    """The three ways on from each state: the own count, one more, one less; each budget is spent once."""
    yield q, node, own.astype(np.int64), up, down
    at = np.flatnonzero(up & (own < CLIP))
    yield q[at], node[at], own[at].astype(np.int64) + 1, np.zeros(len(at), bool), down[at]
    at = np.flatnonzero(down & (own > 0))
    yield q[at], node[at], own[at].astype(np.int64) - 1, up[at], np.zeros(len(at), bool)


def _counts(signatures: pa.Array) -> np.ndarray:
    data, bounds = text_buffers(signatures)
    return (data - np.uint8(48)).reshape(len(bounds) - 1, -1)


class Words:
    """Words as bytes (Latin-1, a byte a letter), with signatures and counts."""

    def __init__(self, table: pa.Table) -> None:
        self.text = table.column("word").combine_chunks()
        self.n = table.column("n").to_numpy()
        self.counts = _counts(table.column("sig").combine_chunks())
        raw, bounds = text_buffers(self.text)
        lead = raw == 0xC3
        before = np.concatenate(([0], np.cumsum(lead)))
        self.start = bounds - before[bounds]
        data = raw.copy()
        data[1:][lead[:-1]] += np.uint8(0x40)
        self.data = data[~lead]
        self.length = np.diff(self.start)
        bits = np.uint32(1) << np.arange(self.counts.shape[1], dtype=np.uint32)
        self.parity = ((self.counts & 1) * bits).sum(axis=1, dtype=np.uint32)

    def matrix(self) -> np.ndarray:
        """The first ``WIDTH`` letters of every word, zeros after its end."""
        out = np.zeros((len(self.length), WIDTH), np.uint8)
        size = np.minimum(self.length, WIDTH)
        row = np.repeat(np.arange(len(size)), size)
        column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        out[row, column] = self.data[self.start[row] + column]
        return out


def one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return int(np.count_nonzero(a != b)) == 1
    if len(a) < len(b):
        a, b = b, a
    if len(a) != len(b) + 1:
        return False
    differ = np.flatnonzero(a[:-1] != b)
    at = int(differ[0]) if len(differ) else len(b)
    return bool(np.array_equal(a[at + 1 :], b[at:]))


def _one_edit_rows(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """``one_edit`` of matrix rows; ``longer`` is the difference of their lengths (-1, 0 or 1)."""
    swap = longer < 0
    a, b = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    differ = a != b
    # of words of unequal length the first difference is where the longer one has its extra letter
    after = np.arange(WIDTH - 1) >= differ.argmax(axis=1)[:, None]
    shifted = ~((a[:, 1:] != b[:, :-1]) & after).any(axis=1)
    return np.where(longer == 0, differ.sum(axis=1) == 1, shifted)


class Trie:
    """The trie of a shard's words; nodes of few words, and those of the last level, are leaves."""

    def __init__(self, members: Words) -> None:
        self.order = np.lexsort(members.counts.T[::-1])
        counts = members.counts[self.order]
        node = np.zeros(len(counts), np.int64)
        starts, ends, children = [np.zeros(1, np.int64)], [np.array([len(counts)])], []
        base = 0
        for level in range(counts.shape[1] + 1):
            start, end = starts[-1], ends[-1]
            table = np.full((len(start), CLIP + 1), -1, np.int64)
            children.append(table)
            if level == counts.shape[1]:
                break
            open_ = np.flatnonzero(end - start > LEAF_WORDS)
            if not len(open_):
                break
            at = _ranges(start[open_], end[open_])
            owner = node[at]
            value = counts[at, level].astype(np.int64)
            first = np.ones(len(at), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
            firsts = np.flatnonzero(first)
            table[owner[firsts], value[firsts]] = base + len(start) + np.arange(len(firsts))
            starts.append(at[firsts])
            ends.append(np.append(at[firsts][1:], 0))
            lasts = np.append(firsts[1:], len(at)) - 1
            ends[-1] = at[lasts] + 1
            node[at] = np.cumsum(first) - 1
            base += len(start)
        self.child = np.vstack(children)
        self.start, self.end = np.concatenate(starts), np.concatenate(ends)
        self.leaf = (self.child < 0).all(axis=1)

    def leaves(self, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, leaf) that a depth-first search within the budgets reaches."""
        q = np.arange(len(counts))
        stack = [(0, q, np.zeros(len(q), np.int64), np.ones(len(q), bool), np.ones(len(q), bool))]
        while stack:
            level, q, node, up, down = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(level, *(c[half:] for c in (q, node, up, down))), (level, *(c[:half] for c in (q, node, up, down)))]
                continue
            closed = self.leaf[node]
            if closed.any():
                yield q[closed], node[closed]
                q, node, up, down = (c[~closed] for c in (q, node, up, down))
            if not len(q):
                continue
            parts = []
            for q2, n2, v2, u2, d2 in _branches(q, node, up, down, counts[q, level]):
                to = self.child[n2, v2]
                on = to >= 0
                parts.append((q2[on], to[on], u2[on], d2[on]))
            stack.append((level + 1, *(np.concatenate(c) for c in zip(*parts))))

    def members(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the leaf in ``leaf`` and member, for all members of these leaves."""
        return np.repeat(np.arange(len(leaf)), self.end[leaf] - self.start[leaf]), self.order[_ranges(self.start[leaf], self.end[leaf])]


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """start[0]..end[0]-1, start[1]..end[1]-1, ..."""
    size = end - start
    total = int(size.sum())
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(total)


class Shard:
    """A shard's trie, asked block by block for the near words of its visitors."""

    def __init__(self, members: pa.Table) -> None:
        self.words = Words(members)
        self.trie = Trie(self.words)
        self.matrix = self.words.matrix()
        order = np.argsort(np.array(self.words.text.to_pylist(), object), kind="stable")
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))

    def near(self, visitors: pa.Table) -> pa.RecordBatch | None:
        """Per visitor with near words here: their number, and the most frequent one."""
        asked = Words(visitors)
        rows = asked.matrix()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for q, leaf in self.trie.leaves(asked.counts):
            sizes = np.cumsum(self.trie.end[leaf] - self.trie.start[leaf])
            at = 0
            while at < len(leaf):  # pairs in blocks, whatever the size of a leaf
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + FRONTIER, side="right")))
                place, member = self.trie.members(leaf[at:to])
                found.append(self._verified(asked, rows, q[at:to][place], member))
                at = to
        if not found:
            return None
        q, member = (np.concatenate(c) for c in zip(*found))
        if not len(q):
            return None
        order = np.lexsort((self.rank[member], -self.words.n[member], q))
        q, member = q[order], member[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        return pa.RecordBatch.from_arrays(
            [asked.text.take(pa.array(q[first])), pa.array(np.diff(np.append(first, len(q)))),
             pa.array(self.words.n[member[first]]), self.words.text.take(pa.array(member[first]))],
            names=["word", "n_near", "best_n", "best"],
        )

    def _verified(self, asked: Words, rows: np.ndarray, q: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        longer = asked.length[q] - self.words.length[member]
        some = (np.bitwise_count(asked.parity[q] ^ self.words.parity[member]) <= 2) & (np.abs(longer) <= 1)
        q, member, longer = q[some], member[some], longer[some]
        ok = np.zeros(len(q), bool)
        short = np.maximum(asked.length[q], self.words.length[member]) <= WIDTH
        for at in range(0, len(q), FRONTIER // 8):
            part = slice(at, at + FRONTIER // 8)
            ok[part] = _one_edit_rows(rows[q[part]], self.matrix[member[part]], longer[part])
        for i in np.flatnonzero(~short):
            a, b = q[i], member[i]
            ok[i] = one_edit(
                asked.data[asked.start[a] : asked.start[a + 1]], self.words.data[self.words.start[b] : self.words.start[b + 1]]
            )
        return q[ok], member[ok]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, part, visitor): the members of a part come first, then its visitors."""
    key, held, shard = None, [], None

    def done() -> Iterator[pa.RecordBatch]:
        if held and shard is not None:
            found = shard.near(pa.Table.from_batches(held))
            if found is not None:
                yield found

    for batch in batches:
        shards, parts, roles = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        change = np.flatnonzero((np.diff(shards) != 0) | (np.diff(parts) != 0) | (np.diff(roles) != 0)) + 1
        for at, to in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            if at == to:
                continue
            now = (int(shards[at]), int(parts[at]), bool(roles[at]))
            if now != key:
                if key is not None and key[2]:
                    yield from done()
                if key is not None and key[:2] != now[:2]:  # members without visitors go too
                    held, shard = [], None
                    release()
                if now[2] and held:
                    shard = Shard(pa.Table.from_batches(held))
                    held = []
                key = now
            held.append(batch.slice(at, to - at).select(["word", "n", "sig"]))
            if key[2] and sum(b.num_rows for b in held) >= BLOCK:
                yield from done()
                held = []
    if key is not None and key[2]:
        yield from done()


def near_words(vocab: DataFrame, *, shard_words: int = SHARD_WORDS, visitors: int = VISITORS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``vocab`` (word, n; each word once) that have near words."""
    groups = letter_groups(vocab)
    vectors = staged(vocab.select("word", "n", signature(F.col("word"), groups).alias("sig")), "signatures")
    top = Top.of(vectors, vectors.count(), shard_words)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                q, shard, own = top.visits(_counts(part.column(2)))
                rows = part.take(pa.array(q))
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(own), *rows.columns], names=["shard", "own", *rows.schema.names])

    visits = staged(vectors.mapInArrow(walk, "shard long, own boolean, word string, n long, sig string"), "visits")
    parts = visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / visitors).cast("int").alias("parts"))
    dealt = visits.join(parts, "shard")
    asking = dealt.select(
        "shard", F.pmod(F.xxhash64("word"), "parts").cast("int").alias("part"), F.lit(True).alias("visitor"), "word", "n", "sig"
    )
    living = dealt.filter("own").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("visitor"), "word", "n", "sig"
    )
    rows = asking.unionByName(living).repartition("shard", "part").sortWithinPartitions("shard", "part", "visitor")
    found = rows.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("top.rank")).alias("best_n"), F.col("top.best").alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without circles: every round follows twice as many links as the one before."""
    reached = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return reached
        reached = moved.select("word", "root")


def spelling_forms(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_chars: int = 6, least_count: int = 5, times: int = 5,
    shard_words: int = SHARD_WORDS, visitors: int = VISITORS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``least_count`` occurrences.

    The form is the most frequent near word, if it is at least ``times`` as frequent as the word; the root is the last word reached by
    following forms. As frequencies grow at every step, forms make no circles and few steps.
    """
    spark: SparkSession = configure(docs.sparkSession)
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    counted = staged(vocabulary(words(docs, doc_id=doc_id, text=text, least_chars=least_chars), least_count), "vocabulary")
    if counted.isEmpty():
        return spark.createDataFrame([], FIELDS)
    found = near_words(counted, shard_words=shard_words, visitors=visitors)
    formed = F.col("best_n") >= times * F.col("n")
    judged = staged(
        counted.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(judged.filter("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
