"""Scoring of all users against all items without ever materialising the score matrix.

Items are stored once in the shared folder, in blocks of neighbouring ids; users are hashed into blocks and every user row is
shuffled once. A task holds one user block and reads the item blocks one after the other, keeping the K best unseen items and
the score range of each user; where there are few user blocks, several tasks share the item blocks out. What is shuffled, stored
and held therefore grows with users + items + seen pairs, not with their product.

Scores of a block come as a matrix product in single precision with a known bound of its error. Only pairs that may
still enter a list, or lower the range, within that bound are scored again in double precision, so lists and ranges are exact.
Users or items with values that are not finite take the plain path in double precision.

What cannot reach a list is not multiplied either. Sparse items stand by their heaviest terms, so that a group of neighbours has
few terms: the greatest weight of each gives a bound of the group's scores, and a group is multiplied, over its own terms only, for
users whose list it may enter. Where no range is asked for, dense items stand by bias and length, which bound their scores, too.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window, functions as F

from rankloom.session import fresh_path

# Rows per block; a task sees at most about this many users, and this many items at a time.
USERS_PER_BLOCK = 8192
ITEMS_PER_BLOCK = 16384
# Up to this many users, their ids may be broadcast.
BROADCAST_USERS = 1_000_000
# Tasks of one scoring job; beyond it a task runs several cells one after the other.
MAX_TASKS = 100_000
# Sparse items of one block, at most, and the entries they may have; items of one group, and users multiplied at once.
SPARSE_ITEMS, SPARSE_ENTRIES = 131_072, 4_000_000
GROUP_ITEMS, GROUP_USERS = 32, 2048
# Scores held at once inside a cell; bounds and profiles of users, four times as many.
SLICE_SCORES = 4_000_000
# Pairs found in groups that are scored again at once.
HITS = 500_000
# Steps of the matrix product that cost as much as one scattered addition.
SCATTER_COST = 300
# Products of norms up to this one are safe in single precision.
_SAFE = 1e15
_EPSILON = 2.0**-23
_NO_ITEM = np.iinfo(np.int64).max

Scorer = Callable[[pa.Table], Callable[[pa.Table], "Block"]]

_RESULT = pa.schema(
    [
        ("user_id", pa.int64()),
        ("variant", pa.int32()),
        ("lo", pa.float64()),
        ("hi", pa.float64()),
        ("ids", pa.list_(pa.int64())),
        ("scores", pa.list_(pa.float64())),
    ]
)


def _block(col: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(blocks)).cast("int")


def _numbers(table: pa.Table, name: str, dtype=np.float64) -> np.ndarray:
    return table[name].to_numpy().astype(dtype, copy=False)


def _lists(table: pa.Table, name: str, dtype=np.float64) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list column."""
    column = table[name]
    sizes = pc.list_value_length(column).to_numpy().astype(np.int64)
    return sizes, pc.list_flatten(column).to_numpy().astype(dtype, copy=False)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    return _lists(table, name)[1].reshape(table.num_rows, -1)


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in the sorted unique keys, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start..start + size - 1 of every run, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the columns of the k best finite scores, best first, ties to the smaller column.

    Returns the number per row and the row-major columns and scores.
    """
    n = scores.shape[1]
    cut = np.partition(scores, n - k, axis=1)[:, n - k, None] if n > k else np.full((len(scores), 1), -np.inf)
    rows, columns = np.nonzero((scores >= cut) & np.isfinite(scores))
    values = scores[rows, columns]
    order = np.lexsort((columns, -values, rows))
    rows, columns, values = rows[order], columns[order], values[order]
    starts = np.searchsorted(rows, np.arange(len(scores)))
    keep = np.arange(len(rows)) - starts[rows] < k
    return np.bincount(rows[keep], minlength=len(scores)), columns[keep], values[keep]


def _rounded(scores: np.ndarray, digits: int | None) -> np.ndarray:
    return scores if digits is None else np.round(scores, digits)


def _single(limits: np.ndarray, towards: float) -> np.ndarray:
    """Limits in single precision, none moved away from ``towards``."""
    with np.errstate(over="ignore"):
        return np.nextafter(limits.astype(np.float32), np.float32(towards))


class Found:
    """The K best items of every user so far, per variant, and the score range."""

    def __init__(self, variants: int, users: int, k: int) -> None:
        self.k = k
        self.scores = np.full((variants, users, k), -np.inf)
        self.ids = np.full((variants, users, k), _NO_ITEM)
        self.low, self.high = np.full(users, np.inf), np.full(users, -np.inf)

    def add(self, variant: int, rows: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
        """Takes what is better than the last of a user's list; of equal scores the smaller id is better."""
        scores, names = self.scores[variant], self.ids[variant]
        last = scores[rows, -1]
        better = np.isfinite(values) & ((values > last) | ((values == last) & (ids < names[rows, -1])))
        if not better.any():
            return
        rows, ids, values = rows[better], ids[better], values[better]
        who = np.unique(rows)
        rows = np.concatenate([rows, np.repeat(who, self.k)])
        ids, values = np.concatenate([ids, names[who].ravel()]), np.concatenate([values, scores[who].ravel()])
        order = np.lexsort((ids, -values, rows))
        rows, ids, values = rows[order], ids[order], values[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        at = rows[keep], place[keep]
        scores[at], names[at] = values[keep], ids[keep]

    def tables(self, names: np.ndarray) -> pa.Table:
        out = []
        for variant, (scores, ids) in enumerate(zip(self.scores, self.ids)):
            filled = scores > -np.inf
            counts = filled.sum(axis=1)
            some = counts > 0
            high = np.maximum(self.high, scores[:, 0])
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32))
            arrays = [
                pa.array(names[some]),
                pa.array(np.full(int(some.sum()), variant, np.int32)),
                pa.array(self.low[some]),
                pa.array(high[some]),
                pa.ListArray.from_arrays(offsets, pa.array(ids[filled])),
                pa.ListArray.from_arrays(offsets, pa.array(scores[filled])),
            ]
            out.append(pa.Table.from_arrays(arrays, schema=_RESULT))
        return pa.concat_tables(out)


class Block:
    """One item block against the users of a cell; the columns of ``guess`` are the items in the order ``order``."""

    #: Items by id, and their order in ``guess`` where that is another one.
    ids: np.ndarray
    order: np.ndarray | None = None
    #: Per user: the most that a guess is wrong by, and whether guesses can be trusted at all.
    slack: np.ndarray
    sure: np.ndarray
    #: Whether the score range is wanted, and whether no score is negative and a guess of 0 is exact.
    ranged, nonnegative = True, False
    #: Whether items stand in groups with a bound.
    grouped = False

    def guess(self, start: int, stop: int) -> np.ndarray:
        raise NotImplementedError

    def pairs(self, rows: np.ndarray, columns: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Scores (variants x pairs) of users and items; all users lie in start..stop."""
        raise NotImplementedError

    def exact(self, start: int, stop: int) -> np.ndarray:
        """All scores (variants x users x items), items by id."""
        raise NotImplementedError

    def within_reach(self, start: int, stop: int, least: np.ndarray, unit: float) -> np.ndarray | None:
        """The columns that alone may reach the scores ``least``; None where all are to be guessed."""
        return None

    def guess_some(self, start: int, stop: int, columns: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def limits(self, start: int, stop: int, least: np.ndarray, column: int, seen: np.ndarray, unit: float, k: int) -> np.ndarray:
        """The guess from which on an item at ``column`` or later may reach the scores ``least`` (variants x users)."""
        return least[0] - unit - self.slack[start:stop]


def _edges(items: int, first: int) -> list[int]:
    edges = [0]
    while edges[-1] < items:
        edges.append(min(items, first))
        first *= 8
    return edges


def _lower(block: Block, found: Found, scores: np.ndarray, start: int, stop: int, digits: int | None, unit: float) -> None:
    """Brings the least score of the users up to date; seen pairs are infinite in ``scores``."""
    low = found.low[start:stop]
    if block.nonnegative and (low <= 0).all():
        return
    guess = scores.min(axis=1).astype(np.float64)
    slack = block.slack[start:stop]
    todo = np.isfinite(guess) & (guess - slack - unit < low)
    if block.nonnegative:
        low[guess == 0] = np.minimum(low[guess == 0], 0.0)
        todo &= guess > 0
    rows = np.flatnonzero(todo)
    if not len(rows):
        return
    near = scores[rows] <= _single((guess + 2 * slack + unit)[rows], np.inf)[:, None]
    line, columns = np.divmod(np.flatnonzero(near), scores.shape[1])
    columns = columns if block.order is None else block.order[columns]
    values = _rounded(block.pairs(start + rows[line], columns, start, stop), digits)[0]
    np.minimum.at(low, rows[line], values)


def _scan(block: Block, found: Found, rows: np.ndarray, items: np.ndarray, k: int, digits: int | None) -> None:
    """Adds an item block to what was found; ``rows`` (sorted) and ``items`` are the users' seen pairs."""
    columns = _place(block.ids, items)
    here = columns >= 0
    rows, columns = rows[here], columns[here]
    if block.grouped:
        _scan_groups(block, found, rows, columns, k, digits)
        return
    size, users = len(block.ids), len(found.low)
    unit = 0.0 if digits is None else 10.0**-digits
    rank = None if block.order is None else np.argsort(block.order)
    step = max(1, SLICE_SCORES // size)
    for start in range(0, users, step):
        stop = min(start + step, users)
        a, b = np.searchsorted(rows, [start, stop])
        line, column = rows[a:b] - start, columns[a:b]
        if not block.sure[start:stop].all():
            _scan_plainly(block, found, start, stop, line, column, k, digits)
            continue
        some = block.within_reach(start, stop, found.scores[:, start:stop, -1], unit)
        if some is not None:
            _scan_some(block, found, start, stop, some, line, column, digits, unit)
            continue
        scores = block.guess(start, stop)
        column = column if rank is None else rank[column]
        if block.ranged:
            scores[line, column] = np.inf
            _lower(block, found, scores, start, stop, digits, unit)
        scores[line, column] = -np.inf
        seen = np.bincount(line, minlength=stop - start)
        full = block.order is None and (found.scores[:, start:stop, -1] > -np.inf).all()
        edges = [0, size] if full else _edges(size, max(16, 4 * k))
        for at, to in zip(edges, edges[1:]):
            limit = block.limits(start, stop, found.scores[:, start:stop, -1], at, seen, unit, k)
            part = scores[:, at:to]
            line, column = np.divmod(np.flatnonzero(part >= _single(limit, -np.inf)[:, None]), to - at)
            free = part[line, column] > -np.inf
            line, column = line[free] + start, column[free] + at
            if not len(line):
                continue
            column = column if block.order is None else block.order[column]
            for variant, values in enumerate(_rounded(block.pairs(line, column, start, stop), digits)):
                found.add(variant, line, block.ids[column], values)


def _unseen(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are not among the sorted seen ones."""
    return _place(seen, keys) < 0


def _scan_some(
    block: Block, found: Found, start: int, stop: int, some: np.ndarray, line: np.ndarray, column: np.ndarray, digits: int | None, unit: float
) -> None:
    """Only the items ``some`` may enter a list of these users; ``line`` and ``column`` are seen."""
    if not len(some):
        return
    size = len(block.ids)
    scores = block.guess_some(start, stop, some)
    limit = found.scores[0, start:stop, -1] - unit - block.slack[start:stop]
    row, at = np.divmod(np.flatnonzero(scores >= _single(limit, -np.inf)[:, None]), len(some))
    free = _unseen(np.sort(line * size + column), row * size + some[at])
    row, at = row[free] + start, some[at[free]]
    if len(row):
        found.add(0, row, block.ids[at], _rounded(block.pairs(row, at, start, stop), digits)[0])


def _scan_groups(block: SparseBlock, found: Found, rows: np.ndarray, columns: np.ndarray, k: int, digits: int | None) -> None:
    """Groups of items whose bound reaches a user's list are multiplied for that user, the best groups first while a list is short."""
    size, users, groups = len(block.ids), len(found.low), block.groups
    unit = 0.0 if digits is None else 10.0**-digits
    step = max(1, min(GROUP_USERS, 4 * SLICE_SCORES // max(groups, block.width, 1)))
    for start in range(0, users, step):
        stop = min(start + step, users)
        a, b = np.searchsorted(rows, [start, stop])
        line, column = rows[a:b] - start, columns[a:b]
        if not block.sure[start:stop].all():
            _scan_plainly(block, found, start, stop, line, column, k, digits)
            continue
        seen = np.sort(line * size + column)
        tile = Tile(block, start, stop)
        bound = block.upper.guess(start, stop)
        low, last = found.low[start:stop], found.scores[0, start:stop, -1]

        def score(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            free = _unseen(seen, row * size + at)
            return row[free], at[free], _rounded(tile.pairs(row[free], at[free]), digits)

        def add(todo: np.ndarray) -> None:
            limit = _single(last - unit - block.slack[start:stop], -np.inf)
            for row, at in tile.hits(todo, limit):
                row, at, values = score(row, at)
                found.add(0, start + row, block.ids[at], values)

        def lower(todo: np.ndarray) -> None:
            limit = _single(low + unit + block.slack[start:stop], np.inf)
            for row, at in tile.hits(todo, limit, below=True):
                row, _at, values = score(row, at)
                np.minimum.at(low, row, values)

        done, count, fresh = np.zeros(bound.shape, bool), 1 + math.ceil(k / GROUP_ITEMS), (last == -np.inf).any()
        while count < groups:
            short = np.flatnonzero(last == -np.inf)
            if not len(short):
                break
            todo = np.zeros(bound.shape, bool)
            for who in np.array_split(short, math.ceil(len(short) / 256)):
                todo[who[:, None], np.argpartition(-bound[who], count - 1, axis=1)[:, :count]] = True
            add(todo & ~done)
            done |= todo
            count *= 8
        # what the better groups bring spares new lists most of the others
        most = bound.max(axis=1, initial=0.0)
        for share in (0.75, 0.5, 0.25, 0.1, 0.0) if fresh else (0.0,):
            limit = last - unit - block.upper.slack[start:stop]
            with np.errstate(invalid="ignore"):
                limit = np.where(limit > -np.inf, limit + share * np.maximum(most - limit, 0.0), limit)
            todo = (bound >= _single(limit, -np.inf)[:, None]) & ~done
            add(todo)
            done |= todo
        if not block.ranged or not (low > 0).any():
            continue
        # no score is negative: mostly a group that shares nothing with a user ends the search
        for count in (1, 16):
            who = np.flatnonzero(low > 0)
            if len(who) and count < groups:
                todo = np.zeros(bound.shape, bool)
                todo[who[:, None], np.argpartition(bound[who], count - 1, axis=1)[:, :count]] = True
                lower(todo)
        if (low > 0).any():
            reach = _single(low + unit + block.lower.slack[start:stop], np.inf)
            lower((block.lower.guess(start, stop) <= reach[:, None]) & (low > 0)[:, None])


scan = _scan


def _scan_plainly(
    block: Block, found: Found, start: int, stop: int, line: np.ndarray, column: np.ndarray, k: int, digits: int | None
) -> None:
    """All scores in double precision; those that are not finite are left out of lists."""
    scores = _rounded(block.exact(start, stop), digits)
    scores[:, line, column] = -np.inf
    for variant, part in enumerate(scores):
        if variant == 0:
            low = np.min(part, axis=1, where=np.isfinite(part), initial=np.inf)
            found.low[start:stop] = np.minimum(found.low[start:stop], low)
            found.high[start:stop] = np.maximum(found.high[start:stop], part.max(axis=1))
        counts, chosen, values = _best(part, k)
        found.add(variant, start + np.repeat(np.arange(stop - start), counts), block.ids[chosen], values)


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file or folder of the shared folder, for a worker."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def stored_table(uri: str) -> pa.Table:
    """A Parquet file or folder of the shared folder, read by a worker."""
    store, path = store_of(uri)
    return pq.read_table(path, filesystem=store, partitioning=None)


def _cell_kernel(scorer: Scorer, k: int, digits: int | None, variants: int, files: list[str], stripes: int, ranged: bool):
    def run(key: tuple, cell: pa.Table) -> pa.Table:
        users = cell.filter(pc.equal(cell["kind"], 0)).sort_by("user_id").combine_chunks()
        seen = cell.filter(pc.equal(cell["kind"], 1))
        if not users.num_rows:
            return _RESULT.empty_table()
        names = _numbers(users, "user_id", np.int64)
        rows = _place(names, _numbers(seen, "user_id", np.int64))
        order = np.argsort(rows, kind="stable")[np.count_nonzero(rows < 0) :]
        rows, items = rows[order], _numbers(seen, "movie_id", np.int64)[order]
        found = Found(variants, len(names), k)
        prepare = scorer(users)
        for file in files[key[0].as_py() % stripes :: stripes]:
            table = stored_table(file)
            table = table.append_column("place", pa.array(np.arange(table.num_rows))).sort_by("movie_id").combine_chunks()
            if table.num_rows:
                block = prepare(table)
                block.ranged &= ranged
                _scan(block, found, rows, items, k, digits)
        return found.tables(names)

    return run


def score_cells(
    users: DataFrame,
    items: DataFrame,
    seen: DataFrame,
    scorer: Scorer,
    k: int,
    digits: int | None = None,
    variants: int = 1,
    users_per_block: int = USERS_PER_BLOCK,
    items_per_block: int = ITEMS_PER_BLOCK,
    ranged: bool = True,
    near: Column | None = None,
    first: Column | None = None,
) -> DataFrame:
    """The K best unseen items of each user; with one variant and if ``ranged`` also the range of all the user's unseen scores.

    ``users`` and ``items`` hold their id and columns the scorer reads; names must differ. Both
    are counted first, so give them as stored tables. Scores are ranked as they are, unless
    ``digits`` asks for rounding. The layout of the item blocks changes no result: with ``near`` they are dealt by id and stand in its order
    inside, with ``first`` those of greatest value come first.
    """
    spark = users.sparkSession
    root = fresh_path(spark, "item-blocks")
    # Several cells per core where there are enough users to share out, or else item blocks.
    n_users, n_items = users.count(), items.count()
    wanted = 4 * spark.sparkContext.defaultParallelism
    user_blocks = max(math.ceil(n_users / users_per_block), min(wanted, math.ceil(n_users / 128)), 1)
    shared = min(math.ceil(n_items / ITEMS_PER_BLOCK), math.ceil(wanted / user_blocks))
    blocks = max(1, math.ceil(n_items / items_per_block), shared)
    if near is not None:
        laid = items.repartition(blocks, "movie_id").withColumn("_near", near).sortWithinPartitions("_near", "movie_id").drop("_near")
    elif first is not None:
        laid = items.withColumn("_first", first).repartitionByRange(blocks, F.desc("_first"), "movie_id").sortWithinPartitions("movie_id").drop("_first")
    else:
        laid = items.repartitionByRange(blocks, "movie_id").sortWithinPartitions("movie_id")
    laid.write.parquet(root)
    files = sorted(spark.read.parquet(root).inputFiles())
    stripes = max(1, min(len(files), math.ceil(wanted / user_blocks)))
    # Pairs of users who are not scored reach no list: where there are few users, only their pairs are dealt to cells.
    pairs = seen.select("user_id", "movie_id").dropna()
    if n_users <= BROADCAST_USERS:
        pairs = pairs.join(F.broadcast(users.select("user_id")), "user_id", "left_semi")
    # A user's rows meet in one cell of every stripe.
    numbered = users.withColumn("kind", F.lit(0)).unionByName(pairs.withColumn("kind", F.lit(1)), True)
    stripe = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    rows = numbered.withColumns({"_ub": _block("user_id", user_blocks), "_stripe": stripe})
    rows = rows.withColumn("_cell", F.col("_ub") * stripes + F.col("_stripe")).drop("_ub", "_stripe")
    # A cell is small in bytes and long in time: a stated number of partitions keeps small
    # shuffle partitions from being merged into few tasks.
    tasks = min(user_blocks * stripes, max(MAX_TASKS, spark.sparkContext.defaultParallelism))
    cells = rows.repartition(tasks, "_cell").groupBy("_cell").applyInArrow(
        _cell_kernel(scorer, k, digits, variants, files, stripes, ranged),
        "user_id long, variant int, lo double, hi double, ids array<long>, scores array<double>",
    )
    # At most K rows per stripe and user meet here.
    per_user = cells.select(
        "user_id",
        "variant",
        "lo",
        "hi",
        F.posexplode(F.arrays_zip("ids", "scores")).alias("_p", "_s"),
    ).select("user_id", "variant", "lo", "hi", F.col("_s.ids").alias("movie_id"), F.col("_s.scores").alias("raw_score"))
    who = Window.partitionBy("user_id", "variant")
    ranked = per_user.select(
        "user_id",
        "variant",
        F.row_number().over(who.orderBy(F.desc("raw_score"), "movie_id")).alias("rank"),
        "movie_id",
        "raw_score",
        F.min("lo").over(who).alias("min_score"),
        F.max("hi").over(who).alias("max_score"),
    ).filter(F.col("rank") <= k)
    ranked = ranked if variants > 1 else ranked.drop("variant")
    return ranked.drop("min_score", "max_score") if variants > 1 or not ranged else ranked


class DenseBlock(Block):
    """``bounded``: items that bias and length keep from every list of a slice are left out of the product."""

    bounded = True

    def __init__(self, users: DenseUsers, ids: np.ndarray, right: np.ndarray, bias: np.ndarray) -> None:
        self.users = users
        self.ids, self.right, self.bias = ids, right, bias
        self.length = np.sqrt(np.einsum("nf,nf->n", right, right))
        wide = np.column_stack([self.right, self.bias, np.ones(len(self.ids))])
        norm = np.sqrt(np.einsum("nf,nf->n", wide, wide)).max(initial=0.0)
        with np.errstate(all="ignore"):
            self.wide = wide.astype(np.float32)
            self.slack = users.norms * norm * (wide.shape[1] + 8) * _EPSILON
        self.sure = (users.norms < _SAFE) & bool(norm < _SAFE)

    def guess(self, start: int, stop: int) -> np.ndarray:
        wide = self.wide if self.order is None else self.ordered
        return self.users.wide[start:stop] @ wide.T

    def within_reach(self, start, stop, least, unit):
        if self.ranged or not self.bounded:
            return None
        users = self.users
        with np.errstate(invalid="ignore"):
            needed = (least[0] - users.bias[start:stop]).min() - unit - self.slack[start:stop].max()
        if not needed > -np.inf:
            return None
        most = self.bias + users.length[start:stop].max() * self.length
        some = np.flatnonzero(most >= needed)
        return some if 2 * len(some) < len(self.ids) else None

    def guess_some(self, start, stop, columns):
        return self.users.wide[start:stop] @ self.wide[columns].T

    def pairs(self, rows, columns, start, stop):
        dot = np.einsum("nf,nf->n", self.users.left[rows], self.right[columns])
        return (dot + self.bias[columns] + self.users.bias[rows])[None]

    def exact(self, start, stop):
        users = self.users
        return (users.left[start:stop] @ self.right.T + self.bias + users.bias[start:stop, None])[None]


class DenseUsers:
    """Dot product of factor vectors plus both biases."""

    def __init__(self, left: np.ndarray, bias: np.ndarray) -> None:
        self.left, self.bias = left, bias
        self.length = np.sqrt(np.einsum("nf,nf->n", left, left))
        wide = np.column_stack([self.left, np.ones(len(self.left)), self.bias])
        self.norms = np.sqrt(np.einsum("nf,nf->n", wide, wide))
        with np.errstate(all="ignore"):
            self.wide = wide.astype(np.float32)

    @classmethod
    def of(cls, users: pa.Table) -> DenseUsers:
        return cls(_matrix(users, "user_vector"), _numbers(users, "user_bias"))

    def __call__(self, items: pa.Table) -> DenseBlock:
        return DenseBlock(self, *_dense_items(items))


def _dense_items(items: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _numbers(items, "movie_id", np.int64), _matrix(items, "item_vector"), _numbers(items, "item_bias")


def dense_scorer(users: pa.Table) -> DenseUsers:
    return DenseUsers.of(users)


class BlendBlock(DenseBlock):
    """Items stand by falling popularity, so that a run of columns has a bound of its popularity."""

    ranged, bounded = False, False

    def __init__(self, users: DenseUsers, items: pa.Table, low: np.ndarray, span: np.ndarray, alphas: list[float], digits: int | None) -> None:
        super().__init__(users, *_dense_items(items))
        self.low, self.span, self.alphas, self.digits = low, span, alphas, digits
        self.popularity = _numbers(items, "score_norm")
        self.order = np.lexsort((self.ids, -_rounded(self.popularity, digits)))
        self.ordered = self.wide[self.order]
        known = np.isfinite(self.popularity).all() and all(0.0 <= a <= 1.0 for a in alphas)
        self.sure &= np.isfinite(low) & np.isfinite(span) & (span < _SAFE) & bool(known)

    def _mixed(self, base: np.ndarray, low: np.ndarray, span: np.ndarray, popularity: np.ndarray) -> np.ndarray:
        scaled = (_rounded(base, self.digits) - low) / np.where(span > 0, span, 1.0)
        scaled = np.where(span > 0, scaled, 0.0)
        return np.stack([a * scaled + (1.0 - a) * popularity for a in self.alphas])

    def pairs(self, rows, columns, start, stop):
        base = super().pairs(rows, columns, start, stop)[0]
        return self._mixed(base, self.low[rows], self.span[rows], self.popularity[columns])

    def exact(self, start, stop):
        base = super().exact(start, stop)[0]
        return self._mixed(base, self.low[start:stop, None], self.span[start:stop, None], self.popularity)

    def limits(self, start, stop, least, column, seen, unit, k):
        most = self.popularity[self.order[column:]].max()
        span, low, slack = self.span[start:stop], self.low[start:stop], self.slack[start:stop]
        lowest = np.full(stop - start, np.inf)
        # far less than a score's rounding, far more than the error of these few steps
        room = unit + 1e-9
        for alpha, needed in zip(self.alphas, least):
            flat = (1.0 - alpha) * most >= needed - room
            if alpha == 0:
                # equal items stand by id: a user finds the K best among the first K + seen
                limit = np.where(flat & (column < k + seen), -np.inf, np.inf)
            else:
                with np.errstate(invalid="ignore"):
                    bound = (needed - room - (1.0 - alpha) * most) / alpha * span + low - unit - slack
                limit = np.where(span > 0, bound - 1e-9 * (1.0 + np.abs(low) + span), np.where(flat, -np.inf, np.inf))
            lowest = np.minimum(lowest, limit)
        return lowest


def blend_scorer(alphas: list[float], digits: int | None = None) -> Scorer:
    """Per alpha: alpha * score scaled to the user's range + (1 - alpha) * item popularity."""

    def prepare(users: pa.Table):
        base = DenseUsers.of(users)
        low = _numbers(users, "min_score")
        span = _numbers(users, "max_score") - low
        return lambda items: BlendBlock(base, items, low, span, alphas, digits)

    return prepare


class Product:
    """Scores of sparse users and columns: terms that many of both have go through a matrix product, the others through lists of their columns.

    ``at`` is the place in ``terms`` of every entry of the columns; an entry comes once.
    """

    def __init__(self, users: SparseUsers, terms: np.ndarray, column: np.ndarray, at: np.ndarray, weights: np.ndarray, size: int) -> None:
        n, m = len(users.sizes), size
        self.size = size
        slot = _place(terms, users.terms)
        row, slot, weight = users.rows[slot >= 0], slot[slot >= 0], users.weights[slot >= 0]
        many = np.bincount(at, minlength=len(terms))
        often = many * np.bincount(slot, minlength=len(terms)) * SCATTER_COST > n * m
        number = np.cumsum(often) - 1
        width = int(often.sum())
        with np.errstate(all="ignore"):
            self.left, self.right = np.zeros((n, width), np.float32), np.zeros((m, width), np.float32)
            np.add.at(self.left, (row[often[slot]], number[slot[often[slot]]]), weight[often[slot]].astype(np.float32))
            np.add.at(self.right, (column[often[at]], number[at[often[at]]]), weights[often[at]].astype(np.float32))
            rare = ~often[at]
            order = np.argsort(at[rare], kind="stable")
            self.post_items, self.post_weights = column[rare][order], weights[rare][order].astype(np.float32)
            self.post_sizes = np.where(often, 0, many)
            self.post_starts = np.cumsum(self.post_sizes) - self.post_sizes
            rare = ~often[slot]
            self.rare_rows, self.rare_slots, self.rare_weights = row[rare], slot[rare], weight[rare].astype(np.float32)
            norm = np.sqrt(np.bincount(column, weights**2, minlength=m)).max(initial=0.0)
            steps = width + int(np.bincount(column, minlength=m).max(initial=0)) + 8
            self.slack = users.norms * norm * steps * _EPSILON
        self.sure = (users.norms < _SAFE) & bool(norm < _SAFE)

    def guess(self, start: int, stop: int) -> np.ndarray:
        scores = self.left[start:stop] @ self.right.T
        a, b = np.searchsorted(self.rare_rows, [start, stop])
        sizes = self.post_sizes[self.rare_slots[a:b]]
        at = _runs(self.post_starts[self.rare_slots[a:b]], sizes)
        cell = np.repeat((self.rare_rows[a:b] - start) * self.size, sizes) + self.post_items[at]
        np.add.at(scores.reshape(-1), cell, np.repeat(self.rare_weights[a:b], sizes) * self.post_weights[at])
        return scores


class SparseBlock(Block):
    """Where no weight is negative, runs of ``GROUP_ITEMS`` items in stored order form groups; otherwise all pairs are guessed."""

    def __init__(self, users: SparseUsers, items: pa.Table) -> None:
        self.users, self.ids = users, _numbers(items, "movie_id", np.int64)
        self.sizes, self.terms = _lists(items, "item_terms", np.int64)
        self.weights = _lists(items, "item_weights")[1]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.known, self.slots = np.unique(self.terms, return_inverse=True)
        self.width = len(self.known)
        self.nonnegative = users.nonnegative and bool((self.weights >= 0).all())
        self.grouped = self.nonnegative
        if not self.grouped:
            self.whole = Product(users, self.known, np.repeat(np.arange(len(self.ids)), self.sizes), self.slots, self.weights, len(self.ids))
            self.slack, self.sure = self.whole.slack, self.whole.sure
            return
        place = _numbers(items, "place", np.int64) if "place" in items.column_names else np.arange(len(self.ids))
        #: the items of the groups, one after the other
        self.member = np.argsort(place)
        self.groups = math.ceil(len(self.ids) / GROUP_ITEMS)
        sizes = self.sizes[self.member]
        at = _runs(self.starts[self.member], sizes)
        stored = np.repeat(np.arange(len(self.ids)), sizes)
        key = stored // GROUP_ITEMS * self.width + self.slots[at]
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.diff(key[order], prepend=-1))
        self.entry_group, self.entry_slot = np.divmod(key[order][begins], max(self.width, 1))
        weight = self.weights[at][order]
        self.greatest = np.maximum.reduceat(weight, begins) if len(begins) else weight
        self.least = np.minimum.reduceat(weight, begins) if len(begins) else weight
        self.least_of = np.diff(begins, append=len(order))
        # a group's entries are begin..end of the entries of all groups; its matrix has a line per item
        self.begin = np.searchsorted(self.entry_group, np.arange(self.groups + 1))
        long = np.diff(self.begin)
        self.matrix_begin = np.concatenate([[0], np.cumsum(long)]) * GROUP_ITEMS
        entry = np.repeat(np.arange(len(begins)), self.least_of) if len(begins) else np.zeros(0, np.int64)
        group = self.entry_group[entry]
        with np.errstate(all="ignore"):
            self.matrices = np.zeros(self.matrix_begin[-1], np.float32)
            self.matrices[self.matrix_begin[group] + stored[order] % GROUP_ITEMS * long[group] + entry - self.begin[group]] = weight
            norm = np.sqrt(np.bincount(stored, self.weights[at] ** 2, minlength=len(self.ids))).max(initial=0.0)
            self.slack = users.norms * norm * (int(long.max(initial=0)) + 8) * _EPSILON
        self.upper = Product(users, self.known, self.entry_group, self.entry_slot, self.greatest, self.groups)
        self.sure = (users.norms < _SAFE) & bool(norm < _SAFE) & self.upper.sure

    @functools.cached_property
    def lower(self) -> Product:
        """Bounds from below: the least weight of the terms that all items of a group have."""
        full = np.full(self.groups, GROUP_ITEMS)
        full[-1:] = len(self.ids) - (self.groups - 1) * GROUP_ITEMS
        common = self.least_of == full[self.entry_group]
        return Product(self.users, self.known, self.entry_group[common], self.entry_slot[common], self.least[common], self.groups)

    def guess(self, start: int, stop: int) -> np.ndarray:
        return self.whole.guess(start, stop)

    def pairs(self, rows, columns, start, stop):
        users = self.users
        sizes = self.sizes[columns]
        at = _runs(self.starts[columns], sizes)
        a, b = np.searchsorted(users.rows, [start, stop])
        own = users.keys[a:b]
        place = _place(own, np.repeat(rows, sizes) * users.span + np.minimum(self.terms[at], users.span - 1))
        profile = np.where(place >= 0, users.weights[a:b][place], 0.0) if len(own) else np.zeros(len(at))
        out = np.zeros(len(rows))
        filled = np.flatnonzero(sizes)
        if len(filled):
            out[filled] = np.add.reduceat(self.weights[at] * profile, (np.cumsum(sizes) - sizes)[filled])
        return out[None]

    def exact(self, start, stop):
        out = np.zeros((stop - start, len(self.ids)))
        known, slots = np.unique(self.terms, return_inverse=True)
        filled = np.flatnonzero(self.sizes)
        a, b = np.searchsorted(self.users.rows, [start, stop])
        for row in range(start, stop) if len(known) else ():
            x, y = np.searchsorted(self.users.rows[a:b], [row, row + 1]) + a
            at = _place(known, self.users.terms[x:y])
            profile = np.zeros(len(known))
            profile[at[at >= 0]] = self.users.weights[x:y][at >= 0]
            out[row - start, filled] = np.add.reduceat(self.weights * profile[slots], self.starts[filled])
        return out[None]


class Tile:
    """Some users of a cell with their profiles as columns of a matrix, against the groups of a block."""

    def __init__(self, block: SparseBlock, start: int, stop: int) -> None:
        self.block, users = block, block.users
        a, b = np.searchsorted(users.rows, [start, stop])
        at = _place(block.known, users.terms[a:b])
        here = at >= 0
        self.profiles = np.zeros((stop - start, block.width))
        self.profiles[users.rows[a:b][here] - start, at[here]] = users.weights[a:b][here]
        with np.errstate(all="ignore"):
            self.columns = self.profiles.T.astype(np.float32, order="C")

    def pairs(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Scores in double precision of users and items."""
        block = self.block
        sizes = block.sizes[columns]
        at = _runs(block.starts[columns], sizes)
        out = np.zeros(len(rows))
        filled = np.flatnonzero(sizes)
        if len(filled):
            product = block.weights[at] * self.profiles[np.repeat(rows, sizes), block.slots[at]]
            out[filled] = np.add.reduceat(product, (np.cumsum(sizes) - sizes)[filled])
        return out

    def hits(self, todo: np.ndarray, limit: np.ndarray, below: bool = False):
        """Users and items of the groups ``todo`` (users x groups) with a guess from the user's limit on, or not above it, in parts."""
        block, users = self.block, len(limit)
        todo = np.ascontiguousarray(todo.T)
        rows, items, found = [], [], 0
        for group in np.flatnonzero(todo.any(axis=1)).tolist():
            who = np.flatnonzero(todo[group])
            x, y = block.begin[group], block.begin[group + 1]
            slots = block.entry_slot[x:y]
            matrix = block.matrices[block.matrix_begin[group] : block.matrix_begin[group + 1]].reshape(GROUP_ITEMS, len(slots))
            if 4 * len(who) > users:
                # copying whole lines is cheaper than picking
                guess, edge = matrix @ self.columns[slots], np.where(todo[group], limit, np.float32(-np.inf if below else np.inf))
            else:
                guess, edge = matrix @ self.columns[slots[:, None], who], limit[who]
            line, at = np.divmod(np.flatnonzero(guess <= edge if below else guess >= edge), len(edge))
            if not len(line):
                continue
            stored = group * GROUP_ITEMS + line
            real = stored < len(block.ids)
            rows.append((at if len(edge) == users else who[at])[real])
            items.append(block.member[stored[real]])
            found += len(line)
            if found > HITS:
                yield np.concatenate(rows), np.concatenate(items)
                rows, items, found = [], [], 0
        if rows:
            yield np.concatenate(rows), np.concatenate(items)


class SparseUsers:
    """Dot product of sparse vectors given as parallel index and weight arrays; an index comes once in a vector."""

    def __init__(self, users: pa.Table) -> None:
        self.sizes, terms = _lists(users, "user_terms", np.int64)
        weights = _lists(users, "user_weights")[1]
        rows = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.lexsort((terms, rows))
        self.rows, self.terms, self.weights = rows[order], terms[order], weights[order]
        # one more than the greatest index: items' other terms are cut down to it and match nothing
        self.span = int(terms.max(initial=-1)) + 2
        self.keys = self.rows * self.span + self.terms
        self.norms = np.sqrt(np.bincount(self.rows, self.weights**2, minlength=len(self.sizes)))
        self.nonnegative = bool((self.weights >= 0).all())

    def __call__(self, items: pa.Table) -> SparseBlock:
        return SparseBlock(self, items)


def sparse_scorer(users: pa.Table) -> SparseUsers:
    return SparseUsers(users)
