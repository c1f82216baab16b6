"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (a run of ``least`` words, A-Z in lower case) are
tiled: the longest run of words free in both is found with Karp-Rabin window hashes, all matches of
that length are marked from left to right, and so on down to ``least`` words. The share of an item's
words under tiles is its coverage; tiles may come in any order, so a passage whose sentences were
moved about is covered all the same. A document is contaminated by each item with a coverage of
``percent`` / 100 or more.

The distinct texts of the benchmark are written to the shared folder in blocks of about ``BLOCK_WORDS`` words,
from where the workers read them: the driver sees their paths only, no document is shuffled and no block outgrows a
worker. The documents are read once for each block. Found texts meet the items that have them in a join.

Defined results: null counts as empty; a text or item of fewer than ``least`` words matches nothing;
equal items are all reported; a repeated row is reported as often as it occurs; empty tables give an
empty result. Columns of ``docs`` other than id and text are not read; ids may have any type.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.textbatch import gram_hashes, lowered, mix, passes, prepare, span_hashes, spread, text_buffers, word_spans
from rankloom.llm.warc import store_of
from rankloom.session import fresh_path, staged

LEAST_WORDS = 5
PERCENT = 75
BLOCK_WORDS = 2_000_000
#: Blocks that one job of ``decontaminate`` applies one after the other, each in a worker of its own.
BLOCKS_PER_JOB = 4
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


@dataclass
class Block:
    """Items of one block: word hashes, their bounds, and the seeds with the item of each."""

    item: list
    words: np.ndarray
    first: np.ndarray
    seed: np.ndarray
    owner: np.ndarray


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_buffers(column)
    data = lowered(data)
    starts, ends, first = word_spans(data, bounds)
    return span_hashes(data, starts, ends), first


def make_block(items: list, texts: list, least: int) -> Block:
    words, first = word_hashes(pa.array(texts, pa.string()))
    grams, rows = gram_hashes(words, first, least)
    owner = spread(rows)
    long = (np.diff(first) >= least)[owner]
    grams, owner = grams[long], owner[long]
    order = np.lexsort((owner, grams))
    return Block(items, words, first, grams[order], owner[order])


def _windows(words: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes and starts of the windows of ``size`` words without a marked one."""
    if len(words) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    value = np.zeros(len(words) - size + 1, np.uint64)
    # Horner by doubling: hash of 2^k words from two hashes of 2^(k-1)
    part, width, done, base = words, 1, 0, np.full(1, _U(_BASE))
    rest = size
    while rest:
        if rest & 1:
            value = value * base + part[done : done + len(value)]
            done += width
        rest >>= 1
        if rest:
            part = part[:-width] * base + part[width:]
            width, base = width * 2, np.multiply(base, base)
    taken = np.concatenate(([0], np.cumsum(~free)))
    starts = np.flatnonzero(taken[size:] == taken[:-size])
    return value[starts], starts


def _common(test: np.ndarray, doc: np.ndarray, free_t: np.ndarray, free_d: np.ndarray, size: int):
    a, at = _windows(test, free_t, size)
    b, to = _windows(doc, free_d, size)
    keep = np.isin(b, a)
    return a, at, b[keep], to[keep]


def greedy_tiles(test: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in test, place in doc, words) of each tile; longest first, then from the left."""
    free_t, free_d = np.ones(len(test), bool), np.ones(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    most = min(len(test), len(doc))
    while most >= least:
        # the greatest length with a match: a match of s words holds one of s - 1
        low, high = least - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(_common(test, doc, free_t, free_d, middle)[3]):
                low = middle
            else:
                high = middle - 1
        if low < least:
            break
        a, at, b, to = _common(test, doc, free_t, free_d, low)
        for value, i in zip(a, at, strict=True):
            if not free_t[i : i + low].all():
                continue
            for j in to[b == value]:
                if free_d[j : j + low].all() and np.array_equal(test[i : i + low], doc[j : j + low]):
                    free_t[i : i + low] = free_d[j : j + low] = False
                    tiles.append((int(i), int(j), int(low)))
                    break
        most = low - 1  # what is left of this length has all its matches marked
    return tiles


def _pairs(block: Block, words: np.ndarray, first: np.ndarray, least: int, percent: int) -> list[tuple]:
    """(document row, item index, tiles, covered words) of the pairs at or over the threshold."""
    grams, rows = gram_hashes(words, first, least)
    at = np.searchsorted(block.seed, grams)
    hit = np.flatnonzero((at < len(block.seed)) & (block.seed[np.minimum(at, len(block.seed) - 1)] == grams))
    if not len(hit):
        return []
    row = spread(rows)[hit]
    low = at[hit]
    many = np.searchsorted(block.seed, grams[hit], side="right") - low
    entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    pair = np.unique(np.stack((np.repeat(row, many), block.owner[entry], entry), 1), axis=0)
    # a tile of t words holds t - least + 1 seeds: no pair can cover more than its seeds allow
    key, start, seeds = np.unique(pair[:, :2], axis=0, return_index=True, return_counts=True)
    length = np.diff(block.first)[key[:, 1]]
    possible = np.minimum(seeds * least, length)
    out = []
    for (doc, item), n in zip(key[possible * 100 >= length * percent], length[possible * 100 >= length * percent], strict=True):
        test = block.words[block.first[item] : block.first[item + 1]]
        tiles = greedy_tiles(test, words[first[doc] : first[doc + 1]], least)
        covered = sum(t[2] for t in tiles)
        if covered * 100 >= int(n) * percent:
            out.append((int(doc), int(item), len(tiles), covered))
    return out


def stored_blocks(benchmark: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """The distinct texts with a number each (key, text), and the folders that hold them block by block."""
    spark = benchmark.sparkSession
    texts = benchmark.select(F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    numbered = staged(texts.withColumn("key", F.monotonically_increasing_id()), "benchmark")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // (BLOCK_WORDS * 6)))
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(count)))
    root = fresh_path(spark, "benchmark-blocks")
    dealt.repartition("block").write.partitionBy("block").parquet(root)
    numbers = sorted(r["block"] for r in dealt.select("block").distinct().collect())
    return numbered, [f"{root}/block={n}" for n in numbers]


@lru_cache(maxsize=1)
def load_block(folder: str, least: int) -> Block:
    """One block from the shared folder; a worker reads it once."""
    store, path = store_of(folder)
    rows = ds.dataset(path, filesystem=store, format="parquet").to_table(columns=["key", "text"])
    return make_block(rows.column("key").to_pylist(), rows.column("text").to_pylist(), least)


def benchmark_overlap(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", least: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, item_id, tiles, covered, item_words) of every contaminating pair."""
    spark = prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, key long, tiles int, covered long, item_words long"
    numbered, folders = stored_blocks(benchmark, item_text)
    found = spark.createDataFrame([], out)
    for folder in folders:

        def run(batches: Iterator[pa.RecordBatch], folder: str = folder) -> Iterator[pa.RecordBatch]:
            block = load_block(folder, least)
            sizes = np.diff(block.first)
            for batch in batches:
                for part in passes(batch):
                    pairs = _pairs(block, *word_hashes(part.column(1)), least, percent)
                    if pairs:
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(pa.array([p[0] for p in pairs])),
                                pa.array([block.item[p[1]] for p in pairs], pa.int64()),
                                pa.array([p[2] for p in pairs], pa.int32()),
                                pa.array([p[3] for p in pairs], pa.int64()),
                                pa.array([int(sizes[p[1]]) for p in pairs], pa.int64()),
                            ],
                            names=["doc_id", "key", "tiles", "covered", "item_words"],
                        )

        rows = source.mapInArrow(run, out)
        # with several blocks each result is written before the next block is read
        found = found.unionByName(staged(rows, "overlap") if len(folders) > 1 else rows)
    items = benchmark.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    keys = items.join(numbered, "text").select("key", "item_id")
    return found.join(keys, "key").select("doc_id", "item_id", "tiles", "covered", "item_words")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
    item_text: str = "text", least: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, unchanged."""
    prepare(docs.sparkSession)
    place, names = docs.columns.index(text), docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    for number, folder in enumerate(stored_blocks(benchmark, item_text)[1]):

        def run(batches: Iterator[pa.RecordBatch], folder: str = folder) -> Iterator[pa.RecordBatch]:
            block = load_block(folder, least)
            for batch in batches:
                for part in passes(batch, f"c{place}"):
                    pairs = _pairs(block, *word_hashes(part.column(place)), least, percent)
                    clean = np.ones(part.num_rows, bool)
                    clean[[p[0] for p in pairs]] = False
                    yield part.filter(pa.array(clean))

        if number and number % BLOCKS_PER_JOB == 0:
            plain = staged(plain, "plain")
        plain = plain.mapInArrow(run, plain.schema)
    return plain.toDF(*names)
