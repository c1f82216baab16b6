"""Words of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.session import configure

#: Rows that one Arrow batch of texts holds, so that JVM and worker hold few MB of text at once.
BATCH_ROWS = 500
#: Bytes hashed at once; the tables of powers have this length.
WINDOW = 1 << 19
#: Bytes of text that one numpy pass takes (a longer text is a pass of its own).
PASS_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_powers: dict[str, np.ndarray] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this subpackage: those of the library and small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return configure(spark)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < size:
        size = max(size, WINDOW)
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.full(size, _U(_BASE)), np.full(size, _U(inverse))
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


def sample(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, those with the smallest hashes of ``keys``.

    Only hashes are sorted; the rows themselves are found by a filter, so no text is gathered to choose.
    """
    marked = rows.withColumn("_h", F.xxhash64(*keys))
    last = marked.select("_h").orderBy("_h").limit(size).agg(F.max("_h")).first()[0]
    return marked.filter(F.col("_h") <= F.lit(last)).limit(size).drop("_h") if last is not None else rows.limit(0)


_M_MMAP_THRESHOLD = -3
_tidy: list[bool] = []


def release() -> None:
    """Give memory that numpy and Arrow have freed back to the system, so that workers stay small.

    From the first call on, large arrays get pages of their own, which go back as soon as they are freed.
    """
    pa.default_memory_pool().release_unused()
    try:
        library = ctypes.CDLL(None)
        if not _tidy:
            library.mallopt(_M_MMAP_THRESHOLD, 1 << 18)
            _tidy.append(True)
        library.malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans (ascending, not overlapping) by Karp-Rabin prefix sums.

    Spans are hashed in windows, so memory does not follow the length of the text.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + WINDOW, side="right")))
        last = int(ends[j - 1])
        up, down = _power_tables(last - first + 1)
        sums = np.empty(last - first + 1, np.uint64)
        sums[0] = 0
        values = data[first:last].astype(np.uint64)
        values += _U(1)
        values *= up[: last - first]
        np.cumsum(values, out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out ^ (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if large else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def passes(batch: pa.RecordBatch, text: str = "text", size: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    if not batch.num_rows:
        return
    release()
    column = batch.column(batch.schema.get_field_index(text))
    _, bounds = text_buffers(column)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1
        to = min(batch.num_rows, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def separators(data: np.ndarray) -> np.ndarray:
    """Mask of the bytes space and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte unchanged."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.view(np.uint8) << np.uint8(5))


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows and, of n + 1 entries, the first word of each row."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    word = ~separators(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def gram_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and, of n + 1 entries, the first run of each row.

    A row of fewer words, but at least one, has its whole sequence as its only run.
    """
    total, counts = len(words), np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(runs)))
    row = np.repeat(np.arange(len(counts)), runs)
    at = first[:-1][row] + np.arange(bounds[-1]) - bounds[:-1][row]
    room = first[1:][row] - at
    grams = np.zeros(len(at), np.uint64)
    factor = _U(1)
    for k in range(size):
        part = words[np.minimum(at + k, max(total - 1, 0))] if total else grams
        grams += np.where(room > k, part * factor, _U(0))
        factor = factor * _U(_BASE) if k == 0 else _U((int(factor) * _BASE) & (2**64 - 1))
    short = np.minimum(counts, size).astype(np.uint64)
    return mix(grams + short[row] * _U(0xA0761D6478BD642F)), bounds


def spread(bounds: np.ndarray) -> np.ndarray:
    """Row number of every entry of a ragged array with these bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


class Covered:
    """Whether a span overlaps one of some (kind, start, end), by binary search."""

    def __init__(self, spans: list[tuple[str, int, int]]) -> None:
        ordered = np.array(sorted((start, end) for _, start, end in spans), np.int64).reshape(-1, 2)
        self.starts, self.reach = ordered[:, 0], np.maximum.accumulate(ordered[:, 1])

    def __call__(self, start: int, end: int) -> bool:
        before = int(np.searchsorted(self.starts, end))
        return before > 0 and bool(self.reach[before - 1] > start)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before every byte of UTF-8, and at the end."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
