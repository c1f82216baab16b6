"""Packing in the order of a space-filling curve.

A document's ids are counted in hashed, signed dimensions; the normalised vector is projected to
three dimensions, and its cell's place on a Hilbert curve is the key. Documents sorted by key lie
next to similar ones. They are laid end to end along the curve and cut every ``length`` ids, so all
sequences but the last are full.

Ids are written once (16 bits each); only the small rows (key, size) are range-sorted for the places,
and the places are then joined with the ids.

Defined results: null counts as empty, and an empty text is its end id alone; equal keys are ordered by a
row number, so copies never gather in one task; a repeated row is packed each time; rows without
id are packed too. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.bpe import encoder
from rankloom.llm.textbatch import mix, passes, prepare, spread
from rankloom.session import fresh_path, staged

LENGTH = 2048
END_ID = 1
DIMENSIONS = 64
AXES = 3
BITS = 16


def hashed_directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of each id."""
    value = mix(np.arange(1, size + 1, dtype=np.uint64))
    return (value % np.uint64(DIMENSIONS)).astype(np.int64), np.where(value >> np.uint64(63), 1.0, -1.0)


def projected(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Three coordinates in 0..1 of every row's hashed vector."""
    rows = len(bounds) - 1
    place, sign = hashed_directions(1 << 16)
    vectors = np.bincount(
        spread(bounds) * DIMENSIONS + place[ids], weights=sign[ids], minlength=rows * DIMENSIONS
    ).reshape(rows, DIMENSIONS).astype(float)
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-9)
    axes = np.random.default_rng(11).standard_normal((DIMENSIONS, AXES))
    return 1 / (1 + np.exp(-3 * (vectors @ axes)))


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points in the unit cube: each level keeps its turned frame."""
    x = np.minimum((points * (1 << bits)).astype(np.int64), (1 << bits) - 1).T.copy()
    axes = len(x)
    # from the coordinates to the transposed index: undo the excess turns from the top bit down
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(axes):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[axes - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _tokenize(spec: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec).encode
        for batch in batches:
            for part in passes(batch):
                ids, bounds = encode(part.column(1))
                key = hilbert_key(projected(ids, bounds))
                bounds = bounds + np.arange(len(bounds))
                full = np.full(bounds[-1], end_id, np.uint16)
                own = np.ones(len(full), bool)
                own[bounds[1:] - 1] = False
                full[own] = ids
                buffers = [None, pa.py_buffer((bounds * 2).astype(np.int32)), pa.py_buffer(full)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds)), pa.array(key), pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)],
                    names=["doc_id", "n", "key", "ids"],
                )

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, at = [batch.column(i).to_pylist() for i in (0, 1)]
            rows: list[tuple] = []
            for d, begin, ids in zip(doc, at, batch.column(2), strict=True):
                values = np.frombuffer(ids.as_buffer(), np.uint16).astype("<u4")
                total, start = len(values), 0
                while start < total:
                    offset = (begin + start) % length
                    size = min(length - offset, total - start)
                    rows.append((d, start, size, zlib.crc32(values[start : start + size]), total, (begin + start) // length, offset))
                    start += size
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every row.

    ``vocabulary``: path of a byte-level BPE file with ids below 65,536; its content goes to the workers.
    """
    spark = prepare(docs.sparkSession)
    spec = Path(vocabulary).read_text()
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    path = fresh_path(spark, "ids")
    made = source.mapInArrow(_tokenize(spec, end_id), "doc_id long, n long, key long, ids binary")
    made.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)

    ranged = tokens.select("row", "n", "key").repartitionByRange("key", "row")
    ordered = staged(ranged.withColumn("part", F.spark_partition_id()), "curve")
    before = Window.partitionBy("part").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    within = ordered.select("row", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inside"))
    # one row per range partition
    totals = ordered.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    places = within.join(F.broadcast(bases), "part").select("row", (F.col("inside") + F.col("base")).alias("at"))
    return (
        tokens.select("row", "doc_id", "ids").join(places, "row").select("doc_id", "at", "ids")
        .mapInArrow(_cut(length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )
