"""Numpy columns through Spark's shuffle: one row holds all entries a batch has for a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from rankloom.llm.textbatch import release

Columns = dict[str, np.ndarray]


def schema(names: list[str]) -> str:
    return "bucket int, " + ", ".join(f"{name} binary" for name in names)


def scatter(bucket: np.ndarray, columns: Columns) -> Iterator[pa.RecordBatch]:
    """One row per bucket that has entries; each column is the bytes of its entries."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    arrays = [pa.array(ordered[starts].astype(np.int32))]
    bounds = np.append(starts, len(ordered))
    for values in columns.values():
        values = np.ascontiguousarray(values[order])
        # the cells lie end to end: offsets over the sorted entries, no object per cell
        offsets = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
        arrays.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(values)]))
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def gather(table: pa.Table | pa.RecordBatch, dtypes: dict[str, str]) -> Columns:
    """The entries of all rows, column by column; the cells of a column lie end to end in its buffer."""
    out = {}
    for name, dtype in dtypes.items():
        column = table.column(table.schema.get_field_index(name))
        parts = []
        for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
            _, offsets, data = chunk.buffers()
            if data is not None and len(chunk):
                bounds = np.frombuffer(offsets, np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
                parts.append(np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]])
        out[name] = (np.concatenate(parts) if parts else np.empty(0, np.uint8)).view(dtype)
    return out


def by_bucket(
    df: DataFrame, buckets: int, dtypes: dict[str, str] | None, work: Callable[..., Iterator[pa.RecordBatch]], out: str
) -> DataFrame:
    """Call ``work`` once per bucket with all its entries (without ``dtypes``: with the table itself).

    The caller chooses the number of buckets from the number of entries, so that one fits a task.
    """

    def one(table: pa.Table) -> pa.Table:
        release()
        done = pa.Table.from_batches(list(work(gather(table, dtypes) if dtypes else table)) or [empty], schema=empty.schema)
        return done

    empty = pa.RecordBatch.from_pylist([], schema=to_arrow_schema(_parse_datatype_string(out)))
    return df.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(one, out)
