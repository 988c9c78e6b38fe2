"""Whole vectors as binary rows: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(vec: str, zero: bool = True):
    """Condition: the vector is not null and holds neither nulls nor non-finite components (nor, unless ``zero``,
    zeros alone)."""
    v = F.transform(vec, lambda x: x.cast("double"))
    ok = F.col(vec).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return ok if zero else ok & F.exists(v, lambda x: x != 0)


def most_common_size(df: DataFrame, vec: str) -> int | None:
    """The length that most vectors have (ties: the shorter); None without vectors."""
    row = df.groupBy(F.size(vec).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else None


def flat(col: pa.Array, kind=np.float64) -> np.ndarray:
    """A list column whose rows all have one length, as a matrix."""
    n = len(col)
    x = col.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return x.reshape(n, -1) if n else x.reshape(0, 0)


def matrix(col, kind) -> np.ndarray:
    """A binary column of equally long rows as a matrix, from its buffer as a whole."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, 0), kind)
    offs, data = col.buffers()[1:]
    at = np.frombuffer(offs, np.int32 if pa.types.is_binary(col.type) else np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind).reshape(len(col), -1)


def binary(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    x = np.ascontiguousarray(x)
    offs = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(x.tobytes())])
