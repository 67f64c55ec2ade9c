"""Integer vectors: from float arrays, packed for Python tasks, exact squared distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components are held between -LARGEST and LARGEST, so that squared distances of up to 64 components fit 64 bits.
LARGEST = 1 << 27


def finite(vector: Column, dims: int) -> Column:
    """Whether a vector has so many components, none null, NaN or infinite."""
    return (F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def integer_vectors(df: DataFrame, scale: int, dims: int, *extra: Column) -> DataFrame:
    """vec_id and ints (array of int: floor(scale * x), held within LARGEST) of the rows with a finite vector; and the extra columns."""
    ints = F.transform("embedding", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x.cast("double") * scale))).cast("int"))
    return df.where(finite(F.col("embedding"), dims)).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("ints"), *extra)


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a column of arrays of one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.BinaryArray:
    """Rows of numbers as bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def unpacked(column: pa.BinaryArray, kind: type, width: int) -> np.ndarray:
    """The rows that packed() made, each of so many numbers."""
    if not len(column):
        return np.zeros((0, width), kind)
    data = np.frombuffer(column.buffers()[2], kind)
    return data[column.offset * width : (column.offset + len(column)) * width].reshape(-1, width)


def squared(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one vector, or row by row."""
    apart = rows.astype(np.int64) - other
    return np.einsum("ij,ij->i", apart, apart)


def digest_text(numbers: np.ndarray) -> str:
    return ",".join(map(str, numbers.ravel().tolist()))
