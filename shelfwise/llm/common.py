"""Small helpers shared by the text operators: column access, scratch tables, connected groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import checkpoint_root, scratch_path

K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names: other columns cannot clash with an operator's own."""
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null is an empty text."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder; it survives lost executors."""
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two 64-bit values, element by element."""
    x = a * K1 + ((b << np.uint64(31)) | (b >> np.uint64(33))) * K2
    x ^= x >> np.uint64(32)
    x *= K3
    x ^= x >> np.uint64(29)
    return x


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 2000, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and, beyond one row, ``size`` bytes of text."""
    for batch in batches:
        width = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                width += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(width), 0
        while start < batch.num_rows:
            full = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, side="right"))
            stop = min(batch.num_rows, start + rows, max(start + 1, full))
            yield batch.slice(start, stop - start)
            start = stop


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def local_roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each row of a symmetric boolean matrix."""
    n = len(adjacent)
    label = np.arange(n)
    while True:
        low = np.minimum(label, np.where(adjacent, label[None, :], n).min(axis=1, initial=n))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def digits(column: str) -> str:
    """SQL for 16 lowercase hex digits of a long."""
    return f"lpad(lower(hex({column})), 16, '0')"
