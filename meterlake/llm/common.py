"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_dir

#: White space of every contract that counts words: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """``frame``, written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs tasks of the current step only.
    """
    path = scratch_dir(spark, f"llm-{purpose}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column as one array, and where each value starts and ends.

    Nulls count as empty.
    """
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(offsets):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in slices of about ``most_bytes`` of one column (a longer value is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = binary_parts(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + most_bytes, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal keys, one table per key; the input is sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
