"""Reading tables and walking over Arrow text in slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that numpy works on at once; a longer text is a slice of its own.
SLICE = 1 << 18
#: Rows that Spark sends to a Python worker at once; texts are long, its default is made for short rows.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table lacks, in any case of letters: ``name``, with underscores if need be."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with at most about ``limit`` bytes.

    ``offsets`` are relative to ``bytes`` and have one entry more than there are rows. Nulls are empty.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield first, end, whole[ends[first] : ends[end]], ends[first : end + 1] - ends[first]
        first = end
    trim()


def arrays(column: pa.Array, limit: int = 1 << 20) -> Iterator[pa.Array]:
    """The column in runs of rows with at most about ``limit`` bytes, to bound what Python objects hold."""
    for first, end, _, _ in slices(column, limit):
        yield column.slice(first, end - first)


def trim() -> None:
    """Give freed memory back to the system: an executor keeps several workers waiting, and each would keep its peak."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """A table for each run of rows with equal whole numbers in ``key``, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)
    trim()


def per_group(df: DataFrame, columns: list[str], work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``work`` on the rows of each group: shuffled by a hash of ``columns``, sorted by it and walked over in runs.

    Many small groups share a batch, which grouped Arrow functions do not allow. Groups whose hashes
    are equal come as one: ``work`` must bear that.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, "_group"):
            if (out := work(group.drop_columns("_group"))) is not None:
                yield from out.to_batches()

    keyed = df.withColumn("_group", F.xxhash64(*columns))
    return keyed.repartition("_group").sortWithinPartitions("_group").mapInArrow(walk, schema)
