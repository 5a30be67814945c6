"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aqspark.sources.staging import new_path, stage  # noqa: F401  (re-exported for the operators)

#: A side of a join is sent to all executors only when it was counted and has at most so many narrow rows.
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_compact(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Like ``stage``, with a stronger compression for tables that carry whole texts."""
    path = new_path(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are within the bound, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def unsigned_hex(c: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def byte_rows(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; nothing for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def prefix(counts: np.ndarray) -> np.ndarray:
    """Sums before each element, and the total at the end."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def release() -> None:
    """Give memory that a worker no longer uses back to the system; workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def batches(rows: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds about ``limit`` bytes of ``column`` at most, or a single row."""
    for batch in rows:
        if not batch.num_rows:
            continue
        size = np.array([0 if x is None else x for x in pc.binary_length(batch.column(column)).to_pylist()], dtype=np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        del batch
        release()


def slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[pa.Array]:
    """Cut a column of texts like ``batches``."""
    size = np.array([0 if x is None else x for x in pc.binary_length(column).to_pylist()], dtype=np.int64)
    group = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        yield column.slice(a, b - a)


def judged(docs: DataFrame, text: str, kind: str, judge: Callable[[pa.Array], pa.Array], *more: Column | str, limit: int = 4 << 20) -> Column:
    """What ``judge`` makes of each text, and of ``more`` columns, as a column of ``docs``. Only these cross to Python, and only the verdict comes back;
    the rows stay where they are, so that texts are carried once. ``judge`` gets about ``limit`` bytes of texts at a time, or a single text."""

    def run(parts: Iterator) -> Iterator[pa.Array]:
        for part in parts:
            columns = part if isinstance(part, tuple) else (part,)
            at = 0
            for cut in slices(columns[0], limit):
                yield judge(cut, *(c.slice(at, len(cut)) for c in columns[1:]))
                at += len(cut)
            del part, columns
            release()

    run.__annotations__ = {"parts": Iterator[pa.Array] if not more else Iterator[tuple[(pa.Array,) * (1 + len(more))]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)(F.col(text).cast("string"), *more)
