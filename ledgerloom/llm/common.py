"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Columns of the documents table.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder, so that a lost executor loses nothing.

    With ``rows_per_task`` they are counted, and read again by no more tasks than it takes for so many rows each: every task of
    a later shuffle writes files of its own, so many tasks with a few rows cost more disk than the rows.
    """
    checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    return kept.coalesce(tasks_for(kept.count(), rows_per_task)) if rows_per_task else kept


def tasks_for(rows: int, rows_per_task: int) -> int:
    return max(1, -(-rows // rows_per_task))


def words(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD)))


def slices(column: pa.Array, most_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """A column in pieces of about ``most_bytes`` at most, one value at least."""
    step = max(1, int(len(column) * most_bytes / max(1, column.nbytes)))
    for start in range(0, len(column), step):
        yield column.slice(start, step)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose column holds about ``most_bytes`` at most (one row at least), so that memory stays bounded."""
    for batch in batches:
        n, start = batch.num_rows, 0
        if n == 0:
            continue
        step = max(1, int(n * most_bytes / max(1, batch.column(column).nbytes)))
        while start < n:
            yield batch.slice(start, step)
            start += step


def give_back() -> None:
    """Memory this process has freed goes back to the system. Python workers stay for later tasks, and those that wait hold what they once took."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not with every C library
        ctypes.CDLL(None).malloc_trim(0)


def gives_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over the batches of a task that calls ``give_back`` at its end."""

    @wraps(run)
    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return to_the_end
