"""What the operators of this subpackage share: tables in the shared folder and caches of a worker process."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.tables import Scratch
from millrace.operators.tables import written as materialize

__all__ = ["REMEMBERED", "Scratch", "by_first", "documents", "give_back", "keep_only", "least_hashes", "materialize", "per_process", "plain_columns", "small_batches"]


#: Equal texts or sets that a task remembers; those beyond are handed on once more and merged by the shuffle.
REMEMBERED = 1_000_000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes, so that very long texts stay within a worker's memory. One setting for all operators: plans read it when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def by_first(batches: Iterator[pa.RecordBatch], most: int, columns: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """``columns`` of sorted batches, ``most`` rows or so at a time, cut so that rows of an equal first column stay together."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(columns(batch))
        size += batch.num_rows
        if size < most:
            continue
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        other = np.flatnonzero(cols[0] != cols[0][-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield [c[:cut] for c in cols]
        held, size = [[c[cut:] for c in cols]], size - cut
    if size:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def plain_columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def least_hashes(docs: DataFrame, rows: int) -> DataFrame:
    """``docs`` (doc_id, text) with _mr_order, a hash of both, cut to some 3 * ``rows`` rows of the least hashes: order by it and limit.

    What is cut goes where it is read, so what a sample gathers does not grow
    with the table. It depends on the rows alone, not on their layout.
    """
    n = docs.count()
    bound = min(int(min(1.0, 3 * rows / max(1, n)) * 2**64) - 2**63, 2**63 - 1)
    return docs.withColumn("_mr_order", F.xxhash64("doc_id", F.col("text").cast("string"))).where(F.col("_mr_order") <= bound)


def per_process(key: tuple, make: Callable[[], Any]) -> Any:
    """An object kept for the life of this Python process, across the tasks that reuse the worker."""
    kept = sys.__dict__.setdefault("_millrace_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def keep_only(*names: str) -> None:
    """Drops what this process keeps under other names: the caches of an operator that ran before stand beside the next one's memory otherwise."""
    kept = sys.__dict__.setdefault("_millrace_kept", {})
    for key in [k for k in kept if k[0] not in names]:
        del kept[key]


def give_back() -> None:
    """Returns to the system what this process has freed; Arrow's and C's allocators keep much of it otherwise, and the worker outlives its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)
