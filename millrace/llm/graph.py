"""Small tables of a fixed size gathered from any number of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.tables import freed


def fixed_table(rows: DataFrame, size: int, chunks: int = 64) -> np.ndarray:
    """Sums of ``value`` by ``bucket`` (0 to size - 1) as one array of unsigned 32-bit numbers, capped at their range.

    Its bytes depend on ``size`` alone: that is the bound on what reaches the
    driver and on what is broadcast.
    """
    width = size // chunks
    summed = rows.groupBy("bucket").agg(F.sum("value").alias("value")).withColumn("chunk", (F.col("bucket") / width).cast("int"))

    def fill(table: pa.Table) -> pa.Table:
        out = np.zeros(width, dtype=np.uint32)
        out[table["bucket"].to_numpy() % width] = np.minimum(table["value"].to_numpy(), 2**32 - 1)
        return pa.table({"chunk": table["chunk"][:1].cast(pa.int32()), "data": pa.array([out.tobytes()], pa.binary())})

    found = np.zeros((chunks, width), dtype=np.uint32)
    with freed(rows.sparkSession):
        chunks_of = summed.groupBy("chunk").applyInArrow(fill, "chunk int, data binary").collect()
    for r in chunks_of:
        found[r.chunk] = np.frombuffer(r.data, np.uint32)
    return found.ravel()
