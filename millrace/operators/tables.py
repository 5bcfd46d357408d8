"""Tables between steps, written to the shared folder of the cluster."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a folder of our own on one machine, as in tests; on a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action in here go with it, and not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/millrace/{name}-{uuid.uuid4().hex}"
    with freed(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._millrace_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` has written for these tables; nothing may read them any more."""
    for table in tables:
        spark, path = table.sparkSession, table.__dict__.get("_millrace_path")
        if path:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


class Scratch:
    """Writes like ``written`` and remembers the tables, so that all but the lasting ones can go at the end."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __call__(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        self.tables.append(written(df, name, compression))
        return self.tables[-1]

    def clear(self, *keep: DataFrame) -> None:
        discard(*(t for t in self.tables if not any(t is k for k in keep)))
        self.tables = list(keep)
