"""A queue of jobs as a stream: at-least-once delivery, effects that happen once.

The store replaces messages with files of a folder: the checkpoint remembers
which were read, a lost batch is read again, and every write is by (job, phase),
so that a batch that comes twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def jobs(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Rows of JSON files as they arrive, so many files a batch: the bound on the backlog that one batch takes."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def once(rows: DataFrame, job: str, path: str) -> DataFrame:
    """The rows of a batch whose job the results at ``path`` do not hold yet; of a job that stands twice, one."""
    spark = rows.sparkSession
    rows = rows.dropDuplicates([job])
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(conf).exists(at):
        return rows
    return rows.join(spark.read.parquet(path).select(job).distinct(), job, "left_anti")


def phase(source: DataFrame, job: str, work: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run ``work`` on every new batch and add its rows to ``results``, each job once. The next phase streams from ``results``."""

    def batch(rows: DataFrame, _: int) -> None:
        work(once(rows, job, results)).write.mode("append").parquet(results)

    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_state(events: DataFrame, job: str, order: list[str], columns: list[str]) -> DataFrame:
    """One row per job: the values of its last event."""
    return events.groupBy(job).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_mr_last")).select(job, "_mr_last.*")


def expired(items: DataFrame, age_days: int, now: str, stored: str = "stored_at", reviewed: str = "reviewed", complete: str = "complete") -> DataFrame:
    """Items to delete and why: reviewed, past their age, or never finished for a day. ``now`` is a timestamp's text."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(stored)
    reason = F.when(F.col(reviewed), "reviewed").when(age >= age_days * 86400, "expired").when(~F.col(complete) & (age >= 86400), "incomplete")
    return items.withColumn("reason", reason).where("reason IS NOT NULL")


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts per tumbling window and key with a watermark: an addition for streams, the batch engine has none."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
