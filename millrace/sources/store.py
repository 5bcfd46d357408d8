"""A store of documents as files: scans, loads that skip what is known, and sinks that write once.

Keys are paths below a root, root/tenant/kind/document/...; any file system that
Spark reads will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a key that name a tenant.
SHARED = ("shared", "registry", "schemas")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """key, length, modified of the files below ``root`` whose names match; their bytes are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(_key(F.col("path"), root).alias("key"), "length", F.col("modificationTime").alias("modified"))


def _key(path: Column, root: str) -> Column:
    """The part of a path below the root, whatever scheme either is written with."""
    bare = root.split("://", 1)[-1].split(":", 1)[-1].strip("/")
    return F.regexp_replace(F.substring_index(path, bare, -1), "^/+", "")


def contents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """key, content, sha256, md5 of the files below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(_key(F.col("path"), root).alias("key"), "content", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


def tenant_of(key: Column) -> Column:
    """First part of a key; null for parts that all tenants share."""
    first = F.element_at(F.split(key, "/"), 1)
    return F.when(first.isin(*SHARED) | (first == ""), None).otherwise(first)


def in_tenant(key: Column) -> Column:
    return tenant_of(key).isNotNull()


def fresh(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose sha256 is not in ``known`` (sha256), each content once: the one of the least key."""
    once = files.groupBy("sha256").agg(F.min("key").alias("_mr_key"))
    new = once.join(known.select("sha256").distinct(), "sha256", "left_anti")
    return files.join(new, "sha256").where(F.col("key") == F.col("_mr_key")).drop("_mr_key")


def changed(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Files that the store (key, md5) does not hold with the same bytes."""
    return files.join(stored.select("key", F.col("md5").alias("_mr_md5")), "key", "left").where(~F.col("md5").eqNullSafe(F.col("_mr_md5"))).drop("_mr_md5")


def unread(keys: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    return keys.join(done.select(*on).distinct(), on, "left_anti")


def page_texts(files: DataFrame) -> DataFrame:
    """document, pages (texts in page order) of files document/page_0001.md: the number in the last part of the key is the page."""
    text = F.decode(F.col("content"), "UTF-8")
    parts = files.select(F.regexp_extract("key", r"^(.*)/[^/]*$", 1).alias("document"), F.regexp_extract("key", r"(\d+)\.[^/.]*$", 1).try_cast("int").alias("page"), text.alias("text")).where("page IS NOT NULL")
    return parts.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("pages"))


def bundles(files: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """folder, missing, complete: folders of files and which of the ``wanted`` names they lack."""
    named = files.select(F.regexp_extract("key", r"^(.*)/[^/]*$", 1).alias("folder"), F.element_at(F.split("key", "/"), -1).alias("name"))
    held = named.groupBy("folder").agg(F.collect_set("name").alias("_mr_names"))
    missing = F.array_except(F.array(*map(F.lit, wanted)), "_mr_names")
    return held.select("folder", missing.alias("missing"), (F.size(missing) == 0).alias("complete"))


def csv_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of a CSV file with a header, trimmed, empty as null; a byte order mark is left out, a missing column fails."""
    rows = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).csv(path)
    rows = rows.toDF(*(c.lstrip("﻿").strip() for c in rows.columns))
    if lacking := [c for c in columns if c not in rows.columns]:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    return rows.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in columns))


def longest_prefix(rows: DataFrame, key: str, prefixes: DataFrame, prefix: str, bound: int = 100_000) -> DataFrame:
    """``rows`` with the columns of the longest prefix that their key begins with. Prefixes number ``bound`` at most, which is checked; they are looked up by length, not one by one."""
    if prefixes.count() > bound:
        raise ValueError(f"more than {bound} prefixes")
    lengths = sorted((r[0] for r in prefixes.select(F.length(prefix)).distinct().collect() if r[0]), reverse=True)
    names = [prefix, *(c for c in prefixes.columns if c != prefix)]
    out, once = rows, prefixes.dropDuplicates([prefix])
    for n in lengths:
        part = once.where(F.length(prefix) == n).select(F.col(prefix).alias(f"_mr_p{n}"), F.struct(*names).alias(f"_mr_s{n}"))
        out = out.join(F.broadcast(part), (F.length(key) >= n) & (F.left(F.col(key), F.lit(n)) == F.col(f"_mr_p{n}")), "left").drop(f"_mr_p{n}")
    kinds = prefixes.select(F.struct(*names).alias("s")).schema["s"].dataType
    best = F.coalesce(*(F.col(f"_mr_s{n}") for n in lengths), F.lit(None).cast(kinds))
    return out.withColumn("_mr_best", best).select(*rows.columns, "_mr_best.*")


def write_jsonl(rows: DataFrame, path: str, order: list[str], header: dict[str, str] | None = None, compression: str | None = None) -> None:
    """Lines of JSON in the order of ``order``, file after file; an existing path fails. ``header``: a first line of its own."""
    lines = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"), *(F.col(c).alias(f"_mr_{i}") for i, c in enumerate(order)))
    keys = [f"_mr_{i}" for i in range(len(order))]
    if header is not None:
        first = rows.sparkSession.range(1).select(F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in header.items()))).alias("value"), F.lit(0).alias("_mr_o"))
        lines = first.unionByName(lines.withColumn("_mr_o", F.lit(1)), allowMissingColumns=True)
        keys = ["_mr_o", *keys]
    out = lines.orderBy(*keys).select("value").write.mode("errorifexists")
    (out.option("compression", compression) if compression else out).text(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of ``schema``; lines that are none, such as a header, have all columns null and are left out."""
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return rows.na.drop(how="all")


def write_once(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").parquet(path)


def verified(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """``expected`` (key, sha256) whose files are missing or have other bytes: an empty result is a clean store."""
    held = contents(spark, root).select("key", F.col("sha256").alias("_mr_held"))
    return expected.join(held, "key", "left").where(~F.col("sha256").eqNullSafe(F.col("_mr_held"))).drop("_mr_held")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def appended(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose key it does not hold: nothing is overwritten, nothing stands twice."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def replaced(spark: SparkSession, path: str, rows: DataFrame) -> str:
    """Write ``rows`` as a new version folder below ``path`` and return it; readers of older versions are not disturbed."""
    target = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(target)
    return target


def next_number(ids: DataFrame, column: str, pattern: str = r"(\d+)$") -> DataFrame:
    """next: one more than the highest number that ``pattern`` finds in the ids; 1 without any."""
    return ids.agg((F.coalesce(F.max(F.regexp_extract(column, pattern, 1).try_cast("long")), F.lit(0)) + 1).alias("next"))
