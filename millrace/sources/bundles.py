"""Deliveries and frozen sets: from manifests and stored parts to documents.

Manifests, exclusions and overrides are tables like any other; nothing here
reads the bytes of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.store import longest_prefix, write_once


def delivered(manifest: DataFrame, exclusions: DataFrame, overrides: DataFrame, files: DataFrame, lines: list[str] | None = None) -> DataFrame:
    """``manifest`` (document, line, file) with line corrected by the longest prefix in ``overrides`` (source_prefix, lob), without excluded documents (document) and other lines, and missing: whether ``files`` (key) lacks its file."""
    named = longest_prefix(manifest, "document", overrides.select("source_prefix", F.col("lob").alias("_mr_lob")), "source_prefix")
    rows = named.withColumn("line", F.coalesce("_mr_lob", "line")).drop("source_prefix", "_mr_lob")
    rows = rows.join(exclusions.select("document").distinct(), "document", "left_anti")
    rows = rows.where(F.col("line").isin(*lines)) if lines else rows
    held = files.select(F.col("key").alias("file")).distinct().withColumn("_mr_held", F.lit(True))
    return rows.join(held, "file", "left").withColumn("missing", F.col("_mr_held").isNull()).drop("_mr_held")


def renders(manifest: DataFrame, kinds: tuple[str, ...] = ("digital", "scanned")) -> DataFrame:
    """A row per document and render: columns file_<kind> become file and render; renders without a file are left out."""
    own = [c for c in manifest.columns if c not in {f"file_{k}" for k in kinds}]
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("render"), F.col(f"file_{k}").alias("file")) for k in kinds)))
    return manifest.select(*own, each.alias("_mr_x")).select(*own, "_mr_x.*").where("file IS NOT NULL")


def checked(bundles: DataFrame, problems: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(bundles without a problem, the others with all their problems)."""
    told = bundles.withColumn("problems", F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in problems.items()))))
    return told.where(F.size("problems") == 0).drop("problems"), told.where(F.size("problems") > 0)


def loaded(labels: DataFrame, metadata: DataFrame, readings: DataFrame, pages: DataFrame, keys: tuple[str, ...] = ("tenant", "doc_type", "source_id")) -> DataFrame:
    """One row per labelled document: label, metadata, how it was read, and its page texts in order; parts that are not there are null. ``pages``: keys, page, text."""
    texts = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("_mr_p"))
    joined = labels.join(metadata, list(keys), "left").join(readings, list(keys), "left").join(texts, list(keys), "left")
    return joined.withColumn("page_texts", F.transform("_mr_p", lambda p: p.text)).drop("_mr_p")


def recoded(code: Column, table: dict[str, str], local: dict[str, str] | None = None) -> Column:
    """The code's new name, a local one first; codes without stay."""
    names = {**table, **(local or {})}
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), code), code) if names else code


def used_ids(*scans: DataFrame, column: str = "source_id") -> DataFrame:
    """Distinct ids of several scans."""
    out = scans[0].select(column)
    for scan in scans[1:]:
        out = out.union(scan.select(column))
    return out.where(F.col(column).isNotNull()).distinct()


def freeze(test: DataFrame, path: str, least: int = 30, allow_small: bool = False) -> int:
    """Write the test documents as the frozen set, once; too few are refused unless allowed. Their number."""
    n = test.count()
    if n < least and not allow_small:
        raise ValueError(f"{n} documents are too few to freeze, {least} are needed")
    write_once(test, path)
    return n


def unfinished(manifest: DataFrame, present: DataFrame, key: str = "source_id") -> DataFrame:
    """Documents of the manifest that an interrupted freeze did not write."""
    return manifest.select(key).join(present.select(key).distinct(), key, "left_anti")


def marked_held_out(frozen: DataFrame, trained: DataFrame, carrier: str = "carrier") -> DataFrame:
    """``frozen`` with held_out_carrier: whether no trained document has the carrier; unknown carriers are not."""
    seen = trained.select(F.col(carrier).alias("_mr_c")).where("_mr_c IS NOT NULL").distinct().withColumn("_mr_seen", F.lit(True))
    joined = frozen.drop("held_out_carrier").join(seen, F.col(carrier) == F.col("_mr_c"), "left")
    return joined.withColumn("held_out_carrier", F.col(carrier).isNotNull() & F.col("_mr_seen").isNull()).drop("_mr_c", "_mr_seen")


def marked_reviewed(frozen: DataFrame, reviews: DataFrame, key: str = "source_id", digest: str = "gold_sha256") -> DataFrame:
    """``frozen`` with review: that of ``reviews`` (key, digest, review) if the gold is still the one that was reviewed."""
    own = reviews.select(F.col(key).alias("_mr_k"), F.col(digest).alias("_mr_h"), F.col("review").alias("_mr_r"))
    joined = frozen.drop("review").join(own, (F.col(key) == F.col("_mr_k")) & (F.col(digest) == F.col("_mr_h")), "left")
    return joined.withColumn("review", F.col("_mr_r")).drop("_mr_k", "_mr_h", "_mr_r")


def to_export(items: DataFrame, exported: DataFrame, limit: int, key: str = "item", order: str = "stored_at") -> DataFrame:
    """The oldest items that were not exported yet, as many as asked for."""
    return items.join(exported.select(key).distinct(), key, "left_anti").orderBy(order, key).limit(limit)
