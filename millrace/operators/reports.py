"""Reports over scored documents and corpora: grouped counts, shares and rates."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import wilson_upper

# Support of a line's floor and of the worst line, documents that make a label well covered, fields of a summary.
LINE_SUPPORT, WORST_SUPPORT, WELL_COVERED, TOP_FIELDS = 20, 200, 3, 15


def subsets(documents: DataFrame) -> DataFrame:
    """A row per document and subset that it belongs to: full, image_only, noisy_ocr, scanned, long_policy, held_out_carrier.

    Reads modality_mode, is_scanned, doc_type, page_count, held_out_carrier; nulls belong to none.
    """
    rules = {
        "image_only": F.col("modality_mode") == "image_only", "noisy_ocr": F.col("modality_mode") == "noisy_ocr_image", "scanned": F.col("is_scanned"),
        "long_policy": (F.col("doc_type") == "policy") & (F.coalesce("page_count", F.lit(1)) > 5), "held_out_carrier": F.col("held_out_carrier"),
    }
    names = F.array_compact(F.array(F.lit("full"), *(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return documents.drop("subset").withColumn("subset", F.explode(names))


def by_subset(results: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """doc_type, subset, documents, n, accuracy of field results (key, correct) over every subset."""
    rows = results.groupBy(key).agg(F.count("*").alias("_n"), F.count_if("correct").alias("_ok")).join(subsets(documents), key)
    return rows.groupBy("doc_type", "subset").agg(F.count("*").alias("documents"), F.sum("_n").alias("n"), (F.sum("_ok") / F.sum("_n")).alias("accuracy"))


def gate_metrics(metrics: DataFrame) -> DataFrame:
    """metric, value: the mean over document types weighted by their readings (metric, doc_type, value, readings); unmeasured types are left out."""
    known = metrics.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("metric").agg((F.sum(F.col("value") * F.col("readings")) / F.nullif(F.sum("readings"), F.lit(0))).alias("value"))


def error_summary(errors: DataFrame, most: int = TOP_FIELDS) -> DataFrame:
    """scope (class, line or field), name, error_class, n of rows (error_class, line, path); fields without row numbers, the ``most`` with the most errors: a report."""
    rows = errors.select(F.coalesce("error_class", F.lit("unknown")).alias("error_class"), F.coalesce("line", F.lit("unknown")).alias("line"), F.regexp_replace("path", r"\[[^\]]*\]", "[]").alias("field"))
    count = lambda name: rows.groupBy(F.lit(name).alias("scope"), (F.col(name) if name != "class" else F.lit("")).alias("name"), "error_class").agg(F.count("*").alias("n"))
    fields = count("field")
    top = fields.groupBy("name").agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), "name").limit(most).select("name")
    return count("class").unionByName(count("line")).unionByName(fields.join(top, "name").select("scope", "name", "error_class", "n"))


def detection(pairs: DataFrame, expected: str, got: str) -> DataFrame:
    """line, documents, accuracy, undetected of detected lines; rows without an expected line don't count."""
    known = pairs.where(F.col(expected).isNotNull())
    right = F.coalesce(F.col(expected) == F.col(got), F.lit(False))
    return known.groupBy(F.col(expected).alias("line")).agg(F.count("*").alias("documents"), F.round(F.avg(right.cast("double")), 4).alias("accuracy"), F.count_if(F.col(got).isNull()).alias("undetected"))


def below_floor(lines: DataFrame, floor: float = 0.85, support: int = LINE_SUPPORT) -> DataFrame:
    return lines.where((F.col("documents") >= support) & (F.col("accuracy") < floor)).select("line")


def worst_line(lines: DataFrame, least: int = WORST_SUPPORT) -> DataFrame:
    """accuracy: the least of lines (correct, total) with support; null without any."""
    return lines.where(F.col("total") >= least).agg(F.round(F.min(F.col("correct") / F.col("total")), 4).alias("accuracy"))


def auto_accept(values: DataFrame, by: list[str]) -> DataFrame:
    """``by``, seen, accepted, wrong, rate, coverage, accuracy, lower of values (flagged, correct): those without a flag are accepted; values whose flag is unknown don't count. ``lower``: the Wilson bound of the accuracy."""
    known = values.where(F.col("flagged").isNotNull())
    counts = known.groupBy(*by).agg(F.count("*").alias("seen"), F.count_if(~F.col("flagged")).alias("accepted"), F.count_if(~F.col("flagged") & ~F.col("correct")).alias("wrong"))
    some = F.nullif("accepted", F.lit(0))
    return counts.withColumns({"rate": F.col("wrong") / some, "coverage": F.col("accepted") / F.col("seen"), "accuracy": (F.col("accepted") - F.col("wrong")) / some, "lower": F.when(some.isNotNull(), 1 - wilson_upper(F.col("wrong"), F.col("accepted")))})


def label_coverage(labels: DataFrame, document: str, field: str, label: str, least: int = WELL_COVERED) -> DataFrame:
    """field, label, documents, thin: in how many documents a label stands for a field, and whether that is too few."""
    counts = labels.where(F.col(label).isNotNull()).groupBy(field, label).agg(F.count_distinct(document).alias("documents"))
    return counts.withColumn("thin", F.col("documents") < least)


def confused_pairs(values: DataFrame, document: str, field: str, pairs: DataFrame) -> DataFrame:
    """documents: how many state both fields of any of the ``pairs`` (field, sibling)."""
    stated = values.where(F.col("value").isNotNull()).select(F.col(document).alias("_d"), F.col(field).alias("_f")).distinct()
    named = stated.join(F.broadcast(pairs.select(F.col("field").alias("_f"), F.col("sibling").alias("_s")).distinct()), "_f")  # a list of the registry
    return named.join(stated.select("_d", F.col("_f").alias("_s")), ["_d", "_s"]).agg(F.count_distinct("_d").alias("documents"))


def examples_by_line(rows: DataFrame, line: str, document: str, synthetic: str) -> DataFrame:
    """line, documents, real, synthetic, rows."""
    return rows.groupBy(line).agg(F.count_distinct(document).alias("documents"), F.count_distinct(F.when(~F.col(synthetic), F.col(document))).alias("real"), F.count_distinct(F.when(F.col(synthetic), F.col(document))).alias("synthetic"), F.count("*").alias("rows"))


def latency(calls: DataFrame, adapter: str, milliseconds: str, served_as: str = "base model") -> DataFrame:
    """adapter, p95_ms, calls of an array column of call times; no adapter counts as ``served_as``."""
    each = calls.select(F.coalesce(adapter, F.lit(served_as)).alias("adapter"), F.explode(milliseconds).alias("_ms")).where("_ms IS NOT NULL")
    return each.groupBy("adapter").agg(F.expr("round(percentile_disc(0.95) WITHIN GROUP (ORDER BY CAST(_ms AS DOUBLE)), 1)").alias("p95_ms"), F.count("*").alias("calls"))


def label_split(results: DataFrame, seen: str, label: str, correct: str) -> DataFrame:
    """kind (seen or unseen), n, accuracy of values by whether the label beside them was trained."""
    known = results.where(F.col(label).isNotNull())
    return known.groupBy(F.when(F.col(seen), "seen").otherwise("unseen").alias("kind")).agg(F.count("*").alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"))


def cited_pages(refs: Column, page_count: Column) -> Column:
    """Distinct cited pages within the document, in order."""
    return F.array_sort(F.array_distinct(F.filter(refs, lambda p: (p >= 1) & (p <= page_count))))


def pages_within(pages: Column, budget: int) -> Column:
    return F.slice(pages, 1, budget)


def only_page(found: DataFrame, keys: list[str], page: str) -> DataFrame:
    """``keys``, page of values that stand on exactly one page."""
    return found.groupBy(*keys).agg(F.count_distinct(page).alias("_n"), F.min(page).alias(page)).where("_n = 1").drop("_n")


def word_pages(pages: DataFrame, document: str, page: str, words: str) -> DataFrame:
    """document, word, pages: an index of where each word stands."""
    each = pages.select(document, page, F.explode(F.array_distinct(words)).alias("word"))
    return each.groupBy(document, "word").agg(F.array_sort(F.collect_set(page)).alias("pages"))


def render_rotation(docs: DataFrame, line: str, family: str, twin: str, scanned: str, mode: str, epochs: int = 4, seed: int = 42, key: str = "doc_id", small: list[str] | None = None) -> DataFrame:
    """epoch, ``key`` of documents that rest: of a twin's renders one is read an epoch, the next one in the next, starting at its family's place; lines in ``small`` rest nothing."""
    twins = docs.where(F.col(twin).isNotNull())
    twins = twins.where(~F.col(line).isin(*small)) if small else twins
    ranked = twins.withColumns({"_mr_r": F.row_number().over(Window.partitionBy(line, family, twin).orderBy(F.coalesce(scanned, F.lit(False)), F.coalesce(mode, F.lit("")), key)) - 1})
    sizes = twins.groupBy(F.col(line).alias("_mr_l"), F.col(family).alias("_mr_f"), F.col(twin).alias("_mr_t")).agg(F.count("*").alias("_mr_n")).where("_mr_n > 1")
    place = F.sha2(F.concat(F.lit(f"{seed}:render_rotation:"), F.col("_mr_f").cast("string"), F.lit(":"), F.col("_mr_t").cast("string")), 256)
    sizes = sizes.withColumn("_mr_i", F.row_number().over(Window.partitionBy("_mr_l", "_mr_f").orderBy(place, "_mr_t")) - 1)
    both = ranked.join(sizes, F.col(line).eqNullSafe(F.col("_mr_l")) & F.col(family).eqNullSafe(F.col("_mr_f")) & (F.col(twin) == F.col("_mr_t")))
    turns = both.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    return turns.where(F.pmod(F.col("_mr_i") + F.col("epoch") - 1, F.col("_mr_n")) != F.col("_mr_r")).select("epoch", key)


def length_histogram(rows: DataFrame, by: list[str], length: str, bucket: int, cap: int) -> DataFrame:
    """``by``, bucket, rows, over: rows per length bucket and how many exceed the cap."""
    return rows.groupBy(*by, (F.floor(F.col(length) / bucket) * bucket).alias("bucket")).agg(F.count("*").alias("rows"), F.count_if(F.col(length) > cap).alias("over"))


def flag_counts(flags: DataFrame, document: str, flag: str) -> DataFrame:
    """kind, flags, documents of flags written as path:kind."""
    kind = F.element_at(F.split(flag, ":"), -1)
    return flags.groupBy(kind.alias("kind")).agg(F.count("*").alias("flags"), F.count_distinct(document).alias("documents"))


def review_paths(flags: Column, routed: tuple[str, ...]) -> Column:
    """Paths of the flags whose kind goes to review, and the paths above their last part."""
    named = F.filter(F.transform(flags, lambda f: F.struct(F.regexp_extract(f, r"^(.*):[^:]*$", 1).alias("p"), F.element_at(F.split(f, ":"), -1).alias("k"))), lambda x: x.k.isin(*routed))
    above = F.filter(F.transform(named, lambda x: F.regexp_replace(x.p, r"\.?[^.]*$", "")), lambda p: p != "")
    return F.array_sort(F.array_distinct(F.concat(F.transform(named, lambda x: x.p), above)))


def calibration_by(scored: DataFrame, by: list[str], confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """``by``, n, ece."""
    from millrace.operators.metrics import calibration_bin

    each = scored.groupBy(*by, calibration_bin(F.col(confidence), bins).alias("_bin")).agg(F.count("*").alias("_n"), F.sum(confidence).alias("_c"), F.sum(F.col(correct).cast("double")).alias("_ok"))
    return each.groupBy(*by).agg(F.sum("_n").alias("n"), F.round(F.sum(F.abs(F.col("_c") - F.col("_ok"))) / F.sum("_n"), 4).alias("ece"))


def epoch_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of either epoch that the other does not hold as often."""
    return a.select(key).exceptAll(b.select(key)).union(b.select(key).exceptAll(a.select(key)))


def comparable(a: dict, b: dict, names: tuple[str, ...]) -> list[str]:
    """Names whose values two reports' identities disagree in."""
    same = lambda x, y: x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
    return [n for n in names if not same(a.get(n), b.get(n))]


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, columns, F.lit(False))


def holds_any(fields: Column, wanted: list[str]) -> Column:
    """Whether a field of the array is a wanted one, or either is the end of the other at a point."""
    return F.exists(fields, lambda f: any_of([(f == w) | f.endswith("." + w) | F.lit(w).endswith(F.concat(F.lit("."), f)) for w in wanted]))
