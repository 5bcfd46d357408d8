"""Metrics, calibration and statistics as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import wilson_upper


def calibration_bin(confidence: Column, bins: int = 10) -> Column:
    """(lo, hi] bins from 0; 0 itself is in the first."""
    edges = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    return F.size(F.filter(edges, lambda e: confidence > e))


def reliability(scored: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """Per bin: rows, mean confidence, accuracy."""
    by = scored.groupBy(calibration_bin(F.col(confidence), bins).alias("bin"))
    return by.agg(F.count("*").alias("n"), F.avg(confidence).alias("mean_confidence"), F.avg(F.col(correct).cast("double")).alias("accuracy"))


def expected_calibration_error(scored: DataFrame, confidence: str, correct: str) -> DataFrame:
    bins = reliability(scored, confidence, correct)
    return bins.agg((F.sum(F.abs(F.col("mean_confidence") - F.col("accuracy")) * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("ece"), F.sum("n").alias("n"))


def isotonic(scored: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """Accuracy per floor(c * bins), made monotone by a running maximum; ten rows at most reach the window."""
    by = scored.groupBy(F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1)).alias("bin")).agg(F.avg(F.col(correct).cast("double")).alias("accuracy"))
    return by.withColumn("fitted", F.max("accuracy").over(Window.partitionBy().orderBy("bin")))


def thresholds(scored: DataFrame, group: str, confidence: str, correct: str, target: float | Column, least: int = 30) -> DataFrame:
    """Loosest threshold of the grid 0.99 to 0.50 whose Wilson bound holds, scanned downwards to the first failure; too few accepted skips.

    Rows are counted by the highest grid value that they reach; the scan sees 50
    rows a group at most. ``target``: a rate, or a column of ``group``.
    """
    grid = F.array(*(F.lit(i / 100) for i in range(50, 100)))
    reached = F.size(F.filter(grid, lambda t: F.col(confidence) >= t))
    bins = scored.groupBy(group, reached.alias("_mr_k")).agg(F.count("*").alias("_mr_n"), F.sum(1 - F.col(correct).cast("int")).alias("_mr_e")).where("_mr_k > 0")
    each = bins.withColumn("_mr_k", F.explode(F.sequence(F.lit(1), F.col("_mr_k")))).withColumn("t", F.get(grid, F.col("_mr_k") - 1))
    counts = each.groupBy(group, "t").agg(F.sum("_mr_n").alias("n"), F.sum("_mr_e").alias("errors"))
    most = target if isinstance(target, Column) else F.lit(target)
    fair = (F.col("n") >= least) & (wilson_upper(F.lit(0), F.col("n")) <= most)
    counts = counts.where(fair).withColumn("ok", wilson_upper(F.col("errors"), F.col("n")) <= most)
    down = Window.partitionBy(group).orderBy(F.desc("t"))
    return counts.withColumn("all_ok", F.bool_and("ok").over(down)).where("all_ok").groupBy(group).agg(F.min("t").alias("threshold"), F.min_by("n", "t").alias("accepted"), F.min_by("errors", "t").alias("errors"))


def accepted_errors(scored: DataFrame, limits: DataFrame, group: str, confidence: str, correct: str) -> DataFrame:
    """accepted, errors, rate over all rows that reach their group's threshold; groups without one accept nothing."""
    hit = scored.join(limits.select(F.col(group).alias("_mr_g"), F.col("threshold").alias("_mr_t")), F.col(group) == F.col("_mr_g")).where(F.col(confidence) >= F.col("_mr_t"))
    return hit.agg(F.count("*").alias("accepted"), F.sum(1 - F.col(correct).cast("int")).alias("errors")).withColumn("rate", F.col("errors") / F.nullif("accepted", F.lit(0)))


def needs_review(confidence: Column, threshold: Column) -> Column:
    """Unknown confidences, and those of groups without a threshold, are reviewed."""
    return F.coalesce(confidence < threshold, F.lit(True))


def field_accuracy(results: DataFrame, by: list[str]) -> DataFrame:
    """``by``, n, normalized, exact of field results (correct, exact)."""
    return results.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.col("correct").cast("double")).alias("normalized"), F.avg(F.col("exact").cast("double")).alias("exact"))


def table_rates(tables: DataFrame, by: list[str]) -> DataFrame:
    """``by``, precision, recall, f1, missed of table counts (expected, got, matched): sums over sums, 0 without rows."""
    sums = tables.groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("expected", "got", "matched")))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return sums.select(*by, share(F.col("matched"), F.col("got")).alias("precision"), share(F.col("matched"), F.col("expected")).alias("recall"), share(2 * F.col("matched"), F.col("expected") + F.col("got")).alias("f1"), F.greatest(F.lit(0), F.col("expected") - F.col("matched")).alias("missed"))


def pooled(rows: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """``by``, rate, weight: the weighted mean, null values left out; null without weight."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg((F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0))).alias("rate"), F.sum(weight).alias("weight"))


def outcome(expected: Column, got: Column, correct: Column) -> Column:
    """right, missed (nothing read), invented (nothing expected) or wrong."""
    blank = lambda c: c.isNull() | (c == "")
    return F.when(correct, "right").when(blank(got), "missed").when(blank(expected), "invented").otherwise("wrong")


def error_tallies(results: DataFrame, by: list[str]) -> DataFrame:
    """``by``, n (values), wrong, missed, invented, rate."""
    kind = outcome(F.col("expected"), F.col("got"), F.col("correct"))
    counts = results.withColumn("_mr_k", kind).groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(F.col("_mr_k") == k).alias(k) for k in ("wrong", "missed", "invented")))
    return counts.withColumn("rate", (F.col("wrong") + F.col("missed") + F.col("invented")) / F.col("n"))


def hard_fields(tallies: DataFrame, field: str, most: int, least: int = 30) -> DataFrame:
    """The ``most`` fields of the highest error rate among those of ``least`` values, ties by values, then name: a report."""
    return tallies.where((F.col("n") >= least) & (F.col("rate") > 0)).orderBy(F.desc("rate"), F.desc("n"), field).limit(most).select(field, F.round("rate", 4).alias("error_rate"), "n")


def worst(rows: DataFrame, by: str, rate: str, support: str, least: int = 1) -> DataFrame:
    """The row of the lowest rate among those with support, ties by name."""
    return rows.where(F.col(support) >= least).agg(F.min(F.struct(F.col(rate).alias("rate"), F.col(by).alias("name"))).alias("_w")).select("_w.name", "_w.rate")


def set_scores(rows: DataFrame, expected: str, got: str) -> DataFrame:
    """value, tp, fp, fn, f1 over documents whose label and answer are sets (arrays)."""
    both = F.array_distinct(F.concat(F.coalesce(expected, F.array().cast("array<string>")), F.coalesce(got, F.array().cast("array<string>"))))
    each = rows.select(F.explode(both).alias("value"), F.coalesce(F.col(expected), F.array().cast("array<string>")).alias("_e"), F.coalesce(F.col(got), F.array().cast("array<string>")).alias("_g"))
    inside = lambda c: F.expr(f"array_contains({c}, value)")
    counts = each.groupBy("value").agg(F.count_if(inside("_e") & inside("_g")).alias("tp"), F.count_if(inside("_g") & ~inside("_e")).alias("fp"), F.count_if(inside("_e") & ~inside("_g")).alias("fn"))
    return counts.withColumn("f1", 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")))


def macro(rows: DataFrame, by: list[str], document: str, correct: str) -> DataFrame:
    """``by``, documents, accuracy: the mean of the documents' own means."""
    each = rows.groupBy(*by, document).agg(F.avg(F.col(correct).cast("double")).alias("_mr_a"))
    return each.groupBy(*by).agg(F.count("*").alias("documents"), F.avg("_mr_a").alias("accuracy"))


def label_accuracy(rows: DataFrame, field: str, label: str, correct: str) -> DataFrame:
    """field, label, n, accuracy of fields by the label printed beside them."""
    return rows.groupBy(field, label).agg(F.count("*").alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"))


def label_spread(accuracy: DataFrame, field: str, least: int = 2) -> DataFrame:
    """field, labels, spread: the greatest less the least accuracy among labels of ``least`` readings; fields with one such label have none."""
    known = accuracy.where(F.col("n") >= least)
    return known.groupBy(field).agg(F.count("*").alias("labels"), (F.max("accuracy") - F.min("accuracy")).alias("spread")).where("labels > 1")


def generalisation_gap(accuracy: DataFrame, field: str, label: str, held_out: Column) -> DataFrame:
    """field, gap: accuracy of the label with the most readings less that of the held-out ones."""
    seen = accuracy.where(~held_out).groupBy(field).agg(F.max_by("accuracy", F.struct("n", label)).alias("_mr_seen"))
    unseen = accuracy.where(held_out).groupBy(field).agg((F.sum(F.col("accuracy") * F.col("n")) / F.sum("n")).alias("_mr_unseen"))
    return seen.join(unseen, field).select(field, (F.col("_mr_seen") - F.col("_mr_unseen")).alias("gap"))


def agreement(rows: DataFrame, by: list[str], first: str, second: str) -> DataFrame:
    """``by``, n, agreement of two readings; values that both leave out don't count."""
    stated = rows.where(F.col(first).isNotNull() | F.col(second).isNotNull())
    return stated.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.col(first).eqNullSafe(F.col(second)).cast("double")).alias("agreement"))


def quantiles(rows: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """``by``, n and nearest-rank quantiles under the names of ``points``."""
    return rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), *(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})").alias(name) for name, q in points.items()))


def shares(rows: DataFrame, kind: str) -> DataFrame:
    """kind, n, share of all rows."""
    counts = rows.groupBy(kind).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # kinds, not rows


def spellings(rows: DataFrame, by: list[str], shape: str) -> DataFrame:
    """``by``, shapes (sorted), of fields that are written in more than one shape."""
    return rows.where(F.col(shape).isNotNull()).groupBy(*by).agg(F.sort_array(F.collect_set(shape)).alias("shapes")).where(F.size("shapes") > 1)


def coverage_floor(rows: DataFrame, document: str, value: str, known: DataFrame, target: float = 0.2) -> DataFrame:
    """value, n, share, under: documents per value among those that have any; under: some, but less than the smaller of ``target`` and 0.75 over the number of ``known`` values, which all stand in the result."""
    stated = rows.where(F.col(value).isNotNull()).select(F.col(document).alias("_mr_d"), F.col(value).alias("value")).distinct()
    facts = stated.agg(F.count_distinct("_mr_d").alias("_mr_all")).join(F.broadcast(known.agg(F.count_distinct("value").alias("_mr_k"))))  # one row each
    counts = known.select("value").distinct().join(stated.groupBy("value").agg(F.count("*").alias("n")), "value", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    share = F.coalesce(F.col("n") / F.nullif("_mr_all", F.lit(0)), F.lit(0.0))
    both = counts.join(F.broadcast(facts)).withColumn("share", share)
    return both.select("value", "n", "share", ((F.col("share") > 0) & (F.col("share") < F.least(F.lit(target), 0.75 / F.col("_mr_k")))).alias("under"))


def winner(rows: DataFrame, by: list[str], name: str, metric: str, step: str, higher: bool = True) -> DataFrame:
    """``by``, name of the best metric, of equals the later step; unmeasured ones are left out."""
    value = F.col(metric) if higher else -F.col(metric)
    return rows.where(F.col(metric).isNotNull()).groupBy(*by).agg(F.max_by(name, F.struct(value.alias("m"), F.col(step).alias("s"))).alias(name))


def candidates(rows: DataFrame, run: str, step: str, loss: str, trailing: int = 3) -> DataFrame:
    """Per run the last ``trailing`` steps, the step of the least loss, and the one nearest to two thirds of the last, of equals the later."""
    by = Window.partitionBy(run)
    last = F.max(step).over(by)
    ranked = rows.withColumns({"_mr_r": F.row_number().over(by.orderBy(F.desc(step))), "_mr_l": F.row_number().over(by.orderBy(F.asc_nulls_last(loss), step)), "_mr_t": F.row_number().over(by.orderBy(F.abs(F.col(step) - last * 2 / 3), F.desc(step)))})
    return ranked.withColumns({"best_loss": (F.col("_mr_l") == 1) & F.col(loss).isNotNull(), "two_thirds": F.col("_mr_t") == 1}).where((F.col("_mr_r") <= trailing) | F.col("best_loss") | F.col("two_thirds")).drop("_mr_r", "_mr_l", "_mr_t")


def review_order(rows: DataFrame, flagged: str, confidence: str, key: str, threshold: float = 0.7, spot_check: float = 0.9) -> DataFrame:
    """Add routing (review, spot_check or standard) and its place in the queue's order: (flagged first, then the least confident); sort by place."""
    routing = F.when(F.col(flagged) | (F.col(confidence) < threshold), "review").when(F.col(confidence) >= spot_check, "spot_check").otherwise("standard")
    return rows.withColumns({"routing": routing, "place": F.struct((~F.col(flagged)).alias("f"), F.col(confidence).alias("c"), F.col(key).alias("k"))})


def reconcile(lines: DataFrame, totals: DataFrame, key: str, amount: str, stated: str, tolerance: float = 0.51) -> DataFrame:
    """Sums of ``lines`` against stated totals: reconciled, mismatch or unverifiable (one side missing)."""
    sums = lines.groupBy(key).agg(F.sum(amount).alias("summed"))
    both = totals.join(sums, key, "full_outer")
    status = F.when(F.col(stated).isNull() | F.col("summed").isNull(), "unverifiable").when(F.abs(F.col(stated) - F.col("summed")) <= tolerance, "reconciled").otherwise("mismatch")
    return both.withColumn("status", status)


def bag_match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal key matched with multiplicity: per key the smaller of both counts."""
    a, b = left.groupBy(*keys).agg(F.count("*").alias("expected")), right.groupBy(*keys).agg(F.count("*").alias("got"))
    both = a.join(b, keys, "full_outer").fillna(0, ["expected", "got"])
    return both.withColumn("matched", F.least("expected", "got"))
