"""Fragments of one document put together: claims over overlapping windows, pages, lists and their totals."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import amount_value, identifier_value, text_value
from millrace.operators.documents import nothing

# What stands for a claim without a number, the columns whose totals are printed, the tolerances of sums and of row counts.
CLAIM_FIELDS = ("loss_date", "claimant", "description", "total_incurred")
TOTALLED = ("total_incurred", "paid", "reserved")
MONEY, ROWS = 0.51, 1


def is_total(row: dict) -> bool:
    return str(row.get("row_type") or "claim").casefold() in ("subtotal", "total")


def claim_key(row: dict) -> str | None:
    """The claim's number, else its date, claimant, description and total; null if it has none of them."""
    if number := identifier_value(row.get("claim_number")):
        return f"claim|{number}"
    parts = [text_value(row.get(f)) or "" for f in CLAIM_FIELDS[:3]] + [str(amount_value(row.get(CLAIM_FIELDS[3])) or "")]
    return "|".join(("fallback", *parts)) if any(parts) else None


def filled(row: dict) -> int:
    return sum(not nothing(v) for v in row.values())


def joined_rows(kept: dict, other: dict) -> tuple[dict, list[str]]:
    """Both readings of one row, and the names they disagree in: blanks are filled, a text that the other begins with yields, else the fuller row's value stays (the first one's if equal)."""
    out, conflicts = dict(kept), []
    newer = filled(other) > filled(kept)
    for name, value in other.items():
        mine = out.get(name)
        if nothing(mine):
            out[name] = value
        elif not nothing(value) and mine != value:
            texts = sorted((mine, value), key=lambda v: len(str(v).strip())) if isinstance(mine, str) and isinstance(value, str) else None
            if texts and texts[0].strip() and texts[0].strip() != texts[1].strip() and texts[1].strip().startswith(texts[0].strip()):
                out[name] = texts[1]
                continue
            out[name] = value if newer else mine
            conflicts.append(name)
    return out, conflicts


def merge_claims(rows: DataFrame, document: str, window: str, position: str, row: str) -> DataFrame:
    """document, place, claim (JSON), windows, conflicts of rows read in overlapping windows; totals among them are left out.

    Rows of one key in one window are different claims: the k-th of any window
    is a reading of the k-th claim of that key. Readings are joined in window
    order. Rows without a key stay as they are. ``place`` orders a document's
    claims by where they were first read.
    """
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [json.loads(t) if t else {} for t in b.column(3).to_pylist()]
            key = [None if is_total(r) else claim_key(r) or "" for r in made]
            keep = pa.array([k is not None for k in key])
            yield pa.RecordBatch.from_arrays([*(c.filter(keep) for c in b.columns), pa.array(key, pa.string()).filter(keep)], ["document", "window", "position", "claim", "key"])

    own = rows.select(F.col(document).cast("string").alias("document"), F.col(window).cast("long").alias("window"), F.col(position).cast("long").alias("position"), F.col(row).cast("string").alias("claim"))
    read = own.mapInArrow(keyed, "document string, window long, position long, claim string, key string")
    slot = F.row_number().over(Window.partitionBy("document", "key", "window").orderBy("position"))
    read = read.withColumn("slot", F.when(F.col("key") == "", F.concat_ws("-", F.col("window"), F.col("position"))).otherwise(slot.cast("string")))
    readings = read.groupBy("document", "key", "slot").agg(F.array_sort(F.collect_list(F.struct("window", "position", "claim"))).alias("r"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            claims, conflicts = [], []
            for found in b.column(3).to_pylist():
                claim, clashes = json.loads(found[0]["claim"] or "{}"), set()
                for other in found[1:]:
                    claim, names = joined_rows(claim, json.loads(other["claim"] or "{}"))
                    clashes.update(names)
                claims.append(json.dumps(claim, ensure_ascii=False, sort_keys=True))
                conflicts.append(sorted(clashes))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(claims, pa.string()), pa.array(conflicts, pa.list_(pa.string())), pa.array(list(map(len, b.column(3).to_pylist())), pa.int32())], ["document", "window", "position", "claim", "conflicts", "windows"])

    folded = readings.select("document", F.col("r")[0].window.alias("window"), F.col("r")[0].position.alias("position"), "r").mapInArrow(fold, "document string, window long, position long, claim string, conflicts array<string>, windows int")
    place = F.row_number().over(Window.partitionBy("document").orderBy("window", "position"))
    return folded.select("document", place.alias("place"), "claim", "windows", "conflicts")


def merge_pages(values: DataFrame, document: str, page: str, field: str, value: str, declarations: str, policy_fields: tuple[str, ...] = ()) -> DataFrame:
    """document, field, value, page, differ of plain values read page by page: the first in page order, but of ``policy_fields`` the one on the declarations page; ``differ``: whether pages disagree. ``page`` may be a struct; where two values could have equal pages, it must hold what orders them, or either may be taken. Values without a page count for ``differ`` alone; documents without values are not in the result."""
    stated = values.where(F.col(value).isNotNull())
    first = F.col(field).isin(*policy_fields) & (F.col(page) == F.col(declarations)) if policy_fields else F.lit(False)
    order = F.when(F.col(page).isNotNull(), F.struct((~F.coalesce(first, F.lit(False))).alias("o"), F.col(page).alias("p")))
    return stated.groupBy(document, field).agg(F.min_by(value, order).alias("value"), F.min_by(page, order).alias("page"), (F.count_distinct(value) > 1).alias("differ"))


def completeness(extracted: Column, stated: Column, detected: Column, tolerance: int = ROWS) -> Column:
    """(flagged, confidence) of a list by the rows read, the number that the document states, and the rows detected; neither known: not flagged, 0.5."""
    wrong = F.coalesce(stated != extracted, F.lit(False))
    off = F.coalesce(F.abs(detected - extracted) > tolerance, F.lit(False))
    d_stated, d_detected = F.coalesce(F.abs(stated - extracted), F.lit(-1)), F.coalesce(F.abs(detected - extracted), F.lit(-1))
    reference = F.when(d_stated >= d_detected, stated).otherwise(detected)
    share = F.when(reference == extracted, 1.0).when(reference == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), 1 - F.abs(extracted - reference) / F.greatest(reference, F.lit(1))), 4))
    flagged = wrong | off
    return F.struct(flagged.alias("flagged"), F.when(flagged, share).when(stated.isNull() & detected.isNull(), 0.5).otherwise(1.0).alias("confidence"))


def reconcile_periods(claims: DataFrame, printed: DataFrame, document: str = "document", columns: tuple[str, ...] = TOTALLED, tolerance: float = MONEY) -> DataFrame:
    """document, period, column, extracted, printed, status of claims against printed totals.

    ``claims``: document, period (null: none given) and amounts. ``printed``:
    document, period (null: the whole document), amounts. Claims without a
    period belong to the only printed period if there is one and no claim gives
    another. A printed sum without a column to compare is a mismatch; periods
    without printed totals have the status unverifiable.
    """
    if not columns:
        raise ValueError("no columns to reconcile")
    long = lambda df: df.select(F.col(document).alias("document"), F.col("period").cast("string").alias("period"), F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("amount")) for c in columns))).alias("_x")).select("document", "period", "_x.*")
    totals = long(printed).where("amount IS NOT NULL").groupBy("document", "period", "column").agg(F.max("amount").alias("printed"))
    named = totals.where("period IS NOT NULL").groupBy("document").agg(F.count_distinct("period").alias("_n"), F.min("period").alias("_only"))
    given = claims.groupBy(F.col(document).alias("document")).agg(F.count("period").alias("_given"))
    only = named.join(given, "document").where("_n = 1 AND _given = 0").select("document", "_only")
    sums = long(claims).groupBy("document", "period", "column").agg(F.sum("amount").alias("extracted"))
    by_period = sums.join(only, "document", "left").withColumn("period", F.coalesce("period", "_only", F.lit("unspecified"))).select("document", "period", "column", "extracted")
    whole = long(claims).groupBy("document", "column").agg(F.sum("amount").alias("extracted")).select("document", F.lit("").alias("period"), "column", "extracted")
    stated = totals.withColumn("period", F.coalesce("period", F.lit("")))
    both = by_period.unionByName(whole).join(stated, ["document", "period", "column"], "full_outer").where("period <> '' OR printed IS NOT NULL")
    status = F.when(F.col("printed").isNull(), "unverifiable").when(F.abs(F.col("extracted") - F.col("printed")) <= tolerance, "reconciled").otherwise("mismatch")
    return both.withColumn("status", status)


def reconciliation_status(lines: DataFrame) -> DataFrame:
    """document, status of ``reconcile_periods``: mismatch if anything printed is, unverifiable if nothing is printed."""
    return lines.groupBy("document").agg(F.when(F.max((F.col("status") == "mismatch").cast("int")) == 1, "mismatch").when(F.max((F.col("status") == "reconciled").cast("int")) == 1, "reconciled").otherwise("unverifiable").alias("status"))


def reconciliation_rate(statuses: DataFrame) -> DataFrame:
    """rate, documents: reconciled among those that print a total; null without any."""
    known = statuses.where("status <> 'unverifiable'")
    return known.agg((F.count_if(F.col("status") == "reconciled") / F.nullif(F.count("*"), F.lit(0))).alias("rate"), F.count("*").alias("documents"))


def coalesced(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A left row's blanks filled from the right row of its key; rows of either side alone stay."""
    both = left.select(*keys, *columns).join(right.select(*keys, *(F.col(c).alias(f"_mr_{c}") for c in columns)), keys, "full_outer")
    return both.select(*keys, *(F.coalesce(c, f"_mr_{c}").alias(c) for c in columns))


def shared_words(needed: DataFrame, held: DataFrame, key: str, words: str) -> DataFrame:
    """``key``, coverage: share of the words of ``needed`` (arrays) that ``held`` has too, each as often as it stands there; no words needed: null."""
    count = lambda df, name: df.select(key, F.explode(words).alias("_w")).groupBy(key, "_w").agg(F.count("*").alias(name))
    both = count(needed, "_need").join(count(held, "_have"), [key, "_w"], "left")
    hit = both.groupBy(key).agg((F.sum(F.least("_need", F.coalesce("_have", F.lit(0)))) / F.sum("_need")).alias("coverage"))
    return needed.select(key).distinct().join(hit, key, "left")
