"""Labels printed beside values: where a value stands in the text, and the label that the layout puts in front of it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import typed_value
from millrace.operators.documents import parsed, printed, walk

# Layouts by how sure they are; characters of a value worth looking for, of a stacked label's distance, and of a label.
PATTERNS = {"inline_kv": 100, "table_column_header": 95, "bold_adjacent": 90, "table_row_label": 85, "stacked_form": 60, "dotted_leader": 55}
LEAST_CHARS, LOOKBACK, LONGEST = 4, 120, 60


def clean(raw: str) -> str:
    """A label without dot leaders, emphasis, list marks and closing punctuation."""
    text = re.sub(r"\*+", "", re.sub(r"\.{3,}", " ", raw))
    text = re.sub(r"[\s*:|.]+$", "", re.sub(r"^[\s*#>|\-]+", "", text))
    return " ".join(text.split()).strip(" :*|-")


def cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def is_rule(line: str) -> bool:
    """A table's line of dashes."""
    return all(set(c) <= set("-: ") for c in cells(line))


def places(text: str, value: Any, path: str) -> list[int]:
    """Where a value stands: as written, else wherever a cell, a word or two words in a row mean the same."""
    if value is None or isinstance(value, bool):
        return []
    if found := [m.start() for m in re.finditer(re.escape(str(value)), text)]:
        return found
    wanted, out = typed_value(value, path), []
    if wanted is None:
        return []
    for cell in re.finditer(r"[^|\t\n]+", text):
        words = list(re.finditer(r"\S+", cell[0]))
        spans = [(words[0].start(), words[-1].end())] if words else []
        spans += [(words[i].start(), words[j].end()) for i in range(len(words)) for j in (i, i + 1) if j < len(words)]
        hits = set()
        for a, b in spans:
            piece = cell[0][a:b]
            bare = piece if (a, b) == spans[0] else piece.strip(".,;:*|")
            if len(bare) > 1 and typed_value(bare, path) == wanted:
                hits.add(cell.start() + a + piece.find(bare))
        out += sorted(hits)
    return out


def header_of(text: str, at: int) -> str | None:
    """The header above a table cell: the row before the table's line of dashes, same column."""
    start = text.rfind("\n", 0, at) + 1
    if not text[start:].lstrip(" \t").startswith("|") or not text[start:at].count("|"):
        return None
    column, above = text[start:at].count("|") - 1, text[:start].split("\n")[:-1]
    table: list[str] = []
    while above and above[-1].strip().startswith("|"):
        table.append(above.pop())
    rule = next((i for i, line in enumerate(table) if is_rule(line)), None)
    if rule is None or rule + 1 >= len(table):
        return None
    names = cells(table[rule + 1])
    return clean(names[column]) or None if column < len(names) else None


def label_of(text: str, at: int) -> tuple[str, str] | None:
    """(label, layout) in front of a place in the text; null if no layout has one."""
    if header := header_of(text, at):
        return header, "table_column_header"
    start = text.rfind("\n", 0, at) + 1
    end = text.find("\n", at)
    line, before = text[start : len(text) if end < 0 else end], text[start:at]
    tries: list[tuple[str, str]] = []
    if line.startswith("|") and len(cells(line)) == 2:
        tries.append((([c for c in map(str.strip, before.split("|")) if c] or [""])[-1], "table_row_label"))
    if m := re.search(r"([^|\n]{2,60}?)\s*[:：]\s*$", before):
        tries.append((m[1], "inline_kv"))
    if m := re.match(r"(.*?)\.{3,}", before):
        tries.append((m[1], "dotted_leader"))
    if m := re.search(r"\*\*([^*\n]{2,60})\*\*\s*$", before):
        tries.append((m[1], "bold_adjacent"))
    for raw, layout in tries:
        if label := clean(raw):
            return label, layout
    last = text[max(0, at - LOOKBACK) : start].rstrip("\n").rsplit("\n", 1)[-1]
    if not before.strip() and last.strip() and not re.search(r"[:：]\s*\S", last) and 0 < len(clean(last)) <= LONGEST:
        return clean(last), "stacked_form"
    return None


def derived(label: dict, text: str) -> Iterator[tuple[str, str, str | None, str | None]]:
    """(path, outcome, label, layout) of every stated value: its surest label, or too_short, not_found, no_label. Of equally sure labels the first in the text."""
    for path, node in walk(printed(label)):
        for value in node if isinstance(node, list) else [node]:
            if value is None:
                continue
            if len(str(value)) < LEAST_CHARS:
                yield path, "too_short", None, None
                continue
            at = places(text, value, path)
            found = [x for x in (label_of(text, a) for a in at) if x]
            if found:
                yield (path, "labelled", *max(found, key=lambda x: PATTERNS[x[1]]))
            else:
                yield path, "no_label" if at else "not_found", None, None


def derive_labels(df: DataFrame, keys: list[str], document: str, text: str) -> DataFrame:
    """``keys``, path, field (without row numbers), outcome, label, layout of the values of each row's document in its text. Null documents have none; null texts hold nothing."""
    n = len(keys)
    own = df.select(*keys, F.col(document).cast("string").alias("_doc"), F.col(text).cast("string").alias("_text"))
    names = ["path", "field", "outcome", "label", "layout"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, (doc, page) in enumerate(zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True)):
                for path, *rest in derived(parsed(doc), page or ""):
                    at.append(i)
                    rows.append((path, re.sub(r"\[\d+\]", "[]", path), *rest))
            if rows:
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(at, pa.int64())) for k in range(n)), *(pa.array(c, pa.string()) for c in zip(*rows, strict=True))], [*keys, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*keys).schema)
    return own.mapInArrow(run, ", ".join([kinds, *(f"{c} string" for c in names)]))


def registry(found: DataFrame, document: str, least: int = 1, examples: int = 3) -> DataFrame:
    """field, label, documents, layout (the surest), confidence, examples of derived labels that ``least`` documents print."""
    weights = F.create_map(*(F.lit(x) for pair in PATTERNS.items() for x in pair))
    rows = found.where("outcome = 'labelled'").withColumn("_w", weights[F.col("layout")])
    out = rows.groupBy("field", "label").agg(F.count_distinct(document).alias("documents"), F.max_by("layout", "_w").alias("layout"), F.round(F.max("_w") / 100, 2).alias("confidence"), F.slice(F.array_sort(F.collect_set(document)), 1, examples).alias("examples"))
    return out.where(F.col("documents") >= least)
