"""Quality rules: a short-circuit cascade whose order follows rejection per cost, measured on a sample. Built-in functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import documents, least_hashes, materialize

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a document to reject; it uses the measures named in ``needs``."""

    name: str
    needs: tuple[str, ...]
    fails: Column


#: Inner columns that a measure goes through, in order. Underscore and prefix: they clash with none of the table's.
STEPS = {
    "n_words": ("_mr_words",),
    "n_repeat_words": ("_mr_words", "_mr_grams", "_mr_order", "_mr_places"),
    "n_lines": ("_mr_lines",),
    "n_dup_lines": ("_mr_lines",),
}


def _expressions() -> dict[str, Column]:
    """Measures and inner columns by name, each over the columns before it."""
    text = F.col("text").cast("string")
    known = F.coalesce(text, F.lit(""))
    at = "_mr_order"
    again = f"(k > 0 AND {at}[greatest(k - 1, 0)].g = x.g) OR (k + 1 < size({at}) AND {at}[least(k + 1, size({at}) - 1)].g = x.g)"
    return {
        "_mr_words": F.filter(F.split(known, SPACES), lambda w: w != ""),
        "n_words": F.size("_mr_words").cast("long"),
        "_mr_grams": F.expr("CASE WHEN size(_mr_words) < 3 THEN array() ELSE transform(sequence(0, size(_mr_words) - 3), i -> xxhash64(_mr_words[i], _mr_words[i + 1], _mr_words[i + 2])) END").cast("array<long>"),
        "_mr_order": F.expr("CASE WHEN size(array_distinct(_mr_grams)) = size(_mr_grams) THEN NULL ELSE sort_array(transform(_mr_grams, (g, i) -> struct(g AS g, i AS i))) END"),
        "_mr_places": F.expr(f"sort_array(transform(filter({at}, (x, k) -> {again}), x -> x.i))"),
        "n_repeat_words": F.coalesce(F.expr("aggregate(_mr_places, struct(0 AS n, -3 AS last), (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)"), F.lit(0)).cast("long"),
        "_mr_lines": F.filter(F.split(known, "\n", -1), lambda x: x.rlike("[^ \t-\r]")),
        "n_lines": F.size("_mr_lines").cast("long"),
        "n_dup_lines": (F.size("_mr_lines") - F.size(F.array_distinct("_mr_lines"))).cast("long"),
        "word_chars": F.length(F.regexp_replace(known, SPACES, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(known, SYMBOLS, "")).cast("long"),
        "n_letters": F.length(F.regexp_replace(known, r"[^\p{L}]+", "")).cast("long"),
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, names: tuple[str, ...] = MEASURES, where: Column | None = None, done: frozenset[str] = frozenset()) -> DataFrame:
    """Add the measures ``names``, each over the whole text (null: no words, no lines); where ``where`` does not hold they are null and cost nothing.

    Words are the maximal runs of other characters than the six ASCII white
    spaces. n_repeat_words counts the words that stand in a 3-word window whose
    words stand, in this order, in another window of the text too: windows are
    compared by 64-bit hash; sorted with their positions, equal ones meet, and
    each repeated window adds the words that the repeated window before it did
    not cover. Texts whose windows are all different skip the sort. Own columns
    of these names are replaced; inner columns stay, for measures that follow.
    """
    made = _expressions()
    for name in names:
        for step in (*STEPS.get(name, ()), name):
            if step not in done:
                docs = docs.withColumn(step, made[step] if where is None else F.when(where, made[step]))
                done |= {step}
    return docs


def base_rules() -> list[Rule]:
    return [Rule("few_words", ("n_words",), F.col("n_words") < 50), Rule("repeats", ("n_words", "n_repeat_words"), 100 * F.col("n_repeat_words") > 50 * F.col("n_words"))]


def default_rules() -> list[Rule]:
    """Rules on top of the base: each far from what prose shows, so clean documents stay."""
    return [
        Rule("symbols", ("n_words", "n_symbols"), F.col("n_symbols") * 10 > F.col("n_words")),
        Rule("duplicate_lines", ("n_lines", "n_dup_lines"), 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        Rule("word_length", ("n_words", "word_chars"), (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
        Rule("few_letters", ("word_chars", "n_letters"), 100 * F.col("n_letters") < 50 * F.col("word_chars")),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = 1000) -> list[Rule]:
    """Rules by rejection per cost, best first, ties as given.

    Each rule runs, with its measures, over a sample: the ``sample_rows`` rows of
    ``docs`` of the least hashes of id and text, written once. Its cost is the
    seconds it adds to a run that only reads the texts, its selectivity the share
    it rejects. Seconds vary, so the order may differ between runs. It changes how
    soon a document is rejected and by which rule, never whether.
    """
    rows = least_hashes(docs.select("doc_id", F.col("text").cast("string").alias("text")), sample_rows)
    sample = materialize(rows.orderBy("_mr_order").limit(sample_rows).select("text"), "sample")

    def run(rows: DataFrame, measure: Column) -> tuple[float, float]:
        began = time.perf_counter()
        found = rows.agg(F.sum(measure), F.count("*")).first()
        return time.perf_counter() - began, (found[0] or 0) / max(1, found[1])

    plain = min(run(sample, F.length("text") * 0)[0] for _ in range(2))
    scored = []
    for at, rule in enumerate(rules):
        seconds, share = run(measured(sample, rule.needs), F.coalesce(rule.fails, F.lit(False)).cast("int"))
        scored.append((-share / max(1e-3, seconds - plain), at, rule))
    return [rule for _, _, rule in sorted(scored, key=lambda x: x[:2])]


def cascade(docs: DataFrame, rules: list[Rule], done: frozenset[str] = frozenset()) -> DataFrame:
    """Add ``rejected_by``: the name of the first rule that fails, null if none does.

    A rule's measures are taken only of documents that no rule before it
    rejected. ``done``: measures that are there already.
    """
    docs = docs.withColumn("rejected_by", F.lit(None).cast("string"))
    for rule in rules:
        open_ = F.col("rejected_by").isNull()
        docs = measured(docs, rule.needs, open_, done)
        done |= {s for n in rule.needs for s in (*STEPS.get(n, ()), n)}
        docs = docs.withColumn("rejected_by", F.when(open_ & rule.fails, F.lit(rule.name)).otherwise(F.col("rejected_by")))
    return docs


def _all_rules() -> list[Rule]:
    return [*base_rules(), *default_rules()]


def judge(docs: DataFrame, rules: list[Rule] | None = None, ordered: bool = True) -> DataFrame:
    """Add the measures, of all documents, and ``rejected_by`` (null: kept) to ``docs``; own columns of these names are replaced. Rules are ordered on a sample of ``docs`` first."""
    rules = rules if rules is not None else _all_rules()
    rules = order_rules(docs, rules) if ordered else rules
    done = frozenset(s for n in MEASURES for s in (*STEPS.get(n, ()), n))
    own = [c for c in docs.columns if c not in (*MEASURES, "rejected_by")]
    return cascade(measured(docs), rules, done).select(*own, *MEASURES, "rejected_by")


def keep(docs: DataFrame, rules: list[Rule] | None = None, ordered: bool = True) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns. Null texts have no words and are rejected; repeated rows stay or go together; an empty table gives an empty result."""
    rules = rules if rules is not None else _all_rules()
    rules = order_rules(docs, rules) if ordered else rules
    # own columns under other names, as the rules' names may clash with them
    own = {c: f"_mr_own{i}" for i, c in enumerate(docs.columns)}
    held = docs.select(F.col("text").cast("string").alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in own.items() if c != "text"), F.col("text").alias(own["text"]))
    # beside a column that is not deterministic, the filter stays above the measures: pushed below, it would repeat them over and over
    judged = cascade(held, rules).withColumn("_mr_hold", F.monotonically_increasing_id()).where("rejected_by IS NULL AND _mr_hold >= 0")
    return judged.select(*(F.col(n).alias(c) for c, n in own.items()))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Null texts have no words and fail the base; repeated rows stay repeated; an empty table gives an empty result."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    base = base_rules()
    judged = judge(docs, [*base, *default_rules()])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (base[0].fails | base[1].fails).alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


def measures_sql(source: str) -> str:
    """DuckDB: the measures of ``source`` (doc_id, text), row by row."""
    return f"""
    words AS (SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
                     list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
              FROM {source}),
    grams AS (SELECT *, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM words),
    counted AS (SELECT *, list_transform(list_filter(map_entries(list_histogram(g)), lambda e: e.value > 1), lambda e: e.key) AS again FROM grams),
    flagged AS (SELECT *, map_from_entries(list_transform(again, lambda k: row(k, true))) AS rep FROM counted),
    hits AS (SELECT *, list_transform(g, lambda x: coalesce(rep[x], false)) AS h FROM flagged),
    measures AS (SELECT doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                        coalesce(len(list_filter(range(1, len(w) + 1), lambda i: coalesce(h[i], false) OR (i > 1 AND coalesce(h[i - 1], false)) OR (i > 2 AND coalesce(h[i - 2], false)))), 0)::BIGINT AS n_repeat_words
                 FROM hits)"""


REJECTED_SQL = """(n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 10 > n_words OR 100 * n_dup_lines > 30 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 100 * length(regexp_replace(coalesce(text, ''), '[^\\p{L}]+', '', 'g')) < 50 * word_chars)"""

OP4_SQL = f"""WITH {measures_sql("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, NOT {REJECTED_SQL} AS kept
FROM measures"""
