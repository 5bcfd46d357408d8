"""Values by meaning: hand-made cases, plain Python against built-in expressions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions import values as V

TODAY = date(2026, 6, 1)
DATES = {
    "2026-04-01": "2026-04-01", "04/01/2026": "2026-04-01", "4/1/2026": "2026-04-01", "04/01/26": "2026-04-01", "07/04/85": "1985-07-04", "13/04/2026": "2026-04-13", "04-01-2026": "2026-04-01",
    "2026/04/01": "2026-04-01", "April 1, 2026": "2026-04-01", "Apr 1, 2026": "2026-04-01", "1 April 2026": "2026-04-01", "1  apr  2026": "2026-04-01", "20260401": "2026-04-01",
    "01/01/36": "2036-01-01", "01/01/37": "1937-01-01", "soon": None, "": None, "02/30/2026": None, "31/02/2026": None,
}
AMOUNTS = {"$1,234.50": 1234.5, "(12.5)": -12.5, "(1,200.00)": -1200.0, "7-": None, "USD 1,234": 1234.0, "abc": None, "-3": -3.0, "": None, "()": None, "1.2.3": None, "$ 5": 5.0, None: None}
NAMES = {"Acme Mfg LLC": "acme manufacturing", "ACME MANUFACTURING, Inc.": "acme manufacturing", "Smith & Jones Inc": "smith and jones", "Co.": None, "  ": None, None: None, "Ünïted Svcs": "ünïted services"}
CARRIERS = {
    "The Travelers Indemnity Company": "travelers", "Travelers Casualty and Surety Company of America": "travelers", "TRAVELERS": "travelers", "Great American": "great american",
    "Other Mutual": "other mutual", "Unknown Insurance Company": "unknown", "dryden_mutual": "dryden", "Pending Mutual Insurance Co": "pending mutual", None: None,
}


def test_dates(spark):
    assert {k: V.date_value(k, TODAY) for k in DATES} == DATES
    rows = spark.createDataFrame([(k,) for k in DATES], "v string")
    got = {r.v: r.d and r.d.isoformat() for r in rows.select("v", S.iso_date(F.col("v"), F.lit(TODAY)).alias("d")).collect()}
    assert got == DATES
    shown = rows.where("v = '1 April 2026'").select(S.output_date(F.col("v"))).first()[0]
    assert shown == "04/01/2026" and V.date_value(None) is None


def test_amounts_and_names(spark):
    assert {k: V.amount_value(k) for k in AMOUNTS} == AMOUNTS
    rows = spark.createDataFrame([(k,) for k in AMOUNTS], "v string")
    assert {r.v: r.a for r in rows.select("v", S.currency(F.col("v")).alias("a")).collect()} == AMOUNTS
    assert V.amount_value(True) is None and V.amount_value(3) == 3.0
    assert {k: V.entity_value(k) for k in NAMES} == NAMES
    assert {k: V.carrier_value(k) for k in CARRIERS} == CARRIERS
    rows = spark.createDataFrame([(k,) for k in CARRIERS], "v string")
    assert {r.v: r.c for r in rows.select("v", V.carrier_key(F.col("v")).alias("c")).collect()} == CARRIERS
    assert V.names_no_carrier("N/A") and V.names_no_carrier("Unknown Insurance Company") and V.names_no_carrier(None) and not V.names_no_carrier("Other Mutual")
    assert V.identifier_value(1.0) == "1" and V.identifier_value("WC-8842317-01") == "WC884231701" and V.identifier_value("1.0") == "10" and V.identifier_value("--") is None


KINDS = {"policy.effective_date": "date", "candidate": "text", "dates[0]": "date", "report_due_dates[0]": "date", "policy_number": "identifier", "loc_no": "identifier", "a.total_paid": "currency", "each_limit": "currency", "named_insured": "entity", "mortgagee_name": "entity", "notes": "text"}


def test_kinds_and_matches(spark):
    assert {k: V.kind_of(k) for k in KINDS} == KINDS
    rows = spark.createDataFrame([(k,) for k in KINDS], "v string")
    assert {r.v: r.k for r in rows.select("v", S.field_kind(F.col("v")).alias("k")).collect()} == KINDS
    yes = [(None, None, None), ("2026-04-01", "04/01/2026", "effective_date"), (12400.0, "$12,400.00", "total_paid"), (957, 957.0, "year"), (["a", "b"], ["B", "a"], "lines"), ([], None, "lines"), ("ACME Mfg", "acme manufacturing llc", "insured"), ("tbd", "TBD", "effective_date")]
    no = [("a", None, None), (None, "", "x"), (["a"], ["a", "b"], "lines"), ([{"a": 1}], [{"a": 1}], "rows"), (1, 1.01, "n"), ("12", "13", "policy_number")]
    assert all(V.match(*x) for x in yes) and not any(V.match(*x) for x in no)
    pairs = spark.createDataFrame([("12-a", "12 A", "policy_number"), ("x", None, "y"), (None, None, "y")], "a string, b string, p string")
    assert [r[0] for r in pairs.select(V.matches(F.col("a"), F.col("b"), F.col("p"))).collect()] == [True, False, True]


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


def test_scalars(spark):
    lit = F.lit
    words = spark.createDataFrame([("Straße ÄB c-d",)], "v string").select(S.folded_words(F.col("v")))
    assert words.first()[0] == ["strasse", "b", "c", "d"]
    assert one(spark, S.word_shingles(F.array(lit("a"), lit("b")), 5)) == ["a b"] and one(spark, S.word_shingles(F.array().cast("array<string>"), 5)) == []
    assert one(spark, S.text_tokens(lit(""))) == 0 and one(spark, S.text_tokens(lit(None).cast("string"))) == 0 and one(spark, S.text_tokens(lit("12 ab٣"))) == 3 + 0 + 1
    assert one(spark, S.answer_tokens(lit("")).cast("int")) == 0
    assert one(spark, S.wilson_upper(lit(0), lit(0))) == 1.0 and abs(one(spark, S.wilson_upper(lit(0), lit(100))) - 0.036994) < 1e-5 and abs(one(spark, S.wilson_upper(lit(0), lit(400))) - 0.009513) < 1e-5
    assert one(spark, S.parsed_run_id(lit(" Extractor-v2.1 "))).asDict() == {"lineage": "extractor", "version": "v2.1"} and one(spark, S.parsed_run_id(lit("extractor"))) is None
    assert one(spark, S.parsed_source_id(lit("policy_0012"))).asDict() == {"kind": "policy", "index": 12} and one(spark, S.parsed_source_id(lit("p-1"))) is None
    assert one(spark, S.clean_label(lit("**Policy Number**: ....... "))) == "Policy Number" and one(spark, S.clean_label(lit("| - Total  Premium |"))) == "Total Premium"
    assert one(spark, S.canonical_field(lit("a[12].b[0]"))) == "a[].b[]"
    assert one(spark, S.form_edition(lit("CP 00 10  10 12"))).asDict() == {"form": "CP 00 10", "printed": "10 12", "edition": "10/12"} and one(spark, S.form_edition(lit("CP 00"))) is None
    assert one(spark, S.edition_mm_yy(lit("(Ed. 4-2012)"))) == "04/12" and one(spark, S.edition_mm_yy(lit("ABC 0412"))) == "04/12" and one(spark, S.edition_mm_yy(lit("none"))) is None
    assert one(spark, S.value_shape(lit("2026-01-02"))) == "date" and one(spark, S.value_shape(lit("AB-123"))) == "identifier" and one(spark, S.value_shape(lit("1.0"))) == "name" and one(spark, S.value_shape(lit(1.0), numeric=True)) == "number"
    assert one(spark, S.whole_number(lit(1.0))) == "1" and one(spark, S.whole_number(lit(1.5))) == "1.5"
    assert one(spark, S.image_tokens(lit(1000), lit(700), 3136, 1254400)) == 31 * 22
    assert one(spark, S.image_tokens(lit(4000), lit(3000), 3136, 1254400)) <= 1254400 // 1024
    probabilities = F.array(lit(-0.1), lit(-0.5))
    import math

    assert math.isclose(one(spark, S.span_confidence(probabilities)), math.exp(-0.5)) and math.isclose(one(spark, S.span_confidence(probabilities, "geomean")), math.exp(-0.3)) and math.isclose(one(spark, S.span_confidence(probabilities, "mean")), (math.exp(-0.1) + math.exp(-0.5)) / 2)
    assert one(spark, S.span_confidence(F.array().cast("array<double>"))) is None
    with pytest.raises(ValueError):
        S.span_confidence(probabilities, "median")
    assert one(spark, S.reading_budget(lit(100))) == 120.0 and one(spark, S.reading_budget(lit(400))) == 240.0
    assert one(spark, S.shard_of(lit("policy_0001"), 4)) == __import__("zlib").crc32(b"policy_0001") % 4
    assert one(spark, S.error_class(lit("abcdefgh"), lit("abcdefgx"))) == "perception" and one(spark, S.error_class(lit(None).cast("string"), lit("x"))) == "invented" and one(spark, S.error_class(lit("abcdefgh"), lit("other"), F.array(lit("other")))) == "schema_reasoning"


def test_repeating_tail():
    assert V.repeating_tail("start " + "ab" * 3000) == 2 and V.repeating_tail("ab" * 100) is None and V.repeating_tail("abcdefgh" * 800 + "x") is None
    assert V.repeating_tail("x" * 20, least_chars=6, least_repeats=2) == 1
