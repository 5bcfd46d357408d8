"""Deliveries, frozen sets and schema validation by hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import reports as rep
from millrace.operators import shapes as H
from millrace.sources import bundles as B


def test_deliveries(spark):
    manifest = spark.createDataFrame([("auto_1", "auto", "f1"), ("auto_2", "auto", "f2"), ("boat_1", "auto", "f3"), ("home_1", "home", "f4")], "document string, line string, file string")
    none = spark.createDataFrame([("boat_", "watercraft")], "source_prefix string, lob string")
    got = B.delivered(manifest, spark.createDataFrame([("auto_2",)], "document string"), none, spark.createDataFrame([("f1",), ("f4",)], "key string"), ["auto", "watercraft"])
    assert sorted((r.document, r.line, r.missing) for r in got.collect()) == [("auto_1", "auto", False), ("boat_1", "watercraft", True)]
    twins = spark.createDataFrame([("a", "x.pdf", "y.pdf"), ("b", "z.pdf", None)], "document string, file_digital string, file_scanned string")
    assert sorted(map(tuple, B.renders(twins).collect())) == [("a", "digital", "x.pdf"), ("a", "scanned", "y.pdf"), ("b", "digital", "z.pdf")]
    good, bad = B.checked(manifest, {"no home": F.col("line") == "home", "odd": F.col("file") == "f4"})
    assert good.count() == 3 and bad.first().problems == ["no home", "odd"]
    keys = "tenant string, doc_type string, source_id string"
    labels = spark.createDataFrame([("t", "p", "1", "L1"), ("t", "p", "2", "L2")], keys + ", label string")
    meta = spark.createDataFrame([("t", "p", "1", "M")], keys + ", meta string")
    read = spark.createDataFrame([("t", "p", "2", "R")], keys + ", reading string")
    pages = spark.createDataFrame([("t", "p", "1", 2, "b"), ("t", "p", "1", 1, "a"), ("u", "p", "1", 1, "other")], keys + ", page int, text string")
    assert sorted((r.source_id, r.meta, r.reading, r.page_texts) for r in B.loaded(labels, meta, read, pages).collect()) == [("1", "M", None, ["a", "b"]), ("2", None, "R", None)]
    codes = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "c string")
    assert [r[0] for r in codes.select(B.recoded(F.col("c"), {"A": "x", "B": "y"}, {"B": "z"})).collect()] == ["x", "z", "C", None]
    assert B.used_ids(labels, meta, read).count() == 2


def test_frozen_sets(spark, tmp_path):
    docs = spark.createDataFrame([("1", "acme", "h1"), ("2", "new", "h2"), ("3", None, "h3")], "source_id string, carrier string, gold_sha256 string")
    with pytest.raises(ValueError, match="too few"):
        B.freeze(docs, str(tmp_path / "frozen"))
    assert B.freeze(docs, str(tmp_path / "frozen"), allow_small=True) == 3
    with pytest.raises(Exception, match="(?i)exist"):
        B.freeze(docs, str(tmp_path / "frozen"), least=1)
    assert [r[0] for r in B.unfinished(docs, docs.where("source_id < '3'")).collect()] == ["3"]
    assert {r.source_id: r.held_out_carrier for r in B.marked_held_out(docs, docs.where("source_id = '1'")).collect()} == {"1": False, "2": True, "3": False}
    reviews = spark.createDataFrame([("1", "h1", "ok"), ("2", "old", "ok")], "source_id string, gold_sha256 string, review string")
    assert {r.source_id: r.review for r in B.marked_reviewed(docs, reviews).collect()} == {"1": "ok", "2": None, "3": None}
    items = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "item string, stored_at int")
    assert [r.item for r in B.to_export(items, items.where("item = 'b'"), 1).collect()] == ["c"]


SCHEMA = {
    "$defs": {"row": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 1}}, "additionalProperties": False}},
    "type": "object", "required": ["a", "gone"],
    "properties": {"a": {"type": ["string", "null"], "pattern": "^x"}, "t": {"type": "array", "items": {"$ref": "#/$defs/row"}, "maxItems": 2}, "e": {"enum": [1, "one"]}, "o": {"oneOf": [{"type": "string"}, {"const": 5}]}, "n": {"anyOf": [{"type": "null"}, {"type": "number", "maximum": 3}]}},
}


def test_schema_validation(spark):
    assert H.schema_errors({"a": "xy", "gone": 1, "t": [{"k": 1.0}], "e": "one", "o": 5, "n": None}, SCHEMA) == []
    bad = {"a": "y", "t": [{"k": 0, "z": 1}, {}, {"k": True}], "e": True, "o": 6, "n": 4}
    assert sorted(H.schema_errors(bad, SCHEMA)) == sorted([("gone", "required"), ("a", "pattern"), ("t", "maxItems"), ("t[0].k", "minimum"), ("t[0].z", "additionalProperties"), ("t[1].k", "required"), ("t[2].k", "type"), ("e", "enum"), ("o", "oneOf"), ("n", "anyOf")])
    df = spark.createDataFrame([(1, json.dumps({"a": None, "gone": 0})), (2, json.dumps(bad)), (3, None)], "id int, d string")
    assert {r.id for r in H.schema_failures(df, ["id"], "d", SCHEMA).collect()} == {2, 3}


def test_reports_on_odd_rows(spark):
    docs = spark.createDataFrame([("1", None, None, "policy", 9, None), ("2", "image_only", True, "policy", None, True)], "source_id string, modality_mode string, is_scanned boolean, doc_type string, page_count int, held_out_carrier boolean")
    assert sorted((r.source_id, r.subset) for r in rep.subsets(docs).collect()) == [("1", "full"), ("1", "long_policy"), ("2", "full"), ("2", "held_out_carrier"), ("2", "image_only"), ("2", "scanned")]
    assert rep.subsets(docs.limit(0)).count() == 0 and rep.worst_line(spark.createDataFrame([("a", 1, 5)], "line string, correct int, total int")).first().accuracy is None
    lines = spark.createDataFrame([("a", 30, 0.8), ("b", 5, 0.1), ("c", 30, 0.9)], "line string, documents int, accuracy double")
    assert [r.line for r in rep.below_floor(lines).collect()] == ["a"]
    values = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "x"), (2, "b", None)], "doc int, f string, value string")
    assert rep.confused_pairs(values, "doc", "f", spark.createDataFrame([("a", "b")], "field string, sibling string")).first().documents == 1
    assert rep.comparable({"a": 1, "b": float("nan")}, {"a": 2, "b": float("nan")}, ("a", "b")) == ["a"]
    assert spark.range(1).select(rep.pages_within(F.array(*map(F.lit, (3, 5, 7))), 2)).first()[0] == [3, 5]
