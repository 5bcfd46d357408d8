"""Files, sinks and the job stream, in temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.sources import store
from millrace.streaming import queue


def put(root, files):
    for name, text in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)


def test_scans_and_loads(spark, tmp_path):
    put(tmp_path, {"t1/policy/d1/page_0001.md": "one", "t1/policy/d1/page_0010.md": "ten", "t1/policy/d1/page_0002.md": "two", "t2/policy/d2/page_0001.md": "one", "shared/x.json": "{}"})
    root = str(tmp_path)
    assert sorted(r.key for r in store.listing(spark, root, "*.md").collect())[0] == "t1/policy/d1/page_0001.md" and store.listing(spark, root).count() == 5
    files = store.contents(spark, root)
    keys = {r.key: (r.tenant, r.own) for r in files.select("key", store.tenant_of(F.col("key")).alias("tenant"), store.in_tenant(F.col("key")).alias("own")).collect()}
    assert keys["t1/policy/d1/page_0001.md"] == ("t1", True) and keys["shared/x.json"] == (None, False)
    known = files.where("key LIKE '%json'").select("sha256")
    assert sorted(r.key for r in store.fresh(files, known).collect()) == ["t1/policy/d1/page_0001.md", "t1/policy/d1/page_0002.md", "t1/policy/d1/page_0010.md"]
    held = files.select("key", F.when(F.col("key").endswith("0002.md"), F.lit("old")).otherwise(F.col("md5")).alias("md5"))
    assert [r.key for r in store.changed(files, held.where("key <> 'shared/x.json'")).orderBy("key").collect()] == ["shared/x.json", "t1/policy/d1/page_0002.md"]
    pages = {r.document: [p.text for p in r.pages] for r in store.page_texts(files.where("key LIKE '%md'")).collect()}
    assert pages == {"t1/policy/d1": ["one", "two", "ten"], "t2/policy/d2": ["one"]}
    assert {r.folder: (r.missing, r.complete) for r in store.bundles(files, ("x.json",)).collect()}["shared"] == ([], True)
    assert store.unread(files.select("key"), files.where("key LIKE '%md'"), ["key"]).count() == 1
    wrong = store.verified(spark, root, files.select("key", "sha256").union(spark.createDataFrame([("gone", "x")], "key string, sha256 string")))
    assert [r.key for r in wrong.collect()] == ["gone"]


def test_tables_of_text(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿name, reason ,more\n a ,,x\n\"b\nc\",why,y\n".encode())
    assert sorted(map(tuple, store.csv_rows(spark, str(tmp_path / "a.csv"), ["name", "reason"]).collect())) == [("a", None), ("b\nc", "why")]
    with pytest.raises(ValueError):
        store.csv_rows(spark, str(tmp_path / "a.csv"), ["absent"])
    rows = spark.createDataFrame([("policy_auto_1",), ("policy_2",), ("other",), ("policy_2",), (None,)], "id string")
    prefixes = spark.createDataFrame([("policy_", "p"), ("policy_auto", "a")], "prefix string, line string")
    assert sorted(((r.id, r.line) for r in store.longest_prefix(rows, "id", prefixes, "prefix").collect()), key=str) == sorted([("policy_auto_1", "a"), ("policy_2", "p"), ("policy_2", "p"), ("other", None), (None, None)], key=str)
    df = spark.createDataFrame([(2, "b", None), (1, "a", 5)], "i int, s string, n int")
    store.write_jsonl(df, str(tmp_path / "out"), ["i"], header={"kind": "test"})
    lines = [json.loads(x) for p in sorted((tmp_path / "out").glob("part*")) for x in p.read_text().splitlines()]
    assert lines == [{"kind": "test"}, {"i": 1, "s": "a", "n": 5}, {"i": 2, "s": "b", "n": None}]
    assert sorted(map(tuple, store.read_jsonl(spark, str(tmp_path / "out"), "i int, s string, n int").collect()), key=str) == [(1, "a", 5), (2, "b", None)]
    with pytest.raises(Exception, match="(?i)exist"):
        store.write_jsonl(df, str(tmp_path / "out"), ["i"])
    store.write_jsonl(df, str(tmp_path / "gz"), ["i"], compression="gzip")
    assert store.read_jsonl(spark, str(tmp_path / "gz"), "i int, s string, n int").count() == 2
    store.write_once(df, str(tmp_path / "once"))
    with pytest.raises(Exception, match="(?i)exist"):
        store.write_once(df, str(tmp_path / "once"))
    assert spark.read.parquet(store.replaced(spark, str(tmp_path / "v"), df)).count() == 2
    new = spark.createDataFrame([(2, "new", 1), (3, "c", 1), (3, "c", 1)], "i int, s string, n int")
    assert sorted((r.i, r.s) for r in store.upserted(df, new.distinct(), ["i"]).collect()) == [(1, "a"), (2, "new"), (3, "c")]
    assert sorted((r.i, r.s) for r in store.appended(df, new, ["i"]).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    ids = spark.createDataFrame([("v1",), ("v12",), ("draft",)], "id string")
    assert store.next_number(ids, "id").first().next == 13 and store.next_number(ids.limit(0), "id").first().next == 1


def test_jobs_run_once(spark, tmp_path):
    folder, out = tmp_path / "jobs", str(tmp_path / "out")
    put(folder, {"a.json": '{"job": "1", "n": 2}\n{"job": "1", "n": 2}\n{"job": "2", "n": 5}\n'})
    work = lambda rows: rows.withColumn("square", F.col("n") * F.col("n"))
    for more in ({}, {"b.json": '{"job": "2", "n": 5}\n{"job": "3", "n": 1}\n'}, {}):
        put(folder, more)
        queue.phase(queue.jobs(spark, str(folder), "job string, n int", 1), "job", work, out, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted((r.job, r.square) for r in spark.read.parquet(out).collect()) == [("1", 4), ("2", 25), ("3", 1)]
    events = spark.createDataFrame([("1", 1, "new"), ("1", 3, "done"), ("1", 2, "running"), ("2", 1, "new")], "job string, at int, state string")
    assert {r.job: r.state for r in queue.latest_state(events, "job", ["at"], ["state"]).collect()} == {"1": "done", "2": "new"}
    items = spark.createDataFrame([("a", "2026-01-01", True, True), ("b", "2026-01-01", False, True), ("c", "2026-02-08", False, False), ("d", "2026-02-08", False, True)], "id string, stored_at string, reviewed boolean, complete boolean").withColumn("stored_at", F.col("stored_at").cast("timestamp"))
    assert {r.id: r.reason for r in queue.expired(items, 30, "2026-02-10 00:00:00").collect()} == {"a": "reviewed", "b": "expired", "c": "incomplete"}


def test_windows_of_a_stream(spark, tmp_path):
    put(tmp_path / "in", {"a.json": "\n".join(json.dumps({"t": f"2026-01-01 00:{m:02}:00", "k": "x"}) for m in (1, 2, 11, 59))})
    stream = spark.readStream.schema("t timestamp, k string").json(str(tmp_path / "in"))
    q = queue.windowed_counts(stream, "t", "k").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((str(r.start)[11:16], r.n) for r in spark.table("counted").collect()) == [("00:00", 2), ("00:10", 1), ("00:50", 1)]
