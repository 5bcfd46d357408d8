"""Queries of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import reports as rep
from millrace.plans.registry import SCORED_SQL, query, scored, table, wilson_sql


@query("""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'image_only' WHEN 1 THEN 'noisy_ocr_image' END AS m, o_orderkey % 4 = 0 AS s, o_orderpriority AS t, o_orderkey % 11 = 0 AS h FROM orders), l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'N') AS ok FROM lineitem GROUP BY 1),
x AS (SELECT *, unnest(list_filter(['full', CASE WHEN m = 'image_only' THEN 'image_only' END, CASE WHEN m = 'noisy_ocr_image' THEN 'noisy_ocr' END, CASE WHEN s THEN 'scanned' END, CASE WHEN h THEN 'held_out_carrier' END], lambda v: v IS NOT NULL)) AS subset FROM d JOIN l ON l_orderkey = o_orderkey)
SELECT t AS doc_type, subset, count(*) AS documents, sum(n)::BIGINT AS n, round(sum(ok) / sum(n), 6) AS accuracy FROM x GROUP BY ALL""")
def subset_accuracy(spark, d):
    key = F.col("o_orderkey")
    documents = table(spark, d, "orders").select("o_orderkey", F.when(key % 3 == 0, "image_only").when(key % 3 == 1, "noisy_ocr_image").alias("modality_mode"), (key % 4 == 0).alias("is_scanned"), F.col("o_orderpriority").alias("doc_type"), F.lit(9).alias("page_count"), (key % 11 == 0).alias("held_out_carrier"))
    results = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "N").alias("correct"))
    return rep.by_subset(results, documents, "o_orderkey").withColumn("accuracy", F.round("accuracy", 6))


@query("SELECT l_linestatus AS metric, round(sum(v * n) / sum(n), 6) AS value FROM (SELECT l_linestatus, l_returnflag, avg(l_discount) AS v, count(*) AS n FROM lineitem GROUP BY ALL) WHERE v IS NOT NULL GROUP BY 1")
def gate_metrics(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("metric"), F.col("l_returnflag").alias("doc_type")).agg(F.avg("l_discount").alias("value"), F.count("*").alias("readings"))
    return rep.gate_metrics(rows).withColumn("value", F.round("value", 6))


@query("""WITH e AS (SELECT l_returnflag AS error_class, l_linestatus AS line, 'claims[].f' || (l_partkey % 40) AS field FROM lineitem), f AS (SELECT field, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, field LIMIT 15)
SELECT 'class' AS scope, '' AS name, error_class, count(*) AS n FROM e GROUP BY ALL UNION ALL SELECT 'line', line, error_class, count(*) FROM e GROUP BY ALL UNION ALL SELECT 'field', field, error_class, count(*) FROM e WHERE field IN (SELECT field FROM f) GROUP BY ALL""")
def error_summary(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("error_class"), F.col("l_linestatus").alias("line"), F.concat(F.lit("claims["), F.col("l_linenumber").cast("string"), F.lit("].f"), (F.col("l_partkey") % 40).cast("string")).alias("path"))
    return rep.error_summary(rows)


@query("SELECT o_orderpriority AS line, count(*) AS documents, round(avg((o_orderkey % 7 NOT IN (0, 1))::INT), 4) AS accuracy, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS undetected FROM orders GROUP BY 1")
def line_detection(spark, d):
    key = F.col("o_orderkey") % 7
    rows = table(spark, d, "orders").withColumn("got", F.when(key == 0, None).when(key == 1, "other").otherwise(F.col("o_orderpriority")))
    return rep.detection(rows, "o_orderpriority", "got")


@query(f"WITH {SCORED_SQL}, g AS (SELECT toxic, count(*) AS seen, count(*) FILTER (WHERE c >= 0.3) AS accepted, count(*) FILTER (WHERE c >= 0.3 AND quality = 0) AS wrong FROM scored GROUP BY 1) SELECT toxic, seen, accepted, wrong, round(wrong / accepted, 6) AS rate, round(accepted / seen, 6) AS coverage, round((accepted - wrong) / accepted, 6) AS accuracy, round(1 - {wilson_sql('wrong', 'accepted')}, 6) AS lower FROM g")
def auto_accept(spark, d):
    rows = scored(spark, d).select("toxic", (F.col("c") < 0.3).alias("flagged"), (F.col("quality") == 1).alias("correct"))
    found = rep.auto_accept(rows, ["toxic"])
    return found.select("toxic", "seen", "accepted", "wrong", *(F.round(c, 6).alias(c) for c in ("rate", "coverage", "accuracy", "lower")))


@query("SELECT c_mktsegment, c_nationkey, count(DISTINCT c_custkey) AS documents, count(DISTINCT c_custkey) < 8 AS thin FROM customer GROUP BY ALL")
def label_coverage(spark, d):
    return rep.label_coverage(table(spark, d, "customer"), "c_custkey", "c_mktsegment", "c_nationkey", least=8)


@query("SELECT lang, count(DISTINCT doc_id) AS documents, count(DISTINCT doc_id) FILTER (WHERE doc_id % 3 <> 0) AS real, count(DISTINCT doc_id) FILTER (WHERE doc_id % 3 = 0) AS synthetic, count(*) AS rows FROM documents GROUP BY 1")
def examples_by_line(spark, d):
    return rep.examples_by_line(table(spark, d, "documents").select("doc_id", "lang", (F.col("doc_id") % 3 == 0).alias("made")), "lang", "doc_id", "made")


@query("SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'base model' ELSE o_orderpriority END AS adapter, round(quantile_disc(ms, 0.95), 1) AS p95_ms, count(*) AS calls FROM (SELECT o_orderkey, o_orderpriority, unnest([o_totalprice / 10, o_totalprice / 20]) AS ms FROM orders) WHERE ms IS NOT NULL GROUP BY 1")
def adapter_latency(spark, d):
    rows = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 4 == 0, None).otherwise(F.col("o_orderpriority")).alias("a"), F.array(F.col("o_totalprice") / 10, F.col("o_totalprice") / 20, F.lit(None).cast("double")).alias("ms"))
    return rep.latency(rows, "a", "ms")


@query("SELECT CASE WHEN c_nationkey % 3 = 0 THEN 'unseen' ELSE 'seen' END AS kind, count(*) AS n, round(avg((c_acctbal > 0)::INT), 6) AS accuracy FROM customer GROUP BY 1")
def label_split(spark, d):
    rows = table(spark, d, "customer").select("c_nationkey", (F.col("c_nationkey") % 3 != 0).alias("seen"), (F.col("c_acctbal") > 0).alias("ok"))
    return rep.label_split(rows, "seen", "c_nationkey", "ok").withColumn("accuracy", F.round("accuracy", 6))


@query("SELECT l_orderkey, list_sort(list_distinct(list_filter(list(l_linenumber), lambda p: p <= 4))) AS pages FROM lineitem GROUP BY 1")
def cited_pages(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("refs"))
    return rows.select("l_orderkey", rep.cited_pages(F.col("refs"), F.lit(4)).alias("pages"))


@query("SELECT l_orderkey, l_returnflag, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_linenumber) = 1")
def inferred_pages(spark, d):
    return rep.only_page(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"], "l_linenumber")


@query("SELECT conv_id, word, list_sort(list_distinct(list(turn))) AS pages FROM (SELECT conv_id, turn, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS word FROM conversations) GROUP BY ALL")
def word_pages(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)).alias("words"))
    return rep.word_pages(turns, "conv_id", "turn", "words")


ROTATION_SQL = """WITH d AS (SELECT doc_id, lang, source || ':' || (doc_id % 50) AS family, doc_id // 3 % 40 AS twin, doc_id % 2 = 0 AS scanned FROM documents WHERE doc_id IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY lang, family, twin ORDER BY scanned, doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang, family, twin) AS n FROM d),
t AS (SELECT lang, family, twin, row_number() OVER (PARTITION BY lang, family ORDER BY sha256('42:render_rotation:' || family || ':' || twin), twin) - 1 AS i FROM (SELECT DISTINCT lang, family, twin FROM r WHERE n > 1)), e AS (SELECT r.*, i, unnest(range(1, 5)) AS epoch FROM r JOIN t USING (lang, family, twin))
SELECT epoch::INT AS epoch, doc_id FROM e WHERE (i + epoch - 1) % n <> r"""


@query(ROTATION_SQL)
def render_rotation(spark, d):
    key = F.col("doc_id")
    rows = table(spark, d, "documents").where("doc_id IS NOT NULL").select("doc_id", "lang", F.concat("source", F.lit(":"), (key % 50).cast("string")).alias("family"), (F.floor(key / 3) % 40).alias("twin"), (key % 2 == 0).alias("scanned"), F.lit(None).cast("string").alias("mode"))
    return rep.render_rotation(rows, "lang", "family", "twin", "scanned", "mode")


@query("SELECT lang, floor(n_chars / 500)::BIGINT * 500 AS bucket, count(*) AS rows, count(*) FILTER (WHERE n_chars > 4000) AS over FROM documents GROUP BY ALL")
def length_histogram(spark, d):
    return rep.length_histogram(table(spark, d, "documents"), ["lang"], "n_chars", 500, 4000)


@query(f"WITH {SCORED_SQL}, b AS (SELECT toxic, doc_id % 2 AS half, greatest(ceil(c * 10 - 1e-12)::INT - 1, 0) AS bin, count(*) AS n, sum(c) AS c, sum(quality) AS q FROM scored GROUP BY ALL) SELECT toxic, half, sum(n)::BIGINT AS n, round(sum(abs(c - q)) / sum(n), 4) AS ece FROM b GROUP BY ALL")
def ece_by_half(spark, d):
    rows = scored(spark, d).withColumn("half", F.col("doc_id") % 2)
    return rep.calibration_by(rows, ["toxic", "half"], "c", "quality")


@query("SELECT o_orderkey FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 EXCEPT ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0) UNION ALL (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0 EXCEPT ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)")
def epoch_difference(spark, d):
    orders = table(spark, d, "orders")
    return rep.epoch_difference(orders.where("o_orderkey % 3 <> 0"), orders.where("o_orderkey % 4 <> 0"), "o_orderkey")


@query("SELECT flag AS kind, count(*) AS flags, count(DISTINCT o_custkey) AS documents FROM (SELECT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'date_order' ELSE 'bad_state' END AS flag FROM orders) GROUP BY 1")
def flag_counts(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 2 == 0, "policy.expiration_date:date_order").otherwise("a.state:bad_state").alias("flag"))
    return rep.flag_counts(rows, "o_custkey", "flag")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN true ELSE source = 'web' END AS held FROM documents")
def held_fields(spark, d):
    """Whether a document's fields meet a wanted one, by whole paths or by their ends."""
    fields = F.array(F.concat(F.lit("a."), F.coalesce("lang", F.lit("-"))), F.concat(F.lit("source."), F.coalesce("source", F.lit("-"))))
    return table(spark, d, "documents").select("doc_id", rep.holds_any(fields, ["en", "source.web"]).alias("held"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ['a.b', 'a'] ELSE [] END AS paths FROM orders")
def review_paths(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("a.b:low"), F.lit("c:other"))).otherwise(F.array(F.lit("c:other"))).alias("flags"))
    return rows.select("o_orderkey", F.reverse(rep.review_paths(F.col("flags"), ("low",))).alias("paths"))
