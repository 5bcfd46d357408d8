"""Queries of nested documents, their scoring, and the statistics over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import documents as docs
from millrace.operators import metrics as met
from millrace.operators import statistics as stats
from millrace.plans.registry import SCORED_SQL, query, scored, table, wilson_sql


def orders_as_documents(spark, d) -> DataFrame:
    """Orders as nested documents: a label (expected) and an answer (got) that differs in known ways."""
    line = F.struct(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("int").cast("string")).alias("claim_number"), F.col("l_linestatus").alias("mode"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(line)).alias("claims"))
    key = F.col("o_orderkey")
    joined = table(spark, d, "orders").join(lines, F.col("l_orderkey") == key)
    envelope = lambda raw, parsed: F.struct(raw.alias("raw"), parsed.alias("parsed"))
    text = key.cast("string")
    expected = F.to_json(F.struct(F.struct(envelope(F.concat(F.lit("No. "), text), text).alias("number"), F.col("o_orderstatus").alias("state")).alias("order"), F.array("o_orderstatus", "o_orderpriority").alias("tags"), "claims"))
    got_state = F.when(key % 4 == 0, None).when(key % 4 == 1, F.lower("o_orderstatus")).when(key % 4 == 2, F.lit("Z")).otherwise(F.col("o_orderstatus"))
    got_claims = F.filter("claims", lambda x, i: (i + key) % 3 != 0)
    got = F.to_json(F.struct(F.struct(envelope(text, text).alias("number"), got_state.alias("state"), F.when(key % 5 == 0, F.lit("more")).alias("extra")).alias("order"), F.array("o_orderpriority", "o_orderstatus").alias("tags"), got_claims.alias("claims")))
    return joined.select("o_orderkey", expected.alias("expected"), got.alias("got"))


CLAIMS_SQL = "c AS (SELECT l_orderkey, claim_number, mode, row_number() OVER (PARTITION BY l_orderkey ORDER BY claim_number, mode) - 1 AS i FROM (SELECT DISTINCT l_orderkey, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INT) AS claim_number, l_linestatus AS mode FROM lineitem))"


@query(f"""WITH {CLAIMS_SQL}, o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT o_orderkey, 'order.number' AS path, o_orderkey::VARCHAR AS value FROM o UNION ALL SELECT o_orderkey, 'order.state', o_orderstatus FROM o
UNION ALL SELECT o_orderkey, 'tags', '["' || o_orderstatus || '", "' || o_orderpriority || '"]' FROM o
UNION ALL SELECT l_orderkey, 'claims[' || i || '].claim_number', claim_number FROM c WHERE l_orderkey IN (SELECT o_orderkey FROM o) UNION ALL SELECT l_orderkey, 'claims[' || i || '].mode', mode FROM c WHERE l_orderkey IN (SELECT o_orderkey FROM o)""")
def nested_flatten(spark, d):
    return docs.flattened(orders_as_documents(spark, d), ["o_orderkey"], "expected")


FIELDS_SQL = """f AS (SELECT o_orderkey, 'order.number' AS path, true AS correct, true AS exact FROM orders UNION ALL SELECT o_orderkey, 'tags', true, o_orderstatus = o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, 'order.state', o_orderkey % 4 IN (1, 3) OR (o_orderkey % 4 = 2 AND o_orderstatus = 'Z'), o_orderkey % 4 = 3 OR (o_orderkey % 4 = 2 AND o_orderstatus = 'Z') FROM orders
UNION ALL SELECT o_orderkey, 'order.extra', false, false FROM orders WHERE o_orderkey % 5 = 0), r AS (SELECT * FROM f WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"""


@query(f"WITH {FIELDS_SQL} SELECT o_orderkey, path, correct, exact FROM r")
def field_results(spark, d):
    return docs.field_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got").select("o_orderkey", "path", "correct", "exact")


@query(f"WITH {FIELDS_SQL} SELECT path, count(*) AS n, round(avg(correct::INT), 6) AS normalized, round(avg(exact::INT), 6) AS exact FROM r GROUP BY 1")
def field_accuracy(spark, d):
    found = met.field_accuracy(docs.field_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got"), ["path"])
    return found.select("path", "n", F.round("normalized", 6).alias("normalized"), F.round("exact", 6).alias("exact"))


@query(f"WITH {FIELDS_SQL}, t AS (SELECT path, count(*) AS n, count(*) FILTER (WHERE NOT correct AND path = 'order.state' AND o_orderkey % 4 = 2) AS wrong, count(*) FILTER (WHERE NOT correct AND path = 'order.state' AND o_orderkey % 4 = 0) AS missed, count(*) FILTER (WHERE path = 'order.extra') AS invented FROM r GROUP BY 1) SELECT path, n, wrong, missed, invented, round((wrong + missed + invented) / n, 6) AS rate FROM t")
def error_tallies(spark, d):
    found = met.error_tallies(docs.field_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got"), ["path"])
    return found.withColumn("rate", F.round("rate", 6))


TABLES_SQL = f"{CLAIMS_SQL}, t AS (SELECT l_orderkey AS o_orderkey, count(*) AS expected, count(*) FILTER (WHERE (i + l_orderkey) % 3 <> 0) AS got FROM c WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1)"


@query(f"WITH {TABLES_SQL} SELECT o_orderkey, 'claims' AS path, expected::INT AS expected, got::INT AS got, got::INT AS matched, CASE WHEN got > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS accuracy FROM t")
def table_results(spark, d):
    return docs.table_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got")


@query(f"WITH {TABLES_SQL} SELECT 'claims' AS path, round(sum(got) / sum(got), 6)::DOUBLE AS precision, round(sum(got) / sum(expected), 6) AS recall, round(2 * sum(got) / (sum(expected) + sum(got)), 6) AS f1, (sum(expected) - sum(got))::BIGINT AS missed FROM t")
def table_rates(spark, d):
    found = met.table_rates(docs.table_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got"), ["path"])
    return found.select("path", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "missed")


@query(f"WITH {CLAIMS_SQL}, g AS (SELECT l_orderkey, count(*) FILTER (WHERE (i + l_orderkey) % 3 <> 0) AS got, count(*) AS expected FROM c WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1) SELECT l_orderkey AS o_orderkey, got::INT AS matched, got::INT AS got, expected::INT AS expected FROM g")
def claim_results(spark, d):
    return docs.claim_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got")


@query(f"WITH {CLAIMS_SQL}, o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), g AS (SELECT l_orderkey, count(*) FILTER (WHERE (i + l_orderkey) % 3 <> 0) AS got, count(*) AS n FROM c GROUP BY 1) SELECT count(*) + 2 * count(*) + 2 * sum(n)::BIGINT AS opportunities, (count(*) FILTER (WHERE o_orderkey % 4 = 0) + 2 * sum(n - got))::BIGINT AS missed FROM o JOIN g ON o_orderkey = l_orderkey")
def false_nulls(spark, d):
    found = docs.false_nulls(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got")
    return found.agg(F.count("*").alias("opportunities"), F.count_if("missed").alias("missed"))


@query("SELECT c_mktsegment, max(CASE WHEN n >= 2 THEN accuracy END) - min(CASE WHEN n >= 2 THEN accuracy END) AS spread FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n, avg((c_acctbal > 0)::INT) AS accuracy FROM customer GROUP BY ALL) GROUP BY 1 HAVING count(*) FILTER (WHERE n >= 2) > 1")
def label_spread(spark, d):
    rows = table(spark, d, "customer").withColumn("ok", F.col("c_acctbal") > 0)
    return met.label_spread(met.label_accuracy(rows, "c_mktsegment", "c_nationkey", "ok"), "c_mktsegment").select("c_mktsegment", "spread")


@query("WITH e AS (SELECT doc_id, [lang, source] AS e, CASE WHEN doc_id % 3 = 0 THEN [lang] WHEN doc_id % 3 = 1 THEN [source, 'other'] ELSE [lang, source] END AS g FROM documents), v AS (SELECT e, g, unnest(list_distinct(list_concat(e, g))) AS value FROM e), c AS (SELECT value, count(*) FILTER (WHERE list_contains(e, value) AND list_contains(g, value)) AS tp, count(*) FILTER (WHERE list_contains(g, value) AND NOT list_contains(e, value)) AS fp, count(*) FILTER (WHERE list_contains(e, value) AND NOT list_contains(g, value)) AS fn FROM v GROUP BY 1) SELECT value, tp, fp, fn, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c")
def set_scores(spark, d):
    key = F.col("doc_id") % 3
    rows = table(spark, d, "documents").select(F.array("lang", "source").alias("e"), F.when(key == 0, F.array("lang")).when(key == 1, F.array("source", F.lit("other"))).otherwise(F.array("lang", "source")).alias("g"))
    return met.set_scores(rows, "e", "g").withColumn("f1", F.round("f1", 6))


@query("WITH d AS (SELECT l_linestatus, l_orderkey, avg((l_returnflag = 'N')::INT) AS a FROM lineitem GROUP BY ALL) SELECT l_linestatus, count(*) AS documents, round(avg(a), 6) AS accuracy FROM d GROUP BY 1")
def macro_accuracy(spark, d):
    rows = table(spark, d, "lineitem").withColumn("ok", F.col("l_returnflag") == "N")
    return met.macro(rows, ["l_linestatus"], "l_orderkey", "ok").withColumn("accuracy", F.round("accuracy", 6))


@query("SELECT l_linestatus, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS rate, sum(l_quantity) AS weight FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1")
def pooled_rate(spark, d):
    return met.pooled(table(spark, d, "lineitem"), ["l_linestatus"], "l_discount", "l_quantity").withColumn("rate", F.round("rate", 6))


@query("WITH k AS (SELECT unnest(['en', 'de', 'fr', 'es', 'xx', 'yy']) AS value), s AS (SELECT DISTINCT doc_id, lang AS value FROM documents WHERE lang IS NOT NULL), c AS (SELECT value, count(s.doc_id) AS n FROM k LEFT JOIN s USING (value) GROUP BY 1) SELECT value, n, round(n / (SELECT count(DISTINCT doc_id) FROM s), 6) AS share, n > 0 AND n / (SELECT count(DISTINCT doc_id) FROM s) < 0.125 AS under FROM c")
def coverage_floor(spark, d):
    known = spark.createDataFrame([(v,) for v in ("en", "de", "fr", "es", "xx", "yy")], "value string")
    return met.coverage_floor(table(spark, d, "documents"), "doc_id", "lang", known).withColumn("share", F.round("share", 6))


@query("SELECT o_orderpriority, arg_max(o_orderkey, o_totalprice * 100000000 + o_orderkey) AS o_orderkey FROM (SELECT o_orderpriority, o_orderkey, round(o_totalprice / 1000) AS o_totalprice FROM orders) WHERE o_totalprice IS NOT NULL GROUP BY 1")
def winner_by_metric(spark, d):
    rows = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", F.round(F.col("o_totalprice") / 1000).alias("m"))
    return met.winner(rows.withColumn("s", F.col("o_orderkey")), ["o_orderpriority"], "o_orderkey", "m", "s")


@query("SELECT o_orderpriority, count(*) AS n, quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.9) AS p90 FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1")
def step_quantiles(spark, d):
    return met.quantiles(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", {"median": 0.5, "p90": 0.9})


@query("SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1")
def kind_shares(spark, d):
    return met.shares(table(spark, d, "events"), "event_type").withColumn("share", F.round("share", 6))


@query(f"WITH g AS (SELECT lang, count(*) AS n, count(*) FILTER (WHERE quality = 0) AS e FROM documents JOIN labels USING (doc_id) GROUP BY 1) SELECT lang, n, e AS errors, round({wilson_sql('e', 'n')}, 9) AS upper FROM g")
def wilson_bounds(spark, d):
    both = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    counts = both.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 0).alias("errors"))
    return counts.withColumn("upper", F.round(S.wilson_upper(F.col("errors"), F.col("n")), 9))


TEMPERATURE_SQL = f"""WITH {SCORED_SQL}, k AS (SELECT toxic, quality, greatest(1e-6, least(1 - 1e-6, c)) AS p, 0.25 + 7.75 * i / 160 AS t FROM scored, range(0, 161) r(i)),
b AS (SELECT toxic, t, quality, 1 / (1 + exp(-ln(p / (1 - p)) / t)) AS c FROM k), g AS (SELECT toxic, t, greatest(ceil(c * 10 - 1e-12)::INT - 1, 0) AS bin, count(*) AS n, sum(c) AS sc, sum(quality) AS sq FROM b GROUP BY ALL),
e AS (SELECT toxic, t, round(sum(abs(sc - sq)) / sum(n), 4) AS ece FROM g GROUP BY ALL) SELECT toxic, round(arg_min(t, ece * 1000000 + t), 4) AS temperature, min(ece) AS ece FROM e GROUP BY 1"""


@query(TEMPERATURE_SQL)
def temperature(spark, d):
    return stats.fit_temperature(scored(spark, d), "toxic", "c", "quality")


@query(f"WITH {SCORED_SQL}, g AS (SELECT toxic, least(floor(c * 10), 9)::BIGINT AS bin, avg(quality) AS a FROM scored GROUP BY ALL) SELECT toxic, round((bin + 0.5) / 10, 4) AS confidence, round(greatest(0.0, max(a) OVER (PARTITION BY toxic ORDER BY bin)), 4) AS calibrated FROM g")
def isotonic_points(spark, d):
    return stats.isotonic_points(scored(spark, d), "toxic", "c", "quality")


@query(f"WITH {SCORED_SQL} SELECT doc_id, CASE WHEN toxic = 1 OR round(c, 9) < 0.7 THEN 'review' WHEN round(c, 9) >= 0.9 THEN 'spot_check' ELSE 'standard' END AS routing, row_number() OVER (ORDER BY toxic DESC, round(c, 9), doc_id)::INT AS place FROM scored QUALIFY row_number() OVER (ORDER BY toxic DESC, round(c, 9), doc_id) <= 100")
def review_routing(spark, d):
    """The first hundred of the review queue, a report."""
    from pyspark.sql import Window

    rows = scored(spark, d).select("doc_id", (F.col("toxic") == 1).alias("flagged"), F.round("c", 9).alias("c"))
    top = met.review_order(rows, "flagged", "c", "doc_id").orderBy("place").limit(100)
    return top.select("doc_id", "routing", F.row_number().over(Window.partitionBy().orderBy("place")).alias("place"))


@query("SELECT o_custkey, count(*) AS n, round(avg((o_orderstatus IS NOT DISTINCT FROM CASE WHEN o_orderkey % 2 = 0 THEN 'F' END)::INT), 6) AS agreement FROM orders GROUP BY 1")
def reading_agreement(spark, d):
    rows = table(spark, d, "orders").withColumn("second", F.when(F.col("o_orderkey") % 2 == 0, "F"))
    return met.agreement(rows, ["o_custkey"], "o_orderstatus", "second").withColumn("agreement", F.round("agreement", 6))


@query()
def bootstrap_ci(spark, d):
    """Quality of documents by label against a candidate, resampled by toxicity: the order of Python's generator has no SQL."""
    rows = scored(spark, d).select(F.concat(F.lit("toxic"), F.col("toxic").cast("string")).alias("metric"), "doc_id", F.col("quality").cast("double").alias("current"), F.col("c").alias("candidate"))
    found = stats.paired_bootstrap(rows, "metric", "doc_id", "current", "candidate", margin=0.05, resamples=2000)
    return found.select("metric", "documents", *(F.round(c, 6).alias(c) for c in ("observed", "lower", "upper", "p_value")))
