"""Queries of corpora: families, splits, samples, windows and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import checks, grounding, lineage, merging
from millrace.operators import documents as docs
from millrace.operators import families as fam
from millrace.operators import metrics as met
from millrace.operators import planning as plan
from millrace.operators import shapes
from millrace.operators import statistics as stats
from millrace.plans.evaluation import orders_as_documents
from millrace.plans.registry import SCORED_SQL, hash_sql, query, raw_sql, scored, table


@query(f"""WITH g AS (SELECT source AS cell, doc_id AS group_id FROM documents WHERE doc_id IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY {hash_sql('group_id')}, group_id) - 1 AS r, count(*) OVER (PARTITION BY cell) AS n, (SELECT count(*) FROM g) AS total FROM g),
s AS (SELECT *, CASE WHEN total < 200 THEN 0.12 ELSE 0.1 END AS ts, CASE WHEN total < 200 THEN 0.18 WHEN total < 1000 THEN 0.15 ELSE 0.1 END AS vs FROM r), k AS (SELECT *, greatest(1, round_even(n * ts, 0)) AS tests, greatest(1, round_even(n * vs, 0)) AS vals FROM s)
SELECT group_id, CASE WHEN n < 3 OR r < n - tests - vals THEN 'train' WHEN r < n - tests THEN 'val' ELSE 'test' END AS split FROM k""")
def cell_splits(spark, d):
    """Exact shares within each source, one document a family."""
    groups = table(spark, d, "documents").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("group_id"), F.lit(1).cast("long").alias("documents"), "source")
    return fam.cell_splits(groups, "source").select("group_id", "split")


@query(f"SELECT DISTINCT doc_id FROM documents WHERE {hash_sql('doc_id', 'double')} < 0.15")
def double_annotation(spark, d):
    return fam.double_annotation(table(spark, d, "documents"), 0.15)


@query("SELECT doc_id, (('0x' || substr(sha256('holdout:' || doc_id), 1, 12))::UBIGINT::DOUBLE / 281474976710656.0) < 0.3 AS inside FROM documents")
def salted_share(spark, d):
    return table(spark, d, "documents").select("doc_id", fam.in_share(F.col("doc_id"), 0.3, "holdout").alias("inside"))


@query(f"""WITH d AS (SELECT doc_id, lang, source, doc_id % 3 <> 0 AS made FROM documents), c AS (SELECT lang, count(*) FILTER (WHERE NOT made) AS real, count(*) FILTER (WHERE made) AS n FROM d GROUP BY 1), b AS (SELECT lang, CASE WHEN real = 0 THEN n ELSE least(n, floor(0.4 * real / 0.6 + 0.5)) END AS budget FROM c),
t AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY {raw_sql('doc_id', 'data_mix')}, doc_id) AS turn FROM d WHERE made), p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY turn, {raw_sql('source', 'data_mix')}, source) AS place FROM t)
SELECT doc_id, lang FROM d WHERE NOT made UNION ALL SELECT doc_id, lang FROM p JOIN b USING (lang) WHERE place <= budget""")
def data_mix(spark, d):
    """Two documents of three as synthetic ones: of these, a budget of 40 % beside the real ones of each language, sources in turn."""
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", (F.col("doc_id") % 3 != 0).alias("made"))
    return fam.mixed_lines(rows, "lang", "made", "source", 0.4).select("doc_id", "lang")


@query(f"SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {raw_sql('doc_id', 'data_mix')}, doc_id)::INT - 1 AS turn FROM documents")
def round_robin(spark, d):
    return fam.round_robin(table(spark, d, "documents").select("source", "doc_id"), "source").select("source", "doc_id", "turn")


@query("SELECT source, doc_id, count(DISTINCT epoch)::BIGINT AS epochs FROM (SELECT source, doc_id, unnest(CASE WHEN doc_id % 10 = 0 THEN [1, 2, 3] ELSE [1, 2, 3, 4] END) AS epoch FROM documents) GROUP BY ALL HAVING count(DISTINCT epoch) <> 4 OR count(*) <> 4")
def epoch_gaps(spark, d):
    """Documents that are not once in each of four epochs: here every tenth misses the last."""
    rows = table(spark, d, "documents").select("source", "doc_id", F.explode(F.when(F.col("doc_id") % 10 == 0, F.array(*map(F.lit, (1, 2, 3)))).otherwise(F.array(*map(F.lit, (1, 2, 3, 4))))).alias("epoch"))
    gaps = fam.interleaved_epochs(rows, "doc_id", 4)
    return gaps.join(table(spark, d, "documents").select("doc_id", "source").distinct(), "doc_id").select("source", "doc_id", "epochs")


@query("""WITH r AS (SELECT 'g' || (doc_id % 97) AS g, doc_id::VARCHAR AS s, CASE WHEN doc_id % 97 = 5 AND doc_id % 2 = 0 THEN 'val' ELSE 'train' END AS split, doc_id % 11 = 0 AS made, CASE WHEN doc_id % 50 = 7 THEN 'b' ELSE 'a' END AS t FROM documents)
SELECT 'group in two splits' AS problem, g AS key FROM r GROUP BY g HAVING count(DISTINCT split) > 1 UNION ALL SELECT DISTINCT 'synthetic outside train', s FROM r WHERE made AND split <> 'train' UNION ALL SELECT DISTINCT 'second tenant', t FROM r WHERE t <> (SELECT min(t) FROM r)""")
def corpus_violations(spark, d):
    key = F.col("doc_id")
    rows = table(spark, d, "documents").select(F.concat(F.lit("g"), key % 97).alias("group_id"), key.cast("string").alias("source_id"), F.when((key % 97 == 5) & (key % 2 == 0), "val").otherwise("train").alias("split"), (key % 11 == 0).alias("synthetic"), F.when(key % 50 == 7, "b").otherwise("a").alias("tenant"))
    return fam.violations(rows)


@query("SELECT doc_id, greatest(0, len(list_filter(string_split_regex(coalesce(text, ''), '\\r?\\n'), lambda x: regexp_full_match(x, '[ \\t]*\\|.*\\|[ \\t]*') AND NOT regexp_full_match(x, '[ \\t|:-]*'))) - 1)::INT AS rows, ((CASE WHEN contains(lower(text), 'the') THEN 2.0 ELSE 0 END) + (CASE WHEN contains(lower(text), 'license') THEN 5.0 ELSE 0 END))::DOUBLE AS score FROM documents")
def page_signals(spark, d):
    return table(spark, d, "documents").select("doc_id", checks.table_rows(F.col("text")).alias("rows"), checks.page_score(F.col("text"), {"the": 2.0, "license": 5.0}).alias("score"))


@query("""WITH o AS (SELECT o_orderkey, o_orderkey % 6 = 0 AS dates, o_orderkey % 7 = 0 AS number, o_orderkey % 4 = 0 AS state FROM orders)
SELECT o_orderkey, 'policy.expiration_date' AS path, 'date_order' AS flag FROM o WHERE dates UNION ALL SELECT o_orderkey, 'policy.policy_number', 'bad_policy_no' FROM o WHERE number UNION ALL SELECT o_orderkey, 'mailing_address.state', 'bad_state' FROM o WHERE state""")
def consistency_flags(spark, d):
    key = F.col("o_orderkey")
    leaf = lambda c: F.struct(c.alias("raw"), c.alias("parsed"))
    policy = F.struct(leaf(F.lit("01/01/2026")).alias("effective_date"), leaf(F.when(key % 6 == 0, "2025-12-31").otherwise("2026-12-31")).alias("expiration_date"), leaf(F.when(key % 7 == 0, "ABCDE").otherwise(F.concat(F.lit("AB-1"), key))).alias("policy_number"))
    address = F.struct(leaf(F.when(key % 4 == 0, "Texas").otherwise("TX")).alias("state"), leaf(F.lit("12345-6789")).alias("postal_code"))
    rows = table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct(policy.alias("policy"), address.alias("mailing_address"))).alias("doc"))
    return checks.consistency_flags(rows, ["o_orderkey"], "doc")


@query("SELECT o_orderkey, list_filter([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_custkey % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL) AS problems FROM orders")
def row_problems(spark, d):
    told = checks.problems(table(spark, d, "orders"), {"large": F.col("o_totalprice") > 200000, "open": F.col("o_orderstatus") == "O", "even": F.col("o_custkey") % 2 == 0})
    return told.select("o_orderkey", "problems")


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) GROUP BY 1")
def documents_set_aside(spark, d):
    kept, _ = checks.set_aside(table(spark, d, "orders"), "o_custkey", F.col("o_totalprice") > 400000)
    return kept.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("WITH v AS (SELECT o_orderpriority AS kind, CASE o_orderkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'wrong_page' WHEN 2 THEN 'ok' ELSE 'skipped' END AS result FROM orders) SELECT kind, count(*) AS n, round(avg((result = 'ok')::INT), 4) AS found_rate FROM v WHERE result <> 'skipped' GROUP BY 1")
def found_rates(spark, d):
    key = F.col("o_orderkey") % 4
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("kind"), F.when(key.isin(0, 2), "ok").when(key == 1, "wrong_page").otherwise("skipped").alias("result"))
    return checks.found_rates(rows, ["kind"])


@query("SELECT c_nationkey, count(*) AS n, round((1.6448536269514722 + 0.8416212335729143) * stddev_samp(c_acctbal) / sqrt(count(*)), 4) AS drop FROM customer GROUP BY 1")
def detectable_drop(spark, d):
    return stats.minimum_detectable_drop(table(spark, d, "customer"), ["c_nationkey"], "c_acctbal").withColumn("drop", F.round("drop", 4))


@query(f"WITH {SCORED_SQL}, m AS (SELECT 'm' || (doc_id % 40) AS metric, avg(c) AS candidate, avg(quality) AS current FROM scored GROUP BY 1) SELECT metric, CASE WHEN candidate < 0.45 THEN 'below_floor' WHEN round(candidate - current, 6) <= -0.015 THEN 'inferior' ELSE 'passed' END AS verdict FROM m")
def gate_verdicts(spark, d):
    rows = scored(spark, d).groupBy(F.concat(F.lit("m"), (F.col("doc_id") % 40).cast("string")).alias("metric")).agg(F.avg("c").alias("candidate"), F.avg("quality").alias("current"))
    rows = rows.withColumns({"lower": F.lit(None).cast("double"), "upper": F.lit(None).cast("double")})
    return stats.gate(rows, {f"m{i}": 0.45 for i in range(40)}, {})


@query(f"WITH {SCORED_SQL}, f AS (SELECT toxic, min(c) + 0.2 AS threshold FROM scored GROUP BY 1) SELECT count(*) AS accepted, sum(1 - quality)::BIGINT AS errors, round(sum(1 - quality) / count(*), 6) AS rate FROM scored JOIN f USING (toxic) WHERE c >= threshold")
def accepted_errors(spark, d):
    rows = scored(spark, d)
    limits = rows.groupBy("toxic").agg((F.min("c") + 0.2).alias("threshold"))
    return met.accepted_errors(rows, limits, "toxic", "c", "quality").withColumn("rate", F.round("rate", 6))


@query("SELECT o_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS r, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def unheld_documents(spark, d):
    """Documents of an anti join, with what belongs to them."""
    orders = table(spark, d, "orders")
    left = lineage.not_in(orders, orders.where("o_orderstatus = 'P'"), ["o_orderkey"])
    return left.join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count("*").alias("n"))


@query("SELECT o_orderkey, coalesce(o_orderstatus, p) AS o_orderstatus FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0) FULL JOIN (SELECT o_orderkey, o_orderpriority AS p FROM orders WHERE o_orderkey % 2 = 0) USING (o_orderkey)")
def twin_filled(spark, d):
    orders = table(spark, d, "orders")
    left = orders.where("o_orderkey % 5 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    right = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderpriority").alias("o_orderstatus"))
    return merging.coalesced(left, right, ["o_orderkey"], ["o_orderstatus"])


@query("""WITH o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) SELECT o_orderkey, 'order.number' AS path, 'No. ' || o_orderkey AS raw, o_orderkey::VARCHAR AS parsed, '[]' AS pages FROM o""")
def envelope_rows(spark, d):
    return shapes.envelope_rows(orders_as_documents(spark, d), ["o_orderkey"], "expected")


@query("SELECT o_orderkey, 'tags' AS path FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT o_orderkey, 'order.state' FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def undeclared_keys(spark, d):
    schema = {"properties": {"order": {"properties": {"number": {}}}, "claims": {}}}
    return shapes.schema_conflicts(orders_as_documents(spark, d), ["o_orderkey"], "expected", schema)


@query("""WITH o AS (SELECT *, o_orderkey % 4 AS k FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) SELECT o_orderkey, 'order.number' AS path, CAST(NULL AS VARCHAR) AS stolen_from FROM o UNION ALL SELECT o_orderkey, 'order.state', NULL FROM o""")
def misattributions(spark, d):
    """Plain fields outside tables; none holds another's value here (hand-made cases are among the tests)."""
    return docs.misattributions(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got")


@query("SELECT item_id, CASE WHEN length(t) < 3 THEN 'unchecked' WHEN item_id % 3 = 0 THEN 'not_printed' WHEN item_id % 3 = 1 THEN 'on_cited_page' ELSE 'on_other_page' END AS status FROM (SELECT item_id, trim(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g')) AS t FROM benchmark)")
def grounded_items(spark, d):
    """Benchmark items against documents of two pages that hold them (or not, every third), cited rightly or on the other page."""
    items = table(spark, d, "benchmark").select("item_id", "text", F.when(F.col("item_id") % 3 == 1, F.array(F.lit(1))).otherwise(F.array(F.lit(2))).alias("cited"))
    own = F.when(F.col("item_id") % 3 == 0, F.lit("something else stands here")).otherwise(F.concat(F.lit("Before "), "text", F.lit(" after")))
    pages = items.select("item_id", own.alias("text"), F.lit(1).alias("page")).unionByName(items.select("item_id", F.lit("the second page").alias("text"), F.lit(2).alias("page")))
    return grounding.ground(items, pages, "item_id", "text", "cited").select("item_id", "status")


@query("WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1), w AS (SELECT conv_id, n, ceil(n / 3)::INT AS k, unnest(range(1, ceil(n / 3)::INT + 1)) AS i FROM n) SELECT conv_id, i::INT AS \"window\", (n // k + (i <= n % k)::INT)::INT AS pages FROM w")
def section_windows(spark, d):
    """A conversation's turns as pages, in windows of three at most."""
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").cast("int").alias("n"))
    rows = turns.select("conv_id", plan.section_plan(F.sequence(F.lit(1), F.col("n")), 3).alias("plan"))
    return plan.planned(rows, "plan").select("conv_id", "window", F.size("pages").alias("pages"))


@query("SELECT o_orderkey, h AS height, w AS width, (h // 32) * (w // 32) AS tokens FROM (SELECT o_orderkey, greatest(32, round_even((200 + o_orderkey % 700) / 32.0, 0) * 32)::INT AS h, greatest(32, round_even((100 + o_orderkey % 900) / 32.0, 0) * 32)::INT AS w FROM orders)")
def picture_tokens(spark, d):
    """Pictures between the least and the greatest area, so that only the rounding to whole steps acts."""
    h, w = 200 + F.col("o_orderkey") % 700, 100 + F.col("o_orderkey") % 900
    size = S.resized(h, w, 1024, 10_000_000)
    return table(spark, d, "orders").select("o_orderkey", size["height"].alias("height"), size["width"].alias("width"), S.image_tokens(h, w, 1024, 10_000_000).alias("tokens"))


@query("SELECT o_orderkey, len(list_distinct([o_orderstatus, o_orderpriority])) = 1 AS single, array_to_string(list_sort([lower(o_orderstatus), lower(o_orderpriority)]), '+') AS line FROM orders")
def line_keys(spark, d):
    lines = F.array("o_orderstatus", "o_orderpriority")
    return table(spark, d, "orders").select("o_orderkey", checks.single_line(F.array_distinct(lines)).isNotNull().alias("single"), checks.line_key(lines).alias("line"))


@query()
def group_splits(spark, d):
    """Families of sources and languages split by all rules at once; tested against a plain version."""
    key = F.col("doc_id")
    groups = table(spark, d, "documents").where("doc_id IS NOT NULL").groupBy((key % 5000).alias("g")).agg(F.count("*").alias("documents"), F.min("source").alias("line"), F.min("lang").alias("carrier"))
    rows = groups.select(F.lit("policy").alias("kind"), F.concat(F.lit("g"), F.col("g").cast("string")).alias("group_id"), "documents", "line", "carrier", (F.col("g") % 9 == 0).alias("synthetic"), (F.col("g") % 13 == 0).alias("pinned"))
    return fam.split_groups(rows).select("group_id", "split", "held_out", "val_half", "repaired")


@query()
def merged_claims(spark, d):
    """Order lines read twice in overlapping windows; tested by hand-made cases."""
    claim = F.to_json(F.struct(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("claim_number"), F.col("l_linestatus").alias("status"), F.col("l_quantity").alias("paid")))
    rows = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 2).alias("window"), F.col("l_partkey").alias("position"), claim.alias("claim"))
    return merging.merge_claims(rows, "l_orderkey", "window", "position", "claim").select("document", "place", "windows", "claim")


@query()
def logistic_fit(spark, d):
    """Quality by confidence and toxicity; tested against a plain version."""
    rows = scored(spark, d).select(F.lit("all").alias("kind"), "c", F.col("toxic").cast("double").alias("toxic"), (F.col("quality") == 1).alias("ok"))
    found = stats.fit_logistic(rows, "kind", ["c", "toxic"], "ok", least=50)
    return found.select("kind", "n", "enforced", F.round("positive", 6).alias("positive"), F.round("bias", 6).alias("bias"))


@query()
def near_families(spark, d):
    """Families by near-duplicate text; tested against a plain version."""
    return fam.assign_groups(table(spark, d, "documents").select("doc_id", "text")).groupBy("family").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query()
def aligned_results(spark, d):
    """All values, tables included, rows paired by what they hold; pairing is tested by hand-made cases."""
    found = docs.aligned_results(orders_as_documents(spark, d), ["o_orderkey"], "expected", "got")
    return met.field_accuracy(found.withColumn("field", S.canonical_field(F.col("path"))), ["field"])


@query()
def density_windows(spark, d):
    """Windows of documents by the length of their lines, as rows a page would be; tested by hand-made cases."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: (F.length(x) / 40).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", plan.density_plan(lines, 8192).alias("plan"))
    return plan.planned(rows, "plan").select("doc_id", "window", F.size("pages").alias("pages"))
