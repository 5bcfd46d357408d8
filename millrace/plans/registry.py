"""Queries of the engine and their SQL, by name. Every query runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import families as fam
from millrace.operators import metrics as met
from millrace.operators import sequences as seq
from millrace.operators import statistics as stats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(make):
        QUERIES[make.__name__] = make
        if sql:
            ORACLES[make.__name__] = sql
        return make

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sql(value: str, salt: str = "") -> str:
    return f"(('0x' || substr(sha256('42:{salt}:' || {value}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


FAMILY_SQL = "families AS (SELECT *, 'grp-' || substr(sha256((min(doc_id) OVER (PARTITION BY coalesce(sha256(text), 'id:' || doc_id)))::VARCHAR), 1, 12) AS family FROM documents)"
SPLIT_SQL = f"""{FAMILY_SQL}, hashed AS (SELECT *, {hash_sql("family")} AS h, (SELECT count(*) FROM documents) AS total FROM families),
    splits AS (SELECT *, CASE WHEN h < (CASE WHEN total < 200 THEN 0.7 WHEN total < 1000 THEN 0.75 ELSE 0.8 END) THEN 'train'
                              WHEN h < (CASE WHEN total < 200 THEN 0.88 ELSE 0.9 END) THEN 'val' ELSE 'test' END AS split FROM hashed)"""


@query(f"WITH {SPLIT_SQL} SELECT lang, split, count(*) AS documents, count(DISTINCT family) AS families FROM splits GROUP BY ALL")
def split_counts(spark, d):
    split = fam.split_families(table(spark, d, "documents"))
    return split.groupBy("lang", "split").agg(F.count("*").alias("documents"), F.count_distinct("family").alias("families"))


@query("SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    return docs.groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query(f"WITH {FAMILY_SQL} SELECT family, count(*) AS n FROM families GROUP BY 1 ORDER BY n DESC, family LIMIT 10")
def largest_families(spark, d):
    return fam.exact_families(table(spark, d, "documents")).groupBy("family").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "family").limit(10)


@query(f"WITH {SPLIT_SQL}, plain AS (SELECT sha256(text) AS digest, CASE WHEN {hash_sql('doc_id')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM documents) SELECT digest, count(DISTINCT split) AS splits, count(*) AS n FROM plain GROUP BY 1 HAVING count(DISTINCT split) > 1")
def leakage_check(spark, d):
    """Leaks of a split by document instead of by family."""
    docs = table(spark, d, "documents")
    split = F.when(S.stable_hash(F.col("doc_id")) < 0.8, "train").otherwise("test")
    return fam.leakage(docs.select(F.sha2("text", 256).alias("digest"), split.alias("split")), "digest")


@query(f"WITH {SPLIT_SQL} SELECT family, count(DISTINCT split) AS splits, count(*) AS n FROM splits GROUP BY 1 HAVING count(DISTINCT split) > 1")
def family_leakage(spark, d):
    return fam.leakage(fam.split_families(table(spark, d, "documents")), "family")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def eval_exclusion(spark, d):
    held = table(spark, d, "labels").where("quality = 0").select("doc_id")
    return table(spark, d, "documents").select("doc_id", "lang").join(held, "doc_id", "left_anti")


@query("""WITH w AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(replace(replace(text, 'ẞ', 'ss'), 'ß', 'ss')), '[^0-9a-z]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, len(ws)::INT AS words, CASE WHEN len(ws) >= 5 THEN len(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4]))) ELSE least(len(ws), 1) END::INT AS shingles FROM w""")
def shingle_counts(spark, d):
    words = table(spark, d, "documents").select("doc_id", S.folded_words(F.col("text")).alias("ws"))
    return words.select("doc_id", F.size("ws").alias("words"), F.size(S.word_shingles(F.col("ws"), 5)).alias("shingles"))


def draw_sql(value: str, epoch: str) -> str:
    return f"(('0x' || substr(sha256('42:' || {epoch} || ':' || {value}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


@query(f"WITH e AS (SELECT doc_id, unnest(range(1, 5)) AS epoch FROM documents), h AS (SELECT epoch, {draw_sql('doc_id', 'epoch')} AS h FROM e), m AS (SELECT epoch, CASE WHEN h < 0.5 THEN 'text' WHEN h < 0.7 THEN 'image' ELSE 'both' END AS mode FROM h) SELECT epoch::INT AS epoch, mode, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY epoch), 6) AS share FROM m GROUP BY epoch, mode")
def mode_mix(spark, d):
    counts = fam.modes(table(spark, d, "documents").select("doc_id")).groupBy("epoch", "mode").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("epoch")), 6))


def raw_sql(value: str, salt: str) -> str:
    return f"('0x' || substr(sha256('42:{salt}:' || {value}), 1, 16))::UBIGINT"


@query(f"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {raw_sql('doc_id', 'twin-cap')}, doc_id) AS rank FROM documents) WHERE rank <= 20")
def twin_cap(spark, d):
    return fam.cap_twins(table(spark, d, "documents").select("source", "doc_id"), "source")


@query(f"WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {raw_sql("source || ':' || doc_id", 'data_mix:twin_rotation')}, doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents), e AS (SELECT *, unnest(range(1, 5)) AS epoch FROM r) SELECT source, epoch::INT AS epoch, doc_id FROM e WHERE ((r - (epoch - 1) * least(2, n)) % n + n) % n < least(2, n)")
def twin_rotation(spark, d):
    return fam.rotation(table(spark, d, "documents").select("source", "doc_id"), "source").select("source", "epoch", "doc_id")


REHEARSAL_SQL = f"""WITH old AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY {raw_sql('doc_id', 'data_mix:rehearsal')}, doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang, source) AS n, count(*) OVER (PARTITION BY lang) AS total FROM documents WHERE doc_id % 4 <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY (i + {hash_sql('source', 'data_mix:rehearsal_carrier')}) / n, {raw_sql('source', 'data_mix:rehearsal_carrier')}, doc_id) - 1 AS p, least(total, greatest(1, floor(0.3 * total + 0.5)))::BIGINT AS k FROM old),
e AS (SELECT *, unnest(range(1, 5)) AS epoch FROM placed)
SELECT doc_id, epoch::INT AS epoch FROM e WHERE ((p - (epoch - 1) * k) % total + total) % total < k UNION ALL SELECT doc_id, unnest(range(1, 5))::INT FROM documents WHERE doc_id % 4 = 0"""


@query(REHEARSAL_SQL)
def rehearsal_rotation(spark, d):
    """New documents (every fourth here) and a third of the old ones a turn, by language, sources spread evenly."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return fam.rehearsal(docs, "lang", "source", F.col("doc_id") % 4 != 0, 0.3).select("doc_id", "epoch")


@query("""WITH s AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), t AS (SELECT *, n * 200 / (SELECT count(*) FROM documents) AS share FROM s),
q AS (SELECT *, greatest(1, floor(share))::BIGINT AS f, share - floor(share) AS part FROM t), p AS (SELECT *, 200 - sum(f) OVER () AS spare, sum((f < n)::INT) OVER (ORDER BY part DESC, lang, source ROWS UNBOUNDED PRECEDING) AS place FROM q),
e AS (SELECT lang, source, f + (f < n AND place <= spare)::BIGINT AS quota FROM p),
r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY sha256(doc_id::VARCHAR), doc_id) AS rank FROM documents)
SELECT doc_id, lang, source FROM r JOIN e USING (lang, source) WHERE rank <= quota OR (SELECT count(*) FROM documents) <= 200""")
def stratified_sample(spark, d):
    return fam.stratified_sample(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source"], 200).select("doc_id", "lang", "source")


@query("WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), t AS (SELECT *, least(400, max(n) OVER ()) AS target FROM n), r AS (SELECT lang, n, CASE WHEN n >= target THEN 1 ELSE least(8, ceil(target / n)) END::INT AS repeats FROM t) SELECT lang, n, repeats, n * repeats::BIGINT AS rows FROM r")
def row_repeat_balance(spark, d):
    docs = table(spark, d, "documents").select("lang", "doc_id")
    copies = fam.repeats_to_target(docs, "lang", 400).groupBy("lang").agg(F.count("*").alias("rows"))
    return fam.line_repeats(docs, "lang", 400).join(copies, "lang")


@query("WITH v AS (SELECT doc_id, unnest([lang, source]) AS value FROM documents), n AS (SELECT value, count(DISTINCT doc_id) AS documents FROM v GROUP BY 1) SELECT value, documents, round(documents / (SELECT count(*) FROM documents), 6) AS share, documents / (SELECT count(*) FROM documents) < least(0.2, 0.75 / (SELECT count(*) FROM n)) AS under FROM n")
def line_coverage(spark, d):
    docs = table(spark, d, "documents")
    counts = docs.select("doc_id", F.explode(F.array("lang", "source")).alias("value")).groupBy("value").agg(F.count_distinct("doc_id").alias("documents"))
    facts = counts.agg(F.count("*").alias("_values")).crossJoin(docs.agg(F.count("*").alias("_all")))  # one row each
    share = F.col("documents") / F.col("_all")
    return counts.crossJoin(F.broadcast(facts)).select("value", "documents", F.round(share, 6).alias("share"), (share < F.least(F.lit(0.2), 0.75 / F.col("_values"))).alias("under"))


@query(f"WITH {SPLIT_SQL} SELECT split, lang, source, count(*) AS n, count(*) FILTER (WHERE length(trim(text)) = 0) AS empty, round(avg(n_chars), 4) AS mean_chars FROM splits GROUP BY split, lang, source")
def target_stats(spark, d):
    docs = table(spark, d, "documents").withColumn("empty", F.length(F.trim("text")) == 0)  # before the join of families, so that no text travels
    split = fam.split_families(docs)
    return split.groupBy("split", "lang", "source").agg(F.count("*").alias("n"), F.count_if("empty").alias("empty"), F.round(F.avg("n_chars"), 4).alias("mean_chars"))


TOKENS_SQL = "(CASE WHEN length(coalesce(text, '')) = 0 THEN 0 ELSE length(regexp_replace(text, '\\P{Nd}+', '', 'g')) + floor((length(text) - length(regexp_replace(text, '\\P{Nd}+', '', 'g'))) / 3.5)::BIGINT + 1 END)"


@query(f"SELECT doc_id, {TOKENS_SQL}::BIGINT AS tokens, ceil({TOKENS_SQL} * 1.25)::BIGINT AS answer, CASE WHEN ceil({TOKENS_SQL} * 1.25) > 8192 THEN 'answer' WHEN {TOKENS_SQL} > 32768 THEN 'total' ELSE 'fits' END AS verdict FROM documents")
def cap_check(spark, d):
    text = F.col("text")
    tokens, answer = S.text_tokens(text).cast("long"), S.answer_tokens(text).cast("long")
    return table(spark, d, "documents").select("doc_id", tokens.alias("tokens"), answer.alias("answer"), F.when(answer > 8192, "answer").when(tokens > 32768, "total").otherwise("fits").alias("verdict"))


@query("WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS summed FROM lineitem GROUP BY 1) SELECT CASE WHEN o_totalprice IS NULL OR summed IS NULL THEN 'unverifiable' WHEN abs(o_totalprice - summed) <= 0.51 THEN 'reconciled' ELSE 'mismatch' END AS status, count(*) AS n FROM orders FULL JOIN s ON o_orderkey = l_orderkey GROUP BY 1")
def reconcile_totals(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "key")
    totals = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), "o_totalprice")
    return met.reconcile(lines, totals, "key", "l_extendedprice", "o_totalprice").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS r FROM lineitem) WHERE r = 1")
def claim_dedup(spark, d):
    rows = seq.fullest(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("WITH a AS (SELECT l_partkey, l_suppkey, count(*) AS e FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), b AS (SELECT l_partkey, l_suppkey, count(*) AS g FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), j AS (SELECT coalesce(e, 0) AS e, coalesce(g, 0) AS g FROM a FULL JOIN b USING (l_partkey, l_suppkey)) SELECT sum(e)::BIGINT AS expected, sum(g)::BIGINT AS got, sum(least(e, g))::BIGINT AS matched, round(2 * sum(least(e, g)) / (sum(e) + sum(g)), 6) AS f1 FROM j")
def row_match(spark, d):
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    both = met.bag_match(lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'"), ["l_partkey", "l_suppkey"])
    return both.agg(F.sum("expected").alias("expected"), F.sum("got").alias("got"), F.sum("matched").alias("matched"), F.round(2 * F.sum("matched") / (F.sum("expected") + F.sum("got")), 6).alias("f1"))


SCORED_SQL = f"scored AS (SELECT doc_id, quality, toxic, {hash_sql('doc_id', 'confidence')} AS c FROM labels)"


def scored(spark, d):
    return table(spark, d, "labels").withColumn("c", S.stable_hash(F.col("doc_id"), salt="confidence"))


@query(f"WITH {SCORED_SQL}, b AS (SELECT greatest(ceil(c * 10 - 1e-12)::INT - 1, 0) AS bin, c, quality FROM scored), g AS (SELECT bin, count(*) AS n, avg(c) AS mc, avg(quality) AS acc FROM b GROUP BY 1) SELECT round(sum(abs(mc - acc) * n) / sum(n), 6) AS ece, sum(n)::BIGINT AS n FROM g")
def ece(spark, d):
    return met.expected_calibration_error(scored(spark, d), "c", "quality").select(F.round("ece", 6).alias("ece"), "n")


@query(f"WITH {SCORED_SQL} SELECT greatest(ceil(c * 10 - 1e-12)::INT - 1, 0) AS bin, count(*) AS n, round(avg(c), 6) AS mean_confidence, round(avg(quality), 6) AS accuracy FROM scored GROUP BY 1")
def reliability_bins(spark, d):
    return met.reliability(scored(spark, d), "c", "quality").select("bin", "n", F.round("mean_confidence", 6).alias("mean_confidence"), F.round("accuracy", 6).alias("accuracy"))


@query(f"WITH {SCORED_SQL}, g AS (SELECT least(floor(c * 10), 9)::BIGINT AS bin, avg(quality) AS accuracy FROM scored GROUP BY 1) SELECT bin, round(accuracy, 6) AS accuracy, round(max(accuracy) OVER (ORDER BY bin), 6) AS fitted FROM g")
def isotonic(spark, d):
    return met.isotonic(scored(spark, d), "c", "quality").select("bin", F.round("accuracy", 6).alias("accuracy"), F.round("fitted", 6).alias("fitted"))


def wilson_sql(e: str, n: str) -> str:
    z = 1.959964
    return f"((({e}) / ({n})::DOUBLE + {z * z} / (2 * {n}) + {z} * sqrt(({e}) / ({n})::DOUBLE * (1 - ({e}) / ({n})::DOUBLE) / {n} + {z * z} / (4.0 * {n} * {n}))) / (1 + {z * z} / {n}))"


@query(f"WITH {SCORED_SQL}, g AS (SELECT toxic, t / 100.0::DOUBLE AS t, count(*) AS n, sum(1 - quality)::BIGINT AS errors FROM scored, range(50, 100) r(t) WHERE c >= t / 100.0::DOUBLE GROUP BY ALL), f AS (SELECT *, bool_and({wilson_sql('errors', 'n')} <= 0.45) OVER (PARTITION BY toxic ORDER BY t DESC) AS ok FROM g WHERE n >= 10 AND {wilson_sql('0', 'n')} <= 0.45) SELECT toxic, round(min(t), 2) AS threshold, arg_min(n, t) AS accepted, arg_min(errors, t) AS errors FROM f WHERE ok GROUP BY 1")
def threshold_scan(spark, d):
    found = met.thresholds(scored(spark, d), "toxic", "c", "quality", 0.45, least=10)
    return found.select("toxic", F.round("threshold", 2).alias("threshold"), "accepted", "errors")


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(spark, d):
    return table(spark, d, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, round(avg((quality <> toxic)::INT), 6) AS agreement FROM labels")
def annotator_agreement(spark, d):
    return table(spark, d, "labels").agg(F.count("*").alias("n"), F.round(F.avg((F.col("quality") != F.col("toxic")).cast("int")), 6).alias("agreement"))


@query("SELECT d.lang, count(*) AS documents, count(l.doc_id) AS labelled, count(*) FILTER (WHERE quality = 0) AS low, round(count(*) FILTER (WHERE quality = 0) / nullif(count(l.doc_id), 0), 6) AS low_rate, round(count(*) FILTER (WHERE toxic = 1) / nullif(count(l.doc_id), 0), 6) AS toxic_rate FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang")
def fault_rates(spark, d):
    both = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").withColumn("has", F.lit(1)), "doc_id", "left")
    n = F.nullif(F.count("has"), F.lit(0))
    return both.groupBy("lang").agg(F.count("*").alias("documents"), F.count("has").alias("labelled"), F.count_if(F.col("quality") == 0).alias("low"), F.round(F.count_if(F.col("quality") == 0) / n, 6).alias("low_rate"), F.round(F.count_if(F.col("toxic") == 1) / n, 6).alias("toxic_rate"))


@query("SELECT event_type, count(*) AS n, round(quantile_disc(value, 0.5), 6) AS median, round(quantile_disc(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def p95_by_type(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.expr("round(percentile_disc(0.5) WITHIN GROUP (ORDER BY value), 6)").alias("median"), F.expr("round(percentile_disc(0.95) WITHIN GROUP (ORDER BY value), 6)").alias("p95"))


@query("WITH w AS (SELECT lang, n_chars::DOUBLE AS y, (length(text) - length(replace(text, ' ', '')))::DOUBLE AS x FROM documents) SELECT lang, round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 3) AS intercept FROM w GROUP BY 1")
def least_squares(spark, d):
    w = table(spark, d, "documents").select("lang", F.col("n_chars").cast("double").alias("y"), (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double").alias("x"))
    return w.groupBy("lang").agg(F.round(F.regr_slope("y", "x"), 4).alias("slope"), F.round(F.regr_intercept("y", "x"), 3).alias("intercept"))


@query("WITH i AS (SELECT lang, doc_id, doc_id - row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS g FROM documents) SELECT lang, min(doc_id) AS first, max(doc_id) AS last, count(*) AS length FROM i GROUP BY lang, g")
def page_runs(spark, d):
    return seq.runs(table(spark, d, "documents"), "lang", "doc_id")


@query("WITH n AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS r FROM conversations), k AS (SELECT *, ceil(n / 3)::BIGINT AS k FROM n), s AS (SELECT *, n // k AS size, n % k AS more FROM k) SELECT conv_id, turn, (CASE WHEN r < more * (size + 1) THEN r // (size + 1) ELSE more + (r - more * (size + 1)) // size END + 1)::INT AS chunk FROM s")
def split_evenly(spark, d):
    return seq.split_evenly(table(spark, d, "conversations").select("conv_id", "turn"), "conv_id", "turn", 3)


@query("SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS answer, arg_min(text, turn) FILTER (WHERE role = 'user') AS question, count(DISTINCT text) FILTER (WHERE role = 'assistant') AS answer_values, count(DISTINCT text) FILTER (WHERE role = 'user') AS question_values FROM conversations GROUP BY 1")
def first_non_null_merge(spark, d):
    turns = table(spark, d, "conversations").withColumns({"answer": F.when(F.col("role") == "assistant", F.col("text")), "question": F.when(F.col("role") == "user", F.col("text"))})
    return seq.first_filled(turns, "conv_id", "turn", ["answer", "question"])


@query("WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS path FROM events) SELECT event_id, path, json_extract_string(props, '$.' || path) AS value FROM k")
def json_flatten(spark, d):
    flat = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("path", "value"))
    return flat


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[0-9A-Za-z]')))::INT AS word_lines, len(string_split(text, chr(10)))::INT AS lines FROM documents")
def word_lines_per_page(spark, d):
    lines = F.split("text", "\n")
    return table(spark, d, "documents").select("doc_id", F.size(F.filter(lines, lambda x: x.rlike("[0-9A-Za-z]"))).alias("word_lines"), F.size(lines).alias("lines"))


@query("SELECT doc_id, regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}') AS email, regexp_matches(text, '[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}') AS phone, regexp_matches(text, '[$][0-9]') AS amount FROM documents")
def pii_shapes(spark, d):
    text = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.rlike("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}").alias("email"), text.rlike("[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}").alias("phone"), text.rlike("[$][0-9]").alias("amount"))


@query(f"WITH {SCORED_SQL} SELECT doc_id, toxic, round(c, 9) AS confidence, row_number() OVER (ORDER BY toxic DESC, c, doc_id)::INT AS place FROM scored ORDER BY place LIMIT 50")
def review_queue(spark, d):
    """Flagged first, then the least confident; a report of 50."""
    top = scored(spark, d).orderBy(F.desc("toxic"), "c", "doc_id").limit(50)
    return top.select("doc_id", "toxic", F.round("c", 9).alias("confidence"), F.row_number().over(Window.partitionBy().orderBy(F.desc("toxic"), "c", "doc_id")).alias("place"))


@query("WITH a AS (SELECT o_custkey AS k, o_orderkey AS id, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_custkey AS k, o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 4 <> 0) SELECT coalesce(a.id, b.id) AS id, a.s AS old_status, b.s AS new_status FROM a FULL JOIN b USING (id) WHERE a.s IS DISTINCT FROM b.s")
def manifest_diff(spark, d):
    """Difference of two snapshots made of orders: rows gone, new or changed."""
    orders = table(spark, d, "orders")
    old = orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("old_status"))
    new = orders.where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("new_status"))
    return old.join(new, "id", "full_outer").where(~F.col("old_status").eqNullSafe(F.col("new_status")))


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderstatus = 'F') WHERE r = 1")
def latest_promoted(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return done.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query("""WITH t AS (SELECT c_mktsegment, c_name, (abs(c_acctbal) % 1000) / 1000 AS p FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY p, c_name) AS rank, count(*) OVER (PARTITION BY c_mktsegment) AS m FROM t),
l AS (SELECT *, 0.05 / (m - rank + 1) AS level, least(1.0, (m - rank + 1) * p) AS own FROM r),
w AS (SELECT *, max(own) OVER (PARTITION BY c_mktsegment ORDER BY rank) AS adjusted, first(CASE WHEN p > level THEN c_name END) OVER (PARTITION BY c_mktsegment ORDER BY rank) AS f FROM l),
x AS (SELECT c_mktsegment, min(rank) AS stop, arg_min(c_name, rank) AS name FROM l WHERE p > level GROUP BY 1)
SELECT w.c_mktsegment, c_name, round(p, 9) AS p, rank::INT AS rank, round(adjusted, 6) AS adjusted_p, coalesce(rank < stop, true) AS shown, CASE WHEN rank > stop THEN x.name END AS stopped_by FROM w LEFT JOIN x USING (c_mktsegment)""")
def holm_step_down(spark, d):
    tests = table(spark, d, "customer").select("c_mktsegment", "c_name", ((F.abs("c_acctbal") % 1000) / 1000).alias("p"))
    return stats.holm(tests, "c_mktsegment", "c_name", "p").select("c_mktsegment", "c_name", F.round("p", 9).alias("p"), "rank", F.round("adjusted_p", 6).alias("adjusted_p"), "shown", "stopped_by")


@query("SELECT value, upper(regexp_replace(value, '[^A-Za-z0-9]', '', 'g')) AS identifier, CASE WHEN regexp_full_match(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'date' WHEN regexp_full_match(value, '[A-Z0-9][A-Z0-9/ -]{4,}') THEN 'identifier' ELSE 'name' END AS shape, n FROM (SELECT unnest([o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey::VARCHAR]) AS value, count(*) AS n FROM orders GROUP BY 1)")
def value_shapes(spark, d):
    orders = table(spark, d, "orders")
    values = orders.select(F.explode(F.array("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey").cast("string"))).alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    return values.select("value", S.identifier(F.col("value")).alias("identifier"), S.value_shape(F.col("value")).alias("shape"), "n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from millrace.plans import corpus, evaluation, layout, reports, values  # noqa: F401  they add their queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)
