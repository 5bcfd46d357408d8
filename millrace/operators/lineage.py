"""Index tables of runs and releases: lookups, newest promoted rows, chains of parents, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.tables import written


def runs(index: DataFrame, run_type: str | None = None, doc_type: str | None = None, scope: str | None = None, status: str | None = None, sweeps: bool = False) -> DataFrame:
    """Rows of the index by any of its columns; runs of a sweep only if asked for. No scope counts as unified."""
    found = index if sweeps else index.where(~F.coalesce(F.col("is_sweep_run"), F.lit(False)))
    for name, value in (("run_type", run_type), ("doc_type", doc_type), ("status", status)):
        found = found.where(F.col(name) == value) if value else found
    return found.where(F.coalesce("scope", F.lit("unified")) == scope) if scope else found


def latest(index: DataFrame, by: list[str], order: list[str], status: str = "promoted") -> DataFrame:
    """Per ``by`` the run_id of the newest row of that status."""
    return index.where(F.col("status") == status).groupBy(*by).agg(F.max_by("run_id", F.struct(*order)).alias("run_id"))


def tagged(index: DataFrame, tag: str) -> DataFrame:
    """The run that a tag means: its id, or its version; a promoted one first, then the newest."""
    hit = index.where((F.col("run_id") == tag) | (F.col("version") == tag))
    return hit.withColumn("_mr_r", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc(F.col("status") == "promoted"), F.desc("created_at"), "run_id"))).where("_mr_r = 1").drop("_mr_r")


def depending_on(index: DataFrame, base: str) -> DataFrame:
    return index.where(F.col("base_version") == base).orderBy("run_id")


def ancestors(index: DataFrame, run: str = "run_id", parent: str = "parent_run_id") -> DataFrame:
    """(run, ancestor, steps) of every run and each run its chain of parents leads to, itself included (0 steps); rings end.

    Chains double in length each round; every round's table is written.
    """
    edges = index.select(F.col(run).alias("run"), F.col(parent).alias("up")).where("up IS NOT NULL AND up <> run").distinct()
    reach = written(index.select(F.col(run).alias("run"), F.col(run).alias("ancestor"), F.lit(0).alias("steps")).distinct().union(edges.select("run", "up", F.lit(1))), "reach")
    n = reach.count()
    while True:
        further = reach.alias("a").join(reach.alias("b"), F.col("a.ancestor") == F.col("b.run")).select("a.run", "b.ancestor", (F.col("a.steps") + F.col("b.steps")).alias("steps"))
        reach = written(reach.union(further).groupBy("run", "ancestor").agg(F.min("steps").alias("steps")), "reach")
        m = reach.count()
        if m == n:
            return reach
        n = m


def trained_documents(index: DataFrame, corpus: DataFrame) -> DataFrame:
    """(run_id, source_id) of all documents that a run or one of its ancestors trained on; ``corpus``: run_id, source_id."""
    chain = ancestors(index)
    return chain.join(corpus.select(F.col("run_id").alias("ancestor"), "source_id"), "ancestor").select(F.col("run").alias("run_id"), "source_id").distinct()


def promoted(index: DataFrame, release: str, tenant: str) -> DataFrame:
    """The index after a release's promotion: it alone is promoted at its tenant, the one before is archived."""
    own = F.col("tenant_id") == tenant
    status = F.when(own & (F.col("release_id") == release), "promoted").when(own & (F.col("status") == "promoted"), "archived").otherwise(F.col("status"))
    return index.withColumn("status", status)


def versions(runs_index: DataFrame, releases: DataFrame) -> DataFrame:
    """A row per version: run and release side by side, either may be absent."""
    return runs_index.select("version", "run_id", F.col("status").alias("run_status")).join(releases.select("version", "release_id", F.col("status").alias("release_status")), "version", "full_outer")


def differences(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys``, column, before, after of every value that two tables hold differently; rows of one side alone differ in all their values."""
    long = lambda df, name: df.select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns))).alias("x")).select(*keys, "x.column", F.col("x.v").alias(name))
    both = long(a, "before").join(long(b, "after"), [*keys, "column"], "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def purge_plan(source: Column, tables: dict[str, DataFrame], column: str = "source_id") -> DataFrame:
    """table, rows: how many rows of each table were made from a document."""
    counts = [df.where(F.col(column) == source).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


def not_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other table does not hold: excluded documents, golds not read yet, leftovers."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def changed_golds(now: DataFrame, trained: DataFrame, key: str = "source_id", digest: str = "gold_sha256") -> DataFrame:
    """Documents whose label is not the one that was trained."""
    return now.join(trained.select(key, F.col(digest).alias("_mr_then")), key).where(F.col(digest) != F.col("_mr_then")).select(key)


def seen_carriers(rows: DataFrame, split: str = "split", carrier: str = "carrier") -> DataFrame:
    """``rows`` with carrier_seen: whether train holds the row's carrier; null without one."""
    trained = rows.where(F.col(split) == "train").select(F.col(carrier).alias("_mr_c")).where("_mr_c IS NOT NULL").distinct().withColumn("_mr_seen", F.lit(True))
    joined = rows.drop("carrier_seen").join(trained, F.col(carrier) == F.col("_mr_c"), "left")
    return joined.withColumn("carrier_seen", F.when(F.col(carrier).isNotNull(), F.coalesce("_mr_seen", F.lit(False)))).drop("_mr_c", "_mr_seen")
