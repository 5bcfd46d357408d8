"""URL filters: pattern rules indexed by their rarest literal token. Built-in functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """A rule of the method: block a URL that ``regex`` (Java syntax, searched in the lower-cased URL) matches.

    ``literals``: tokens (runs of a-z and 0-9) that stand in every URL which the
    expression matches, each delimited on both sides. At least one is needed.
    """

    name: str
    regex: str
    literals: tuple[str, ...]


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: The contract's host rules.
HOST_RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)

_EDGE = r"(?:^|[^a-z0-9])"
_END = r"(?:[^a-z0-9]|$)"

#: Advertising, tracking and sign-in addresses.
PATTERNS = (
    Pattern("ad_track_host", r"://(?:[^/?#]*\.)?ads-track\.", ("ads", "track")),
    Pattern("ad_server_host", r"://(?:[^/?#]*\.)?(?:ad|ads|adserver)\d*\.doubleclick\.", ("doubleclick",)),
    Pattern("banner_path", r"://[^/?#]+/(?:[^?#]*/)?banner/", ("banner",)),
    Pattern("pixel", r"/pixel\.(?:gif|png)" + _END, ("pixel",)),
    Pattern("login", r"://[^/?#]+/(?:[^?#]*/)?login" + _END, ("login",)),
    Pattern("cart", r"://[^/?#]+/(?:[^?#]*/)?cart/", ("cart",)),
    Pattern("casino", _EDGE + "casino" + _END, ("casino",)),
    Pattern("warez", _EDGE + "warez" + _END, ("warez",)),
    Pattern("mirror_list", r"/mirror/list" + _END, ("mirror", "list")),
    Pattern("session", r"[?&]sessionid=", ("sessionid",)),
)


def tokens(url: Column) -> Column:
    """Distinct runs of a-z and 0-9 of the lower-cased URL."""
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? # or the end. Null or no ://: both empty."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def host_verdict(host: Column, path: Column, rules: tuple[HostRule, ...] = HOST_RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits host and path; nulls if none does. Equal lengths: the first in name order."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.name)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def rule_index(spark: SparkSession, urls: DataFrame, patterns: tuple[Pattern, ...]) -> DataFrame:
    """One row a pattern: its literal that the fewest of all URLs hold (ties: first in order), its expression. Rules are few and given, not drawn from the data."""
    wanted = sorted({t for p in patterns for t in p.literals})
    for p in patterns:
        if not p.literals or any(not re.fullmatch("[a-z0-9]+", t) for t in p.literals):
            raise ValueError(f"{p.name}: literals must be tokens")
    holds = urls.select(tokens(F.col("_mr_url")).alias("t"))
    counts = holds.agg(*(F.sum(F.array_contains("t", t).cast("long")).alias(t) for t in wanted)).first().asDict()
    rows = ", ".join("('{}', '{}', '{}')".format(min(p.literals, key=lambda t: (counts[t] or 0, t)), p.name, p.regex.replace("\\", "\\\\").replace("'", "\\'")) for p in patterns)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(_mr_token, _mr_pattern, _mr_regex)")


def pattern_hits(urls: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS) -> DataFrame:
    """(_mr_url, pattern) of the distinct URLs that a pattern matches, the first in name order where several do.

    Equal URLs are merged before anything else, so the patterns see a URL on a
    third of the rows once. A URL's tokens fetch the rules indexed under them (a join with the
    rule table, which is as large as the rule list); only those run.
    """
    urls = urls.groupBy("_mr_url").agg(F.lit(1).alias("_mr_one")).where("_mr_url IS NOT NULL")
    index = F.broadcast(rule_index(urls.sparkSession, urls, patterns))
    candidates = urls.select("_mr_url", F.explode(tokens(F.col("_mr_url"))).alias("_mr_token")).join(index, "_mr_token")
    return candidates.where("lower(_mr_url) RLIKE _mr_regex").groupBy("_mr_url").agg(F.min("_mr_pattern").alias("pattern"))


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple[HostRule, ...] = HOST_RULES, patterns: tuple[Pattern, ...] = PATTERNS, shares: int = 64) -> DataFrame:
    """Add host, path, rule, pattern and verdict to ``pages``; own columns of these names are replaced.

    Host rules decide where one fits; elsewhere a URL is blocked if a pattern
    matches and allowed if none does. Null URLs have no host and are allowed.
    Repeated rows stay repeated; an empty table gives an empty result. Rows of
    one URL, or of none, meet the patterns' hits in ``shares`` places, and the
    few URLs that a pattern matches are repeated for that.
    """
    kept = pages.drop("host", "path", "rule", "pattern", "verdict")
    share = F.pmod(F.xxhash64(*kept.columns) + F.spark_partition_id(), F.lit(shares))
    kept = kept.withColumns({"_mr_url": F.col(url).cast("string"), "_mr_share": share})
    hits = pattern_hits(kept.select("_mr_url"), patterns).withColumn("_mr_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    host, path = host_and_path(F.col("_mr_url"))
    judged = kept.join(hits, ["_mr_url", "_mr_share"], "left").drop("_mr_share").withColumns({"host": host, "path": path})
    rule, verdict = host_verdict(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("pattern").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumns({"rule": rule, "verdict": F.coalesce(verdict, own)}).drop("_mr_url")


def op6_url_filters(spark, sf_dir: str) -> DataFrame:
    """All pages, judged by their URLs. Nulls, ties and repeated rows as in ``filter_urls`` and ``host_verdict``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _sql() -> str:
    fits = [f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}') THEN " for r in sorted(HOST_RULES, key=lambda r: (-len(r.name), r.name))]
    rule = " ".join(f + f"'{r.name}'" for f, r in zip(fits, sorted(HOST_RULES, key=lambda r: (-len(r.name), r.name)), strict=True))
    verdict = " ".join(f + f"'{r.verdict}'" for f, r in zip(fits, sorted(HOST_RULES, key=lambda r: (-len(r.name), r.name)), strict=True))
    pattern = " ".join(f"WHEN regexp_matches(lower(url), '{p.regex}') THEN '{p.name}'" for p in sorted(PATTERNS, key=lambda p: p.name))
    return f"""WITH rests AS (SELECT page_id, url, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    judged AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS told, CASE {pattern} END AS pattern FROM parts)
SELECT page_id, host, path, rule, coalesce(told, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern FROM judged"""


OP6_SQL = _sql()
