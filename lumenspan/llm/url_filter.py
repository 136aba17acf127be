"""URL filters: host-suffix and path-prefix expressions on hashed rules.

Every URL is expanded into the expressions ``suffix + path prefix`` that a rule
could name: all label suffixes of its host times those prefixes of its path
whose length some rule has.  The expressions meet the rules in an equi-join on
the first four bytes of their SHA-256 digest; the full digest confirms, and the
longest rule (host and path together) decides.  The rules are a list of
bounded size; the join is a broadcast join only while they number at most
``BROADCAST_RULES``.

A popular host and path is one row of the smaller side of the join back, so
adaptive execution can split it.

Defined cases: a null URL or one without ``://`` has an empty host and path and
takes the default verdict; repeated pages are each judged; of equal rules with
different verdicts the block wins; further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as C

#: (host, path, verdict) of the production rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BROADCAST_RULES = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([tuple(x) for x in rules], "host string, path string, verdict string")


def expressions(host_: Column, path_: Column, lengths: Sequence[int]) -> Column:
    """All ``host suffix + path prefix`` strings with a path prefix of one of ``lengths``."""
    labels = F.split(host_, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ways = F.filter(F.array(*[F.lit(int(n)) for n in lengths]), lambda n: n <= F.length(path_))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(ways, lambda n: F.concat(s, F.substr(path_, F.lit(1), n)))))


def judge(pages: DataFrame, rules: DataFrame, *, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null where none fits) and verdict."""
    keep = [c for c in pages.columns if c not in {"host", "path", "rule", "verdict"}]
    base = pages.select(*keep, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    listed = (
        rules.where("host is not null and path is not null").groupBy(F.concat("host", "path").alias("_rule"), F.length("path").alias("_n")).agg(F.max("verdict").alias("_verdict"))
        .withColumn("_digest", F.sha2("_rule", 256)).withColumn("_prefix", F.substring("_digest", 1, 8))
    )
    shape = listed.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("_n")).alias("lengths")).first()
    # One row for each expression; the page's own columns stay behind and come back by a key of its URL parts.
    # Rows without a host can't meet a rule and are many in one key: they stay out of the join.
    bare = F.col("host") == ""
    parts = base.where(~bare).select("host", "path").distinct()
    met = parts.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), shape.lengths)).alias("_e"))
    met = met.withColumn("_full", F.sha2("_e", 256)).withColumn("_prefix", F.substring("_full", 1, 8))
    right = F.broadcast(listed) if shape.n <= BROADCAST_RULES else listed
    best = (
        met.join(right, "_prefix").where("_full = _digest").groupBy("host", "path")
        .agg(F.max(F.struct(F.length("_rule").alias("n"), F.col("_verdict").alias("verdict"), F.col("_rule").alias("rule"))).alias("_best"))
    )
    met = base.where(~bare).join(best, ["host", "path"], "left").select(*keep, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
    return met.unionByName(base.where(bare).select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")))


def query(spark, sf_dir: str) -> DataFrame:
    """``op6_url_filter``: every page's rule and verdict."""
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules_frame(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH p AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rh, rp, v) AS (VALUES ('org','/','allow'),('example.org','/es/','block'),('example.org','/en/1','block'),('com','/fr/','allow'),('com','/de/','block')),
m AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v FROM q JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT q.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM q LEFT JOIN m USING (page_id)
"""
