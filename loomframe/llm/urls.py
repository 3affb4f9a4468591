"""URL filters as a sort-merge range join on reversed-host keys.

A rule (host, path prefix) becomes the interval of keys that start with its reversed host
and path: ``net.example/en/`` up to the same with U+10FFFF behind. A URL is looked up at
each level of its host (``net``, ``net.example``, ...), as a key with its whole path. Per
level, interval borders and URL keys are sorted together and swept once: each border
carries the stack of rules that are active behind it, nested ones on top, and a URL key
takes over the stack of the last border before it. The longest rule over all levels wins.

Levels without a rule are never looked up. Levels with more than ``ROWS_EACH`` URLs are
swept in salted parts, each with its own copy of the level's few borders. Only DataFrame
functions are used. Null URLs have empty host and path, no rule, and the default verdict;
repeated rows are kept. Of rules with the same host and path, ``block`` counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomframe.llm.shared import only

ROWS_EACH = 4_000
DEFAULT = "allow"
#: Host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Above every character, so that a prefix with it behind ends the prefix's interval.
_ABOVE = "\U0010ffff"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) of a list written in the program."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _rest(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")),
                  F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _levels(host: Column) -> Column:
    """Reversed host and each of its parents' (``net``, ``net.example``, ...)."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host != "", F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), "."))) \
        .otherwise(F.array(F.lit("")))


def borders(rules: DataFrame) -> DataFrame:
    """level, key, edge, stack: what is active from each interval border on.

    ``edge`` puts ends before starts and starts before URLs of the same key. The rules that
    a rule lies in are found by its path's prefixes, so no rule meets all others.
    """
    each = only(rules, host="host", path="path", verdict="verdict").filter("host IS NOT NULL AND path IS NOT NULL") \
        .select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict") \
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict")) \
        .withColumn("level", reversed_host(F.col("host")))
    rule = F.struct(F.length("path").alias("depth"), F.concat("host", "path").alias("rule"), "verdict")
    outer = each.select("level", F.col("path").alias("prefix"), rule.alias("outer"))
    inner = each.select("level", "path", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda n: F.left(F.col("path"), n))).alias("prefix"))
    stacks = inner.join(outer, ["level", "prefix"]).groupBy("level", "path").agg(
        F.sort_array(F.collect_list("outer")).alias("stack"))
    start = stacks.select("level", F.col("path").alias("key"), F.lit(1).alias("edge"), F.lit(0).alias("nested"), "stack")
    end = stacks.select("level", F.concat("path", F.lit(_ABOVE)).alias("key"), F.lit(0).alias("edge"),
                        (-F.length("path")).alias("nested"), F.slice("stack", 1, F.size("stack") - 1).alias("stack"))
    return start.unionByName(end)


def judge(pages: DataFrame, rules: DataFrame | None = None, rows_each: int = ROWS_EACH,
          default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    spark = pages.sparkSession
    edges = borders(rule_table(spark, RULES) if rules is None else rules)
    distinct = only(pages, page_id="page_id", url="url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    split = distinct.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    probes = split.select("page_id", "url", F.col("path").alias("key"), F.explode(_levels(F.col("host"))).alias("level"))
    # Levels that have rules, with the number of parts their URLs are cut into.
    ruled = edges.select("level").distinct()
    parts = probes.join(ruled, "level", "left_semi").groupBy("level").agg(
        F.ceil(F.count(F.lit(1)) / rows_each).cast("int").alias("parts"))
    looked_up = probes.join(parts, "level").select(
        "level", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")).cast("int").alias("part"), "key",
        F.lit(2).alias("edge"), F.lit(0).alias("nested"), F.lit(None).cast(edges.schema["stack"].dataType).alias("stack"),
        "page_id", "url")
    copied = edges.join(parts, "level").select(
        "level", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "key", "edge", "nested", "stack",
        F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"))
    sweep = Window.partitionBy("level", "part").orderBy("key", "edge", "nested") \
        .rowsBetween(Window.unboundedPreceding, 0)
    active = F.last("stack", ignorenulls=True).over(sweep)
    found = looked_up.unionByName(copied).select("edge", "page_id", "url", active.alias("active")) \
        .filter((F.col("edge") == 2) & (F.size("active") > 0)) \
        .select("page_id", "url", F.element_at("active", -1).alias("top")) \
        .select("page_id", "url", F.struct(F.length("top.rule").alias("size"), "top.rule", "top.verdict").alias("best"))
    # One row per page and URL again, by the same grouping, then its copies.
    both = split.select("page_id", "url", "copies", F.lit(None).cast(found.schema["best"].dataType).alias("best")) \
        .unionByName(found.select("page_id", "url", F.lit(0).cast("long").alias("copies"), "best"))
    whole = both.groupBy("page_id", "url").agg(F.sum("copies").alias("copies"), F.max("best").alias("best"))
    return whole.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


#: The same in DuckDB.
SQL = r"""
WITH r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3)
    ELSE '' END AS rest FROM pages),
u AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
f AS (SELECT n, r.host || r.path AS rule, verdict, row_number() OVER (PARTITION BY n ORDER BY length(r.host || r.path) DESC,
    r.host || r.path DESC) AS o FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM f WHERE o = 1) USING (n)
"""
