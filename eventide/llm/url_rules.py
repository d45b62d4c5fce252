"""URL filter: a sort-merge range join of urls with nested host rules.

A host's canonical key is its labels in reverse, each closed by ``\\x01``
(``www.example.com`` -> ``com|example|www|``). All hosts below a rule's host
are then exactly the keys in one interval: from the rule's key to the same key
with its last byte raised by one. Any two such intervals are nested or
apart, so a sweep along the sorted keys keeps a stack: an interval's start
pushes the rules of its host, its end pops them. The stack after each bound is
stored with the bound; urls and bounds are sorted together, and a url takes
the stack of the last bound before it. From that stack the rules whose path
the url's path starts with are kept, the longest wins.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import stored, table

#: Fixed rules of the registered query: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
STACK = "array<struct<h:int,p:int,host:string,path:string,verdict:string>>"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
            for h, p, v in rules]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    return spark.range(1).select(F.inline(F.array(*rows)))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "\x01"), F.lit("\x01"))


def bounds(rules: DataFrame) -> DataFrame:
    """Start and end of every rule host's interval, with the stack after it:
    all rules of the host and of its ancestors, without the host's own after
    the end. The longest come first; equal rules go by verdict, ``allow``
    first."""
    rules = rules.select("host", "path", "verdict").dropna().distinct()
    hosts = rules.select(F.col("host").alias("at")).distinct().withColumn("labels", F.split("at", r"\.", -1))
    above = hosts.select("at", F.explode(F.expr(
        "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")).alias("host"))
    stacks = (above.join(rules, "host").groupBy("at").agg(F.sort_array(F.collect_list(F.struct(
        (-F.length("host")).alias("h"), (-F.length("path")).alias("p"), "host", "path", "verdict"))).alias("stack"))
        .withColumn("key", host_key(F.col("at"))))
    start = stacks.select("key", "stack")
    end = stacks.select(F.expr("concat(substring(key, 1, length(key) - 1), '\x02')").alias("key"),
                        F.expr("filter(stack, r -> r.host <> at)").alias("stack"))
    return start.unionByName(end).select("key", F.col("stack").cast(STACK).alias("stack"))


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``urls``.

    A rule fits its host and all hosts below it when the url's path starts
    with the rule's path; of those that fit, the longest host, then the longest
    path wins. Without a fitting rule ``rule`` is null and the verdict is
    ``default``. A null url or one without ``://`` has an empty host and path,
    which no rule with a host fits. Repeated rows are judged each; other columns
    of ``urls`` are not read. Rules with a null field are ignored. Hot hosts
    are split: rows are dealt by ranges of (key, row hash). A stack holds the
    rules on one chain of hosts, so it grows with the rule list, not the urls.
    """
    rows = (urls.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
            .select("_id", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path")))
    rows = rows.select("_id", "host", "path", host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
                       F.xxhash64("_id", "path").alias("salt"), F.lit(None).cast(STACK).alias("stack"))
    marks = bounds(rules).select(
        F.lit(None).cast(rows.schema["_id"].dataType).alias("_id"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), "key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("salt"), "stack")
    dealt = rows.unionByName(marks).repartitionByRange("key", "kind", "salt").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt)
    # one row per range: the stack that the ranges before it leave behind
    carry = dealt.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("left"))
    carry = carry.select("part", F.last("left", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
    active = swept.join(carry, "part", "left").withColumn("active", F.coalesce("active", "carry"))
    best = active.withColumn("best", F.expr(
        "get(filter(active, r -> (host = r.host or endswith(host, concat('.', r.host))) and startswith(path, r.path)), 0)"))
    return best.select(F.col("_id").alias(id_col), "host", "path",
                       F.concat(F.col("best.host"), F.col("best.path")).alias("rule"),
                       F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))


OP9_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT p.*, rhost, rpath, rverdict,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) AS k
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1
"""
