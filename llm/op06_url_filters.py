"""URL filters: prefix rules matched to urls by a sort-merge range join.

A host is written in reverse with a closing dot (``www.example.com`` is ``com.example.www.``),
so that a rule's host and all its subdomains are the one key interval from ``com.example.`` up
to ``com.example/`` ('/' follows '.'). Intervals are nested or disjoint. Each interval end
carries the stack of rules that are active after it; urls and ends are sorted together and each
url takes the stack of the last end before it. Its path then picks the longest fitting rule.

Urls are dealt out by a salt, never by host, and each salt sweeps over all rules, so a host with
a third of all urls is spread evenly; the cost is one copy of the rules per shuffle partition.

Defined cases: a null url, or one without '://', has an empty host and path and fits no rule;
A-Z in hosts are lower-cased; of rules with one host and path, block wins; rules with a null or
empty host fit nothing and a null path is empty; repeated urls and other columns are kept as they
are (an existing ``host``, ``path``, ``rule`` or ``verdict`` is replaced); no rules: the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.tables import others, shuffles, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "array<struct<path:string,size:int,verdict:string,rule:string>>"

#: The rules of the registered query.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def labels_of(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(labels_of(host), "."), F.lit("."))


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): every point of the key order where the active rules change."""
    rules = rules.where("host is not null and host <> ''").select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    own = rules.groupBy("host").agg(
        F.collect_set(
            F.struct("path", F.length(F.concat("host", "path")).alias("size"), "verdict", F.concat("host", "path").alias("rule"))
        ).alias("own")
    )
    own = own.select(key_of(F.col("host")).alias("key"), labels_of(F.col("host")).alias("labels"), "own")
    depth = F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("depth")
    outer = own.select("key", "labels", depth).select(
        F.col("key").alias("inner"), F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("depth")), "."), F.lit(".")).alias("key")
    )
    nested = outer.join(own.select("key", "own"), "key").groupBy("inner").agg(
        F.flatten(F.collect_list("own")).alias("within"),
        F.flatten(F.collect_list(F.when(F.col("key") != F.col("inner"), F.col("own")))).alias("outside"),
    )
    opens = nested.select(F.col("inner").alias("key"), F.col("within").alias("stack"))
    closes = nested.select(F.expr("concat(substr(inner, 1, length(inner) - 1), '/')").alias("key"), F.col("outside").alias("stack"))
    return opens.unionByName(closes).select("key", F.col("stack").cast(RULE).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, the longest fitting rule (null if none) and its verdict or the default."""
    salts = shuffles(pages.sparkSession)
    made = ["host", "path", "rule", "verdict"]
    kept = others(pages, made)
    u = F.col(url)
    points = pages.select(
        F.struct(*[F.col(c) for c in kept]).alias("page"),
        host_of(u).alias("host"),
        path_of(u).alias("path"),
        F.pmod(F.xxhash64(u, F.monotonically_increasing_id()), F.lit(salts)).alias("salt"),
    ).select("page", "host", "path", "salt", key_of(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast(RULE).alias("stack"))
    ends = boundaries(rules).select(
        F.lit(None).cast(points.schema["page"].dataType).alias("page"), F.lit("").alias("host"), F.lit("").alias("path"),
        F.expr(f"explode(sequence(0L, {salts - 1}L))").alias("salt"), "key", F.lit(0).alias("kind"), "stack",
    )
    sweep = Window.partitionBy("salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.unionByName(ends).withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fits = F.expr("array_max(transform(filter(active, r -> startswith(path, r.path)), r -> struct(r.size, r.verdict, r.rule)))")
    return swept.withColumn("best", fits).select(
        *[F.col("page").getField(c).alias(c) for c in kept],
        "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    hit = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    )
    verdict = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
hits AS (SELECT *, CASE {hit} ELSE NULL END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE rule {verdict} ELSE 'allow' END AS verdict FROM hits"""


ORACLE_SQL = _sql()
