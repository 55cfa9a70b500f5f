"""URL filter: host-suffix and path-prefix expressions, joined on short hash prefixes.

Each URL is expanded into its host suffixes (at label borders) times the path prefixes of the lengths
that rules have; an equi-join on the first bytes of the expression's SHA-256 finds candidates, the
full digest confirms them, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.session import local_frame

from . import common as C

# The rules (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SCHEMA = "verdict string, host string, path string"
PREFIX_BYTES = 4


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return local_frame(spark, rules, SCHEMA)


def parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; null or without ``://``: both empty."""
    u, (rest, head) = f"`{url_col}`", C.fresh(df, "rest", "head")
    d = df.withColumn(rest, F.expr(f"CASE WHEN instr({u}, '://') > 0 THEN substring({u}, instr({u}, '://') + 3) ELSE '' END"))
    d = d.withColumn(head, F.expr(rf"regexp_extract(`{rest}`, '^[^/?#]*', 0)"))
    d = d.withColumn("path", F.expr(rf"regexp_extract(substring(`{rest}`, char_length(`{head}`) + 1), '^[^?#]*', 0)"))
    return d.withColumn("host", F.expr(C.lower_az(f"`{head}`"))).drop(rest, head)


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` plus ``host``, ``path``, ``rule`` (host and path of the rule that decides, else null) and
    ``verdict`` (the rule's, else ``default``).

    A rule fits its host and all its subdomains if the path starts with the rule's.  Precedence: the longest rule,
    then the longer host, then block before allow.  Rules with a null field are left out, an empty rule
    host fits nothing; repeated rules and rows are harmless; empty tables give empty or default results.
    Distinct URLs are judged once and joined back.  Columns ``host``, ``path``, ``rule`` and ``verdict`` of ``urls`` are replaced.
    """
    r = (rules.where("verdict IS NOT NULL AND host != '' AND path IS NOT NULL")
         .select("verdict", F.expr(C.lower_az("host")).alias("host"), "path").distinct()
         .select("verdict", F.expr("concat(host, path)").alias("rule"), F.expr("char_length(host)").alias("hlen"),
                 F.expr("char_length(path)").alias("plen"), F.expr("sha2(concat(host, ' ', path), 256)").alias("digest")))
    r = C.written(r, "url-rules")
    lengths = [x.plen for x in r.select("plen").distinct().collect()]  # one integer per distinct path length of the rules
    row = F.struct(*[F.col(f"`{c}`") for c in urls.columns])  # goes along whole, so that no inner name can meet one of its columns
    base = parts(urls.select(row.alias("row"), F.col(f"`{url_col}`").alias("url")))
    each = base.select("host", "path").where("host != ''").distinct()
    arr = "array({})".format(", ".join(map(str, lengths))) if lengths else "cast(array() as array<int>)"
    exprs = (each.select("host", "path", F.expr("split(host, '[.]')").alias("labels"))
             .select("host", "path", F.expr("explode(transform(labels, (x, i) -> array_join(slice(labels, i + 1, size(labels)), '.')))").alias("suffix"))
             .select("host", "path", "suffix", F.expr(f"explode(filter({arr}, n -> n <= char_length(path)))").alias("n"))
             .select("host", "path", F.expr("sha2(concat(suffix, ' ', substring(path, 1, n)), 256)").alias("full")))
    short = f"substring({{}}, 1, {2 * PREFIX_BYTES})"
    hit = (exprs.withColumn("short", F.expr(short.format("full")))
           .join(C.small_side(r.withColumn("short", F.expr(short.format("digest")))), "short").where("full = digest"))
    best = (hit.groupBy("host", "path").agg(F.expr(
        "max_by(struct(rule, verdict), struct(char_length(rule), hlen, verdict = 'block', rule))").alias("best")))
    return (base.join(best, ["host", "path"], "left").select(
        *[F.col(f"row.`{c}`") for c in urls.columns if c not in ("host", "path", "rule", "verdict")], "host", "path",
        F.expr("best.rule").alias("rule"), F.expr(f"coalesce(best.verdict, '{default}')").alias("verdict")))
