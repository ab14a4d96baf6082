"""Verdicts on urls by rules, carried over to aliases along redirects and canonical links.

A rule names a host and the beginning of a path; it fits the host, all its subdomains and every path that
begins so, and the longest rule that fits decides. Rules reach hosts by a join of each distinct host's own
and parent names, so lists of any length work and a busy host is one row.

A page that names another url as its canonical one, or refreshes to it, is the same thing by another name.
Distributed connected components over these links make classes of urls. A url without a rule of its own takes
its class's decision: allow if a url of the class is allowed by a rule, else block if one is blocked, else the
default. A url's own rule always stands.

Only DataFrame functions are used.

Defined results: a null url, or one without "://", has empty host and path, no rule and no aliases, and gets
the default. Links are read from a page's html (null: none), with or without quotes; several count all; a
target that is empty or has another scheme than http and https is left out. Urls are the same node if they
agree after lower-casing scheme and host and without the fragment. Repeated pages stay and share their verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.components import components
from wardline.llm.words import lower_ascii
from wardline.session import written

ALLOW, BLOCK = "allow", "block"

# The rules of the query over pages: (host, path, verdict).
RULES = [
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
]

# Scheme, host, path, query.
PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
LINK_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?is)^<link\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*\bcanonical\b)[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH = r"""(?is)^<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*['"]?([^"'>\s]+)"""


def _parts(frame: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """frame with the host, path and node of a url column; the node is null if there is no host."""
    scheme, host, path = f"{prefix}scheme", f"{prefix}host", f"{prefix}path"
    frame = frame.withColumns(
        {
            scheme: lower_ascii(F.regexp_extract(url, PARTS, 1)),
            host: F.coalesce(lower_ascii(F.regexp_extract(url, PARTS, 2)), F.lit("")),
            path: F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")),
        }
    )
    way = F.when(F.col(path) == "", "/").otherwise(F.col(path))
    name = F.concat(scheme, F.lit("://"), host, way, F.regexp_extract(url, PARTS, 4))
    known = (F.col(host) != "") & F.col(scheme).isin("http", "https")
    return frame.withColumn(f"{prefix}node", F.when(known, name)).drop(scheme)


def _resolved(frame: DataFrame, base: str, target: str) -> DataFrame:
    """frame with a column whole: a link's target as a url of its own, seen from the page at base."""
    frame = frame.withColumns(
        {
            "way": F.trim(F.replace(target, F.lit("&amp;"), F.lit("&"))),
            "origin": F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1),
            "folder": F.regexp_extract(base, r"(?s)^.*?://[^/?#]*(/[^?#]*/|/)?", 1),
        }
    )
    way = F.col("way")
    whole = (
        F.when(way == "", None)
        .when(way.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), way)
        .when(way.startswith("//"), F.concat(F.substring_index("origin", "//", 1), way))
        .when(way.startswith("/"), F.concat("origin", way))
        .otherwise(F.concat("origin", F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), way))
    )
    return frame.withColumn("whole", whole).drop("way", "origin", "folder")


def links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(a, b): nodes of pages and of the urls that they redirect to or call canonical."""
    told = pages.filter(F.col(html).rlike("(?i)canonical|http-equiv")).select(F.col(url).alias("url"), F.col(html).alias("html"))
    tags = told.select("url", F.explode(F.regexp_extract_all("html", F.lit(LINK_TAG), F.lit(0))).alias("tag"))
    named = F.concat(*[F.regexp_extract("tag", CANONICAL, k) for k in (1, 2, 3)], F.regexp_extract("tag", REFRESH, 1))
    ends = _parts(_parts(_resolved(tags.withColumn("target", named), "url", "target"), "url", "a_"), "whole", "b_")
    return written(ends.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "ends").dropna().distinct()


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    fields = ("rule_host", "rule_path", "action")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, rule, strict=True)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (with host and path) and the longest rule that fits: its text and action, null without any."""
    hosts = urls.select("host").distinct()
    labels = F.split("host", r"\.")
    parents = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    named = hosts.select("host", parents.alias("rule_host")).join(rules, "rule_host")
    own = F.struct("rule_path", F.concat("rule_host", "rule_path").alias("rule"), "action")
    of_host = named.groupBy("host").agg(F.collect_set(own).alias("rules"))
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r.getField("rule_path")))
    ranked = F.transform(fitting, lambda r: F.struct(F.length(r.getField("rule")), r.getField("rule"), r.getField("action")))
    best = F.array_max(ranked)
    joined = urls.join(of_host, "host", "left").withColumn("best", best)
    return joined.select(*urls.columns, F.col("best").getField("rule").alias("rule"), F.col("best").getField("action").alias("action"))


def judge(pages: DataFrame, id: str, url: str, html: str, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of pages."""
    seen = _parts(pages.select(F.col(id).alias("id"), F.col(url).alias("url")), "url").drop("url")
    classes = components(links(pages, url, html), "a", "b")
    members = _parts(classes.select(F.col("node").alias("url"), "root"), "url").drop("url")
    ruled = decide(members, rules).groupBy("root").agg(F.min("action").alias("decision"))  # allow comes before block
    shared = classes.join(ruled, "root").select("node", "decision")
    judged = decide(seen, rules).join(shared, "node", "left")
    return judged.select("id", "host", "path", "rule", F.coalesce("action", "decision", F.lit(default)).alias("verdict"))
