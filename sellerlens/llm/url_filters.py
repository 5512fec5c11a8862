"""URL filters with redirect equivalence.

Rules (host, path prefix, verdict) judge a url by its longest fitting rule. A
page without one asks its aliases: urls joined by redirects or canonical links
form connected components, and a block on any url of a component holds for all
of its members that have no rule, unless an explicit allow in the component
takes precedence. Pages that nothing judges are allowed.

Edges between urls: ``<link rel=canonical>`` and ``<meta http-equiv=refresh>``
in the html, and the usual permanent redirects (https, bare host instead of
www. or m., no fragment, no tracking parameters, no trailing slash, index page
or .html ending).

Judging works on distinct urls; rules meet urls by an equi-join on each host
suffix, so large rule tables need no broadcast. Components come from
large-star/small-star steps, which pre-aggregate hubs.

Cases: a null url, or one without ``://``, has an empty host and path, no rule
and no alias, and is allowed; null html gives no link; repeated rows are
judged alike; an empty table gives an empty result; columns besides (page_id,
url, html) are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm.common import connected_components, materialise

# The rule list that the query is asked to apply, as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
TRACKING = "utm_[a-z]+|ref|gclid|fbclid|mc_eid|igshid"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def redirected(url: Column) -> Column:
    """Where the usual permanent redirects lead."""
    query = F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{TRACKING})(?:=|$)"))
    host = F.regexp_replace(host_of(url), "^(?:www|m)\\.(?=[^.]+\\.)", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(path_of(url), "/index\\.html?$", "/"), "\\.html?$", ""), "/+$", "")
    return F.concat(F.lit("https://"), host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, f"(?is)\\b{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)')", 0)
    value = F.regexp_replace(quoted, "(?is)^[^\"']*[\"']|[\"']$", "")
    bare = F.regexp_extract(tag, f"(?is)\\b{name}\\s*=\\s*([^\\s\"'>]+)", 1)
    return F.trim(F.replace(F.when(quoted != "", value).otherwise(bare), F.lit("&amp;"), F.lit("&")))


def html_targets(html: Column) -> Column:
    """Raw targets of canonical links and meta refreshes."""
    canonical = F.regexp_extract_all(html, F.lit("(?is)<link\\b[^>]*\\brel\\s*=\\s*[\"']?canonical\\b[^>]*>"), F.lit(0))
    refresh = F.regexp_extract_all(html, F.lit("(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b[^>]*>"), F.lit(0))
    of_refresh = F.transform(refresh, lambda t: F.regexp_extract(_attribute(t, "content"), "(?is)url\\s*=\\s*[\"']?([^\"']*)", 1))
    found = F.concat(F.transform(canonical, lambda t: _attribute(t, "href")), of_refresh)
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda t: t != "")


def resolved(base: Column, target: Column) -> Column:
    """``target`` as an absolute url seen from ``base``; null if it is none."""
    scheme = F.regexp_extract(base, "^([^:/?#]+)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:|^#"), F.lit(None))
        .otherwise(F.concat(site, F.regexp_replace(path_of(base), "[^/]*$", ""), F.when(path_of(base) == "", "/").otherwise(""), target))
    )


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, rule_verdict) of the distinct ``url`` values that a rule fits; the longest wins."""
    u = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", "\\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    u = u.where("host <> ''").select("url", "path", F.explode(suffix).alias("rule_host"))
    fits = u.join(rules, "rule_host").where(F.expr("startswith(path, rule_path)"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), (F.col("rule_verdict") == "allow").alias("a"),
                          rule.alias("rule"), F.col("rule_verdict").alias("v")))
    return fits.groupBy("url").agg(best.alias("b")).select("url", "b.rule", F.col("b.v").alias("rule_verdict"))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): urls that redirect to or declare each other, loops left out."""
    p = pages.where("instr(url, '://') > 0")
    site = redirected(F.col("url"))
    own = p.select(F.col("url").alias("a"), site.alias("b"))
    declared = p.select("url", F.explode(html_targets(F.col("html"))).alias("t")).select(
        F.col("url").alias("a"), resolved(F.col("url"), F.col("t")).alias("b")).where("instr(b, '://') > 0")
    onward = declared.select(F.col("b").alias("a"), redirected(F.col("b")).alias("b"))
    return own.unionByName(declared).unionByName(onward).where("a <> b").distinct()


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Per page: page_id, url, host, path, rule, verdict, decided_by (rule, alias or default), component."""
    p = pages.select("page_id", "url", "html")
    edges = materialise(alias_edges(p))
    comps = materialise(connected_components(edges).withColumnsRenamed({"node": "url"}))
    urls = p.select("url").where("url IS NOT NULL").unionByName(comps.select("url")).distinct()
    judged = materialise(judge(urls, rules))
    said = (
        comps.join(judged, "url").groupBy("component")
        .agg(F.max(F.col("rule_verdict") == "allow").alias("allows"), F.max(F.col("rule_verdict") == "block").alias("blocks"))
    )
    of_url = comps.join(said, "component", "left").select("url", "component", "allows", "blocks")
    out = p.select("page_id", "url").join(judged, "url", "left").join(of_url, "url", "left")
    alias = F.when(F.col("blocks") & ~F.col("allows"), "block").when(F.col("allows"), "allow")
    return out.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("rule_verdict", alias, F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").when(alias.isNotNull(), "alias").otherwise("default").alias("decided_by"),
        "component",
    )
