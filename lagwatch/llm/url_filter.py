"""URL filter with redirect equivalence; DataFrame functions only.

A page is linked to the URL that its canonical link or its refresh redirect names. Pages and
targets that links connect are aliases (distributed connected components). Every URL is judged by the
longest rule that fits; a URL without rule takes its aliases' decision: block if one of them is
blocked by rule and none is allowed by rule, else allow. An explicit rule for the URL itself always
wins.

A resource is host, path and query; scheme and fragment do not matter. Nulls, and text without
``://``, have empty host and path, fit no rule, have no aliases and are allowed. A null html has no links.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import connected_components, stage

#: Rule lists are literal expressions; longer ones are refused rather than planned for minutes.
MOST_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Patterns for the links of a page, in Java's and RE2's common syntax.
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\x22']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\x22']?([^\x22'\s>]+)"
TARGET = r"(?is)\burl\s*=\s*[\x22']?([^\x22'\s>;]+)"

Rule = tuple[str, str, str]  # allow or block, host, path


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def resource_of(url: Column) -> Column:
    """Host, path and query; empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1), F.lit(""))
    return F.concat(host_of(url), rest)


def ordered(rules: Sequence[Rule]) -> list[Rule]:
    """Longest first; of equally long ones allow before block, then by text."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0], r[1], r[2]))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(ordered(rules)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def absolute(link: Column, url: Column) -> Column:
    """A link as absolute URL; null if it cannot be one."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link == "", F.lit(None))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between resources, from canonical links and refresh redirects."""
    url, html = F.col("url"), F.col("html")
    links = F.array(
        F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
        F.regexp_extract(F.regexp_extract(html, REFRESH, 0), TARGET, 1),
    )
    named = pages.filter(url.contains("://") & (html.rlike(CANONICAL) | html.rlike(REFRESH)))
    named = named.select("url", F.explode(links).alias("link")).filter("link != ''")
    edges = named.select(resource_of(url).alias("a"), resource_of(absolute(F.col("link"), url)).alias("b"))
    return edges.filter("a != b and b is not null and b != ''").distinct()


def judge(pages: DataFrame, rules: Sequence[Rule], name: str = "urls") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    edges = stage(link_edges(pages), f"{name}-edges")
    own = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    judged = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        own["rule"].alias("rule"), own["verdict"].alias("own"), resource_of(F.col("url")).alias("node"),
    )
    if edges.isEmpty():  # no page names another: no aliases
        return judged.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"))
    parts = connected_components(edges, f"{name}-components")
    # a resource has the form host + path + query: judge it as a URL again
    as_url = F.concat(F.lit("x://"), F.col("node"))
    ruled = parts.withColumn("v", rule_of(host_of(as_url), path_of(as_url), rules)["verdict"])
    spread = (
        ruled.groupBy("component")
        .agg(F.max(F.col("v") == "block").alias("blocked"), F.max(F.col("v") == "allow").alias("allowed"))
        .filter("blocked and not coalesce(allowed, false)")
    )
    blocked = stage(parts.join(spread, "component").select("node", F.lit("block").alias("spread")), f"{name}-blocked")
    return judged.join(blocked, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "spread", F.lit("allow")).alias("verdict")
    )
