"""URL filters: block decisions spread over redirects and canonical links.

Rules are (host, path, verdict). A rule fits its host and all subdomains when the URL's
path starts with the rule's path; the longest fitting rule (host, then path) decides.
Pages that name one another as canonical page or redirect to one another are aliases: the
components of that graph. A URL without a rule of its own is blocked if a URL of its
component is blocked by a rule. An explicit allow rule always wins for the URL it fits.

Links are read as a browser would: not from comments, with ``&amp;`` as ``&``, relative to the
page, without dot segments; an empty path is the root. Targets that are no pages (``mailto:``,
``#part``) make no edge.

Null or malformed URLs have an empty host and path, fit no rule and are allowed. Repeated
pages give repeated rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, components


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]

# <link rel="canonical" href="..."> and <meta http-equiv="refresh" content="0; url=...">
COMMENTS = r"(?s)<!--.*?(?:-->|\z)"
TAGS = r"(?i)<(?:link|meta)\s[^<>]*+>"
CANONICAL = r"(?i)\brel\s*=\s*[\"']?canonical\b"
HREF = r"(?i)(?<![\w-])href\s*=\s*[\"']?([^\"'\s<>]+)"
REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
TARGET = r"(?i)(?<![\w-])content\s*=\s*[\"']?\s*[0-9.]*\s*;\s*url\s*=\s*[\"']?([^\"'\s<>]+)"

AMPERSAND = r"(?i)&(?:amp|#38|#x26);"
SCHEME = r"(?i)^[a-z][a-z0-9+.\-]*:"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _without_dots(path: Column) -> Column:
    """A path without the segments ``.`` and ``..``."""
    parts = F.split(path, "/")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    # a dot at the end names the folder
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.array_join(kept, "/")).otherwise(path)


def node_of(url: Column) -> Column:
    """What tells one page from another: host, path and query, not scheme or fragment."""
    host, path = host_of(url), _without_dots(path_of(url))
    query = F.regexp_extract(_rest(url), r"^[^?#]*([^#]*)", 1)
    return F.concat(host, F.when((path == "") & (host != ""), "/").otherwise(path), query)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    own = (host == rule.host) | host.endswith(f".{rule.host}")
    return own & path.startswith(rule.path)


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` and its verdict, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r.host), -len(r.path), r))
    name = verdict = None
    for rule in ordered:
        fits = _fits(rule, host, path)
        name = F.when(fits, rule.host + rule.path) if name is None else name.when(fits, rule.host + rule.path)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _absolute(base: Column, target: Column) -> Column:
    """A link target as a URL; relative ones are resolved against the page's."""
    origin = F.concat(F.lit("x://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    return (
        F.when(target.rlike(SCHEME + "//"), target)
        .when(target.rlike(SCHEME) | target.startswith("#"), F.lit(None))
        .when(target.startswith("?"), F.concat(origin, path_of(base), target))
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target))
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) nodes of the canonical links and redirects in the pages."""
    tags = F.regexp_extract_all(F.regexp_replace(F.col(html), COMMENTS, " "), F.lit(TAGS), F.lit(0))
    # the cheap test spares most pages the regular expression
    linked = pages.filter(F.lower(F.col(html)).rlike("canonical|refresh"))
    found = linked.select(F.col(url).alias("_url"), F.explode(tags).alias("_tag")).select(
        "_url",
        F.when(F.col("_tag").rlike(CANONICAL), F.regexp_extract("_tag", HREF, 1))
        .when(F.col("_tag").rlike(REFRESH), F.regexp_extract("_tag", TARGET, 1))
        .alias("_target"),
    )
    return (
        found.filter("_target <> ''")
        .select(
            node_of(F.col("_url")).alias("source"),
            node_of(_absolute(F.col("_url"), F.regexp_replace("_target", AMPERSAND, "&"))).alias("target"),
        )
        .filter("source <> '' AND target <> '' AND source <> target")
        .distinct()
    )


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = tuple(RULES),
    url: str = "url",
    html: str = "html",
    edges: DataFrame | None = None,
) -> DataFrame:
    """All columns of ``pages`` and host, path, rule, verdict, component.

    ``edges`` (source, target) are redirects known from elsewhere, as URLs. ``component``
    is null for a page without links. Own columns replace columns of the same names.
    """
    spark = pages.sparkSession
    links = alias_edges(pages, url, html)
    if edges is not None:
        links = links.union(edges.select(node_of(F.col("source")), node_of(F.col("target")))).distinct()
    scratch = Scratch(spark)
    links = scratch.save(links, "links")
    base = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    name, own = rule_columns(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", name).withColumn("_own", own)
    if links.isEmpty():
        return base.withColumn("verdict", F.coalesce("_own", F.lit("allow"))).drop("_own").withColumn(
            "component", F.lit(None).cast("long")
        )
    # nodes get 64-bit numbers; the aliases that a rule blocks need not be pages themselves
    nodes = links.select(F.col("source").alias("node")).union(links.select("target")).distinct()
    numbered = links.select(F.xxhash64("source").alias("a"), F.xxhash64("target").alias("b"))
    found = components(numbered, scratch)
    as_url = F.concat(F.lit("x://"), F.col("node"))
    _, verdict = rule_columns(host_of(as_url), path_of(as_url), rules)
    member = nodes.select(F.xxhash64("node").alias("node"), verdict.alias("_verdict")).join(found, "node")
    blocked = member.groupBy("component").agg(F.max(F.col("_verdict").eqNullSafe("block")).alias("_blocked"))
    aliases = found.join(blocked, "component").select(F.col("node").alias("_node"), "component", "_blocked")
    aliases = scratch.save(aliases, "aliases")
    judged = base.drop("component").withColumn("_node", F.xxhash64(node_of(F.col(url)))).join(aliases, "_node", "left")
    spread = F.when(F.col("_blocked"), "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce("_own", spread)).drop("_own", "_node", "_blocked")


def op1_url_filters(spark, folder: str) -> DataFrame:
    from tablewarden.llm.common import load

    return judge(load(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict", "component")
