"""Url filtering with redirect equivalence, in DataFrame functions only.

Rules name a host (and all its subdomains) and a beginning of the path; the longest that fits decides.  Pages that
redirect to each other or declare a canonical address are aliases: their addresses are nodes of a graph, its connected
components are found by alternating stars, and a block of one address reaches all aliases that no rule of their own
decides.  An explicit allow of an address always takes precedence over a block that comes from an alias.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.components import components
from sourcetrail.llm.tables import is_empty, written

#: (verdict, host, beginning of the path)
Rule = tuple[str, str, str]

_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?\s*canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'>\s]+)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, with A-Z in lower case; empty without ://."""
    at = F.locate("://", url)
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, string.ascii_uppercase, string.ascii_lowercase)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    at = F.locate("://", url)
    return F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def address_of(url: Column) -> Column:
    """Host, path and query: addresses that differ in the scheme or the fragment only are one.  Null without a host."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)?", 1)
    path = path_of(url)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (size, allowed, rule, verdict) of the longest rule that fits, of two equally long ones the allow; or null."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(
                F.lit(len(h + p)).alias("size"), F.lit(int(v == "allow")).alias("allowed"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")
            ),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,allowed:int,rule:string,verdict:string>")


def _first(tag: Column, pattern: str, groups: int) -> Column:
    found = [F.regexp_extract(tag, pattern, i + 1) for i in range(groups)]
    return F.coalesce(*[F.when(f != "", f) for f in found])


def links(pages: DataFrame) -> DataFrame:
    """(url, target): canonical links and refresh redirects that the pages declare, as absolute addresses."""
    canonical = _first(F.regexp_extract("html", _CANONICAL, 0), _HREF, 3)
    refresh = _first(F.regexp_extract("html", _REFRESH, 0), _TARGET, 1)
    found = pages.select("url", F.explode(F.array(canonical, refresh)).alias("target")).where("target is not null and url is not null")
    scheme = F.regexp_extract("url", r"^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(F.col("url")))
    folder = F.regexp_replace(F.when(path_of(F.col("url")) == "", "/").otherwise(path_of(F.col("url"))), r"[^/]*$", "")
    target = F.trim(F.regexp_replace("target", "&amp;", "&"))
    absolute = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(site, folder, target))
    )
    return found.select("url", absolute.alias("target"))


def judge(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """pages (page_id, url, html) with host, path, rule and verdict.

    edges: further redirects (url, target).  A page with a rule has the rule's verdict; otherwise it is blocked if an
    alias is blocked by a rule, else it has the default.  Null urls and urls without :// have an empty host and path, no
    rule and no aliases; null html declares nothing; repeated rows stay repeated; other columns are ignored.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    declared = links(pages)
    if edges is not None:
        declared = declared.union(edges.select("url", "target"))
    graph = declared.select(address_of(F.col("url")).alias("u"), address_of(F.col("target")).alias("v"))
    graph = written(graph.where("u is not null and v is not null and u <> v").distinct(), "alias-links")

    host, path = F.coalesce(host_of(F.col("url")), F.lit("")), F.coalesce(path_of(F.col("url")), F.lit(""))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    out = ["page_id", "host", "path", F.col("fit.rule").alias("rule")]
    own = F.col("fit.verdict")
    if is_empty(graph):
        return judged.select(*out, F.coalesce(own, F.lit(default)).alias("verdict"))

    # addresses, also those that are no page here, are judged by the same rules
    nodes = components(graph).withColumn("as_url", F.concat(F.lit("any://"), "node"))
    node_fit = fitting_rule(host_of(F.col("as_url")), path_of(F.col("as_url")), rules)
    nodes = nodes.select("node", "component", (F.coalesce(node_fit["verdict"], F.lit("")) == "block").alias("blocked"))
    blocked = nodes.groupBy("component").agg(F.max("blocked").alias("blocked")).where("blocked").select("component")
    reached = nodes.join(blocked, "component").select("node", F.lit("block").alias("from_alias"))
    judged = judged.withColumn("node", address_of(F.col("url"))).join(reached, "node", "left")
    return judged.select(*out, F.coalesce(own, F.col("from_alias"), F.lit(default)).alias("verdict"))
