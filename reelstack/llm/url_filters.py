"""URL filters with redirect equivalence.

Rules name a host (with its subdomains) and a path prefix. A page that no rule
fits takes the decision of its aliases: pages are joined by redirects and
canonical links into connected components, a component with an explicitly
allowed member allows the rest, else one with a blocked member blocks the rest,
else the page is allowed. A page's own rule always wins.

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule and the verdict allow; repeated rows each get their verdict; null
html has no links; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelstack.llm.common import only, text_or_empty
from reelstack.llm.graph import components

# Fixed values of the contract: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Start tags that name another address of the page.
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Longest fitting rule as struct(rule, verdict), null when none fits. The
    rules are literals of the plan, so no join or broadcast is needed."""
    fit = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                  F.struct(F.lit(-len(h + p)).alias("rank"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
           for v, h, p in rules]
    return F.get(F.sort_array(F.filter(F.array(*fit), lambda r: r.isNotNull())), F.lit(0)) if fit else F.lit(None)


def without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments, which climb no further than the root."""
    segments = F.split(path, "/", -1)
    last = F.element_at(segments, -1).isin(".", "..")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda a, s: F.when(s == ".", a).when(
        s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(1)))).otherwise(F.concat(a, F.array(s))))
    return F.when(F.contains(path, F.lit("/.")), F.concat(
        F.array_join(kept, "/"), F.when(last, F.lit("/")).otherwise(""))).otherwise(path)


def node(url: Column) -> Column:
    """The address that a url names: scheme and host in lower case, no dot
    segments, and no fragment, which never reaches the server."""
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"(?s)^[^#]*?://[^?#]*(\?[^#]*)", 1)
    return F.when(site != "", F.concat(F.translate(site, UPPER, LOWER), without_dots(path), query)).otherwise(
        F.regexp_extract(url, r"(?s)^([^#]*)", 1))


def link_target(url: Column, link: Column) -> Column:
    """Absolute form of a link on the page ``url``: absolute, scheme-relative,
    root-relative, relative to the page's folder, or a query alone. Links of other
    schemes, to a place on the page itself, and empty ones give null."""
    link = F.btrim(F.regexp_replace(link, r"&(?:amp|#38|#[xX]26);", "&"))
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.concat(site, F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1)))
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.startswith("?"), F.concat(site, path, link))
            .when((link != "") & ~link.startswith("#") & ~link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(folder, link)))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and of refreshes in the html."""
    html = text_or_empty("html")
    named = pages.select("url", html.alias("html")).filter(
        F.col("url").contains("://") & F.col("html").rlike(r"(?i)canonical|http-equiv"))
    attr = lambda tag, pattern: F.regexp_extract(F.regexp_extract("html", tag, 0), pattern, 1)
    links = F.array(attr(CANONICAL, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"),
                    attr(REFRESH, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"))
    return named.select("url", F.explode(links).alias("link")).select(
        "url", link_target(F.col("url"), F.col("link")).alias("target")).filter("target is not null")


def component_verdicts(links: DataFrame, rules=RULES) -> DataFrame:
    """(node, verdict) of addresses whose component has a ruled member."""
    edges = links.select(node(F.col("url")).alias("u"), node(F.col("target")).alias("v"))
    members = components(edges)
    n = F.col("node")
    ruled = members.select("component", matched_rule(host_of(n), path_of(n), rules)["verdict"].alias("v"))
    verdicts = ruled.filter("v is not null").groupBy("component").agg(F.min("v").alias("verdict"))
    return members.join(verdicts, "component").select("node", "verdict")


def url_filters(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page. ``redirects`` may
    add (url, target) pairs from a crawl log."""
    pages = only(pages, "page_id", "url", "html")
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target").na.drop())
    aliases = component_verdicts(links, rules).select(F.col("node").alias("_node"), F.col("verdict").alias("_alias"))
    url = F.col("url")
    judged = pages.select("page_id", node(url).alias("_node"), host_of(url).alias("host"),
                          path_of(url).alias("path"))
    judged = judged.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    joined = judged.join(aliases, "_node", "left")
    return joined.select("page_id", "host", "path", F.col("_rule")["rule"].alias("rule"), F.coalesce(
        F.col("_rule")["verdict"], "_alias", F.lit("allow")).alias("verdict"))
