"""URL rules with decisions that follow redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.llm.components import connected_components
from tabspark.llm.scratch import cut

#: (verdict, host, path) rules (fixed values); most rules one call takes, as they become part of the plan.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MOST_RULES = 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host, lower case A-Z, and path of a url; both empty for null and without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct<size, rule, verdict>; of equally long ones allow wins. Null if none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES}")
    listed = [F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
                       F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in sorted(rules, key=lambda r: r[0] == "allow")]
    if not listed:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    fits = F.filter(F.array(*listed), lambda r: (
        (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.aggregate(fits, F.lit(None).cast("struct<size:int,rule:string,verdict:string>"), lambda best, r: F.when(
        best.isNull() | (r["size"] >= best["size"]), F.struct(r["size"].alias("size"), r["rule"].alias("rule"),
                                                              r["verdict"].alias("verdict"))).otherwise(best))


def node_of(url: Column) -> Column:
    """The address that equivalent spellings share: no scheme, fragment, default port, last slash or tracking parameter."""
    host, path = host_path(url)
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(path, r"/+$", "")
    asked = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(r"^(ref|utm_\w+)(=|$)")))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, asked))


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) addresses: each page to all its canonical links and refresh redirects.

    Relative targets are resolved against the page. Links without a target and
    links of a page to itself are left out.
    """
    def targets(tag: str, link: str) -> Column:
        tags = F.regexp_extract_all(html, F.lit(tag), F.lit(1))
        return F.transform(tags, lambda t: F.regexp_extract(t, link, 1))

    canonical = targets(r"(?is)(<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>)", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)")
    redirect = targets(r"(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>)", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)")
    found = pages.select(F.col(url).alias("url"), F.explode(F.concat(canonical, redirect)).alias("target")).filter(
        F.col("url").isNotNull() & (F.col("target") != ""))
    host, path = host_path(F.col("url"))
    t, site = F.col("target"), F.concat(F.lit("x://"), host)
    full = (F.when(t.contains("://"), t).when(t.startswith("//"), F.concat(F.lit("x:"), t)).when(t.startswith("/"), F.concat(site, t))
            .when(t.startswith("?"), F.concat(site, path, t)).otherwise(
        F.concat(site, F.regexp_replace(path, r"[^/]*$", ""), F.when(path == "", F.lit("/")).otherwise(F.lit("")), t)))
    return found.select(node_of(F.col("url")).alias("src"), node_of(full).alias("dst")).filter("src != dst").distinct()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, edges: DataFrame | None = None,
          key: str = "page_id", url: str = "url", html: str | None = "html", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page, and the address and component that decided.

    The longest rule that fits a page decides it. A page without one takes the
    decision of its aliases: the pages of its component of redirect and canonical
    links (those in the html, and ``edges`` (src, dst) of urls if given) and the
    pages with an equivalent address. An explicit allow among the aliases takes
    precedence over blocks; without either the verdict is ``default``. So a block
    reaches every alias of a blocked page and never overrides a rule.

    All of it is DataFrame operations. Components see addresses that have a link,
    not pages; decisions combine per address before they are shuffled. A null url
    or one without ``://`` has empty host and path, no address and no aliases; equal
    rows are judged alike; null html has no links.
    """
    rules = RULES if rules is None else rules
    host, path = host_path(F.col(url))
    own = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"), node_of(F.col(url)).alias("address"))
    own = own.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    own = own.select("page_id", "host", "path", "address", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("said"))
    links = None if html is None else link_edges(pages, url, html)
    if edges is not None:
        given = edges.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst"))
        links = given if links is None else links.unionByName(given)
    said = own.filter("address is not null and said is not null").groupBy("address").agg(
        F.max((F.col("said") == "allow").cast("int")).alias("allowed"))
    if links is not None:
        links = cut(links.filter("src is not null and dst is not null"), "links")
    if links is None or links.isEmpty():
        # no link: an address is its own component
        decided = said.select("address", F.col("address").alias("component"), "allowed")
    else:
        groups = cut(connected_components(links), "components").withColumnsRenamed({"node": "address"})
        said = said.join(groups, "address", "left").withColumn("component", F.coalesce("component", "address"))
        joined = said.groupBy("component").agg(F.max("allowed").alias("allowed"))
        members = groups.unionByName(said.select("address", "component")).distinct()
        decided = members.join(joined, "component").select("address", "component", "allowed")
    out = own.join(decided, "address", "left")
    taken = F.when(F.col("allowed") == 1, F.lit("allow")).when(F.col("allowed") == 0, F.lit("block")).otherwise(F.lit(default))
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", taken).alias("verdict"), "address",
                      F.coalesce("component", "address").alias("component"))
