"""URL filters with redirect equivalence, in DataFrame operations only.

Rules name a host, which covers its subdomains, and the start of a path; the longest fitting rule decides. URLs that
redirect to one another or name one another as canonical are aliases: connected components over those links carry a
block from any member to the members that no rule fits. A member that a rule allows explicitly clears the component:
explicit allow goes before carried blocks, and a URL's own rule before both.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmill.llm.components import components
from creditmill.operators.lookup import attach
from creditmill.session import settle

Rule = tuple[str, str, str]  # block or allow, host, start of path
RULES: tuple[Rule, ...] = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
                           ("allow", "org", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def _rest(url: Column) -> Column:
    """What follows the first ://, empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def key_of(url: Column) -> Column:
    """What identifies a URL as an alias: host, path and query, without scheme and fragment; null without a host."""
    tail = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), tail))


def resolved(href: Column, base: Column) -> Column:
    """A link's target as an absolute URL."""
    href = F.replace(href, F.lit("&amp;"), F.lit("&"))
    root = F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(path_of(base), r"^(.*/)?", 0)
    return (F.when(href == "", F.lit(None)).when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
            .when(href.startswith("//"), F.concat(F.lit("http:"), href)).when(href.startswith("/"), F.concat(root, href))
            .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), href)))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(action, rule), or null. The rules are a parameter and stay in the expression."""
    listed = F.array(*[F.struct(F.lit(len(h) + len(p)).alias("length"), F.lit(len(h)).alias("host_length"),
                                F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules])
    fits = F.filter(listed, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"])))
                    & path.startswith(r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(  # of equal lengths the longer host, then allow
        r["length"], r["host_length"], (r["action"] == "allow").alias("allowed"),
        F.concat(r["host"], r["path"]).alias("rule"), r["action"].alias("action"))))
    return best


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges between URL keys of all canonical links and refreshes of a page, with the target's URL."""
    base, body = F.col(url).cast("string"), F.coalesce(F.col(html).cast("string"), F.lit(""))
    canonical, refresh = (F.regexp_extract_all(body, F.lit(tag), F.lit(0)) for tag in (CANONICAL, REFRESH))
    hrefs = F.concat(F.transform(canonical, lambda t: F.regexp_extract(t, HREF, 1)),
                     F.transform(refresh, lambda t: F.regexp_extract(t, TARGET, 1)))
    found = pages.select(base.alias("_url"), F.explode(F.filter(hrefs, lambda h: h != "")).alias("_href"))
    told = found.select(key_of(F.col("_url")).alias("a"), resolved(F.col("_href"), F.col("_url")).alias("target"))
    return told.withColumn("b", key_of(F.col("target"))).dropna(subset=["a", "b"]).filter("a <> b")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None, url: str = "url",
          html: str = "html", key: str = "page_id") -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict, component.

    `redirects` may add edges as rows (from_url, to_url), such as HTTP redirects that a crawler logged. A null URL, or one
    without ://, has empty host and path, fits no rule, has no aliases and is allowed; null html has no links, and a page with several has them all. Rows that
    repeat a URL get the same verdict; ties between rules go to the longer host, then to allow. An empty table gives no
    rows; other columns are not read. `component` is the smallest alias, null for URLs without aliases.
    """
    edges = links(pages, url, html).select("a", "b")
    if redirects is not None:
        more = redirects.select(key_of(F.col("from_url")).alias("a"), key_of(F.col("to_url")).alias("b"))
        edges = edges.union(more.dropna().filter("a <> b"))
    members = settle(components(settle(edges.distinct())))
    # a key is host + path + query: its own rule can be read off it
    as_url = F.concat(F.lit("x://"), F.col("node"))
    ruled = members.withColumn("r", rule_for(host_of(as_url), path_of(as_url), rules))
    carried = (ruled.groupBy("component").agg(F.max(F.coalesce(F.col("r.action") == "allow", F.lit(False))).alias("cleared"),
                                              F.max(F.coalesce(F.col("r.action") == "block", F.lit(False))).alias("blocked")))
    told = settle(members.join(carried, "component")
                  .select(F.col("node").alias("_key"), "component", (F.col("blocked") & ~F.col("cleared")).alias("_carried")))
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), host_of(address).alias("host"), path_of(address).alias("path"),
                        key_of(address).alias("_key"))
    own = rows.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    return (attach(own, told, "_key", spread="page_id")
            .select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce(F.col("_r.action"), F.when(F.col("_carried"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    "component"))
