"""URL rules whose block decisions reach aliases: pages joined by redirect and canonical links. DataFrames only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.graph import components
from fitmesh.llm.storage import stored

MOST_RULES = 4096  # rules travel inside the plan
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` segments resolved."""
    def add(done: Column, segment: Column) -> Column:
        return F.when(segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(segment == ".", done).otherwise(F.array_append(done, segment))

    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    clean = F.concat(F.lit("/"), F.array_join(F.aggregate(segments, F.array().cast("array<string>"), add), "/"))
    return F.when(F.regexp_like(path, F.lit(r"/\.\.?(/|$)")), clean).otherwise(path)


def canonical(url: Column) -> Column:
    """One spelling of a URL: no scheme, ``www.``, default port, dot segments, fragment, tracking parameters or trailing slash."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    query = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~F.regexp_like(q, F.lit(r"^(utm_[a-z]*|ref|fbclid|gclid)(=|$)")))), "&")
    path = F.regexp_replace(without_dots(path_of(url)), r"/+$", "")
    return F.when(url.isNotNull(), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def resolved(to: Column, base: Column) -> Column:
    """The absolute URL that ``to`` means on ``base``; null for schemes without ``//`` such as ``mailto:``."""
    root, path = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1), path_of(base)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (F.when(F.regexp_like(to, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), to)
            .when(F.regexp_like(to, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None))
            .when(to.startswith("//"), F.concat(F.lit("http:"), to))
            .when(to.startswith("/"), F.concat(root, to))
            .when(to.startswith("?"), F.concat(root, path, to))
            .when(to.startswith("#"), F.regexp_extract(base, r"(?s)^([^#]*)", 1))
            .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), to)))


def page_links(pages: DataFrame) -> DataFrame:
    """``(a, b)`` canonical URL spellings that one page declares equal: ``rel=canonical`` and ``http-equiv=refresh``.

    Tags and attributes in any case. Relative targets are resolved against the page's ``<base href>`` or its URL.
    """
    def target(tag: str, value: str) -> Column:
        found = F.regexp_extract(F.regexp_extract("html", tag, 0), value, 1)
        return F.regexp_replace(found, "&amp;", "&")

    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("url", html.alias("html")).where(F.col("url").contains("://") & (F.contains(F.lower("html"), F.lit("canonical")) | F.contains(F.lower("html"), F.lit("refresh"))))
    links = F.array(target(r"(?i)<link\b[^>]*\brel=[\"']?canonical\b[^>]*>", r"(?i)\bhref=[\"']?([^\"'\s>]+)"),
                    target(r"(?i)<meta\b[^>]*\bhttp-equiv=[\"']?refresh\b[^>]*>", r"(?i)\burl=[\"']?([^\"'\s>]+)"))
    declared = target(r"(?i)<base\b[^>]*\bhref=[^>]*>", r"(?i)\bhref=[\"']?([^\"'\s>]+)")
    p = p.select("url", declared.alias("declared"), F.explode(links).alias("to")).where("to <> ''")
    base = F.when(F.col("declared") != "", resolved(F.col("declared"), F.col("url")))
    p = p.select("url", "to", F.coalesce(base, "url").alias("base"))
    return p.select(canonical(F.col("url")).alias("a"), canonical(resolved(F.col("to"), F.col("base"))).alias("b")).where("b is not null")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages`` (page_id, url, html).

    ``rules`` are (verdict, host, path): a rule fits its host and all subdomains when the path starts with the rule's;
    the longest host plus path wins, allow on ties. ``redirects`` may add (from_url, to_url) pairs to the links that pages
    declare. Spellings of one URL and linked URLs form components. A page without a rule of its own takes its component's
    verdict: allow if any member is allowed by a rule, else block if any is blocked, else allow.

    A null url, or one without ``://``, has empty host and path and stands alone. Null html declares no link. Repeated
    rows get equal results, null ids stay null, other columns are ignored, an empty table gives no rows.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules; join larger lists by host first")
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(canonical(F.col("from_url")).alias("a"), canonical(F.col("to_url")).alias("b")))
    p = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.withColumn("alias", F.when(F.col("url").contains("://"), canonical(F.col("url"))))
    fitting = []
    for verdict, host, path in rules:
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        value = F.struct(F.lit(len(host) + len(path)).alias("size"), F.lit(verdict == "allow").alias("allow"), F.lit(host + path).alias("rule"))
        fitting.append(F.when(fits, value))
    best = F.array_max(F.array_compact(F.array(*fitting))) if fitting else F.lit(None).cast("struct<size:int,allow:boolean,rule:string>")
    p = stored(p.withColumn("best", best).select("page_id", "host", "path", "alias", F.col("best.rule").alias("rule"), F.col("best.allow").alias("allow")), "url-pages")
    aliases = p.where("alias is not null").groupBy("alias").agg(F.bool_or("allow").alias("allow"), F.count_if(~F.col("allow")).alias("blocks"))
    comp = stored(components(stored(links, "url-links").distinct()), "url-components")
    named = aliases.join(comp.withColumnRenamed("node", "alias"), "alias", "left").withColumn("component", F.coalesce("component", "alias"))
    decided = named.groupBy("component").agg(F.bool_or("allow").alias("any_allow"), F.sum("blocks").alias("blocks"))
    blocked = decided.where(F.coalesce(~F.col("any_allow"), F.lit(True)) & (F.col("blocks") > 0)).select("component")
    blocked = named.join(blocked, "component", "left_semi").select("alias").withColumn("hit", F.lit(True))
    out = p.join(blocked, "alias", "left")
    own = F.when(F.col("rule").isNotNull(), F.col("allow")).otherwise(F.col("hit").isNull())
    return out.select("page_id", "host", "path", "rule", F.when(own, "allow").otherwise("block").alias("verdict"))
