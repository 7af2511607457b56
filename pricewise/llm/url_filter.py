"""URL filters with redirect equivalence.

A page is judged by the longest rule that fits its host (or a parent domain)
and the start of its path. Canonical links and meta refreshes make two urls
aliases; distributed connected components over these edges give every page the
decisions of its aliases. A page's own rule decides. Without one, an explicit
allow among its aliases goes before a block; a block among them blocks; else
the page is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str            # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """What two urls share that name the same page: host, path and query. Null without a host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url), _query_of(url)))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule as a struct (rule, verdict); null if none fits."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in sorted(rules, key=lambda r: (-len(r.name), r.verdict, r.name))]
    return reduce(lambda a, b: F.coalesce(a, b), fits)


# What a browser does not read as markup, tags as a whole, and attributes one after the other: quoted values are taken
# whole, so that nothing inside one looks like an attribute.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea|title)\b.*?(?:</\1\s*>|\z)"
_TAG = r"(?is)<(?:link|meta)(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
_ATTRIBUTE = r"(?s)[\s/\"']([^\s=>\"'/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, without its quotes; empty if there is none."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
    value = F.get(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2)), (F.array_position(names, name) - 1).cast("int"))
    return F.trim(F.regexp_replace(F.coalesce(F.when(F.array_contains(names, name), value), F.lit("")), "\\A[\"']|[\"']\\z", ""))


def _resolve(target: Column, url: Column) -> Column:
    """An absolute url for a link found on a page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"(?s)\A(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)\A(.*/)", 1)
    return (F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target))
            .when(target != "", F.concat(site, F.when(folder == "", "/").otherwise(folder), target)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links of a page to its canonical or refresh target.

    Columns: a and b (alias keys of the page and the target), host and path of
    both (``a_host``, ...). The first ``link`` whose ``rel`` words hold canonical
    and the first ``meta`` refresh of a page count; comments, scripts, styles,
    templates, text areas and titles are not read.
    """
    tags = pages.select(F.col(f"`{url}`").alias("u"), F.col(f"`{html}`").alias("h")) \
        .filter(F.col("h").rlike("(?i)canonical|refresh")) \
        .select("u", F.regexp_extract_all(F.regexp_replace("h", _HIDDEN, " "), F.lit(_TAG), F.lit(0)).alias("tags"))
    canonical = F.filter("tags", lambda t: t.rlike(r"(?i)\A<link") & F.array_contains(
        F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical") & (_attribute(t, "href") != ""))
    refresh = F.filter("tags", lambda t: t.rlike(r"(?i)\A<meta") & (F.lower(_attribute(t, "http-equiv")) == "refresh"))
    to = F.trim(F.regexp_replace(F.regexp_extract(_attribute(F.get(refresh, F.lit(0)), "content"),
                                                  r"(?is)\A[^;,]*[;,]\s*url\s*=\s*(.*)\z", 1), "[\"']", ""))
    found = tags.select("u", F.explode(F.array(_attribute(F.get(canonical, F.lit(0)), "href"), to)).alias("t")).filter("t != ''")
    target = found.select("u", _resolve(F.col("t"), F.col("u")).alias("target"))
    ends = [c for name, x in (("a", F.col("u")), ("b", F.col("target")))
            for c in (alias_key(x).alias(name), host_of(x).alias(f"{name}_host"), path_of(x).alias(f"{name}_path"))]
    return target.select(*ends).filter("a is not null and b is not null")


def judge(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, host, path, rule (null if none fits), verdict.

    Null urls and urls without ``://`` have an empty host and path, no rule and
    no alias; they are allowed. Null html has no links. Repeated rows and null
    ids keep their rows; an empty table gives none. Other columns are not read.
    ``rules`` is a list held by the caller, compiled into one expression.
    """
    u = F.col("u")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("u"))
    rows = rows.select("page_id", host_of(u).alias("host"), path_of(u).alias("path"), alias_key(u).alias("key"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("r"))

    edges = cut(alias_edges(pages, url, html), "url-edges")
    component = connected_components(edges)
    # decisions among the members: pages that are linked, and link targets that are no pages
    members = edges.selectExpr("a as key", "a_host as host", "a_path as path").union(
        edges.selectExpr("b as key", "b_host as host", "b_path as path")).distinct()
    ruled = members.select("key", rule_of(F.col("host"), F.col("path"), rules)["verdict"].alias("v"))
    votes = cut(component.join(ruled, component.node == ruled.key).groupBy("component").agg(
        F.max((F.col("v") == "allow").cast("int")).alias("allowed"),
        F.max((F.col("v") == "block").cast("int")).alias("blocked")), "url-votes")
    inherited = cut(component.join(votes, "component").select(
        F.col("node").alias("key"), F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block")
        .alias("inherited")).filter("inherited is not null"), "url-inherited")
    return rows.join(inherited, "key", "left").select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), "inherited", F.lit("allow")).alias("verdict"))
