"""URL filters over redirect equivalence.

A rule (host, path) decides every URL of its host and subdomains under its path; the
longest rule wins.  URLs without a rule of their own follow their aliases: redirect and
canonical-link edges are closed into classes by distributed connected components, and
a blocked URL blocks all of its class except URLs that a rule explicitly allows.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import lookup, ship
from tonearm.llm.components import connected_components
from tonearm.session import materialize

#: So many rules are compiled into the plan; longer lists are a table joined on host suffix and path prefix.
COMPILED_RULES = 500
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"://([^/?#]*)([^?#]*)"
TAG = r"(?i)<(?:link|meta)\b[^>]*>"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def best_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The verdict and text of the longest rule that fits, as a struct, or null.

    Of equally long ones the longer host wins, then allow.
    """
    answer = F.lit(None).cast("struct<verdict:string,rule:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "allow")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        answer = F.when(fits, F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.host + r.path).alias("rule"))) \
            .otherwise(answer)
    return answer


def with_rule(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` (host, path, ...) with ``own``, the struct of :func:`best_rule`, for any number of rules.

    Long lists are a table with a row per (host, path).  A URL looks its candidates up by
    equality: each suffix of its host at a dot with each prefix of its path that is as
    long as some rule's path; of the rules found the longest stays.
    """
    if len(rules) <= COMPILED_RULES:
        return rows.withColumn("own", best_rule(rules, F.col("host"), F.col("path")))
    best = {}
    for r in rules:
        if r.verdict == "allow" or (r.host, r.path) not in best:
            best[r.host, r.path] = r
    spark = rows.sparkSession
    listed = [(f"{r.host}\n{r.path}", (len(r.host + r.path), len(r.host), r.verdict, r.host + r.path))
              for r in best.values()]
    known = spark.createDataFrame(
        listed, "place string, found struct<length:int,host_length:int,verdict:string,rule:string>")
    known = materialize(known, "url-rules")
    sizes = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "url-ruled")
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(
        F.slice("labels", i, F.size("labels")), "."))
    paths = F.transform(F.filter(sizes, lambda n: n <= F.length("path")),
                        lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = (rows.select("rid", "path", labels.alias("labels")).select("rid", F.explode(hosts).alias("host"), paths.alias("paths"))
             .select("rid", "host", F.explode("paths").alias("prefix"))
             .select("rid", F.concat("host", F.lit("\n"), "prefix").alias("place")))
    hits = lookup(tried, known, "place", ["found"]).filter("found IS NOT NULL")
    longest = hits.groupBy("rid").agg(F.max("found").alias("found"))
    own = F.when(F.col("found").isNotNull(), F.struct("found.verdict", "found.rule"))
    return rows.join(longest, "rid", "left").withColumn("own", own).drop("rid", "found")


def node_of(url: Column) -> Column:
    """A URL's node: lower-case scheme and host, path (at least ``/``) and query, no fragment; null without ``://``."""
    query = F.regexp_extract(url, r"://[^?#]*(\?[^#]*)", 1)
    scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host_of(url), path, query))


def links_of(html: Column) -> Column:
    """What a page's canonical links and meta refreshes name, as written."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TAG), F.lit(0))
    value = lambda t, name: F.regexp_extract(t, rf"(?i)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", 0)
    bare = lambda v: F.regexp_replace(v, r"(?i)^[a-z-]+\s*=\s*[\"']?|[\"']$", "")
    attr = lambda t, name: bare(value(t, name))
    canonical = F.transform(F.filter(tags, lambda t: attr(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")),
                            lambda t: attr(t, "href"))
    refresh = F.transform(F.filter(tags, lambda t: attr(t, "http-equiv").rlike(r"(?i)^refresh$")),
                          lambda t: F.regexp_extract(attr(t, "content"), r"(?i)\burl\s*=\s*['\"]?([^'\"]+)", 1))
    return F.filter(F.concat(canonical, refresh), lambda h: h != "")


_PARTS = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?", re.S)


def _without_dots(path: str) -> str:
    """A path with its ``.`` and ``..`` segments worked off; ``..`` at the root stays at the root."""
    out: list[str] = []
    steps = path.split("/")
    for at, step in enumerate(steps):
        if step == "..":
            if len(out) > 1:
                out.pop()
        elif step != ".":
            out.append(step)
        if step in (".", "..") and at == len(steps) - 1:
            out.append("")
    return "/".join(out)


def resolve(base: str, link: str) -> str | None:
    """The absolute URL that ``link`` names on page ``base`` (RFC 3986, section 5), or None if it has no host.

    Character references are decoded and surrounding white space is dropped first, as in HTML.
    """
    link = html_lib.unescape(link).strip(" \t\n\f\r")
    scheme, host, path, query = _PARTS.match(link).groups()
    base_scheme, base_host, base_path, base_query = _PARTS.match(base).groups()
    if scheme is not None:
        if host is None:
            return None
    elif host is not None:
        scheme = base_scheme
    else:
        if base_host is None:
            return None
        scheme, host = base_scheme, base_host
        if path == "":
            path, query = base_path, base_query if query is None else query
        elif not path.startswith("/"):
            path = (base_path.rpartition("/")[0] if "/" in base_path else "") + "/" + path
    return None if scheme is None else f"{scheme}://{host}{_without_dots(path)}{query or ''}"


def _resolve_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [resolve(u, h) for u, h in zip(batch.column("url").to_pylist(), batch.column("link").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("u"), pa.array(names, pa.string())], names=["u", "to"])


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of (page_id, url, html).

    ``redirects`` (from_url, to_url) adds edges to the pages' own canonical links and
    meta refreshes.  Null urls and urls without ``://`` have empty host and path, no
    aliases, and are allowed unless a rule fits; repeated rows are judged alike; an
    empty table gives no rows; extra columns are not read.  Links are resolved against
    the page's URL; the page's own URL is taken as it stands (its dot segments stay).
    """
    ship(pages.sparkSession)
    url = F.col("url")
    links = F.when(F.instr(url, "://") > 0, links_of(F.col("html")))
    # Only the URLs of pages with links go to Python.
    light = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"),
                         links.alias("links"), F.when(F.size(links) > 0, url).alias("url"))
    light = materialize(with_rule(light, rules), "url-pages")
    edges = (light.filter(F.size("links") > 0)
             .select(F.col("node").alias("u"), "url", F.explode("links").alias("link"))
             .mapInArrow(_resolve_all, "u string, to string").select("u", node_of(F.col("to")).alias("v")))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("from_url")).alias("u"),
                                                   node_of(F.col("to_url")).alias("v")))
    edges = materialize(edges.distinct(), "url-edges")
    classes = materialize(connected_components(edges), "url-classes")
    node = F.col("node")
    places = classes.select("node", "component", host_of(node).alias("host"), path_of(node).alias("path"))
    blocked = (with_rule(places, rules).filter(F.col("own.verdict") == "block")
               .select("component").distinct().withColumn("hit", F.lit(True)))
    aliases = lookup(classes, blocked, "component", ["hit"]).filter("hit").select("node", "hit")
    out = lookup(light, aliases, "node", ["hit"])
    verdict = F.coalesce("own.verdict", F.when(F.col("hit"), "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"))


#: The query's rules.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
