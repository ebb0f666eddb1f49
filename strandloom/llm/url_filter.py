"""URL filter with redirect equivalence.

Rules are (verdict, host, path): a rule fits its host and all subdomains if the
URL's path starts with the rule's; the longest host and path wins, of equally long
ones the allowing one, then the first by name.  A page whose URL no rule fits takes
its verdict from its aliases: the URLs reachable over redirects and canonical links
in either direction, found as distributed connected components.  An allowed alias
lets the page through even if another alias is blocked; a blocked alias blocks it
otherwise; without either it is allowed.  A rule on the page's own URL always holds.

Edges come from all ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` in the
html, and from a table of redirects if one is given.  A target is taken against the
page's URL, or the html's first ``<base href>``, by RFC 3986; one of a scheme without
``//`` (``mailto:``) is none.  A refresh's target goes on to the end of its attribute
or its own quotes, so ``;`` may be in it, and references as ``&amp;`` are unescaped.
Fragments, A-Z or a-z in scheme and host, and ``.`` and ``..`` in the path don't tell
URLs apart.

Defined cases: a URL that is null or has no ``://`` has empty host and path, fits
no rule, has no aliases and is allowed; null html has no links; repeated rows each
get their verdict; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.graph import components
from strandloom.llm.runtime import Scratch, merged, weighed, workers

#: As HTML reads it: a name, and a value in quotes or up to a space.  Possessive, so that long tags take no stack.
ATTRIBUTE = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?=>)|[^\s>"'][^\s>]*+))?+"""
TAG = r"(?i)<(?:link|meta|base)(?=[\s/])(?:[\s/]++|" + ATTRIBUTE + ")*+>"
#: In the content of a refresh: what follows the seconds or ``url=``.
REFRESH = re.compile(r"\s*(?:[\d.]+[\s;,]+(?:url\s*=\s*)?|[\s;,]*url\s*=\s*)(.*)", re.A | re.I | re.S)
SPACE = "".join(map(chr, range(33)))
_ATTRIBUTE, _REFERENCE = re.compile(ATTRIBUTE, re.A), re.compile(r"&#?\w+;", re.A)



def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``? #``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the winning rule, null if none fits."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1] + r[2]))
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in reversed(order):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def without_dots(path: Column) -> Column:
    """The path without its segments ``.`` and ``..``, which takes the one before along."""
    parts = F.split(path, "/", -1)

    def add(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), add)
    last = F.when(path.rlike(r"/\.\.?\z"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(path.contains("/."), F.array_join(F.concat(kept, last), "/")).otherwise(path)


def node_of(url: Column) -> Column:
    head = _lower(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(head, without_dots(path_of(url)), query))


def resolved(to: Column, url: Column) -> Column:
    """What the reference ``to`` means on the page ``url``, null if it is empty, only a fragment, or of a scheme without ``//``."""
    base, path = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), path_of(url)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*\z", ""))
    return (
        F.when((to == "") | to.startswith("#"), None)
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), to)
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
        .when(to.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), to))
        .when(to.startswith("/"), F.concat(base, to))
        .when(to.startswith("?"), F.concat(base, path, to))
        .otherwise(F.concat(base, folder, to))
    )


def unescaped(text: str) -> str:
    """References that end in ``;``, named or numeric, as their characters; unknown ones stay."""
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], text)


def attributes(tag: str) -> dict[str, str]:
    """Names, lower-cased, to whole values, unescaped; the first of a name counts."""
    found = {}
    for name, value in _ATTRIBUTE.findall(tag):
        found.setdefault(name.lower(), unescaped(value[1:-1] if value[:1] in ('"', "'") else value))
    return found


def refresh_of(has: dict[str, str]) -> str:
    """Where a refresh leads: to the closing quote if the target has quotes of its own, else all that is left; empty without one."""
    found = REFRESH.match(has.get("content", ""))
    to = found[1] if found else ""
    return to[1:].partition(to[0])[0] if to[:1] in ('"', "'") else to


def targets(tags: list[str]) -> tuple[str, set[str]]:
    """The first base, and all that canonical links and refreshes name, as written."""
    base, named = None, set()
    for tag in tags:
        has, kind = attributes(tag), tag[1:5].lower()
        if kind == "base" and base is None:
            base = has.get("href")
        elif kind == "link" and "canonical" in has.get("rel", "").lower().split():
            named.add(has.get("href", ""))
        elif kind == "meta" and has.get("http-equiv", "").strip().lower() == "refresh":
            named.add(refresh_of(has))
    return stripped(base or ""), set(map(stripped, named))


def stripped(url: str) -> str:
    return re.sub(r"[\t\n\r]", "", url.strip(SPACE))


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between the node of a page's url and those that its html names."""
    workers(pages.sparkSession)
    named = pages.where(F.col("html").rlike("(?i)canonical|http-equiv") & F.col("url").contains("://"))
    named = named.select("url", F.regexp_extract_all("html", F.lit(TAG), F.lit(0)).alias("tags"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, tags in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                base, found = targets(tags)
                rows += [(url, base, to) for to in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["url", "base", "to"])

    named = named.mapInArrow(read, "url string, base string, to string")
    named = named.withColumn("base", F.coalesce(resolved(F.col("base"), F.col("url")), "url"))
    return named.select(node_of(F.col("url")).alias("a"), node_of(resolved(F.col("to"), F.col("base"))).alias("b"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    id_col: str = "page_id",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """One row per page: id_col, host, path, rule, verdict, alias_verdict.

    ``pages`` has url and html; ``redirects`` has from_url and to_url.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col("url")
    seen = pages.select(id_col, url, host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = seen.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("own"), node_of(url).alias("node"))

    edges = link_edges(pages)
    if redirects is not None:
        start, to = F.col("from_url"), F.col("to_url")
        edges = edges.union(redirects.select(node_of(start), node_of(resolved(to, start))))
    edges = scratch.save(edges.where("a <> b").distinct(), "edges")
    member = scratch.save(components(edges, scratch), "member")
    _, known = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    said = member.select("component", known.alias("known")).where("known is not null")
    said = scratch.save(said.groupBy("component").agg(F.min("known").alias("alias_verdict")), "said")  # allow < block
    alias = scratch.save(member.join(merged(said), "component").select("node", "alias_verdict"), "alias")
    return seen.join(weighed(alias, "node"), "node", "left").select(
        id_col, "host", "path", "rule", F.coalesce("own", "alias_verdict", F.lit("allow")).alias("verdict"), "alias_verdict"
    )
