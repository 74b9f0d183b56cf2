"""URL filters: allow and block rules, carried over redirects and canonical links."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from merchant_ledger.functions.once import with_once
from merchant_ledger.llm.common import materialize
from merchant_ledger.llm.components import components

#: (verdict, host, path): a rule fits its host and all hosts below, and paths that start so.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: What a browser doesn't read as tags.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b.*?(?:</\1\s*>|\z)"
LINK = r"(?is)<link\b[^>]*>"
CANONICAL = r"(?is)(?<![-\w])rel\s*=\s*(?:\"[^\">]*\bcanonical\b|'[^'>]*\bcanonical\b|canonical\b)"
META = r"(?is)<meta\b[^>]*>"
REFRESH = r"(?is)(?<![-\w])http-equiv\s*=\s*[\"']?\s*refresh\b"
BASE = r"(?is)<base\b[^>]*>"
#: The url in a refresh's content, in quotes or up to its end: it may hold any ; and =.
REFRESH_URL = r"(?is)^[^;,]*[;,]\s*(?:url\s*=\s*)?(?:\"([^\"]*)|'([^']*)|(.*))"
ENTITY = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)")


def lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(host: str, path: str) -> Column:
    inside = (F.col("host") == host) | F.col("host").endswith(f".{host}")
    return inside & F.col("path").startswith(path)


def by_rules(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, by host then path; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        rule = F.when(fits(host, path), host + path).otherwise(rule)
        verdict = F.when(fits(host, path), kind).otherwise(verdict)
    return rule, verdict


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, with . and .. segments resolved."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    kept = F.array_join(F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), step), "/")
    end = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(kept, end)).otherwise(path)


def node(url: Column) -> Column:
    """What names a page: host, path without dots, and query; neither scheme nor fragment. Null if no url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    path, query = (F.regexp_extract(rest, r"(?s)^([^?]*)(.*)", i) for i in (1, 2))
    return F.when(host_of(url) != "", F.concat(host_of(url), without_dots(path), query))


def resolved(base: Column, to: Column) -> Column:
    """The url that a link ``to`` leads to from ``base``, dots not yet resolved; null for another
    kind of place (mailto: and so on) and for a base without host."""
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path = path_of(base)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    led = (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(to.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), to))
        .when(to.startswith("/"), F.concat(root, to))
        .when(to.startswith("?"), F.concat(root, path, to))
        .when(to.startswith("#"), base)
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), to))
    )
    return F.when((host_of(base) != "") & (to != ""), led)


def any_group(text: Column, pattern: str) -> Column:
    """What the one of three groups that took part has found."""
    return F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)])


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in either quotes or none; empty if the tag has none."""
    return any_group(tag, rf"""(?is)(?<![-\w]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


@F.pandas_udf(StringType())
def unescaped(values: pd.Series) -> pd.Series:
    """Values of attributes with character references undone, without white space around them.

    A name without its semicolon stays, as in a query's ``&copy=1``.
    """
    return values.map(lambda x: ENTITY.sub(lambda m: html.unescape(m[0]), x).strip(" \t\n\f\r"))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(u, v): pages and what their canonical link or refresh leads to, as nodes.

    Relative targets are resolved against the page's url, or its <base> where it has one. Tags
    in comments, scripts and templates don't count; values are unescaped.
    """
    text = F.col("html")
    led = pages.where(text.rlike(CANONICAL) | text.rlike(REFRESH)).select(
        "url", F.regexp_replace(text, UNREAD, " ").alias("html")
    )
    led = with_once(led, {"html": F.col("html")})
    links = F.filter(F.regexp_extract_all("html", F.lit(LINK), F.lit(0)), lambda x: x.rlike(CANONICAL))
    metas = F.filter(F.regexp_extract_all("html", F.lit(META), F.lit(0)), lambda x: x.rlike(REFRESH))
    targets = F.concat(
        F.transform(links, lambda x: attribute(x, "href")),
        F.transform(metas, lambda x: any_group(F.trim(attribute(x, "content")), REFRESH_URL)),
    )
    led = led.select(
        "url", attribute(F.regexp_extract("html", BASE, 0), "href").alias("base"), F.explode(targets).alias("to")
    )
    led = led.select("url", unescaped("base").alias("base"), unescaped("to").alias("to"))
    for name, column in (
        ("base", F.coalesce(resolved(F.col("url"), F.col("base")), F.col("url"))),
        ("to", resolved(F.col("base"), F.col("to"))),
        ("u", node(F.col("url"))),
        ("v", node(F.col("to"))),
    ):
        led = with_once(led, {name: column})
    return led.select("u", "v").where("u is not null and v is not null")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule and verdict (allow or block).

    The longest rule that fits decides. A page that no rule fits takes the decision of its
    aliases, all that canonical links, refreshes and ``redirects`` (from_url, to_url) connect
    with it: allow if any of them has an allow rule, else block if any has a block rule.
    A target counts with the rule of its own url even if it is no page here. A page without
    either is allowed. Aliases are components in the graph of links, found in joins; links
    without a url at either end, to what is no web page (mailto: and so on) or in null html don't count. A null url or
    one without :// has empty host and path. Repeated pages are judged each; no rows give no
    rows. Only page_id, url and html are read.
    """
    url = F.col("url")
    rule, verdict = by_rules(rules)
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.union(
            redirects.select(node(F.col("from_url")).alias("u"), node(F.col("to_url")).alias("v"))
            .where("u is not null and v is not null")
        )
    roots = materialize(components(edges), "url-aliases")
    host = F.regexp_extract("node", r"(?s)^([^/]*)", 1)
    decided = roots.withColumns({
        "host": host, "path": F.regexp_extract("node", r"(?s)^[^/]*([^?]*)", 1)
    }).withColumn("own", verdict)
    kinds = decided.groupBy("root").agg(
        F.max(F.col("own") == "allow").alias("any_allow"), F.max(F.col("own") == "block").alias("any_block")
    )
    inherited = roots.join(kinds, "root").select(
        "node", F.when(F.col("any_allow"), "allow").when(F.col("any_block"), "block").alias("inherited")
    )
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node(url).alias("node"))
    return (
        judged.withColumns({"rule": rule, "own": verdict})
        .join(inherited, "node", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("own", "inherited", F.lit("allow")).alias("verdict"))
    )


def op10(pages: DataFrame) -> DataFrame:
    return judge(pages)
