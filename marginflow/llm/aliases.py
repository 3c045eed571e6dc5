"""URL filters with redirect equivalence; DataFrame expressions only.

Rules.  A rule (host, path, allow or block) fits a URL whose host is the rule's or below it and whose
path starts with the rule's; the longest wins.  Rules meet the distinct hosts, each under all its
suffixes, so a page meets one row: its host's rules, longest first.

Aliases.  Canonical links and redirects (``<link rel="canonical">``, ``<meta http-equiv="refresh">`` in
a page, or given pairs of URLs) make edges between addresses: a URL without its scheme and fragment,
its host lower-cased.  Connected components over these edges are sets of aliases.  A URL without a
rule of its own takes its aliases' decision: allow where any alias is explicitly allowed, else block
where any is blocked.  Link targets decide too, whether or not they are pages here.

Addresses with an edge are numbered once, in a written table, and components are computed over these
numbers by grouping and joins (``components.py``); a component's decisions are combined before they
meet its members again.  Both sides of each join are written tables, so Spark splits the partition of
an address, host or component that holds a large share of the rows.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule and no alias;
a null or empty page links to nothing; of rules of equal length allow wins, then the first in the
alphabet; repeated pages each have their row; a page that is very long is searched whole; no pages
give no rows, no rules allow everything; columns beside those named are not read, whatever their
names.  Dot segments and percent escapes of link targets are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none or the URL is null."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host(url: Column) -> Column:
    return _lower(F.regexp_extract(rest(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """A URL without scheme and fragment, its host lower-cased; null where it has no host."""
    own = host(url)
    return F.when(own != "", F.concat(own, F.regexp_extract(rest(url), r"^[^/?#]*([^#]*)", 1)))


def _attribute(tag: Column, name: str) -> Column:
    found = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.replace(F.concat(*[F.regexp_extract(tag, found, i) for i in (1, 2, 3)]), F.lit("&amp;"), F.lit("&"))


def targets(html: Column) -> Column:
    """Canonical links and redirects that a page names, as written there."""
    shown = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    tags = lambda kind: F.regexp_extract_all(shown, F.lit(rf"(?i)<{kind}\s[^<>]*"), F.lit(0))
    links = F.transform(F.filter(tags("link"), lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")),
                        lambda t: _attribute(t, "href"))
    moved = F.transform(F.filter(tags("meta"), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"),
                        lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1))
    named = F.filter(F.transform(F.concat(links, moved), F.trim), lambda x: x != "")
    return F.when(F.rlike(html, F.lit(r"(?i)canonical|refresh")), named).otherwise(F.array().cast("array<string>"))


def resolve(target: Column, url: Column) -> Column:
    """The URL that ``target`` names on a page at ``url``; null where it names none."""
    here, own = F.concat(F.lit("://"), host(url)), path(url)
    folder = F.when(own == "", "/").otherwise(F.regexp_extract(own, r"(?s)^(.*/)", 1))
    return (F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), target)
            .when(F.startswith(target, F.lit("//")), F.concat(F.lit(":"), target))
            .when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")) | F.startswith(target, F.lit("#")) | (host(url) == ""), F.lit(None))
            .when(F.startswith(target, F.lit("/")), F.concat(here, target))
            .when(F.startswith(target, F.lit("?")), F.concat(here, own, target))
            .otherwise(F.concat(here, folder, target)))


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: those that fit the host, the winning one first."""
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    told = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("start"), "verdict",
        F.concat("host", "path").alias("rule")).distinct()
    met = hosts.where("host <> ''").distinct().select("host", suffix.alias("suffix")).join(told, "suffix")
    order = F.struct((-F.length("rule")).alias("longest"), "verdict", "rule", "start")  # allow comes before block
    return met.groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("rules"))


def _judged(rows: DataFrame, rules: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` (with host and path) and the ``rule`` and ``own`` verdict of each, null where none fits."""
    found = scratch.table(f"{name}_rules", _host_rules(rows.select("host"), rules))
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["start"])), F.lit(0))
    return (rows.join(found, "host", "left").withColumn("_fit", fits)
            .select(*rows.columns, F.col("_fit.rule").alias("rule"), F.col("_fit.verdict").alias("own")))


def decide(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, id_col: str = "page_id",
           url_col: str = "url", html_col: str | None = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, reason`` of every page.

    ``rules`` has ``host, path, verdict``; ``links`` further edges as URLs ``source, target`` (a
    crawler's redirects).  ``reason`` is ``rule``, ``alias`` or ``default``.
    """
    scratch, url = Scratch(pages.sparkSession, "aliases"), F.col(url_col)
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        _lower(F.col("host")).alias("host"), "path", "verdict")
    named = (F.transform(F.coalesce(targets(F.col(html_col)), F.array().cast("array<string>")), lambda t: address(resolve(t, url)))
             if html_col else F.array().cast("array<string>"))
    rows = scratch.table("pages", pages.select(
        F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"),
        address(url).alias("address"), named.alias("named")))

    edges = rows.where("address is not null").select(F.col("address").alias("a"), F.explode("named").alias("b"))
    if links is not None:
        edges = edges.union(links.select(address(F.col("source")), address(F.col("target"))))
    edges = scratch.table("edges", edges.where("a <> b").distinct())
    ends = edges.select(F.col("a").alias("address")).union(edges.select(F.col("b").alias("address"))).distinct()
    nodes = scratch.table("nodes", ends.select(
        "address", F.monotonically_increasing_id().alias("node"),
        host(F.concat(F.lit("://"), "address")).alias("host"), path(F.concat(F.lit("://"), "address")).alias("path")))
    number = lambda end: nodes.select(F.col("address").alias(end), F.col("node").alias(f"node_{end}"))
    linked = edges.join(number("a"), "a").join(number("b"), "b").select("node_a", "node_b")
    member = components(linked, scratch, "node_a", "node_b")
    own = _judged(nodes, rules, scratch, "nodes").join(member, "node", "left").select(
        "address", F.coalesce("component", "node").alias("component"), "own")
    own = scratch.table("members", own)
    decided = scratch.table("decisions", own.where("own is not null").groupBy("component").agg(F.min("own").alias("alias")))
    alias = scratch.table("aliases", own.join(decided, "component").select("address", "alias"))

    judged = _judged(rows.select("page_id", "host", "path", "address"), rules, scratch, "pages").join(alias, "address", "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("own", "alias", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("alias").isNotNull(), "alias").otherwise("default").alias("reason"))
