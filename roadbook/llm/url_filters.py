"""Operator 13: URL rules that reach a page's aliases, through redirect equivalence.

A rule names a host and the beginning of a path; it fits the host and its
subdomains, and of the rules that fit a url the longest (host and path) decides,
of equally long ones an allowing one. Rules are a table like any other: a host's
suffixes meet them by a join over different addresses, so neither their number nor
a page's repeats matter.

Pages name other urls for themselves: a canonical link, or a refresh that sends the
reader on. Those edges, and any redirects given as a table, make urls equivalent;
Spark finds the connected components. If a rule blocks any url of a component,
fetched or only named, the component's urls are blocked. An allowing rule that fits
a url has precedence over what its aliases bring: explicitly allowed is allowed. A
url that no rule fits and no blocked alias touches is allowed.

Urls are told apart without their fragment, scheme and host in lower case; nothing
else about them is interpreted. A named url is resolved against the page's own, or
its ``base``; comments, scripts, styles, titles and other raw text name nothing.

Defined results: a url that is null or has no ``://`` has empty host and path, fits
no rule, has no aliases and is allowed; null and empty html names nothing; unfinished
tags name nothing; repeated rows are rows of their own; an empty table of pages,
rules or redirects does what it says; other columns come along only if asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship
from roadbook.llm.components import components

BLOCK, ALLOW = "block", "allow"

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NAMES_ONE = r"(?i)canonical|refresh"  # a page without either word names no alias
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(script|style|title|textarea|template|iframe|noembed|noframes|xmp)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\Z)"""
    r"""|<(link|meta|base)(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_REFRESH = re.compile(r"""\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?["']?([^"']+)""", re.I)


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, below paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def __post_init__(self):
        if self.verdict not in (BLOCK, ALLOW) or not self.host or self.host != self.host.translate(str.maketrans(_CAPITALS, _SMALL)):
            raise ValueError(f"not a rule: {self}")


def rules_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as a table ``host, path, verdict``; a long list is better read from a file of these columns."""
    return spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")


def _folded(text: Column) -> Column:
    return F.translate(text, _CAPITALS, _SMALL)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``; empty without."""
    return F.coalesce(_folded(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url as aliases are told apart; null where it has no ``://``."""
    rest = _after_scheme(url)
    scheme = F.substr(url, F.lit(1), F.locate("://", url) - 1)
    tail = F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    return F.when(rest.isNotNull(), F.concat(_folded(scheme), F.lit("://"), host_of(url), tail))


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or "").strip())
    return found


def named_urls(url: str, html: str) -> list[str]:
    """The urls that a page names for itself: canonical links and refreshes."""
    base, named = url, []
    for m in _TOKEN.finditer(html):
        if not m[2]:
            continue
        tag, attributes = m[2].lower(), _attributes(m[3])
        target = None
        if tag == "base":
            if base is url and attributes.get("href"):
                base = _joined(url, attributes["href"]) or url
        elif tag == "link" and "canonical" in attributes.get("rel", "").lower().split():
            target = attributes.get("href")
        elif tag == "meta" and attributes.get("http-equiv", "").lower() == "refresh":
            found = _REFRESH.match(attributes.get("content", ""))
            target = found and found[1].strip()
        if target and (whole := _joined(base, target)):
            named.append(whole)
    return named


def _joined(base: str, target: str) -> str | None:
    try:
        whole = urljoin(base, target)
    except ValueError:  # not a url
        return None
    return whole if "://" in whole else None


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = batch.filter(pc.fill_null(pc.match_substring_regex(batch.column(1), _NAMES_ONE), False))
        found = [(url, target) for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                 for target in named_urls(url, html)]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in range(2)], names=["a", "b"])


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a, b``: a page's url and one that it names for itself, as nodes; repeats and loops left out."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string")).where(
        F.col(url_col).contains("://") & F.col(html_col).isNotNull())
    return _as_nodes(rows.mapInArrow(_edges, "a string, b string"))


def _as_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")).where("a <> b").distinct()


def decide(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` of the different addresses that a rule fits: the longest one's."""
    rule = rules.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")).distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    reached = (addresses.select("host").distinct().withColumn("_suffix", F.explode(suffixes))
               .join(rule, F.col("_suffix") == F.col("_host")).select("host", "_host", "_path", "_verdict"))
    fits = addresses.distinct().join(reached, "host").where(F.startswith("path", "_path"))
    text = F.concat("_host", "_path")
    longest = F.max_by(F.struct(text.alias("rule"), F.col("_verdict").alias("verdict")),
                       F.struct(F.char_length(text), F.when(F.col("_verdict") == ALLOW, 1).otherwise(0), text))
    return fits.groupBy("host", "path").agg(longest.alias("_won")).select("host", "path", "_won.*")


def judge(pages: DataFrame, rules: DataFrame | Iterable[Rule], redirects: DataFrame | None = None, url_col: str = "url",
          html_col: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The kept columns with ``host, path, rule, verdict`` for each page; ``redirects`` may add edges ``a, b`` of urls."""
    spark = pages.sparkSession
    if clash := {"host", "path", "rule", "verdict"} & set(keep):
        raise ValueError(f"{sorted(clash)} would be given twice")
    scratch = Scratch(spark, "aliases")
    if not isinstance(rules, DataFrame):
        rules = rules_table(spark, rules)
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(_as_nodes(redirects.select(F.col("a").cast("string"), F.col("b").cast("string")))).distinct()
    edges = scratch.keep(edges)
    aliases = scratch.keep(components(edges, scratch))  # node, component

    kept = {c: f"_kept{i}" for i, c in enumerate(keep)}
    url = F.col(url_col).cast("string")
    rows = pages.select(*[F.col(c).alias(k) for c, k in kept.items()], host_of(url).alias("host"), path_of(url).alias("path"),
                        node_of(url).alias("_node"))
    named = aliases.select(host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    decided = scratch.keep(decide(rows.select("host", "path").union(named), rules))

    by_rule = aliases.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")).join(
        decided.where(F.col("verdict") == BLOCK), ["host", "path"])
    blocked = aliases.join(by_rule.select("component").distinct(), "component", "left_semi").select(
        F.col("node").alias("_blocked")).distinct()
    judged = rows.join(decided, ["host", "path"], "left").join(blocked, F.col("_node") == F.col("_blocked"), "left")
    verdict = F.coalesce("verdict", F.when(F.col("_blocked").isNotNull(), BLOCK), F.lit(ALLOW))
    return judged.select(*[F.col(k).alias(c) for c, k in kept.items()], "host", "path", "rule", verdict.alias("verdict"))
