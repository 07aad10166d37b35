"""Allow and block lists for urls in one trie: host labels from the right, then path segments.

The trie is built from the rules on the driver, sent to the tasks with the function, and walked once
for each url; the longest fitting rule wins. Its size is that of the lists. A rule fits its host, all subdomains,
and all paths that start with its path, also in the middle of a segment. The length of a rule is
the length of host and path together; of equally long rules the longer host wins, and a rule that
stands in both lists blocks.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule fits and the
verdict is the default (allow). Repeated rows are judged each by itself; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import table

QUERY = "op6_url_filter"
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


class Node:
    """Children by label or segment; rules that end here by the begin of the next segment."""

    __slots__ = ("labels", "segments", "ends")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.ends: dict[str, tuple[int, int, str, str]] = {}  # length, length of the host, verdict, rule


def build_trie(rules) -> Node:
    """Rules are (verdict, host, path that begins with a slash)."""
    root = Node()
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.labels.setdefault(label, Node())
        *whole, last = path[1:].split("/")
        for segment in whole:
            node = node.segments.setdefault(segment, Node())
        entry = (len(host) + len(path), len(host), verdict, host + path)
        node.ends[last] = max(node.ends.get(last, entry), entry)  # block is greater than allow
    return root


def longest(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """Verdict and text of the longest rule that fits."""
    best = None
    segments = path[1:].split("/") if path.startswith("/") else None
    if segments is None:
        return None
    by_host = root
    for label in [None, *reversed(host.split("."))]:
        by_host = by_host if label is None else by_host.labels.get(label)
        if by_host is None:
            break
        node = by_host
        for segment in segments:
            if node.ends:
                lengths = {len(x) for x in node.ends}
                for n in lengths:
                    if n <= len(segment) and (found := node.ends.get(segment[:n])) and (best is None or found[:2] > best[:2]):
                        best = found
            node = node.segments.get(segment)
            if node is None:
                break
    return best and best[2:]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(df: DataFrame, rules=RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict of each url; columns of these names are replaced."""
    root = build_trie(rules)
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    parts = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
            found = [longest(root, h, p) for h, p in zip(hosts, paths, strict=True)]
            rule = pa.array([f and f[1] for f in found], pa.string())
            verdict = pa.array([f[0] if f else default for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], names=[*kept, "host", "path", "rule", "verdict"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema), "rule string", "verdict string"])
    return parts.mapInArrow(judge, schema)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH u AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(r.verdict, length(h || p)) AS verdict
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(f.verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (page_id)
"""
