"""URL filter: a trie over reversed host labels, then over path segments, with the longest match.

A rule is (host, path, action). It fits a URL whose host is the rule's host or lies below it and
whose path starts with the rule's path. Of the fitting rules the longest decides: the one with
more host labels, then the one with the longer path; of an allow and a block entry for the same
host and path, block holds. URLs that no rule fits get the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import LOWER, UPPER, column_or, ready, table

#: Rules that are broadcast as a trie at most (some 100 bytes each); more are joined, see ``filter_urls``.
MAX_TRIE_RULES = 500_000

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


class Trie:
    """Nodes are dicts: host labels and whole path segments lead to child nodes.

    A rule's last path segment is only a prefix of the URL's, so it lies in the node's ``ends``:
    length of the prefix -> prefix -> (rule, action).
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = _node()
        for host, path, action in rules:
            at = self.root
            for label in reversed(host.split(".")):
                at = at["labels"].setdefault(label, _node())
            at = at["paths"]
            *whole, last = path.split("/")
            for segment in whole:
                at = at["segments"].setdefault(segment, _path_node())
            ends = at["ends"].setdefault(len(last), {})
            if last not in ends or action == "block":
                ends[last] = (host + path, action)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits, or None."""
        best, at = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            at = at["labels"].get(label)
            if at is None:
                break
            found = _longest(at["paths"], segments)
            if found is not None:
                best = found
        return best


def _path_node() -> dict:
    return {"segments": {}, "ends": {}}


def _node() -> dict:
    return {"labels": {}, "paths": _path_node()}


def _longest(at: dict, segments: list[str]):
    best = None
    for segment in segments:
        for size in sorted(at["ends"], reverse=True):
            if len(segment) >= size and (found := at["ends"][size].get(segment[:size])):
                best = found
                break
        at = at["segments"].get(segment)
        if at is None:
            break
    return best


def split_url(url):
    """Columns host, path: the host follows the first ``://``, A-Z lower-cased; both empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """All columns of ``pages`` plus host, path, rule, verdict (same-named columns are replaced).

    ``rules`` has host, path, action (allow or block); rows with a NULL in them are left out, hosts
    are lower-cased. Up to MAX_TRIE_RULES rules travel as a broadcast trie in one narrow pass. A
    longer list is joined instead: each page offers its (host suffix, path prefix) keys, only for
    prefix lengths that occur in rules, and the longest hit is kept.

    NULL and empty URLs, and URLs without ``://``, have an empty host and path and fit no rule.
    Repeated rows are judged one by one; an empty table or an empty rule list is fine.
    """
    ready(pages.sparkSession)
    host, path = split_url(column_or(pages, "url", "string"))
    out = pages.withColumn("host", host).withColumn("path", path)
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "action").dropna()
    some = rules.limit(MAX_TRIE_RULES + 1).collect()
    if len(some) <= MAX_TRIE_RULES:
        judged = _by_trie(out, Trie([tuple(r) for r in some]))
    else:
        judged = _by_join(out, rules)
    return judged.withColumn("rule", F.col("_judged.rule")) \
        .withColumn("verdict", F.coalesce("_judged.action", F.lit(default))).drop("_judged")


def _by_trie(pages: DataFrame, trie: Trie) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(trie)

    @F.arrow_udf("rule string, action string")
    def judge(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = [shared.value.match(h, p) or (None, None)
                 for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array([r for r, _ in found], pa.string()),
                                           pa.array([a for _, a in found], pa.string())], ["rule", "action"])

    return pages.withColumn("_judged", judge("host", "path"))


def _by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by an equi-join on distinct (host, path) pairs of the pages."""
    one = rules.groupBy("host", "path").agg(F.max("action").alias("action"))  # block sorts after allow
    lengths = sorted(r[0] for r in one.select(F.length("path")).distinct().collect())  # at most the longest path
    urls = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    offers = (urls.withColumn("_l", labels)
              .withColumn("_i", F.explode(F.sequence(F.lit(1), F.size("_l"))))
              .withColumn("_h", F.array_join(F.slice("_l", F.col("_i"), F.size("_l")), "."))
              .withColumn("_n", F.explode(F.filter(F.array(*[F.lit(n) for n in lengths]),
                                                   lambda n: n <= F.length("path"))))
              .withColumn("_p", F.substring(F.col("path"), F.lit(1), F.col("_n"))))
    hits = offers.join(one.toDF("_h", "_p", "action"), ["_h", "_p"])
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("_h", "_p").alias("rule"), "action"), F.struct(-F.col("_i"), "_n")).alias("_judged"))
    return pages.join(best, ["host", "path"], "left")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages``."""
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(rhost, rpath, action) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (
  SELECT page_id, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT parts.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN fit ON fit.page_id = parts.page_id AND fit.k = 1
"""
