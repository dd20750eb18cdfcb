"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the 13-word windows of the benchmark items (an item of fewer words is one pattern).
Patterns of one length share a table set. The search looks at the block of the last two words
(one word for one-word patterns) under the window: the shift table says how far the window may
move without passing an occurrence, and a shift of zero leads to the suffix bucket of that block,
where the pattern's first block selects the test strings and a direct comparison confirms.
Documents stay where they are: only the tables travel.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import as_bytes, column_or, materialise, ready, table, words

WINDOW = 13
#: Bytes of benchmark text in one table set. More text makes more sets, searched one after another.
SHARD_BYTES = 8_000_000


class WuManber:
    """Tables for patterns of one length (lists of words), each with the items it stands for."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[int]]):
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.reach = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict] = {}
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b:end]
                self.shift[key] = min(self.shift.get(key, self.reach), m - end)
            first = self.buckets.setdefault(p[m - b:], {}).setdefault(p[:b], [])
            first.append((list(p), tuple(sorted(items))))

    def search(self, w: list[bytes]):
        """(start, items) of every occurrence, in order."""
        m, b, reach = self.length, self.block, self.reach
        shift, buckets = self.shift.get, self.buckets
        i, n = m, len(w)
        while i <= n:
            key = (w[i - 2], w[i - 1]) if b == 2 else (w[i - 1],)
            s = shift(key, reach)
            if s:
                i += s
                continue
            start = i - m
            for p, items in buckets[key].get(tuple(w[start:start + b]), ()):
                if w[start:i] == p:
                    yield start, items
            i += 1


def build_tables(items: list[tuple[int, bytes]]) -> list[WuManber]:
    """One table set for each pattern length among the items (id, UTF-8 text)."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = words(text)
        m = min(WINDOW, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            by_length[m][tuple(w[i:i + m])].add(item)
    return [WuManber(p) for _, p in sorted(by_length.items())]


def _shards(benchmark: DataFrame):
    """Table sets of at most about SHARD_BYTES of text each; items stream by, one shard at a time."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), column_or(benchmark, "text", "string")).dropna()
    for item, text in rows.toLocalIterator():
        raw = text.encode("utf-8", "surrogatepass")
        held.append((item, raw))
        size += len(raw)
        if size >= SHARD_BYTES:
            yield build_tables(held)
            held, size = [], 0
    if held:
        yield build_tables(held)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_FOUND = "n_words long, spans array<struct<s:int,e:int>>, items array<long>"


def find_occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` plus ``_hits``: struct(n_words, spans of hit words [s, e), sorted item ids).

    One row per row of ``docs``, all its columns kept. Words are runs of ASCII letters (A-Z
    lower-cased), digits and all characters beyond ASCII. NULL or wordless text has no hits;
    items without words or id are no patterns; items with the same id count once.
    """
    spark = docs.sparkSession
    ready(spark)
    text = column_or(docs, "text", "string")
    empty = F.array().cast("array<struct<s:int,e:int>>")
    out = docs.withColumn("_hits", F.struct(F.lit(None).cast("long").alias("n_words"), empty.alias("spans"),
                                            F.array().cast("array<long>").alias("items")))
    first = True
    for tables in _shards(benchmark):
        shared = spark.sparkContext.broadcast(tables)
        if not first:
            out = materialise(out, "decontaminate")  # one table set at a time in a worker
        out = out.withColumn("_hits", _search(shared)(text, F.col("_hits")))
        first = False
    if first:
        out = out.withColumn("_hits", _search(spark.sparkContext.broadcast([]))(text, F.col("_hits")))
    return out


def _search(shared):
    @F.arrow_udf(_FOUND)
    def search(text: pa.Array, before: pa.Array) -> pa.Array:
        out = []
        for raw, was in zip(as_bytes(text), before.to_pylist(), strict=True):
            w = words(raw)
            spans = [(x["s"], x["e"]) for x in was["spans"]]
            items = set(was["items"])
            for t in shared.value:
                for start, found in t.search(w):
                    if spans and spans[-1][0] <= start <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], start + t.length))
                    else:
                        spans.append((start, start + t.length))
                    items.update(found)
            out.append({"n_words": len(w), "spans": [{"s": s, "e": e} for s, e in _union(spans)],
                        "items": sorted(items)})
        return pa.array(out, pa.struct([("n_words", pa.int64()),
                                        ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                                        ("items", pa.list_(pa.int64()))]))
    return search


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items_sha256, contaminated (same-named columns are replaced).

    A document is contaminated where n_hit > 0 and share * n_hit >= n_words.
    """
    found = find_occurrences(docs, benchmark)
    n_hit = F.aggregate("_hits.spans", F.lit(0).cast("long"), lambda a, x: a + (x["e"] - x["s"]).cast("long"))
    ids = F.array_join(F.array_sort(F.transform("_hits.items", lambda x: x.cast("string"))), ",")
    return (found.withColumn("n_words", F.col("_hits.n_words"))
            .withColumn("n_hit", n_hit)
            .withColumn("n_items", F.size("_hits.items").cast("long"))
            .withColumn("items_sha256", F.sha2(ids.cast("binary"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
            .drop("_hits"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were."""
    keep = "__contaminated"
    found = contamination(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                                      column_or(docs, "text", "string").alias("text")), benchmark)
    return found.withColumnRenamed("contaminated", keep).where(~F.col(keep)).select("_row.*")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against all of ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items_digest(items) -> str:
    """The digest column's rule in Python (for tests): sorted as strings, comma-joined, SHA-256."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


OP2_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
pat AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, w[i : i + least(13, len(w)) - 1] AS p
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM pat),
win AS (
  SELECT doc_id, m, i, w[i : i + m - 1] AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lens WHERE len(w) >= m)),
occ AS (SELECT win.doc_id, win.i, win.m, pat.item_id FROM win JOIN pat ON win.m = pat.m AND win.p = pat.p),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM (SELECT DISTINCT doc_id, i, m FROM occ)) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
SELECT dw.doc_id, CAST(coalesce(len(dw.w), 0) AS BIGINT) AS n_words,
       CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= coalesce(len(dw.w), 0) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
