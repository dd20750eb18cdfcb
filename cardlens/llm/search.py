"""Ranked lexical search: MaxScore over blocks, with bounds from precomputed term-pair intersection lists.

The index holds every term of every document, cut into blocks of at most BLOCK_DOCS documents and
about BLOCK_BYTES of text. A row is one term of one block: its documents and how often each holds it.

For a set of queries the postings of their terms get integer impacts, and each query's terms are
paired. For every block and pair the intersection list is computed once: the documents that hold
both terms, their joint impacts and the largest of them. A block is then searched query by query:

* A pair adds to a score at most max(U_a, U_b, U_ab): the two terms' maxima and the joint maximum. Plain
  MaxScore would allow U_a + U_b. The bounds of the pairs add up to tighter bounds of sets of terms.
* Pairs are taken in order of their bounds. Those whose bounds together stay below the score that
  the query's k-th best document is known to reach are not essential: no document that holds only
  such terms can enter, so their postings are not walked.
* Where the first essential pair is essential only through its joint maximum, its candidates are
  the documents of its intersection list, not those of the two postings.
* The rest is looked up only for the candidates that the remaining bounds still let in.

Blocks are searched in waves: one in 4,096 (by hash), one in 256, one in 16, the rest. The k-th best
scores found so far are a wave's thresholds, so most blocks end at their bounds, and a wave hands on about
16 k documents a query, however many blocks it has. Skipping is by bounds alone; results are exact.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.llm.common import ALNUM_TABLE, as_bytes, column_or, materialise, ready, table, words

BLOCK_DOCS = 4096
BLOCK_BYTES = 16 << 20
#: Queries are answered in batches of about so many terms (all of a batch's queries travel to every task).
BATCH_TERMS = 100_000
#: One block in so many belongs to the first wave, or to one of the first two, and so on.
WAVES = (4096, 256, 16, 1)

POSTINGS = "block long, term binary, docs array<int>, counts array<int>, df int"
POSTINGS_ARROW = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("docs", pa.list_(pa.int32())),
                            ("counts", pa.list_(pa.int32())), ("df", pa.int32())])


# --- index ---------------------------------------------------------------------------------------

@dataclass
class Index:
    """postings: POSTINGS; lengths: the doc_ids and lengths of each block's documents, by place."""

    postings: DataFrame
    lengths: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> Index:
    """Index every term of every row of ``docs`` (doc_id, text); other columns are not read.

    A block ends at ``block_docs`` documents, or with the document that brings it to ``block_bytes``.

    Terms are runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased. Rows that
    repeat a doc_id are documents of their own. NULL, empty and blank texts hold no terms.
    """
    ready(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        base, at = TaskContext.get().partitionId() << 32, 0
        block = _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                block.add(doc_id, text)
                if len(block.ids) >= block_docs or block.size >= block_bytes:
                    yield from block.rows(base + at)
                    block, at = _Block(), at + 1
        yield from block.rows(base + at)

    thin = docs.select(column_or(docs, "doc_id", "long").alias("doc_id"), column_or(docs, "text", "string").alias("text"))
    # a row without a term carries the block's documents: their ids and lengths
    every = materialise(thin.mapInArrow(run, POSTINGS + ", ids array<long>"), "search-postings")
    heads = every.where("term IS NULL")
    total = heads.select(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n).alias("l"),
                         F.size(F.filter("counts", lambda n: n > 0)).alias("n")).agg(F.sum("n"), F.sum("l")).first()
    return Index(every.where("term IS NOT NULL").select("block", "term", "docs", "counts", "df"),
                 heads.select("block", "ids", "counts"), int(total[0] or 0), int(total[1] or 0))


class _Block:
    """Postings of the documents added so far."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.terms: list[int] = []
        self.tfs: list[int] = []
        self.distinct: list[int] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found = words(text, ALNUM_TABLE)
        counts = Counter(found)
        code = self.vocabulary.setdefault
        self.terms += [code(t, len(self.vocabulary)) for t in counts]
        self.tfs += counts.values()
        self.distinct.append(len(counts))
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        self.size += len(text or b"")

    def rows(self, block: int):
        if not self.ids:
            return
        schema = POSTINGS_ARROW.append(pa.field("ids", pa.list_(pa.int64())))
        yield pa.RecordBatch.from_pydict({
            "block": [block], "term": [None], "docs": [None], "counts": [self.lengths], "df": [len(self.ids)],
            "ids": [self.ids]}, schema=schema)
        if not self.terms:
            return
        terms, tfs = np.array(self.terms, np.int32), np.array(self.tfs, np.int32)
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.distinct)
        order = np.argsort(terms, kind="stable")
        df = np.bincount(terms, minlength=len(self.vocabulary))
        ends = np.concatenate(([0], np.cumsum(df)))
        names = list(self.vocabulary)
        docs, tfs = docs[order], tfs[order]
        for a in range(0, len(names), 50_000):
            b = min(a + 50_000, len(names))
            cut = slice(ends[a], ends[b])
            offsets = pa.array(ends[a:b + 1] - ends[a], pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(b - a, block)), pa.array(names[a:b], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(docs[cut])),
                pa.ListArray.from_arrays(offsets, pa.array(tfs[cut])),
                pa.array(df[a:b].astype(np.int32)), pa.nulls(b - a, pa.list_(pa.int64()))], schema=schema)


# --- weights, impacts, pairs -----------------------------------------------------------------------

def query_terms(queries: DataFrame) -> DataFrame:
    """item_id, term: the distinct terms of each query (item_id, text)."""
    low = F.translate(column_or(queries, "text", "string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))
    return queries.select(column_or(queries, "item_id", "long").alias("item_id"),
                          F.explode(F.array_distinct(found)).alias("term")) \
        .select("item_id", F.col("term").cast("binary").alias("term")).distinct()


def weights(index: Index, terms: DataFrame) -> DataFrame:
    """term, w of the ``terms`` that occur: floor(1000 * ln((2N + 2) / (2df + 1)))."""
    wanted = materialise(terms.select("term").distinct(), "search-terms")
    df = index.postings.select("term", "df").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1)
    return df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))


def impacts(w: int, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of weight ``w`` adds to the scores of documents of ``n`` terms that hold it ``tf`` times."""
    m = 50 + (50 * n * n_docs) // n_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def paired(terms: list[tuple[bytes, int]]) -> list[tuple[bytes, ...]]:
    """A query's terms, lightest first, two by two; an odd one stays single.

    Neighbours have about the same weight, so a pair is wholly essential or wholly not, as a rule.
    """
    names = [t for t, _ in sorted(terms, key=lambda x: (x[1], x[0]))]
    return [tuple(names[i:i + 2]) for i in range(0, len(names), 2)]


@dataclass
class Unit:
    """A pair of terms (or one term) in a block: postings, largest impacts, the intersection list."""

    lists: list[tuple[np.ndarray, np.ndarray]]
    alone: int = 0
    both: int = 0
    common: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))

    @property
    def bound(self) -> int:
        return max(self.alone, self.both)


def intersect(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The documents of both postings and their largest joint impact (0 if there is none)."""
    common, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return common, int((a[1][x] + b[1][y]).max()) if len(common) else 0


def best_of_block(units: list[Unit], n: int, k: int, least: int, joint: bool = True,
                  walked: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the documents of a block that can be among the ``k`` best and reach ``least``.

    Every document that a caller needs is among them: those of the ``k`` highest scores of the block,
    ties with the k-th included, as far as they reach ``least``. ``joint=False`` uses the terms' own
    maxima only (U_a + U_b); ``walked`` collects how many postings were read.
    """
    units = sorted(units, key=lambda u: u.bound if joint else sum(int(x.max()) for _, x in u.lists))
    bounds = [u.bound if joint else sum(int(x.max()) for _, x in u.lists) for u in units]
    upto = np.concatenate(([0], np.cumsum(bounds))).astype(np.int64)
    first = int(np.searchsorted(upto[1:], least))  # units before this one are not essential
    if first == len(units):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    acc = np.zeros(n, np.int64)
    read = 0
    held = np.zeros(n, bool)
    for at in range(len(units) - 1, first - 1, -1):
        unit = units[at]
        if at == first and joint and upto[at] + unit.alone < least:
            # essential only where both terms meet: the rest of the two lists is left for the lookup
            held[unit.common] = True
            read += len(unit.common)
            first += 1
            break
        for docs, gain in unit.lists:
            acc[docs] += gain
            held[docs] = True
            read += len(docs)
    places = np.flatnonzero(held)
    for at in range(first - 1, -1, -1):
        least = max(least, _kth(acc[places], k))
        places = places[acc[places] + upto[at + 1] >= least]
        for docs, gain in units[at].lists:
            where = np.searchsorted(docs, places)
            where[where == len(docs)] = 0
            here = docs[where] == places
            acc[places[here]] += gain[where[here]]
            read += len(places)
    scores = acc[places]
    keep = scores >= max(least, _kth(scores, k))
    if walked is not None:
        walked.append(read)
    return places[keep], scores[keep]


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


# --- search ----------------------------------------------------------------------------------------

FOUND = "item long, doc_id long, score long"
FOUND_ARROW = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def search(index: Index, queries: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: each query's ``k`` highest-scoring documents with a score above 0.

    Equal scores by ascending doc_id (NULL last). Queries without text or without a term of the
    index have no row; rows that repeat an item_id are one query of the terms of all of them.
    An empty index or an empty list of queries gives an empty result.
    """
    spark = queries.sparkSession
    ready(spark)
    terms = materialise(query_terms(queries), "search-queries")
    w = materialise(weights(index, terms), "search-weights")
    weighted = materialise(terms.join(w, "term"), "search-weighted")
    found = None
    for batch in _batches(weighted):
        part = _answer(index, weighted, batch, k)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def _batches(weighted: DataFrame) -> list[tuple]:
    """Ranges (low, high) of item_id (low exclusive) of about BATCH_TERMS terms each, and NULL items."""
    sizes = weighted.where("item_id IS NOT NULL").groupBy("item_id").agg(F.count("*").alias("n"))
    total = weighted.agg(F.count("*"), F.count("item_id")).first()
    cuts = -(-total[1] // BATCH_TERMS)
    out = [(None, None)] if total[0] > total[1] else []
    if not cuts:
        return out
    # a cut per batch of terms; a query is never cut itself
    edges = sizes.select("item_id", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))).agg(
        F.percentile_approx("item_id", [(i + 1) / cuts for i in range(cuts)], 100 * cuts)).first()[0]
    low = None
    for high in sorted(set(edges[:-1])):
        out.append((low, high))
        low = high
    return [*out, (low, float("inf"))]


def _answer(index: Index, weighted: DataFrame, batch: tuple, k: int) -> DataFrame:
    spark = weighted.sparkSession
    low, high = batch
    mine = weighted.where("item_id IS NULL") if high is None else weighted.where(
        (F.col("item_id") > F.lit(low) if low is not None else F.col("item_id").isNotNull())
        & (F.col("item_id") <= F.lit(high) if high != float("inf") else F.lit(True)))
    rows = mine.collect()  # at most about BATCH_TERMS
    items: dict[int | None, list] = {}
    weight = {}
    for r in rows:
        items.setdefault(r.item_id, []).append((bytes(r.term), r.w))
        weight[bytes(r.term)] = r.w
    order = sorted(items, key=lambda i: (i is None, i or 0))
    plan = [paired(items[i]) for i in order]
    shared = spark.sparkContext.broadcast((weight, plan))
    wanted = materialise(mine.select("term").distinct(), "search-batch")
    lists = index.postings.join(wanted, "term", "left_semi")
    # one table for every pass: a block's documents, then its lists with their impacts and pairs
    heads = index.lengths.select("block", F.lit(None).cast("binary").alias("term"), F.col("ids").alias("docs"), "counts")
    ready_lists = materialise(
        lists.select("block", "term", F.col("docs").cast("array<long>").alias("docs"), "counts").union(heads)
        .groupBy("block").applyInArrow(_scored_lists(shared, index.n_docs, index.n_terms), LISTS), "search-lists")

    digits = F.pmod(F.xxhash64("block"), F.lit(WAVES[0]))
    found, least = None, [1] * len(order)
    for before, wave in zip((None, *WAVES), WAVES):
        these = (digits % wave == 0) if before is None else (digits % wave == 0) & (digits % before != 0)
        blocks = ready_lists.where(these)
        if wave > 1 and blocks.isEmpty():
            continue
        floors = spark.sparkContext.broadcast(least)
        part = materialise(blocks.groupBy("block").applyInArrow(_searched(shared, floors, k), FOUND), "search-found")
        # only the k best so far go on
        found = materialise(_ranked(part if found is None else found.union(part), k).drop("rank"), "search-best")
        if wave > 1:
            kth = found.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least"))  # one row a query
            reached = {r.item: r.least for r in kth.where(F.col("n") == k).collect()}
            least = [reached.get(i, 1) for i in range(len(order))]
    names = spark.createDataFrame(list(enumerate(order)), "item int, item_id long")
    return (_ranked(found, k).join(F.broadcast(names), "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


#: kind 0: the documents' ids; 1: a term's postings with impacts; 2: an intersection list, ``high`` its joint maximum.
LISTS = "block long, kind int, a binary, b binary, docs array<long>, gains array<long>, high long"
LISTS_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()),
                         ("docs", pa.list_(pa.int64())), ("gains", pa.list_(pa.int64())), ("high", pa.int64())])


def _numbers(column, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def _scored_lists(shared, n_docs: int, n_terms: int):
    """For each block: impacts of its postings, and the intersection lists of the queries' pairs."""

    def run(rows: pa.Table) -> pa.Table:
        weight, plan = shared.value
        rows = rows.combine_chunks()
        block = rows["block"][0].as_py()
        names = rows["term"].to_pylist()
        head = names.index(None)
        lengths = _numbers(rows["counts"], head).astype(np.int64)
        out = [(block, 0, None, None, rows["docs"][head].as_py(), None, None)]
        held = {}
        for i, name in enumerate(names):
            if name is not None:
                docs = _numbers(rows["docs"], i)
                gains = impacts(weight[name], _numbers(rows["counts"], i).astype(np.int64), lengths[docs], n_docs, n_terms)
                held[name] = docs, gains
                out.append((block, 1, name, None, docs, gains, int(gains.max())))
        for a, b in sorted({u for units in plan for u in units if len(u) == 2 and u[0] in held and u[1] in held}):
            common, high = intersect(held[a], held[b])
            out.append((block, 2, a, b, common, None, high))
        columns = zip(*out, strict=True)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, LISTS_ARROW, strict=True)],
                                    schema=LISTS_ARROW)

    return run


def _searched(shared, floors, k: int):
    """For each block: the documents that can be among the ``k`` best of a query (item is its number)."""

    def run(rows: pa.Table) -> pa.Table:
        _, plan = shared.value
        rows = rows.combine_chunks()
        kinds, a, b, high = (rows[c].to_pylist() for c in ("kind", "a", "b", "high"))
        postings, joint, ids = {}, {}, None
        for i, kind in enumerate(kinds):
            if kind == 0:
                ids = rows["docs"][i].as_py()
            elif kind == 1:
                postings[a[i]] = _numbers(rows["docs"], i), _numbers(rows["gains"], i), high[i]
            else:
                joint[a[i], b[i]] = _numbers(rows["docs"], i), high[i]
        out = [[], [], []]
        for item, units in enumerate(plan):
            here = []
            for names in units:
                found = [postings[t] for t in names if t in postings]
                if found:
                    unit = Unit([(docs, gains) for docs, gains, _ in found], max(h for _, _, h in found))
                    if len(found) == 2:
                        unit.common, unit.both = joint[names]
                    here.append(unit)
            places, scores = best_of_block(here, len(ids), k, floors.value[item])
            out[0] += [item] * len(places)
            out[1] += [ids[p] for p in places.tolist()]
            out[2] += scores.tolist()
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=FOUND_ARROW)

    return run


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of all ``documents`` for every ``benchmark`` item."""
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), 50)


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
total AS (SELECT count(*) FILTER (WHERE len(ws) > 0) AS nd, sum(len(ws))::BIGINT AS nl FROM words),
tf AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM words),
postings AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM tf GROUP BY doc_id, term),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weight AS (
  SELECT term, floor(1000 * ln((2.0 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, total GROUP BY term, nd),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nl))))::BIGINT AS score
  FROM items JOIN weight USING (term) JOIN postings USING (term), total GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
