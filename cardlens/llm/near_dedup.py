"""Near-duplicate classes by an inverted join over MinHash signature coordinates.

1. Each text becomes its set of word shingles and a signature of ``coords`` minimum values.
   Texts with the same set form one class; only one signature per class goes on.
2. Every class is posted under each coordinate-value pair. A value held by one class alone can
   not collide, so only shared values stay, and a class with fewer than ``need`` shared values
   can match nobody and leaves.
3. Two classes that agree in ``need`` of ``coords`` coordinates agree in at least one of the
   ``coords - need + 1`` rarest values of each (prefix): only those are looked up. A value of a
   passage that very many documents share is common, so it falls outside the prefixes of
   documents that have little else in common.
4. Merging with skips: first every class is held against the leader of its lists that it shares
   most postings with, and linked classes merge. A list is led by its most central member, the
   one whose values are shared most, as the original among its variants. A list whose members
   all belong to one component is skipped for good, and so is a member that has too few shingles
   in common with all other components together. In the lists that still hold several
   components, the pairs across components are counted on a longer signature, in blocks of about
   ``block`` members by ``block`` members, and pairs above the match threshold are retained.
5. Retained pairs are confirmed on the full shingle sets, so a link is never an estimate.

``need`` lies ``sigmas`` standard deviations below the expected number of collisions of a pair
exactly at the threshold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import (SPACE_TABLE, WordHasher, as_bytes, column_or, materialise, mix, ready,
                                 shingles, table)
from cardlens.llm.components import components

#: Rows of bare ids that may be broadcast (about 50 MB in a hash table); beyond that the join shuffles.
BROADCAST_IDS = 2_000_000
#: Coordinates of the signature that the last blocks are counted on.
FINE = 1024


def _need(coords: int, percent: int, sigmas: float) -> int:
    """Collisions that a pair at the threshold falls short of by chance once in many thousand times."""
    p = percent / 100
    return max(1, math.floor(coords * p - sigmas * math.sqrt(coords * p * (1 - p))))


def _coefficients(coords: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix(np.arange(1, coords + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) | np.uint64(1)
    b = mix(np.arange(1, coords + 1, dtype=np.uint64) + np.uint64(seed * 7_000_003 + 17))
    return a, b


def _signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 1024):
            low = np.minimum(low, (s[i:i + 1024, None] * a + b).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signatures(docs: DataFrame, k_words: int, coords: int, seed: int) -> DataFrame:
    """doc_id, n, digest (of the whole set), sig (empty for an empty set)."""
    a, b = _coefficients(coords, seed)

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            ns, digests, sigs, cuts = [], [], [], [0]
            for text in as_bytes(batch.column("text")):
                s = shingles(hasher(text, SPACE_TABLE), k_words)
                ns.append(len(s))
                two = np.array([np.bitwise_xor.reduce(mix(s)), mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64)])
                digests.append(two.tobytes())
                if len(s):
                    sigs.append(_signature(s, a, b))
                cuts.append(cuts[-1] + (coords if len(s) else 0))
            flat = np.concatenate(sigs) if sigs else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))],
                ["doc_id", "n", "digest", "sig"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, sig array<int>")


def _sets(docs: DataFrame, k_words: int) -> DataFrame:
    """node, items: the full shingle set of each row."""

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            found = [shingles(hasher(t, SPACE_TABLE), k_words).view(np.int64) for t in as_bytes(batch.column("text"))]
            cuts = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))],
                ["node", "items"])

    return docs.mapInArrow(run, "node long, items array<long>")


def _small(ids: DataFrame) -> DataFrame:
    """A written table of ids, broadcast up to BROADCAST_IDS so that what joins it need not move."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b whose full sets have 100 * intersection >= percent * union.

    Ids are broadcast up to BROADCAST_IDS, so one side's sets stay where they are and of the
    other's only those named travel; beyond that all joins shuffle.
    """
    small = F.broadcast if pairs.count() <= BROADCAST_IDS else lambda x: x
    first = sets.toDF("a", "xa").join(small(pairs.select("a", "b")), "a")
    named = sets.toDF("b", "xb").join(small(pairs.select("b").distinct()), "b", "left_semi")
    both = first.join(named, "b").select("a", "b", F.size("xa").alias("na"), F.size("xb").alias("nb"),
                                         F.size(F.array_intersect("xa", "xb")).alias("i"))
    return both.where(F.col("i") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _fine(sets: DataFrame, coords: int, seed: int) -> DataFrame:
    """node, fine: a longer signature of one byte a coordinate, for the pairs that are left."""
    a, b = _coefficients(coords, seed)

    def run(batches):
        for batch in batches:
            fine = [_signature(np.array(x, np.int64).view(np.uint64), a, b).astype(np.uint8).tobytes()
                    for x in batch.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(fine, pa.binary())], ["node", "fine"])

    return sets.mapInArrow(run, "node long, fine binary")


def _blocks(active: DataFrame, fine: DataFrame, need: int, percent: int, block: int) -> DataFrame:
    """Pairs of different components whose fine signatures collide in ``need`` coordinates.

    ``active``: pv, node, comp, n, x (see ``_able``); ``fine``: node, fine. In each list the largest
    component needs no pairs of its own. It is cut into parts of about ``block`` members and the
    rest of the list likewise; a group holds one part against one part of the rest. A pair that
    shares several lists is retained in the first of them only.
    """
    sizes = materialise(
        active.groupBy("pv", "comp").agg(F.count("*").alias("c"))
        .groupBy("pv").agg(F.max(F.struct("c", "comp")).alias("big"), F.sum("c").alias("size"))
        .where(F.col("big.c") < F.col("size"))
        .select("pv", F.col("big.comp").alias("big"), F.ceil(F.col("big.c") / block).cast("int").alias("pb"),
                F.ceil((F.col("size") - F.col("big.c")) / block).cast("int").alias("pr")), "near-sizes")
    mine = F.pmod(F.xxhash64("node", "pv"), F.when(F.col("own"), F.col("pb")).otherwise(F.col("pr"))).cast("int")
    # parts of the rest count from 0, parts of the largest component from -1 down
    other = F.when(F.col("own"), F.sequence(F.lit(0), F.col("pr") - 1)).otherwise(F.sequence(-F.col("pb"), F.col("pr") - 1))
    cut = (active.join(sizes, "pv").withColumn("own", F.col("comp") == F.col("big")).withColumn("mine", mine)
           .withColumn("mine", F.when(F.col("own"), -1 - F.col("mine")).otherwise(F.col("mine")))
           .withColumn("other", F.explode(other))
           .select(F.xxhash64("pv", F.least("mine", "other"), F.greatest("mine", "other")).alias("g"),
                   (F.col("mine") < F.col("other")).alias("side"), (F.col("mine") == F.col("other")).alias("same"),
                   "pv", "node", "comp", "n", "x"))
    about = active.groupBy("node").agg(F.sort_array(F.collect_list("pv")).alias("pvs")).join(fine, "node")
    names = ["pv", "node", "comp", "n", "x", "side", "same", "pvs", "fine"]

    def compare(rows):
        pv, node, comp, n, x, side, same, pvs, sig = zip(*rows, strict=True)
        node, comp, n, x, side = map(np.array, (node, comp, n, x, side))
        sig = np.frombuffer(b"".join(sig), np.uint8).reshape(len(rows), -1)
        for i in range(len(rows) - 1):
            js = np.arange(i + 1, len(rows))
            js = js[(comp[js] != comp[i]) & (True if same[0] else side[js] != side[i])]
            most = np.minimum(x[js], x[i])
            js = js[most * 100 >= percent * (n[js] + n[i] - most)]
            if len(js):
                for j in js[(sig[js] == sig[i]).sum(axis=1) >= need]:
                    if min(set(pvs[i]) & set(pvs[j])) == pv[0]:
                        yield int(min(node[i], node[j])), int(max(node[i], node[j]))

    def batch_of(pairs):
        return pa.RecordBatch.from_pydict({"a": pa.array([p for p, _ in pairs], pa.int64()),
                                           "b": pa.array([p for _, p in pairs], pa.int64())})

    def run(batches):
        held, group = [], None
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in names]
            for g, *row in zip(batch.column("g").to_pylist(), *cols, strict=True):
                if g != group:
                    if len(held) > 1:
                        out += compare(held)
                    held, group = [], g
                held.append(row)
            yield batch_of(out)
        if len(held) > 1:
            yield batch_of(list(compare(held)))

    parts_out = int(active.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cut.join(about, "node").select("g", *names).repartition(parts_out, "g").sortWithinPartitions("g")
            .mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, *, k_words: int = 5, percent: int = 80, coords: int = 128,
                    sigmas: float = 4.0, star_rounds: int = 2, block: int = 128, seed: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Links join documents with 100 * |intersection| >= percent * |union| of their distinct
    ``k_words``-word shingles (words lie between ASCII white space, A-Z lower-cased; a text of
    fewer words is one shingle). ``component_id`` is the smallest doc_id reachable over links.

    * NULL or blank text: an empty set, linked with nothing, its own component.
    * Exact copies and repeated rows: one class, so copies are never expanded into pairs. Rows
      that repeat a doc_id with another text count as one document, linked by either text.
    * NULL doc_id: the row takes the component of its class (NULL if the class has no other id)
      and is not kept.
    * An empty table gives an empty result; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), column_or(docs, "text", "string").alias("text"))
    need = _need(coords, percent, sigmas)
    prefix = coords - need + 1

    base = materialise(_signatures(docs, k_words, coords, seed), "near-base")
    classes = materialise(
        base.where("n > 0").groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("size"), F.any_value("sig").alias("sig"))
        .where("node IS NOT NULL"), "near-classes")

    posted = classes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", F.shiftleft(F.col("at").cast("long"), 32)
        .bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("pv"))
    shared = materialise(posted.groupBy("pv").agg(F.count("*").alias("f")).where("f > 1"), "near-shared")
    front = materialise(
        posted.join(shared, "pv").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "pv"))).alias("v"))
        .where(F.size("v") >= need)
        .select("node", F.expr(f"transform(slice(v, 1, greatest(0, {prefix - coords} + size(v))), x -> x.pv)")
                .alias("pvs"), F.expr("-aggregate(v, 0D, (s, x) -> s + ln(x.f))").alias("far")), "near-front")
    lists = materialise(front.select("node", "far", F.explode("pvs").alias("pv")), "near-lists")
    edges = _linked(docs, front, lists, percent, sigmas, k_words, star_rounds, block)
    # a doc_id with several texts ties their classes together
    repeated = materialise(base.where("doc_id IS NOT NULL").groupBy("doc_id")
                           .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
                           .where("low < high").select("doc_id"), "near-repeated")
    some = not repeated.isEmpty()
    if some:
        edges = edges.union(base.where("n > 0").join(repeated, "doc_id").join(classes.select("digest", "node"), "digest")
                            .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    comps = components(edges, "near")

    named = materialise(
        classes.join(comps, "node", "left")
        .select("digest", F.least("node", F.coalesce("comp", "node")).alias("component_id"), "size", "node")
        .where("size > 1 OR component_id <> node").select("digest", "component_id"), "near-named")
    found = base.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    if some:  # also rows without a text of their own
        whole = repeated.join(comps, F.col("doc_id") == F.col("node")).select("doc_id", "comp")
        found = found.join(materialise(whole, "near-whole"), "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("comp", "component_id").alias("component_id"))
    return (found
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _linked(docs, front, lists, percent, sigmas, k_words, star_rounds, block) -> DataFrame:
    """Confirmed links between classes (a, b), enough of them for the true components."""
    spark = docs.sparkSession
    ids = front.select(F.col("node").alias("doc_id")).distinct()
    if front.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = materialise(_sets(docs.join(ids, "doc_id", "left_semi"), k_words), "near-sets")

    none = spark.createDataFrame([], "a long, b long")
    edges, tested = none, none
    comps = spark.createDataFrame([], "node long, comp long")
    for turn in range(star_rounds):
        members = lists.join(comps, "node", "left").select("pv", "node", "far", F.coalesce("comp", "node").alias("comp"))
        leaders = materialise(
            members.groupBy("pv").agg(F.min(F.struct("far", "node", "comp")).alias("l"),
                                      F.min("comp").alias("low"), F.max("comp").alias("high"))
            .where("low < high").select("pv", F.col("l.node").alias("leader"), F.col("l.comp").alias("led")),
            "near-leaders")
        tries = (members.join(leaders, "pv").where("comp <> led")
                 .groupBy("node", "leader").agg(F.count("*").alias("c"))
                 .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"), "node", "c")
                 .join(tested, ["a", "b"], "left_anti")
                 .groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("c", "a", "b")).alias("p")))
        tries = materialise(tries.select("p.a", "p.b").distinct(), "near-tries")
        if tries.isEmpty():
            break
        edges = materialise(edges.union(_confirmed(tries, sets, percent)), "near-edges")
        tested = tested.union(tries)
        comps = components(edges, "near-star")

    members = lists.join(comps, "node", "left").select("pv", "node", F.coalesce("comp", "node").alias("comp"))
    active = _able(members, sets, percent)
    if active.groupBy("pv").agg((F.min("comp") < F.max("comp")).alias("open")).where("open").isEmpty():
        return edges
    last = _small(materialise(active.select("node").distinct(), "near-last"))
    fine = materialise(_fine(sets.join(last, "node", "left_semi"), FINE, 77), "near-fine")
    rest = materialise(_blocks(active, fine, _need(FINE, percent, sigmas), percent, block)
                       .join(tested, ["a", "b"], "left_anti"), "near-rest")
    return materialise(edges.union(_confirmed(rest, sets, percent)), "near-edges")


def _able(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members of open lists that can still link with another component: pv, node, comp, n, x.

    Two sets of different components have at most ``x`` shingles in common, where ``x`` counts a
    set's shingles that some other component's set holds as well. So a link between sets of n and
    m needs 100 * x >= percent * (n + m - x): a member stays in a list only if that holds for the
    smallest m in it. This is a bound, not an estimate: no link is lost.
    """
    mixed = materialise(
        members.groupBy("pv").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where("low < high").select("pv"), "near-mixed")
    members = materialise(members.join(mixed, "pv", "left_semi").select("pv", "node", "comp"), "near-members")
    nodes = _small(materialise(members.select("node", "comp").distinct(), "near-nodes"))
    items = sets.join(nodes, "node").select("node", "comp", F.size("items").alias("n"), F.explode("items").alias("item"))
    crossing = materialise(
        items.groupBy("item").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where("low < high").select("item"), "near-crossing")
    able = materialise(
        items.join(crossing, "item").groupBy("node").agg(F.max("n").alias("n"), F.count("*").alias("x"))
        .where(F.col("x") * 100 >= percent * F.col("n")), "near-able")
    members = members.join(able, "node")
    least = members.groupBy("pv").agg(F.min("n").alias("m"))
    fits = F.col("x") * 100 >= percent * (F.col("n") + F.col("m") - F.col("x"))
    return materialise(members.join(materialise(least, "near-least"), "pv").where(fits).drop("m"), "near-active")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: three-word shingles, 100 * intersection >= 85 * union."""
    return near_duplicates(table(spark, sf_dir, "documents"), k_words=3, percent=85)
