"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf; the leaves of a group (a language) form a binary tree in id order, and the
groups' roots form one more tree. Nodes are stored as a table (tree, level, idx, digest).

Leaves lie in leaf partitions of ``1 << SPAN`` consecutive ones. To prove leaves, each leaf partition

1. computes the coordinates of the nodes that the paths of all its leaves need and that it can't
   derive from the leaves themselves: the minimal union, shared by all of them (``octopus``);
2. fetches these, once, by one join with the node table;
3. derives the interiors its leaves share, and expands each leaf's own proof from them.

A whole partition of a tree of n leaves so fetches at most one node a level above its own, not one
a level and leaf.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.llm.common import column_or, materialise, ready, table

#: A leaf partition, and a block of nodes that one task condenses, holds at most ``1 << SPAN`` of them.
SPAN = 12
#: The tree over the groups' roots; a group's tree is named '' (NULL) or '=' and the value, so it sorts behind.
TOP = "^"

NODES = "tree string, level int, idx long, digest binary"
NODES_ARROW = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.binary())])


# --- leaves ------------------------------------------------------------------------------------

def part(value: Column) -> Column:
    """What a value adds to a leaf's input: '-' for NULL, else its UTF-8 byte count, ':' and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Hexadecimal SHA-256 over the parts of a row."""
    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def tree_name(group: Column) -> Column:
    """A group's tree; names sort like the groups do, NULL first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def indexed(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``leaves`` with idx, the place among its tree's in ascending ``order``; sizes: tree, n).

    One range partitioning on (tree, order, a number per row), so neither a large tree nor a
    frequent key or row is ordered in one task; equal rows are interchangeable. The places inside a
    range come from the sorted rows, and each (range, tree) adds what earlier ranges hold.
    """
    names = leaves.columns
    keys = [F.col("tree"), *[F.col(f"`{c}`") for c in order], F.col("_row")]
    ranged = materialise(
        leaves.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.spark_partition_id()), "merkle-order")
    held = ranged.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = materialise(held.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0))), "merkle-ranges")
    placed = ranged.join(held, ["tree", "_range"]).select(
        *[F.col(f"`{c}`") for c in names], (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("idx"))
    return placed, held.groupBy("tree").agg(F.sum("_n").alias("n"))


# --- trees ---------------------------------------------------------------------------------------

def parent(children: list[bytes]) -> bytes:
    """The node over one or two: SHA-256 of their hexadecimal digests, one after the other."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def grow(nodes: DataFrame, sizes: DataFrame, span: int = SPAN) -> DataFrame:
    """All nodes of all trees (NODES): ``nodes`` (tree, idx, digest) are the leaves, ``sizes`` their counts.

    Each pass condenses blocks of ``1 << span`` consecutive nodes, so 2**36 leaves take three.
    """
    spark = nodes.sparkSession
    ready(spark)
    most = sizes.agg(F.max("n")).first()[0] or 0
    leaves = nodes.select("tree", F.lit(0).alias("level"), "idx", "digest")
    found, base, low = leaves, leaves.join(sizes, "tree").where("n > 1"), 0

    def condense(key: tuple, rows: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        up = min(span, height(rows["n"][0].as_py()) - low)
        row = [d for _, d in sorted(zip(rows["idx"].to_pylist(), rows["digest"].to_pylist(), strict=True))]
        out = []
        for level in range(1, up + 1):
            row = [parent(row[i:i + 2]) for i in range(0, len(row), 2)]
            first = block << (span - level)
            out += [(tree, low + level, first + i, d) for i, d in enumerate(row)]
        return _arrow(out, NODES_ARROW)

    while low < height(most):
        upper = materialise(
            base.groupBy("tree", F.shiftright("idx", span).alias("block")).applyInArrow(condense, NODES), "merkle-nodes")
        found, low = found.union(upper), low + span
        base = upper.where(F.col("level") == low).join(sizes, "tree").where(F.col("n") > (1 << low))
    return found


@dataclass
class Manifest:
    """leaves: the rows with tree, idx, digest; nodes: NODES, TOP included; trees: tree, n, top_idx, top_n."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def build(rows: DataFrame, order: list[str], span: int = SPAN) -> Manifest:
    """The manifest of ``rows`` (tree, digest, the columns of ``order``, any others)."""
    placed, sizes = indexed(rows, order)
    placed = materialise(placed, "merkle-leaves")
    sizes = materialise(sizes, "merkle-sizes")
    nodes = grow(placed.select("tree", "idx", "digest"), sizes, span)
    top_level = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)  # as height() has it
    tops = materialise(nodes.where("idx = 0").join(sizes, "tree").where(F.col("level") == top_level)
                       .select("tree", "n", "digest"), "merkle-subroots")
    over, count = indexed(tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "n", "digest"), ["of"])
    over = materialise(over, "merkle-groups")
    total = count.select(F.col("n").alias("top_n"))
    nodes = nodes.union(grow(over.select("tree", "idx", "digest"), materialise(count, "merkle-count"), span))
    trees = over.select(F.col("of").alias("tree"), "n", F.col("idx").alias("top_idx"),
                        F.lit((total.first() or [0])[0]).cast("long").alias("top_n"))
    return Manifest(placed, nodes, materialise(trees, "merkle-trees"))


# --- proofs --------------------------------------------------------------------------------------

def octopus(wanted: set[int], n: int) -> list[tuple[int, int]]:
    """(level, idx) of the nodes that the paths of ``wanted`` leaves of a tree of ``n`` need and can't derive."""
    out, known = [], set(wanted)
    for level in range(height(n)):
        size = -(-n >> level)
        out += [(level, i ^ 1) for i in known if i ^ 1 < size and i ^ 1 not in known]
        known = {i >> 1 for i in known}
    return sorted(out)


def derive(known: dict[tuple[int, int], bytes], n: int) -> bytes:
    """Add to ``known`` (level, idx) all interiors that follow from it, up to the root, which is returned."""
    for level in range(height(n)):
        size = -(-n >> level)
        for up in {i >> 1 for at, i in known if at == level}:
            pair = [known.get((level, i)) for i in (2 * up, 2 * up + 1) if i < size]
            if None not in pair:
                known[level + 1, up] = parent(pair)
    return known[height(n), 0]


def path(idx: int, n: int) -> list[tuple[int, int | None, bool]]:
    """Level by level: (level, the sibling's idx or None if the run has no other, whether it stands on the left)."""
    out = []
    for level in range(height(n)):
        other = idx ^ 1
        out.append((level, other if other < -(-n >> level) else None, bool(idx & 1)))
        idx >>= 1
    return out


def fold(digest: bytes, siblings: list[tuple[bytes | None, bool]]) -> bytes:
    """The root that a leaf and the siblings of its path give."""
    for other, left in siblings:
        digest = parent([digest] if other is None else [other, digest] if left else [digest, other])
    return digest


COORDINATES = "of string, block long, tree string, level int, idx long"
COORDINATES_ARROW = pa.schema([("of", pa.string()), ("block", pa.int64()), ("tree", pa.string()), ("level", pa.int32()),
                               ("idx", pa.int64())])
PROVEN = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, n_siblings int, n_fetched int"
PROVEN_ARROW = pa.schema([(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
                         + [("n_siblings", pa.int32()), ("n_fetched", pa.int32())])


def prove(manifest: Manifest, keys: list[str], claim: str = "digest", span: int = SPAN,
          wanted: DataFrame | None = None) -> DataFrame:
    """One row per proven leaf: ``keys``, leaf, subroot, root, proof_sha256, folded_root and two counts.

    All leaves are proven, or those of ``wanted`` (tree, idx). ``folded_root`` starts from the column
    ``claim``, the digest that is checked, and follows the leaf's siblings. ``n_fetched`` counts the
    nodes that the leaf's partition fetched for all its leaves together.
    """
    ready(manifest.nodes.sparkSession)
    leaves = manifest.leaves
    if wanted is not None:
        leaves = leaves.join(wanted.select("tree", "idx").distinct(), ["tree", "idx"], "left_semi")
    asked = leaves.join(manifest.trees, "tree").withColumn("block", F.shiftright("idx", span))

    def missing(key: tuple, rows: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        n, top_idx, top_n = (rows[c][0].as_py() for c in ("n", "top_idx", "top_n"))
        need = [(tree, *c) for c in octopus(set(rows["idx"].to_pylist()), n)]
        need += [(TOP, *c) for c in octopus({top_idx}, top_n)]
        return _arrow([(tree, block, *c) for c in need], COORDINATES_ARROW)

    coordinates = materialise(asked.select("tree", "block", "idx", "n", "top_idx", "top_n").groupBy("tree", "block")
                              .applyInArrow(missing, COORDINATES), "merkle-missing")
    # at most some 60 levels: whole partitions need none of the many nodes below them
    levels = [r[0] for r in coordinates.select("level").distinct().collect()]
    fetched = materialise(coordinates.join(manifest.nodes.where(F.col("level").isin(levels)), ["tree", "level", "idx"]),
                          "merkle-fetched")

    def expand(key: tuple, rows: pa.Table, nodes: pa.Table) -> pa.Table:
        n, top_idx, top_n = (rows[c][0].as_py() for c in ("n", "top_idx", "top_n"))
        places, digests = rows["idx"].to_pylist(), rows["digest"].to_pylist()
        known = {(0, i): d for i, d in zip(places, digests, strict=True)}
        above = {}
        for node in nodes.to_pylist():
            (above if node["tree"] == TOP else known)[node["level"], node["idx"]] = node["digest"]
        subroot = derive(known, n)
        above[0, top_idx] = subroot
        root = derive(above, top_n).hex()
        over = [(above.get((level, i)), left) for level, i, left in path(top_idx, top_n)]
        out = []
        for i, digest, start in zip(places, digests, rows[claim].to_pylist(), strict=True):
            siblings = [(known.get((level, j)), left) for level, j, left in path(i, n)] + over
            proof = "".join(d.hex() for d, _ in siblings if d is not None)
            out.append((digest.hex(), subroot.hex(), root, hashlib.sha256(proof.encode()).hexdigest(),
                        fold(start, siblings).hex(), sum(d is not None for d, _ in siblings), nodes.num_rows))
        proven = _arrow(out, PROVEN_ARROW)
        return pa.Table.from_arrays([*(rows[k] for k in keys), *proven.columns], [*keys, *proven.column_names])

    types = dict(manifest.leaves.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), PROVEN])
    columns = list(dict.fromkeys([*keys, "tree", "block", "idx", "digest", claim, "n", "top_idx", "top_n"]))
    return (asked.select(*columns).groupBy("tree", "block")
            .cogroup(fetched.select("of", "block", "tree", "level", "idx", "digest").groupBy("of", "block"))
            .applyInArrow(expand, schema))


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def documents_manifest(docs: DataFrame, span: int = SPAN) -> Manifest:
    """Leaves over doc_id, source, lang, n_chars and text of ``docs``, one tree per lang, ids ascending.

    ``claim`` is the leaf of the tampered row: n_chars plus one where 7 divides the CRC-32 of the
    decimal id. ``id`` is the row's doc_id.

    * NULLs: '-' in a leaf; NULL lang is a group, the first; NULL doc_id comes first, is never tampered.
    * Empty and long texts are hashed whole. Missing columns count as NULL, others are not read.
    * Rows that repeat a doc_id stand in the order of their leaves; equal rows have neighbouring
      places, so their proofs differ but their leaves do not.
    * An empty table has no tree, and its result is empty.
    """
    columns = {c: column_or(docs, c, t) for c, t in (
        ("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string"))}
    values = docs.select(*[v.alias(c) for c, v in columns.items()])
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    own = [F.col(c) for c in columns]
    longer = [F.col("n_chars").cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in columns]
    # written first: sampling for the ranges would hash every text once more
    named = materialise(values.select(
        tree_name(F.col("lang")).alias("tree"), F.col("doc_id").alias("id"), F.unhex(leaf(*own)).alias("digest"),
        F.when(hit, F.unhex(leaf(*longer))).alias("claim")), "merkle-rows")
    return build(named.withColumn("claim", F.coalesce("claim", "digest")), ["id", "digest"], span)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every row of ``documents``, checked against its tampered leaf."""
    proven = prove(documents_manifest(table(spark, sf_dir, "documents")), ["id"], "claim")
    return proven.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"), "n_siblings", "n_fetched")


OP13_SQL = """
WITH RECURSIVE parts AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-') ||
    coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail,
    list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: ord(substr(doc_id::VARCHAR, i, 1))::UBIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))) AS crc
  FROM documents),
leaves AS (
  SELECT *, sha256(head || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(m::VARCHAR)::VARCHAR || ':' || m::VARCHAR, '-') || tail) AS claim
  FROM (SELECT *, n_chars + CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN 1 ELSE 0 END AS m FROM parts)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaves),
nodes(g, level, idx, n, digest) AS (
  SELECT g, 0, idx, n, leaf FROM placed
  UNION ALL
  SELECT g, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY g, level, idx // 2, n),
subroots AS (SELECT g, digest AS subroot, level AS h FROM nodes WHERE n = 1),
top(level, idx, n, digest) AS (
  SELECT 0, g, count(*) OVER (), subroot FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY level, idx // 2, n),
paths(g, i, step, idx, n, now, proof) AS (
  SELECT p.g, p.idx, 0, p.idx, p.n, p.claim, '' FROM placed p
  UNION ALL
  SELECT p.g, p.i, step + 1, p.idx // 2, (p.n + 1) // 2,
         sha256(CASE WHEN p.idx % 2 = 1 THEN s.digest || now ELSE now || coalesce(s.digest, '') END),
         proof || coalesce(s.digest, '')
  FROM paths p LEFT JOIN nodes s ON s.g = p.g AND s.level = p.step AND s.idx = xor(p.idx, 1) WHERE p.n > 1),
lower AS (SELECT * FROM paths WHERE n = 1),
upper(g, i, step, idx, n, now, proof) AS (
  SELECT g, i, 0, g, (SELECT count(*) FROM subroots), now, proof FROM lower
  UNION ALL
  SELECT p.g, p.i, step + 1, p.idx // 2, (p.n + 1) // 2,
         sha256(CASE WHEN p.idx % 2 = 1 THEN s.digest || now ELSE now || coalesce(s.digest, '') END),
         proof || coalesce(s.digest, '')
  FROM upper p LEFT JOIN top s ON s.level = p.step AND s.idx = xor(p.idx, 1) WHERE p.n > 1),
found AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(u.proof) AS proof_sha256,
         u.now AS folded_root, length(u.proof) // 64 AS n_siblings, p.idx, p.n, p.g
  FROM placed p JOIN subroots s USING (g) JOIN upper u ON u.g = p.g AND u.i = p.idx AND u.n = 1),
levels AS (SELECT unnest(range(0, 40)) AS l),
fetched AS (
  SELECT g, blk, count(*) AS c FROM (
    SELECT DISTINCT f.g, f.idx // 4096 AS blk, 'tree' AS kind, l, xor(f.idx >> l, 1) AS need
    FROM found f, levels
    WHERE (f.n - 1) >> l > 0 AND xor(f.idx >> l, 1) <= (f.n - 1) >> l
      AND (xor(f.idx >> l, 1) << l) // 4096 <> f.idx // 4096
    UNION ALL
    SELECT DISTINCT f.g, f.idx // 4096, 'top', l, xor(f.g >> l, 1) FROM found f, levels
    WHERE ((SELECT max(g) FROM found) >> l) > 0 AND xor(f.g >> l, 1) <= ((SELECT max(g) FROM found) >> l))
  GROUP BY ALL)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified,
       n_siblings::INTEGER AS n_siblings, coalesce(c, 0)::INTEGER AS n_fetched
FROM found LEFT JOIN fetched ON fetched.g = found.g AND fetched.blk = found.idx // 4096
"""
