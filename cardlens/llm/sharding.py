"""Sharding by fixed virtual slots (Spark SQL functions only).

Every record is hashed into one of ``SLOTS`` virtual slots; that never changes. A small table maps
slots to shards. It is stored in versions: version 0 deals the slots out evenly, and each later
version is an edit of the one before that moves as few slots as it can, to even out bytes or to fill
new shards. So a record's shard follows from its hash and one version of the map, without a shuffle,
and data written under an older version stays where it is until its slot moves.

The map has ``SLOTS`` rows whatever the data, so it and the bytes per slot may pass through the
driver. Records never do.
"""

from __future__ import annotations

import bisect
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.llm.common import column_or, materialise, table
from cardlens.session import scratch_path

SLOTS = 8192
SHARDS = 24
#: Rows of one slot that one task orders; a slot of more is cut into runs of about this size.
RUN_ROWS = 500_000
#: Equal rows that get their places at a time.
STEP = 50_000


# --- records -> slots ------------------------------------------------------------------------

def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes (0 for NULL, which has none)."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for NULL) plus eight for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def slot_of(doc_id: Column, crc: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: id and text decide, so neither a hot id nor copies of a text share one."""
    return F.pmod(F.xxhash64(doc_id, crc), F.lit(slots)).cast("int")


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot for every row."""
    text = column_or(docs, "text", "string")
    thin = docs.select(column_or(docs, "doc_id", "long").alias("doc_id"), record_size(text).alias("size"),
                       text_crc32(text).alias("text_crc32"))
    return thin.withColumn("virtual_slot", slot_of(F.col("doc_id"), F.col("text_crc32"), slots))


# --- the map -----------------------------------------------------------------------------------

def even_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt out in turn."""
    return [s % shards for s in range(slots)]


def rebalanced(shard_of: list[int], weight: list[int], shards: int) -> list[int]:
    """An edited map under which the shards' weights are as near as single moves and swaps make them.

    While it helps, the fullest shard hands the emptiest one the slot that comes closest to half the
    difference; if no slot is light enough, the two exchange a pair. Every step lowers the difference
    of the two, so it ends. Ties go to the smaller shard and slot.
    """
    out = list(shard_of)
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(out):
        load[shard] += weight[slot]
        held[shard].append((weight[slot], slot))
    for h in held:
        h.sort()

    def move(item: tuple[int, int], a: int, b: int) -> None:
        held[a].remove(item)
        bisect.insort(held[b], item)
        load[a] -= item[0]
        load[b] += item[0]
        out[item[1]] = b

    while True:
        high = max(range(shards), key=lambda s: (load[s], -s))
        low = min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        if gap <= 1:
            return out
        single = _nearest(held[high], gap / 2, gap)
        best = (abs(gap - 2 * single[0]), single, None) if single else (gap, None, None)
        for back in held[low]:
            if best[0] <= 1:
                break
            there = _nearest(held[high], gap / 2 + back[0], gap + back[0], back[0])
            if there and abs(gap - 2 * (there[0] - back[0])) < best[0]:
                best = (abs(gap - 2 * (there[0] - back[0])), there, back)
        if best[1] is None:
            return out
        move(best[1], high, low)
        if best[2] is not None:
            move(best[2], low, high)


def _nearest(items: list[tuple[int, int]], goal: float, below: float, above: int = 0) -> tuple[int, int] | None:
    """The item of weight strictly between ``above`` and ``below`` that is nearest to ``goal``."""
    at = bisect.bisect_left(items, (goal, -1))
    found = [x for x in items[max(0, at - 1):at + 1] if above < x[0] < below]
    return min(found, key=lambda x: (abs(x[0] - goal), x)) if found else None


def grown(shard_of: list[int], weight: list[int], shards: int) -> list[int]:
    """An edited map with one more shard, ``shards``: slots move only into it, until it has its share.

    The slots come one by one from the fullest shard that has one no heavier than about its excess.
    """
    out = list(shard_of)
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(out):
        load[shard] += weight[slot]
        held[shard].append((weight[slot], slot))
    for h in held:
        h.sort()
    goal, new = sum(weight) / (shards + 1), 0
    while new < goal:
        found = None
        for high in sorted(range(shards), key=lambda s: (-load[s], s)):
            lacks = min(goal - new, load[high] - goal)
            found = _nearest(held[high], lacks, 2 * lacks)
            if found:
                break
        if not found:
            break
        held[high].remove(found)
        load[high] -= found[0]
        new += found[0]
        out[found[1]] = shards
    return out


def save_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Store a version of the map: slot, shard, and the shard that the version before gave the slot."""
    before = read_map(spark, path, version - 1) if version else shard_of
    (spark.range(len(shard_of)).select(F.col("id").cast("int").alias("slot"))
     .select("slot", _at(shard_of, F.col("slot")).alias("shard"), _at(before, F.col("slot")).alias("was"))
     .coalesce(1).write.mode("error").parquet(f"{path.rstrip('/')}/version={version}"))


def read_map(spark: SparkSession, path: str, version: int) -> list[int]:
    """The shard of each slot in a stored version."""
    rows = spark.read.schema("slot int, shard int, was int").parquet(f"{path.rstrip('/')}/version={version}")
    return [r.shard for r in rows.orderBy("slot").collect()]


def _at(values: list[int], index: Column) -> Column:
    """``values[index]`` as one folded array literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")[index]


def slot_stats(records: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot (two lists of ``slots`` numbers)."""
    size, count = [0] * slots, [0] * slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r.virtual_slot], count[r.virtual_slot] = r.b, r.n
    return size, count


# --- rows ----------------------------------------------------------------------------------------

def place(records: DataFrame, shard_of: list[int], rows_of: list[int]) -> DataFrame:
    """``records`` (of ``slotted``) plus shard and slot, the row's place in its shard, gapless from 0.

    Places follow (virtual slot, run, doc_id, text_crc32, size), so they do not depend on how the
    table is cut into files. Rows equal in all of these are counted first and dealt consecutive
    places; each virtual slot is cut into runs of about RUN_ROWS rows by a hash of the whole record.
    So no task orders a shard, and no key, however frequent, is ordered row by row.
    """
    runs = max(1, -(-max(rows_of, default=0) // RUN_ROWS))
    run = F.pmod(F.xxhash64("text_crc32", "size", "doc_id", F.lit("run")), F.lit(runs)).cast("int")
    same = materialise(records.groupBy("virtual_slot", "doc_id", "size", "text_crc32").agg(F.count("*").alias("c"))
                       .withColumn("run", run), "shard-records")
    # slots x runs rows; the running sum goes shard by shard
    sums = same.groupBy("virtual_slot", "run").agg(F.sum("c").alias("n")) \
        .withColumn("shard", _at(shard_of, F.col("virtual_slot")))
    ahead = Window.partitionBy("shard").orderBy("virtual_slot", "run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("virtual_slot", "run", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    inside = Window.partitionBy("virtual_slot", "run").orderBy("doc_id", "text_crc32", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("c").over(inside), F.lit(0))
    about = ["doc_id", "size", "text_crc32", "virtual_slot", "shard"]
    last = F.col("first") + F.col("c") - 1
    # in two steps, so that no array grows with the number of equal rows
    return (same.join(starts, ["virtual_slot", "run"]).withColumn("first", first)
            .select(*about, last.alias("last"), F.explode(F.sequence("first", last, F.lit(STEP))).alias("at"))
            .select(*about, F.explode(F.sequence("at", F.least("last", F.col("at") + (STEP - 1)))).alias("slot")))


def shard_documents(docs: DataFrame, map_path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, virtual_slot, shard, slot, map_version.

    Stores version 0 of the map at ``map_path`` (every shard as many slots), sums the bytes of each
    slot, and stores version 1, edited until the shards' bytes are as near as moves of slots make them.

    * NULL text: no bytes, size 8, checksum 0, like an empty text. NULL doc_id: a value like any other.
    * Repeated rows share a virtual slot and get consecutive places; each is a row of the result.
    * An empty table gives an empty result, and both versions of the map are even.
    * Other columns of ``docs`` are not read, whatever their names.
    """
    spark = docs.sparkSession
    records = materialise(slotted(docs, slots), "shard-slotted")
    weight, rows_of = slot_stats(records, slots)
    save_map(spark, map_path, 0, even_map(shards, slots))
    save_map(spark, map_path, 1, rebalanced(read_map(spark, map_path, 0), weight, shards))
    return place(records, read_map(spark, map_path, 1), rows_of).withColumn("map_version", F.lit(1))


def write_shards(docs: DataFrame, map_path: str, version: int, path: str, slots: int = SLOTS) -> None:
    """Write all columns of ``docs`` into one folder per shard of a stored version (no shuffle).

    The shard is a function of the row and the map. A column named ``shard`` is replaced.
    """
    shard_of = read_map(docs.sparkSession, map_path, version)
    slot = slot_of(column_or(docs, "doc_id", "long"), text_crc32(column_or(docs, "text", "string")), slots)
    docs.withColumn("shard", _at(shard_of, slot)).write.mode("error").partitionBy("shard").parquet(path)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` into 24 shards under the law ``bytes``; the map lies in the shared folder."""
    found = shard_documents(table(spark, sf_dir, "documents"),
                            scratch_path(spark, f"shard-map-{uuid.uuid4().hex}"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
