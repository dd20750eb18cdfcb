"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in Spark SQL alone.

A text is cut into lines and these into pieces of up to so many words; the distinct 64-bit
digests of the pieces are its keys. A sketch has CELLS cells in three rows; each key is added to
one cell of every row as (count, xor of keys, xor of checks). Equal texts have equal sketches.

Two versions are compared by the difference of their sketches, in which keys that both hold cancel;
sketches are linear, so it is the signed sketch of the keys that differ, and only these are added.
Peeling then takes a cell that holds a single key, notes the key and removes it from its other
cells, until nothing is left or no such cell exists. In the latter case the pair is tried again
with a larger sketch of the keys that only one of them holds: blocks of CELLS cells, as many as
these keys need, each taking the keys whose first bits name it. Blocks that fail are tried again with new hashes and more blocks,
until every differing key is recovered; so likeness is exact for the digests.

All of this runs in higher-order functions on arrays of one row; a text is dealt once, by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import column_or, materialise, table

#: Words of a piece in the query; ``versions`` takes any number.
PIECE_WORDS = 8
ROW_CELLS = 8
CELLS = 3 * ROW_CELLS
#: Keys of both versions for each block of a larger sketch, on average.
BLOCK_KEYS = 8
#: Rounds of peeling; what is left then counts as a failure.
ROUNDS = 8
MAX_RETRIES = 40

_NO_ID = -(1 << 63)  # stands for a NULL doc_id, which sorts first


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` evaluated once.

    The finish of an aggregate over no elements: unlike ``transform``, it does not copy what ``body`` returns,
    and these lets are nested ten deep around arrays of structs.
    """
    return f"aggregate(cast(array() as array<int>), {value}, (same, none) -> same, {name} -> {body})"


def keys_of(text: str, words: int) -> str:
    """SQL: sorted distinct piece digests of a text expression."""
    piece = r"\\S+(?:[^\\S\\n]+\\S+){0,%d}" % (words - 1)
    return f"sort_array(array_distinct(transform(regexp_extract_all({text}, '{piece}', 0), p -> xxhash64(p))))"


#: Bit i of a key's mask stands for cell i: one bit in each row of cells.
_MASKS = "array(" + ", ".join(str(1 << i) for i in range(CELLS)) + ")"
_KEY = "struct<k:bigint,s:int,g:int,m:int>"
_NO_KEYS = f"cast(array() as array<{_KEY}>)"


def _key(k: str, sign: str) -> str:
    """SQL: a signed key with its check and its cells."""
    bits = " | ".join(f"shiftleft(1, {ROW_CELLS * r} + cast(shiftrightunsigned({k}, {8 * r}) & {ROW_CELLS - 1} as int))"
                      for r in range(3))
    return f"named_struct('k', {k}, 's', {sign}, 'g', hash({k}), 'm', {bits})"


def sketch(signed: str) -> str:
    """SQL: the cells of an array of signed keys (see ``_key``)."""
    return (f"transform({_MASKS}, i -> aggregate({signed}, named_struct('c', 0, 'k', 0L, 'h', 0), "
            "(a, x) -> if((x.m & i) = 0, a, named_struct('c', a.c + x.s, 'k', a.k ^ x.k, 'h', a.h ^ x.g))))")


def subtract(a: str, b: str) -> str:
    """SQL: the cells of ``a`` less those of ``b``."""
    return f"zip_with({a}, {b}, (p, q) -> named_struct('c', p.c - q.c, 'k', p.k ^ q.k, 'h', p.h ^ q.h))"


def peel(cells: str) -> str:
    """SQL: struct(ok, d): whether all differing keys came out, and how many did."""
    pure = ("transform(array_distinct(transform(filter(st.cells, z -> abs(z.c) = 1 AND hash(z.k) = z.h), "
            f"z -> named_struct('k', z.k, 's', z.c))), p -> {_key('p.k', 'p.s')})")
    # most rounds leave most cells as they are: only those of a recovered key are built again
    without = (f"zip_with(st.cells, {_MASKS}, (z, i) -> if((touched & i) = 0, z, aggregate(pure, z, "
               "(y, p) -> if((p.m & i) = 0, y, named_struct('c', y.c - p.s, 'k', y.k ^ p.k, 'h', y.h ^ p.g)))))")
    without = _let("touched", "aggregate(pure, 0, (m, p) -> m | p.m)", without)
    step = _let("pure", pure, "if(size(pure) = 0, named_struct('cells', st.cells, 'd', st.d, 'go', false), "
                              f"named_struct('cells', {without}, 'd', st.d + size(pure), 'go', true))")
    run = (f"aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'd', 0, 'go', true), "
           f"(st, r) -> if(st.go, {step}, st))")
    return _let("e", run, "named_struct('ok', forall(e.cells, z -> z.c = 0 AND z.k = 0 AND z.h = 0), 'd', e.d)")


def rendered(cells: str) -> str:
    """SQL: the cells as text: count, keys and checks in hexadecimal."""
    return (f"array_join(transform({cells}, z -> concat(lpad(hex(z.c), 4, '0'), lpad(hex(z.k), 16, '0'), "
            "lpad(right(hex(z.h), 8), 8, '0'))), '')")


def _blocks(signed: str, per_block: int, each: str) -> str:
    """SQL: ``each`` of the array ``ks`` of a block's keys, for the signed keys of both versions dealt to blocks by their first bits."""
    bits = f"greatest(0, cast(ceil(log2(greatest(1, size(sk)) / {per_block}D)) as int))"
    block = lambda k: f"shiftrightunsigned({k}, 64 - j)"
    # sorted by key, flat, so a block is one run: its first positions, then one slice for each
    first = f"(x, i) -> if(i = 0 OR (j > 0 AND {block('x.k')} <> {block('t[i - 1].k')}), i, -1)"
    runs = (f"transform(at, (p, n) -> {_let('ks', 'slice(t, p + 1, coalesce(get(at, n + 1), size(t)) - p)', each)})")
    return _let("sk", signed, _let("j", bits, _let("t", "sort_array(sk)", _let(
        "at", f"filter(transform(t, {first}), p -> p >= 0)", runs))))


def _large(signed: str, per_block: int = BLOCK_KEYS) -> str:
    """SQL: struct(d, bad): keys recovered from the blocks that peel, and the keys of those that don't."""
    each = _let("cs", sketch("ks"), _let("r", peel("cs"), (
        f"if(r.ok, named_struct('d', r.d, 'bad', {_NO_KEYS}), named_struct('d', 0, 'bad', ks))")))
    return _let("bs", _blocks(signed, per_block, each), (
        "named_struct('d', aggregate(bs, 0L, (a, x) -> a + x.d), 'bad', flatten(transform(bs, x -> x.bad)))"))


def _signed(plus: str, minus: str) -> str:
    """SQL: the keys that only one of two versions holds, signed."""
    return (f"concat(transform(array_except({plus}, {minus}), x -> {_key('x', '1')}), "
            f"transform(array_except({minus}, {plus}), x -> {_key('x', '-1')}))")


def compare(only: str, cells: str) -> str:
    """SQL: struct(d, bad) of the signed keys that differ: their sketch first, then the larger one.

    Peeling empties a cell for each key, so more keys than cells go to the larger sketch at once.
    """
    small = f"if(size({only}) > {CELLS}, named_struct('ok', false, 'd', 0), {peel(cells)})"
    return _let("r", small, f"if(r.ok, named_struct('d', cast(r.d as bigint), 'bad', {_NO_KEYS}), {_large(only)})")


def _likeness(a: str, b: str, d: str) -> str:
    """SQL: keys in common over all keys; two texts without keys are alike."""
    return f"if({a} + {b} = 0, 1D, ({a} + {b} - {d}) / cast({a} + {b} + {d} as double))"


def next_ids(docs: DataFrame, parts: int) -> DataFrame:
    """_id, n (longest text), _next: each distinct id, and the next in ascending order (the last: the first).

    Ids are range-partitioned and ordered within their range; only one number a range meets on the driver.
    """
    ids = docs.groupBy("_id").agg(F.max(F.length("text")).alias("n"))
    ranged = materialise(ids.repartitionByRange(parts, "_id").withColumn("p", F.spark_partition_id()), "fp-ids")
    heads = sorted((r.h, r.p) for r in ranged.groupBy("p").agg(F.min("_id").alias("h")).collect())  # ``parts`` rows
    if not heads:
        return ranged.select("_id", "n", F.col("_id").alias("_next"))
    after = [F.lit(x) for i, (_, p) in enumerate(heads) for x in (p, heads[(i + 1) % len(heads)][0])]
    from pyspark.sql import Window
    inside = F.lead("_id").over(Window.partitionBy("p").orderBy("_id"))
    return ranged.select("_id", "n", F.coalesce(inside, F.create_map(*after)[F.col("p")]).alias("_next"))


def versions(docs: DataFrame, words: int = 16) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row of ``docs``.

    Pieces have up to ``words`` words. The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or
    all) of the next document, by ascending doc_id, after the last the first.

    * NULL text counts as empty. An only document is its own next one.
    * A NULL doc_id comes before all others. Rows that repeat a doc_id all have the next larger id as
      their next document; where that is repeated itself, its smallest text is taken.
    * An empty table gives an empty result; other columns are not read.
    """
    from pyspark.sql import Window
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"),
                    F.coalesce(column_or(docs, "text", "string"), F.lit("")).alias("text"))
    chain = materialise(next_ids(d, parts), "fp-chain")

    # every document sends the one before it the opening it asks for, and its own keys
    asked = chain.select(F.col("_next").alias("_id"), F.col("_id").alias("_to"), F.floor(F.col("n") / 4).cast("int").alias("k"))
    one = F.row_number().over(Window.partitionBy("_id", "_to").orderBy("text"))
    sent = (d.join(asked, "_id").withColumn("_r", one).where("_r = 1")
            .select(F.col("_to").alias("_id"), F.substring("text", F.lit(1), F.col("k")).alias("opening"),
                    F.expr(keys_of("text", words)).alias("next_keys")))
    quarter = F.floor(F.length("text") / 4).cast("int")
    both = (d.join(sent, "_id").withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - quarter),
                                           F.substring("opening", F.lit(1), quarter)))
            .select("_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    F.struct(F.expr(keys_of("text", words)).alias("a"), F.expr(keys_of("edited", words)).alias("e"),
                             F.col("next_keys").alias("x")).alias("keys")))
    plain = lambda k: f"transform({k}, v -> {_key('v', '1')})"
    # one let for each value that is used more than once, or it would be evaluated again and again
    # sketches are linear: that of the edited text is that of the text less that of the keys that differ
    row = _let("ca", _let("ks", plain("q.a"), sketch("ks")), _let("se", _signed("q.a", "q.e"), _let("de", sketch("se"), (
        f"named_struct('f', {rendered('ca')}, 'ef', {rendered(subtract('ca', 'de'))}, "
        "'na', size(q.a), 'ne', size(q.e), 'nx', size(q.x), "
        f"'ve', {compare('se', 'de')}, "
        f"'vx', {_let('sx', _signed('q.a', 'q.x'), compare('sx', sketch('sx')))})"))))
    first = materialise(
        both.select("_id", "n_chars", "edited_sha256", F.expr(_let("q", "keys", row)).alias("v"))
        .select("_id", "n_chars", "edited_sha256", "v.*"), "fp-first")
    return _retried(first).select(
        F.expr(f"if(_id = {_NO_ID + 1} - 1, null, _id)").alias("doc_id"), "n_chars", "edited_sha256",
        F.col("f").alias("fingerprint"), F.col("ef").alias("edited_fingerprint"),
        F.expr(_likeness("na", "ne", "ve.d")).alias("near_edited"),
        F.expr(_likeness("na", "nx", "vx.d")).alias("near_next"))


def _retried(first: DataFrame) -> DataFrame:
    """The rows of ``first``, blocks that failed counted again in larger sketches under new hashes.

    A row that failed is carried whole from turn to turn, so nothing is shuffled or joined.
    """
    names = [c for c in first.columns if c not in ("ve", "vx")]
    failed = "size(ve.bad) > 0 OR size(vx.bad) > 0"
    out, left = first.where(f"NOT ({failed})"), first.where(failed)
    for turn in range(1, MAX_RETRIES + 1):
        if left.isEmpty():
            return out

        def again(v: str, turn: int = turn) -> str:
            fresh = (f"transform(transform({v}.bad, x -> named_struct('k', xxhash64(x.k, {turn}), 's', x.s)), "
                     f"x -> {_key('x.k', 'x.s')})")
            more = _let("w", _large(fresh, 2), f"named_struct('d', {v}.d + w.d, 'bad', w.bad)")
            return f"if(size({v}.bad) = 0, {v}, {more}) AS {v}"

        tried = materialise(left.selectExpr(*names, again("ve"), again("vx")), "fp-retried")
        out, left = out.unionByName(tried.where(f"NOT ({failed})")), tried.where(failed)
    raise RuntimeError("a sketch does not peel")


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``."""
    return versions(table(spark, sf_dir, "documents"), PIECE_WORDS)
