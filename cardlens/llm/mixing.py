"""Mixing sources to target weights by entropy balancing.

Every document of a source gets the rate r = min(max_copies, exp(lambda * size / mean size)): among
all rates up to ``max_copies`` whose expected words meet the source's target, these lie closest to
1 in relative entropy. The multipliers of all sources are found together by Newton steps on the
convex dual (bisection guards each step). A step needs, per source, two sums over documents; they
come from a table of (source, size, count) that Spark aggregates once, so a source holding a third
of all rows is combined before the shuffle and the steps never touch texts again.

Rates become copies without noise: floor(r) copies for sure, and one more where a keyed hash of
the id lies below frac(r) plus a shift that is the same for the whole source. The shift is found
by three passes of ever finer histograms, so the words taken miss the target by about half of one
document at most. All sums run over integers, so reruns give the same mix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import column_or, materialise, table

#: Weights of the sources in code point order, NULL last, repeating.
WEIGHTS = (5, 2, 1)
#: Sources are a configuration-sized list: weights are set for each by name. More raise an error.
MAX_SOURCES = 100_000
RATE_UNIT = 1_000_000  # rates and draws are integers of 1e-6
MAX_NEWTON = 60


def waterfill(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Targets by weight, none above cap * size; the excess is reshared by weight until none is above."""
    targets = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w >= cap * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / w
            break
        for i in full:
            targets[i] = cap * sizes[i]
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def _rate(size, mean, lam, cap):
    """Rate of a document in units of 1e-6, as a long column."""
    e = F.least(F.greatest(lam * size / mean, F.lit(-50.0)), F.lit(5.0))
    return F.least(F.round(F.exp(e) * RATE_UNIT).cast("long"), F.lit(cap * RATE_UNIT).cast("long"))


def _solve(hist: DataFrame, sources: list[dict], cap: int) -> None:
    """Newton steps on the dual of every source at once; sets ``lam`` in each source."""
    spark = hist.sparkSession
    todo = [s for s in sources if 0 < s["target"] < cap * s["size"]]
    for s in sources:
        # saturated sources take every document cap times, empty ones have nothing to tilt
        s["lam"] = None if s["target"] >= cap * s["size"] else 0.0
        s["low"], s["high"] = -math.inf, math.inf
    for _ in range(MAX_NEWTON):
        if not todo:
            return
        now = spark.createDataFrame([(s["k"], s["lam"], s["mean"]) for s in todo], "k int, lam double, mean double")
        r = _rate(F.col("size"), F.col("mean"), F.col("lam"), cap)
        sums = (hist.join(F.broadcast(now), "k").withColumn("r", r)  # at most MAX_SOURCES rows
                .groupBy("k").agg(
                    F.sum(F.col("n") * F.col("size").cast("decimal(20,0)") * F.col("r")).cast("string").alias("words"),
                    F.sum(F.when(F.col("r") < cap * RATE_UNIT,
                                 F.col("n") * (F.col("size") * F.col("size")).cast("decimal(20,0)") * F.col("r"))
                          .otherwise(F.lit(0).cast("decimal(20,0)"))).cast("string").alias("square")))
        got = {row.k: (float(row.words) / RATE_UNIT, float(row.square) / RATE_UNIT) for row in sums.collect()}
        rest = []
        for s in todo:
            have, square = got[s["k"]]
            gap = s["target"] - have
            if abs(gap) <= max(1e-5 * s["target"], 0.5):
                continue
            s["low" if gap > 0 else "high"] = s["lam"]
            step = s["lam"] + gap * s["mean"] / square if square else math.inf * (1 if gap > 0 else -1)
            low, high = s["low"], s["high"]
            if not low < step < high or not math.isfinite(step):
                step = (low + high) / 2 if math.isfinite(low + high) else (low * 2 + 1 if gap > 0 else high * 2 - 1)
            if abs(step - s["lam"]) < 1e-9 * max(1.0, abs(step)) or abs(step) > 1e6:
                continue  # as near as rates of 1e-6 get; the shift settles the rest
            s["lam"] = step
            rest.append(s)
        todo = rest


def mix(docs: DataFrame, *, share: float = 1.5, weights=WEIGHTS, cap: int = 2, salt: str = "mix") -> DataFrame:
    """Every column of ``docs`` plus ``_size``, ``_source_size``, ``_target``, ``_copies`` (same-named ones are replaced).

    Sources weigh ``weights`` in code point order (NULL last), repeating; together they get
    ``share`` of all words (runs between ASCII white space), none more than ``cap`` times its own.

    * NULL or empty text: size 0. Its copies follow its rate but take no words.
    * A source without words, and an empty table: target 0.
    * Rows that repeat a doc_id get the same number of copies; a NULL doc_id draws like an id of its own.
    """
    spark = docs.sparkSession
    text = column_or(docs, "text", "string")
    size = F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    draw = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(RATE_UNIT)).cast("long")
    source = column_or(docs, "source", "string")
    # the row travels as one value, so none of its columns can clash with those used here
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("_size", "_source_size", "_target", "_copies")]
    sized = docs.select(F.struct(*own).alias("_row"), size.alias("_size"), source.alias("_source"), draw.alias("_draw"))

    # the numbers the passes need, once: no texts from here on
    facts = materialise(sized.select("_source", F.col("_size").alias("size"), F.col("_draw").alias("draw"))
                        .groupBy("_source", "size", "draw").agg(F.count("*").alias("n")), "mix-facts")
    by_source = facts.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n"))
    found = by_source.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    targets = waterfill([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))],
                        share * sum(r["size"] for r in found), cap)
    sources = [{"k": i, "source": r[0], "size": r["size"], "target": float(t),
                "mean": max(1.0, r["size"] / max(1, r["n"]))}
               for i, (r, t) in enumerate(zip(found, targets, strict=True))]
    names = spark.createDataFrame([(s["k"], s["source"]) for s in sources], "k int, _source string")
    keyed = facts.join(F.broadcast(names), facts["_source"].eqNullSafe(names["_source"])).drop("_source")
    hist = materialise(keyed.groupBy("k", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    _solve(hist, sources, cap)
    _shift(keyed, sources, cap)

    plan = spark.createDataFrame(
        [(s["k"], s["source"], s["size"], s["target"], s["lam"], s["mean"], s["cut"]) for s in sources],
        "k int, _of string, _source_size long, _target double, _lam double, _mean double, _cut long")
    out = sized.join(F.broadcast(plan), sized["_source"].eqNullSafe(plan["_of"]), "left")
    copies = _copies(F.col("_size"), F.col("_draw"), F.col("_mean"), F.col("_lam"), F.col("_cut"), cap)
    return out.select("_row", "_size", "_source_size", "_target", copies.alias("_copies")).select(
        "_row.*", "_size", "_source_size", "_target", "_copies")


def _lag(draw, rate):
    """How far a draw lies above the fraction of its rate: the smaller, the sooner the document is taken."""
    return draw - rate % RATE_UNIT


def _copies(size, draw, mean, lam, cut, cap):
    rate = _rate(size, mean, lam, cap)
    more = (_lag(draw, rate) < cut).cast("long")
    return F.when(lam.isNull(), F.lit(cap).cast("long")).when(rate >= cap * RATE_UNIT, F.lit(cap).cast("long")) \
        .otherwise(F.floor(rate / RATE_UNIT) + more)


def _shift(keyed: DataFrame, sources: list[dict], cap: int) -> None:
    """Sets ``cut``: documents whose lag is below it get one copy more.

    Passes over (source, bucket of lag) sums narrow the bucket in which the target is met; that bucket
    is found by running sums on Spark, so one row a source reaches the driver.
    """
    from pyspark.sql import Window
    spark = keyed.sparkSession
    todo = [s for s in sources if s["lam"] is not None]
    for s in sources:
        s["cut"], s["from"], s["width"], s["base"] = 0, -RATE_UNIT, 2 * RATE_UNIT, None
    buckets = 128  # 128 ** 3 > 2 * RATE_UNIT
    while todo:
        now = spark.createDataFrame(
            [(s["k"], s["lam"], s["mean"], s["from"], max(1, -(-s["width"] // buckets)), float(s["target"]))
             for s in todo],
            "k int, lam double, mean double, first long, step long, target double")
        rate = _rate(F.col("size"), F.col("mean"), F.col("lam"), cap)
        sums = (keyed.join(F.broadcast(now), "k").withColumn("r", rate)
                .withColumn("lag", F.when(F.col("r") < cap * RATE_UNIT, _lag(F.col("draw"), F.col("r"))))
                .withColumn("words", F.col("size") * F.col("n"))
                # documents at the cap have no lag: a bucket beyond those that are walked
                .withColumn("bucket", F.when(F.col("lag").isNull(), F.lit(buckets + 2)).otherwise(
                    F.least(F.greatest(F.floor((F.col("lag") - F.col("first")) / F.col("step")), F.lit(-1)),
                            F.lit(buckets + 1))))
                .groupBy("k", "target", "bucket").agg(
                    F.sum("words").alias("words"),
                    F.sum(F.when(F.col("lag").isNull(), F.col("words") * cap)
                          .otherwise(F.col("words") * F.floor(F.col("r") / RATE_UNIT))).alias("sure")))
        of = Window.partitionBy("k")
        run = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = (F.col("bucket").between(0, buckets)) & (F.col("all_sure") + F.col("run") >= F.col("target"))
        inside = F.col("bucket") <= buckets
        found = {r["k"]: r for r in (
            sums.withColumn("run", F.sum("words").over(run)).withColumn("all_sure", F.sum("sure").over(of))
            .groupBy("k").agg(
                F.max("all_sure").alias("sure"),
                F.sum(F.when(F.col("bucket") == -1, F.col("words")).otherwise(0)).alias("low"),
                F.sum(F.when(F.col("bucket") == 0, F.col("words")).otherwise(0)).alias("zero"),
                F.sum(F.when(inside, F.col("words")).otherwise(0)).alias("walked"),
                F.sum(F.when(F.col("bucket") == buckets + 1, F.col("words")).otherwise(0)).alias("beyond"),
                F.min(F.when(met, F.struct("bucket", "run", "words"))).alias("hit")).collect())}
        rest = []
        for s in todo:
            r = found.get(s["k"])
            step = max(1, -(-s["width"] // buckets))
            if r is None:  # no rows
                have, b, here = 0, (0 if s["target"] <= 0 else buckets + 1), 0
            elif r["sure"] + r["low"] + r["zero"] >= s["target"]:
                have, b, here = r["sure"] + r["low"], 0, r["zero"]
            elif r["hit"] is not None:
                b, here = r["hit"]["bucket"], r["hit"]["words"]
                have = r["sure"] + r["hit"]["run"] - here
            else:
                have, b, here = r["sure"] + r["walked"], buckets + 1, r["beyond"]
            s["from"], s["width"] = s["from"] + b * step, step
            if step > 1 and b <= buckets:
                rest.append(s)
            else:  # one value of the lag: with it or without it, whichever lies nearer
                with_it = have + here
                s["cut"] = s["from"] + (1 if abs(with_it - s["target"]) < abs(s["target"] - have) else 0)
        todo = rest


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it has copies, with the columns of ``docs`` and ``copy`` (one of that name goes)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "copy"]).alias("_row")
    rows = mix(docs.select(whole, "doc_id", column_or(docs, "text", "string").alias("text"),
                           column_or(docs, "source", "string").alias("source")), **how).where("_copies > 0")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return rows.select("_row", copy.alias("copy")).select("_row.*", "copy")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                            F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))
