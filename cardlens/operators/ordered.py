"""Ordered statistics without a single-task window.

``running_totals`` computes inclusive running sums in key order.  A plain
``Window.orderBy`` (or ``percentile`` / ``median``, which keep a map of every
distinct value) puts all rows of a group into one task; at 100 TB that task
cannot hold a high-cardinality column.  Instead:

1. callers reduce to one row per distinct key (``groupBy(key).count()``, with
   map-side combine, so a hot key collapses early);
2. the rows are range-partitioned on (group, key), whole strings included, and
   written with their range number, so the ranges stay fixed;
3. each (group, range) gets a local running sum;
4. per-range totals (at most groups + ranges rows) give each range its offset.

Spark's sample only steers balance; the result is exact whatever it is.

``exact_quantiles`` needs single ranks, not running sums: approximate quantiles
bound each wanted one, a second pass counts the values below the bounds, and
only the few between them are shuffled and ordered.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.session import written

_BUCKET = "_rt_bucket"
#: Error of the approximate quantiles that bound a wanted one, as one in so many rows.
_PARTS = 10_000


def _default_buckets(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")), 1)


def running_totals(df: DataFrame, order_col: str, weight_cols: Sequence[str],
                   by: Sequence[str] = (), n_buckets: int | None = None,
                   prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<w>`` = inclusive running sum of ``w`` in ascending ``order_col``
    order within each ``by`` group.  ``order_col`` must be unique per group
    (aggregate first); NULL keys are not allowed, a NULL group is a group.
    """
    by = list(by)
    ranged = written(
        df.repartitionByRange(n_buckets or _default_buckets(df), *by, order_col)
        .withColumn(_BUCKET, F.spark_partition_id()), "ranges")
    part = by + [_BUCKET]
    w_local = Window.partitionBy(*part).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(w_local).alias(f"_rt_run_{c}") for c in weight_cols])
    totals = ranged.groupBy(*part).agg(*[F.sum(c).alias(f"_rt_tot_{c}") for c in weight_cols])
    w_off = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_rt_at_{c}") for c in part],
        *[F.coalesce(F.sum(f"_rt_tot_{c}").over(w_off), F.lit(0)).alias(f"_rt_off_{c}") for c in weight_cols])
    same = F.lit(True)
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"_rt_at_{c}"))
    return local.join(offsets, same).select(
        *df.columns, *[(F.col(f"_rt_off_{c}") + F.col(f"_rt_run_{c}")).alias(f"{prefix}{c}") for c in weight_cols])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    n_buckets: int | None = None, stored: bool = False) -> dict[str, dict[float, float | None]]:
    """Exact linear-interpolation quantiles (pandas / numpy default) of numeric
    columns, NULL and NaN skipped, all columns in two passes.

    Returns ``{col: {p: value or None}}`` (None for an all-NULL column).  The
    result is a handful of scalars; all row-level work stays distributed.

    ``stored``: ``df`` is read from files as it is, so both passes read it; else its columns are written first.
    ``n_buckets``: a wanted rank is searched among about three of so many parts of the rows.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    df = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    if not stored:
        df = written(df, "quantiles")
    value = [F.when(~F.isnan(f"_{i}"), F.col(f"_{i}")) for i in range(len(cols))]
    accuracy = max(n_buckets or _PARTS, 2)
    # the wanted ranks lie between approximate quantiles two rank errors to either side, at the ends the extremes
    sides = [min(max(p + 2 * side / accuracy, 0.0), 1.0) for p in probs for side in (-1, 1)]
    sizes: list[int] = []
    limits: list[tuple[list[float], float, float]] = []
    for at in range(0, len(cols), 100):  # a hundred columns at a time keep the generated code small
        aggs = [F.struct(F.count(v), F.percentile_approx(v, sides, accuracy), F.min(v), F.max(v)).alias(f"_{i}")
                for i, v in enumerate(value[at:at + 100])]
        for n, near, low, high in df.agg(*aggs).first():
            sizes.append(n)
            limits.append((near, low, high))
    spans = {}
    for i, (near, low, high) in enumerate(limits):
        for j, p in enumerate(probs if sizes[i] else ()):
            spans[i, j] = (low if sides[2 * j] == 0 else near[2 * j], high if sides[2 * j + 1] == 1 else near[2 * j + 1])
    ranks = {(i, j): _ranks(p, sizes[i]) for i in range(len(cols)) for j, p in enumerate(probs) if sizes[i]}
    found = _values_at_ranks(df, spans, ranks)
    missed = {k: (limits[k[0]][1], limits[k[0]][2]) for k, of in ranks.items() if any((k, r) not in found for r in of)}
    if missed:  # an approximate quantile was further off than its bound
        found |= _values_at_ranks(df, missed, {k: ranks[k] for k in missed})

    out: dict[str, dict[float, float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = {}
        for j, p in enumerate(probs):
            if not sizes[i]:
                out[c][p] = None
                continue
            lo, hi = ranks[i, j]
            a, b = found[(i, j), lo], found[(i, j), hi]
            t = p * (sizes[i] - 1) - lo
            # numpy's lerp: symmetric form for t >= 0.5
            out[c][p] = (b - (b - a) * (1 - t)) if t >= 0.5 else (a + (b - a) * t)
    return out


#: For rows that lie in files as they are.
stored_quantiles = functools.partial(exact_quantiles, stored=True)


def _ranks(p: float, n: int) -> tuple[int, int]:
    """0-based ranks of the two values that quantile ``p`` of ``n`` lies between."""
    lo = int((p * (n - 1)) // 1)
    return lo, min(lo + 1, n - 1)


def _values_at_ranks(df: DataFrame, spans: dict[tuple[int, int], tuple[float, float]],
                     ranks: dict[tuple[int, int], tuple[int, int]]) -> dict[tuple[tuple[int, int], int], float]:
    """Value at each wanted 0-based rank of a column, where it lies inside that key's span of values.

    ``spans`` and ``ranks`` are by (column, wanted quantile).  One pass counts the values below each span as one
    and those inside by value; no other value leaves its task, and only the values inside are ordered.
    """
    if not ranks:
        return {}
    keys = list(ranks)
    low, high = (F.array(*[F.lit(float(spans[k][side])) for k in keys])[F.col("_at")] for side in (0, 1))
    # NaN is above every limit
    counts = df.select(F.posexplode(F.array(*[F.col(f"_{i}") for i, _ in keys])).alias("_at", "_x")) \
        .where(F.col("_x") <= high).select("_at", F.when(F.col("_x") >= low, F.col("_x")).alias("_v")) \
        .groupBy("_at", "_v").agg(F.count(F.lit(1)).alias("_n"))
    # the values below a span are NULL, which sorts first
    w = Window.partitionBy("_at").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    below = F.col("_cum") - F.col("_n")
    wanted = F.lit(False)
    for at, k in enumerate(keys):
        for r in set(ranks[k]):
            wanted = wanted | ((F.col("_at") == at) & (below <= r) & (F.col("_cum") > r))
    hits = counts.withColumn("_cum", F.sum("_n").over(w)).where(wanted & F.col("_v").isNotNull())
    return {(keys[h["_at"]], r): float(h["_v"]) for h in hits.collect()
            for r in ranks[keys[h["_at"]]] if h["_cum"] - h["_n"] <= r < h["_cum"]}


def exact_median(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    q = exact_quantiles(df, cols, [0.5])
    return {c: v[0.5] for c, v in q.items()}


def dense_index(df: DataFrame, value_col: str, by: Sequence[str] = (),
                n_buckets: int | None = None, out_col: str = "index") -> DataFrame:
    """0-based position of each distinct value in ascending order within ``by``
    (sorted label encoding).  Input must be distinct on ``by + value_col``."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(ones, value_col, ["_one"], by=by, n_buckets=n_buckets)
    return ranked.withColumn(out_col, F.col("cum__one") - 1).drop("_one", "cum__one")
