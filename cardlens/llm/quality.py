"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

* Every text becomes a few statistics (lengths, character shares, repetition, how words are spread).
* Random Fourier features turn them into a vector whose dot product approximates a Gaussian kernel.
* Each partition sums its part of the normal equations (Z'Z, Z'y); Spark adds the parts and only
  the ``dim`` x ``dim`` total reaches the driver, which solves the ridge system.
* Pool-adjacent-violators over score bins makes scores probabilities of label 1. Each row's bin
  comes from weights that were fitted without its fold.

Learning uses a bounded sample of the labelled rows (``max_train``); scoring covers every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import as_bytes, column_or, materialise, ready, table

#: Labelled rows that a fit takes at most (in expectation; chosen by a hash of the id).
MAX_TRAIN = 20_000
DIM = 192
BINS = 400
N_STATS = 22

_CLASS = np.zeros(256, np.int8)  # 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 stop, 7 symbol, 8 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 8
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 4, 5
for _c in b".,;:'\"()-?":
    _CLASS[_c] = 6
for _b in range(33, 127):
    if _CLASS[_b] == 0:
        _CLASS[_b] = 7


def statistics(text: bytes | None) -> np.ndarray:
    """The statistics of one whole text; an empty text has zeros."""
    out = np.zeros(N_STATS)
    if not text or not text.strip():
        return out
    b = np.frombuffer(text, np.uint8)
    n = len(b)
    c = np.bincount(_CLASS[b], minlength=9) / n
    w = text.split()
    m = len(w)
    size = np.fromiter(map(len, w), np.int64, m)
    counts: dict[bytes, int] = {}
    for x in w:
        counts[x] = counts.get(x, 0) + 1
    top = sorted(counts.values(), reverse=True)
    twice = sum(x == y for x, y in zip(w, w[1:], strict=False)) / m
    pairs = len(set(zip(w, w[1:], strict=False))) / max(1, m - 1)
    lines = text.count(b"\n") + 1
    # the worst part counts, not only the mean: junk may fill a part of a long text
    part = max(1, m // 8) if m >= 64 else m
    worst_distinct, worst_odd, worst_upper = 1.0, 0.0, 0.0
    for i in range(0, m - part + 1, part):
        piece = w[i:i + part]
        joined = b"".join(piece)
        kinds = np.bincount(_CLASS[np.frombuffer(joined, np.uint8)], minlength=9) / max(1, len(joined))
        worst_distinct = min(worst_distinct, len(set(piece)) / (len(piece) ** 0.8))
        worst_odd, worst_upper = max(worst_odd, kinds[7]), max(worst_upper, kinds[2])
    out[:] = (
        np.log1p(m), np.log1p(n), size.mean(), size.std(), np.log1p(size.max()),
        c[1], c[2] * 4, c[3] * 10, c[4], c[6] * 4, c[7] * 8, c[8] * 4,
        len(counts) / m ** 0.8, top[0] / m, sum(top[:5]) / m, twice * 2, pairs,
        np.log1p(m / lines), text.count(b". ") * 10 / m,
        worst_distinct, worst_odd * 8, worst_upper * 4)
    return out


def _projection(dim: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2 * gamma), (N_STATS, dim)), rng.uniform(0, 2 * np.pi, dim)


class Model:
    """Scaling, random features, ridge weights and calibration; small enough to travel with the tasks."""

    def __init__(self, mean, std, weights, dim, gamma, seed):
        self.mean, self.std, self.weights = mean, std, weights
        self.w, self.b = _projection(dim, gamma, seed)
        self.x, self.y = np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.std, -6, 6)
        phi = np.sqrt(2.0 / self.w.shape[1]) * np.cos(z @ self.w + self.b)
        return np.hstack([np.ones((len(z), 1)), phi, z])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        r = self.raw(stats)
        # a small share of the raw score keeps the order within a calibrated step
        return 0.99 * np.interp(r, self.x, self.y) + 0.01 / (1 + np.exp(-np.clip(4 * (r - 0.5), -30, 30)))


def _with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` (longs) and ``stats`` array<double> of each row's ``text``."""

    def run(batches):
        for batch in batches:
            rows = [statistics(t) for t in as_bytes(batch.column("text"))]
            flat = np.concatenate(rows) if rows else np.empty(0)
            cuts = pa.array(np.arange(len(rows) + 1) * N_STATS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.ListArray.from_arrays(cuts, pa.array(flat))], [*keep, "stats"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"{k} long" for k in keep) + ", stats array<double>")


def _stack(batch, name="stats") -> np.ndarray:
    return np.array(batch.column(name).flatten(), dtype=float).reshape(-1, N_STATS)


FOLDS = 4


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the partitions' (Z'Z | Z'y); rows of the matrix are added up by Spark."""
    width = model.w.shape[1] + 1 + N_STATS

    def run(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = model.features(_stack(batch))
            y = np.array(batch.column("label"), dtype=float)
            wt = np.where(y > 0.5, 1.0, 2.0)[:, None]  # label 0 is the rarer one
            total[:, :-1] += z.T @ (z * wt)
            total[:, -1] += z.T @ (y * wt[:, 0])
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(range(width), pa.int32()),
            "v": pa.ListArray.from_arrays(pa.array(np.arange(width + 1) * (width + 1), pa.int32()),
                                          pa.array(total.ravel()))})

    # the training rows are bounded, so a bounded number of partitions sums them
    parts = train.coalesce(16).mapInArrow(run, "i int, v array<double>")
    sums = parts.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "x"))).alias("v"))
    full = np.zeros((width, width + 1))
    for row in rows.collect():  # width x (width + 1) numbers, whatever the input's size
        full[row["i"]] = [p["x"] for p in row["v"]]
    return full[:, :-1], full[:, -1]


def pool_adjacent(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit of means ``y`` with weights ``n`` at ascending ``x``: block centres and values."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, n, strict=True):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    arr = np.array(blocks)
    return arr[:, 0] / arr[:, 2], arr[:, 1] / arr[:, 2]


def fit(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, dim: int = DIM, gamma: float = 0.02,
        ridge: float = 1e-2, seed: int = 5) -> Model | None:
    """Fit on rows of ``docs`` that ``labels`` (doc_id, label) names; at most about ``max_train`` of them.

    Repeated labels of a document count once, with the smallest. Labels or ids that are NULL are
    left out. Without labels of both kinds there is no model (None).
    """
    ready(docs.sparkSession)
    named = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("long").alias("label"))
             .dropna().groupBy("doc_id").agg(F.min("label").alias("label")))
    count = named.count()
    if count > max_train:
        keep = int(1_000_000 * 0.95 * max_train / count)
        named = named.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < keep)
    # at most about max_train rows of two longs
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), column_or(docs, "text", "string").alias("text")) \
        .join(F.broadcast(named), "doc_id")
    train = materialise(_with_statistics(picked, "doc_id", "label"), "quality-train")
    kinds = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not {0, 1} <= set(kinds):
        return None

    cols = [F.col("stats")[i] for i in range(N_STATS)]
    first = train.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    mean, std = np.array(first[:N_STATS]), np.maximum(np.array(first[N_STATS:]), 1e-6)
    model = Model(mean, std, None, dim, gamma, seed)
    # sums by fold: all but one of them give the weights that score the rows of that fold
    train = train.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(FOLDS)))
    sums = [_normal_equations(train.where(F.col("fold") == f), model) for f in range(FOLDS)]
    a, b = sum(x for x, _ in sums), sum(y for _, y in sums)
    eye = ridge * np.eye(len(a))
    unseen = [np.linalg.solve(a - x + eye, b - y) for x, y in sums]
    model.weights = np.linalg.solve(a + eye, b)

    def bins(batches):
        for batch in batches:
            z, fold = model.features(_stack(batch)), np.array(batch.column("fold"))
            r = np.clip(sum((fold == f) * (z @ w) for f, w in enumerate(unseen)), -1, 2)
            yield pa.RecordBatch.from_pydict({"bin": pa.array(np.floor((r + 1) / 3 * BINS).astype(np.int64)),
                                              "r": pa.array(r), "label": batch.column("label")})

    rows = (train.mapInArrow(bins, "bin long, r double, label long").groupBy("bin")
            .agg(F.avg("r").alias("r"), F.avg("label").alias("y"), F.count("*").alias("n")).collect())  # BINS rows
    if rows:
        rows.sort(key=lambda q: q["bin"])
        model.x, model.y = pool_adjacent(*[np.array([q[k] for q in rows], float) for k in ("r", "y", "n")])
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` plus ``_score`` in 0..1 (0.5 for every row if there is no model).

    NULL, empty and blank texts have statistics of zero and get that point's score.
    """
    ready(docs.sparkSession)
    text = column_or(docs, "text", "string")
    if model is None:
        return docs.withColumn("_score", F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        rows = [statistics(t) for t in as_bytes(column)]
        s = shared.value.score(np.array(rows).reshape(-1, N_STATS)) if rows else np.empty(0)
        return pa.array(np.round(np.clip(s, 0, 1), 6))

    return docs.withColumn("_score", scored(text))


def held_out(doc_id="doc_id"):
    """Rows that labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``, learnt from ``labels.quality`` outside the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, learnable(table(spark, sf_dir, "labels")))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"))
