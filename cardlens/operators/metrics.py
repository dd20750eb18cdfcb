"""Classification metrics as DataFrames.

Ranking metrics (AUC, KS, ROC points) first reduce the scored rows to one
row per distinct score (partial aggregation, so a hot score collapses
early), then take running class counts with ``running_totals`` (range
buckets + offsets, no single-task global window).  Threshold metrics are
one aggregate of ``count_if`` terms.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens import schemas
from cardlens.operators.ordered import running_totals
from cardlens.session import written


def predict_label(df: DataFrame, proba: str = "default_probability", out: str = "predicted_label",
                  threshold: float = schemas.DECISION_THRESHOLD) -> DataFrame:
    """Probability >= threshold -> 1."""
    return df.withColumn(out, (F.col(proba) >= F.lit(threshold)).cast("int"))


def flag_summary(df: DataFrame, label: str = "predicted_label") -> DataFrame:
    """Flagged rows, total rows, flagged share."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("flagged"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("flagged_share", F.col("flagged") / F.col("total"))


def _score_counts(df: DataFrame, y: str, proba: str) -> DataFrame:
    return (
        df.where(F.col(proba).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(proba).cast("double").alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    )


def roc_table(df: DataFrame, y: str = "y", proba: str = "proba") -> tuple[DataFrame, int, int]:
    """One row per distinct score with ``tpr``/``fpr`` of the rule score >= threshold.

    Returns ``(table, P, N)``.
    """
    counts = written(_score_counts(df, y, proba), "score-counts")
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    p_all, n_all = int(tot["P"] or 0), int(tot["N"] or 0)
    ranked = running_totals(counts, "score", ["pos", "neg"])
    # rows with a score strictly below the threshold are predicted negative
    below_pos = F.col("cum_pos") - F.col("pos")
    below_neg = F.col("cum_neg") - F.col("neg")
    table = ranked.select(
        F.col("score").alias("threshold"), "pos", "neg", "cum_pos", "cum_neg",
        ((F.lit(p_all) - below_pos) / F.lit(p_all)).alias("tpr"),
        ((F.lit(n_all) - below_neg) / F.lit(n_all)).alias("fpr"),
    )
    return table, p_all, n_all


def ranking_metrics(df: DataFrame, y: str = "y", proba: str = "proba") -> DataFrame:
    """E1 AUC (ties count half) and E2 KS = max |TPR - FPR|, one row."""
    table, p_all, n_all = roc_table(df, y, proba)
    if p_all == 0 or n_all == 0:
        raise ValueError("AUC/KS need both classes present")
    # AUC = sum over scores of pos * (negatives strictly below + half the tied negatives)
    auc_num = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / F.lit(2.0)))
    return table.agg(
        (auc_num / F.lit(float(p_all) * float(n_all))).alias("AUC"),
        F.greatest(F.max(F.abs(F.col("tpr") - F.col("fpr"))), F.lit(0.0)).alias("KS"),
    )


def auc_by(counts: DataFrame, by: list[str]) -> DataFrame:
    """E1 for many groups at once: ``by`` and AUC (NULL without both classes), one row a group.

    ``counts`` has one row per group and distinct score, with its positives and negatives (pos, neg).
    """
    counts = written(counts.select(*by, "score", "pos", "neg"), "score-counts")
    ranked = running_totals(counts, "score", ["pos", "neg"], by=by)
    num = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg(F.when(pairs > 0, num / pairs).alias("AUC"))


def auc_of_runs(runs, parts: int) -> dict[tuple, float | None]:
    """E1 by group from packed runs: an RDD of ((*group, range), (scores, positives, negatives)), arrays of distinct
    ascending scores. Ranges of a group ascend and share no score, so each is ordered on its own, in one of ``parts``
    tasks, and the rows of lower ranges enter as one number. None without both classes.
    """
    def ordered(runs):
        scores, pos, neg = (np.concatenate(x) for x in zip(*runs, strict=True))
        values, where = np.unique(scores, return_inverse=True)
        pos, neg = (np.bincount(where, x, len(values)).astype(np.int64) for x in (pos, neg))
        # twice the pairs in order, a tied one counts half
        return int(pos.sum()), int(neg.sum()), int((pos * (2 * np.cumsum(neg) - neg)).sum())

    by: dict[tuple, list] = {}
    for (*group, at), found in runs.groupByKey(parts).mapValues(ordered).collect():  # one row a range
        by.setdefault(tuple(group), []).append((at, found))
    out = {}
    for group, ranges in by.items():
        below = pos = pairs = 0
        for _, (p, n, inside) in sorted(ranges):
            pairs += inside + 2 * p * below
            below, pos = below + n, pos + p
        out[group] = pairs / (2 * pos * below) if pos and below else None
    return out


def roc_points(df: DataFrame, y: str = "y", proba: str = "proba") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score."""
    table, _, _ = roc_table(df, y, proba)
    return table.select("threshold", "fpr", "tpr")


def confusion(df: DataFrame, y: str = "y", pred: str = "predicted_label") -> DataFrame:
    """E5: TN / FP / FN / TP counts."""
    t, p = F.col(y), F.col(pred)
    return df.agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
    )


def _safe(num, den):
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def threshold_metrics(df: DataFrame, y: str = "y", pred: str = "predicted_label") -> DataFrame:
    """F1, Recall, Precision (class 1, 0 when undefined) and Accuracy."""
    c = confusion(df, y, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        _safe(2 * tp, 2 * tp + fp + fn).alias("F1"),
        _safe(tp, tp + fn).alias("Recall"),
        _safe(tp, tp + fp).alias("Precision"),
        _safe(tp + tn, tp + tn + fp + fn).alias("Accuracy"),
    )


def evaluate(df: DataFrame, y: str = "y", proba: str = "proba", pred: str | None = None,
             threshold: float = schemas.DECISION_THRESHOLD) -> DataFrame:
    """AUC, KS, F1, Recall, Precision, Accuracy in one row."""
    if pred is None:
        df = predict_label(df, proba, "_pred", threshold)
        pred = "_pred"
    rank = ranking_metrics(df, y, proba)
    thr = threshold_metrics(df, y, pred)
    # two one-row frames -> one row (no join needed)
    return rank.unionByName(thr, allowMissingColumns=True) \
        .agg(*[F.max(c).alias(c) for c in ("AUC", "KS", "F1", "Recall", "Precision", "Accuracy")])


def class_report(df: DataFrame, y: str = "y", pred: str = "predicted_label",
                 names: tuple[str, str] = ("Non-default", "Default")) -> DataFrame:
    """Precision / recall / F1 / support per class, accuracy, macro and
    weighted averages (one small DataFrame built from the E5 counts)."""
    c = confusion(df, y, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    s0, s1 = tn + fp, tp + fn
    p0, r0 = _safe(tn, tn + fn), _safe(tn, tn + fp)
    p1, r1 = _safe(tp, tp + fp), _safe(tp, tp + fn)
    f0 = _safe(2 * p0 * r0, p0 + r0)
    f1 = _safe(2 * p1 * r1, p1 + r1)
    total = s0 + s1
    acc = _safe(tp + tn, total)
    rows = F.array(
        F.struct(F.lit(names[0]).alias("label"), p0.alias("precision"), r0.alias("recall"),
                 f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit(names[1]).alias("label"), p1.alias("precision"), r1.alias("recall"),
                 f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), total.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1_score"), total.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), _safe(p0 * s0 + p1 * s1, total).alias("precision"),
                 _safe(r0 * s0 + r1 * s1, total).alias("recall"),
                 _safe(f0 * s0 + f1 * s1, total).alias("f1_score"), total.alias("support")),
    )
    out = c.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("support", F.col("support").cast("bigint"))
