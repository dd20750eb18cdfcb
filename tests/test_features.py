"""Feature, join and label corner cases (values worked out by hand)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardlens.operators import account_features as af
from cardlens.operators import joins, labels
from cardlens.operators import ordered
from cardlens.operators import txn_features as tf

AS_OF = "2024-01-31"


def test_utilisation_and_ledger_ratio(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 0.0), (3, None), (4, -100.0)],
                               "k int, CREDIT_LIMIT double").withColumn("LEDGER_BALANCE", F.lit(50.0))
    out = af.account_features(df, AS_OF, stats={}).orderBy("k").collect()
    assert [r.utilization_ratio for r in out] == [0.5, 0.0, 0.0, -0.5]
    assert [r.ledger_to_limit_ratio for r in out] == [0.5, 0.0, 0.0, 0.0]


def test_p99_cap_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "OVERDUEAMOUNT double")
    stats = af.snapshot_stats(df)
    assert stats["overdue_p99"] == pytest.approx(3.97)
    got = [r.OVERDUEAMOUNT for r in af.clean_snapshot(df, stats).collect()]
    assert got[:3] == [1.0, 2.0, 3.0] and got[3] == pytest.approx(3.97) and got[4] is None


def test_exact_quantile_matches_numpy(spark):
    """Several columns, heavy ties, NULLs, extreme ranks: only the ranges
    holding a wanted rank are ordered, the result equals numpy's."""
    import numpy as np

    n = 4000
    a = [float((i * 7919) % 997) for i in range(n)]
    b = [None if i % 11 == 0 else float(i % 3) for i in range(n)]       # three values, many copies
    c = [float(i * i % 50021) - 20000.0 for i in range(n)]
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = ordered.exact_quantiles(df, ["a", "b", "c"], probs, n_buckets=5)
    for name, vals in (("a", a), ("b", b), ("c", c)):
        arr = np.array([v for v in vals if v is not None])
        for p in probs:
            assert got[name][p] == pytest.approx(float(np.quantile(arr, p))), (name, p)


def test_running_totals_bucketed_equals_window(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 37) % 3001).alias("k"), (F.col("id") % 5).alias("w"))
    a = {r.k: r.cum_w for r in ordered.running_totals(df, "k", ["w"], n_buckets=9).collect()}
    b = {r.k: r.cum_w for r in ordered.running_totals(df, "k", ["w"], n_buckets=1).collect()}
    assert a == b


def test_dense_index_splits_text_with_a_common_prefix(spark):
    """Values that share a long prefix lie in several ranges; a NULL group is a group of its own."""
    rows = [(g, f"CUSTOMER_{i:05d}") for g in ("a", None) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v string")
    out = ordered.dense_index(df, "v", by=["g"], n_buckets=6)
    assert sorted((r.g or "", r.v, r["index"]) for r in out.collect()) == sorted(
        (g or "", v, int(v[-5:])) for g, v in rows)
    ranges = df.repartitionByRange(6, "g", "v").select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert max(r["count"] for r in ranges.collect()) < 1500


def _txn(spark, rows):
    return spark.createDataFrame(rows, "RIMNO long, billing_amt double, ccy string, reversal_flag string, "
                                       "merch_id string, mcc string, trxn_date timestamp_ntz")


def test_transaction_flags_and_null_key(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 10.0, "818", " y ", "m1", "1", t), (1, 20.0, "840", "TRUE", "m1", "2", t),
            (1, 30.0, None, "N", None, "2", t), (1, 40.0, "x", None, "m2", None, None),
            (None, 99.0, "818", "Y", "m9", "9", t)]
    out = tf.aggregate_transactions(tf.clean_amounts(_txn(spark, rows)), as_of=AS_OF).collect()
    assert len(out) == 1  # NULL key forms no group
    r = out[0]
    assert (r.txn_count, r.txn_intl_count, r.txn_reversal_count) == (4, 3, 2)
    assert (r.unique_merchants, r.unique_mcc, r.days_since_last_txn) == (2, 2, 30)
    assert r.txn_mean_amount == 25.0


def test_join_without_transactions_fills_zero(spark):
    prime = spark.createDataFrame([(1,), (2,)], "RIMNO long")
    feats = spark.createDataFrame([(1, 3, 7)], "RIMNO long, txn_count bigint, days_since_last_txn bigint")
    out = {r.RIMNO: r for r in joins.merge_features(prime, feats).collect()}
    assert (out[2].txn_count, out[2].days_since_last_txn) == (0, 0)
    assert out[1].days_since_last_txn == 7


def test_target_mapping(spark):
    df = spark.createDataFrame([(" norm ",), ("wrof",), ("ZZZZ",), (None,)], "STATUS string")
    assert [r.target for r in labels.with_target(df).collect()] == [0, 1]
    assert labels.unknown_status_count(df).first()[0] == 2


def test_success_rate_v8(spark):
    df = spark.createDataFrame([(1, "TTF"), (1, "T"), (1, None)], "RIMNO long, payment_history string") \
        .withColumn("billing_amt", F.lit(0.0))
    r = tf.transaction_features_uncapped(df).first()
    assert r.payment_success_rate == 0.75


def test_quantiles_order_only_the_values_near_the_wanted_ranks(spark, monkeypatch):
    """Of many distinct values, those between the bounds alone are shuffled; NaN, NULL and infinities keep their places."""
    import numpy as np

    spans, plain = [], ordered._values_at_ranks
    monkeypatch.setattr(ordered, "_values_at_ranks", lambda df, s, r: spans.append(s) or plain(df, s, r))
    n = 50_000
    a = [float((i * 7919) % 49_999) / 3 for i in range(n)]
    b = [None if i % 7 == 0 else float("nan") if i % 7 == 1 else float("inf") if i == 2 else -a[i] for i in range(n)]
    df = spark.createDataFrame(list(zip(a, b, strict=True)), "a double, b double")
    got = ordered.exact_quantiles(df, ["a", "b"], [0.5, 0.99])
    kept = [np.array(a), np.array([v for v in b if v is not None and v == v])]
    assert len(spans) == 1  # no second try
    for i, (c, v) in enumerate(zip("ab", kept, strict=True)):
        for j, p in enumerate((0.5, 0.99)):
            assert got[c][p] == pytest.approx(float(np.quantile(v, p)), rel=1e-12)
            low, high = spans[0][i, j]
            assert ((v >= low) & (v <= high)).mean() < 0.002


def test_transaction_features_evaluate_their_source_once(spark):
    """The cap and the aggregate read the written columns, not the source's rows a second time."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    t = _txn(spark, [(i % 3, float(i), "818", "N", "m", "1", None) for i in range(40)])
    out = tf.transaction_features(t.mapInArrow(counted, t.schema), as_of="2001-12-31").collect()
    assert sum(r.txn_count for r in out) == 40
    assert seen.value == 40
