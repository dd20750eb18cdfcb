"""Plan shape guard rails: what must hold at 100 TB, checked on the smallest data."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

# model fitting / search compositions are exercised in test_ml.py
HEAVY = {"m5_m10_train_score", "m7_m8_tune", "pipeline_train_evaluate", "pipeline_score_latest",
         "m3_smote_class_counts"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - HEAVY))
def test_no_cross_products(spark, name):
    plan = _plan(entry_mod.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_txn_aggregate_is_partial_and_pruned(spark):
    df = entry_mod.queries()["t_txn_features"](spark, SF_SMALL)
    df.collect()  # finalise the adaptive plan
    plan = _plan(df)
    assert "partial_count" in plan and "partial_sum" in plan          # map-side combine
    scans = [seg.split("ReadSchema: ")[1].split("\n")[0] for seg in plan.split("FileScan")[1:]
             if "ReadSchema" in seg]
    assert scans
    for schema in scans:
        assert "l_tax" not in schema and "l_comment" not in schema      # column pruning


def test_bucketed_running_totals_partition_by_bucket(spark):
    from pyspark.sql import functions as F
    from cardlens.operators import ordered
    df = spark.range(0, 1000).select((F.col("id") * 13 % 997).alias("k"), F.lit(1).alias("w"))
    plan = _plan(ordered.running_totals(df, "k", ["w"], n_buckets=4))
    assert "_rt_bucket" in plan.split("Window")[1].split("\n")[0]      # no whole-table window
