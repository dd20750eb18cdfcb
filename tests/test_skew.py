"""A key with a third of the rows is split by the joins that carry rows."""

import pytest
from pyspark.sql import functions as F

from cardlens.operators import churn, joins

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 997)
    df = spark.range(40_000, numPartitions=8).select(
        key.cast("string").alias("RIMNO"), key.cast("string").alias("RIM_NO"), F.md5(F.col("id").cast("string")).alias("pad"),
        F.when(F.col("id") % 2 == 0, "a.csv").otherwise("b.csv").alias("source_file"), F.lit("CLSB").alias("STATUS"))
    yield df
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _splits(df):
    n = len(df.collect())
    return n, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_features_join_splits_hot_customer(skewed):
    feats = skewed.where("RIMNO IS NOT NULL").groupBy("RIMNO").agg(F.count("*").alias("n"))
    assert _splits(joins.merge_features(skewed.drop("RIM_NO"), feats)) == (40_000, True)


def test_churn_joins_split_hot_customer(skewed):
    labelled, _ = churn.churn_latest_vs_history(skewed.drop("RIM_NO"))
    assert _splits(labelled.where("pad IS NOT NULL")) == (20_000, True)
    assert _splits(churn.churn_per_file(skewed)) == (40_000, True)
