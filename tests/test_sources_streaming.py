"""File sources, sinks and the streaming jobs."""

import os

import pytest
from pyspark.sql import functions as F

from cardlens.operators import churn as ch
from cardlens.sources import files as fl
from conftest import SF_SMALL


def test_missing_folder_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        fl.load_prime(spark, str(tmp_path / "nothing-here"))
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        fl.load_prime(spark, str(empty))


def test_ragged_files_union_by_name(spark, tmp_path):
    d = tmp_path / "prime"
    d.mkdir()
    (d / "jan.csv").write_text("RIM_NO,CREDIT_LIMIT,STATUS\n\" 1,234.00\",\"2,000.50\",NORM\n", encoding="latin-1")
    (d / "feb.csv").write_text("RIM_NO,STATUS,OVERDUEAMOUNT,MIN_PAYMENT\n7,N/A,\"1,000\",5\n", encoding="latin-1")
    df = fl.load_prime(spark, str(d))
    rows = {r.source_file: r for r in df.collect()}
    assert "MIN_PAYMENT" not in df.columns and "RIMNO" in df.columns
    assert rows["jan.csv"].RIMNO == 1234 and rows["jan.csv"].CREDIT_LIMIT == 2000.5
    assert rows["jan.csv"].OVERDUEAMOUNT is None
    assert rows["feb.csv"].STATUS is None and rows["feb.csv"].OVERDUEAMOUNT == 1000.0


def test_latest_file_comes_from_names_and_prunes_folders(spark, tmp_path):
    rows = [(i, f"prime {2000 + i % 3}%.csv", "NORM") for i in range(30)]
    root = str(tmp_path / "p")
    spark.createDataFrame(rows, "RIMNO long, source_file string, STATUS string").write.option("header", True) \
        .partitionBy("source_file").csv(root)
    assert fl.source_files(spark, root) == [f"prime {y}%.csv" for y in (2000, 2001, 2002)]
    latest = fl.latest_source_file(spark, root)
    df = fl.read_text_table(spark, root)
    assert latest == ch.latest_file(df) == "prime 2002%.csv"
    newest = df.where(F.col("source_file") == F.lit(latest))
    assert newest.count() == 10
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "source_file" in plan.split("PartitionFilters: [")[1].split("]")[0]
    flat = tmp_path / "flat"
    flat.mkdir()
    for n in ("a b.csv", "c.csv"):
        (flat / n).write_text("RIM_NO\n1\n")
    assert fl.latest_source_file(spark, str(flat)) == "c.csv"
    assert fl.source_files(spark, str(flat)) == sorted(r[0] for r in fl.read_text_table(spark, str(flat))
                                                       .select("source_file").distinct().collect())
    (flat / "c.csv").unlink()
    with pytest.raises(ValueError, match="at least 2"):
        fl.latest_source_file(spark, str(flat))


def test_no_status_column_nobody_churns(spark):
    df = spark.createDataFrame([("h.csv", "1"), ("l.csv", "1"), ("l.csv", "2")], "source_file string, RIMNO string")
    labelled, _ = ch.churn_latest_vs_history(df)
    assert sorted((r.RIMNO, r.CHURN) for r in labelled.collect()) == [("1", 0), ("2", 0)]


def test_scoring_stream_end_to_end(spark, tmp_path):
    from cardlens.operators import txn_features as tf
    from cardlens.plans import training as tr
    from cardlens.sources.adapters import AS_OF, prime_view, txn_view
    from cardlens.streaming import files as st

    prime = prime_view(spark, SF_SMALL)
    txn = txn_view(spark, SF_SMALL)
    latest = ch.latest_file(prime)
    model_root = str(tmp_path / "model")
    tr.run_training(prime.where(F.col("source_file") != latest), txn, AS_OF, id_cols=["RIMNO", "o_orderkey"],
                    out_dir=model_root, max_iter=3)
    new = prime.where(F.col("source_file") == latest).drop("source_file", "MIN_PAYMENT", "OVER_LIMIT")
    cols = [c for c in new.columns]
    landing = str(tmp_path / "landing")
    new.select(*[F.col(c).cast("string").alias(c) for c in cols]).coalesce(1) \
        .write.option("header", True).csv(landing)
    out = str(tmp_path / "out")
    q = st.scoring_stream(spark, landing, out, cols, model_root + "/model",
                          tf.transaction_features(txn, AS_OF), AS_OF,
                          checkpoint=str(tmp_path / "ckpt"),
                          date_formats=["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"])
    q.awaitTermination()
    res = spark.read.parquet(out)
    assert res.count() == new.count()
    assert res.where((F.col("default_probability") < 0) | (F.col("default_probability") > 1)).count() == 0
    # more parts of the same file land: the file is scored anew from all of them, not added to
    n = res.count()
    half = spark.read.option("header", True).csv(landing)
    two = str(tmp_path / "landing2")
    for part in (half.where("o_orderkey % 2 = 0"), half.where("o_orderkey % 2 = 1")):
        part.withColumn("source_file", F.lit("m.csv")).write.mode("append").option("header", True).partitionBy("source_file").csv(two)
        st.scoring_stream(spark, two, str(tmp_path / "out2"), cols, model_root + "/model", tf.transaction_features(txn, AS_OF),
                          AS_OF, checkpoint=str(tmp_path / "ckpt2"),
                          date_formats=["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]).awaitTermination()
    again = spark.read.parquet(str(tmp_path / "out2"))
    assert again.count() == n
    key = lambda rows: sorted((r[0], round(r[2], 12)) for r in rows)
    assert key(map(tuple, again.select("RIMNO", "source_file", "default_probability").collect())) == key(
        map(tuple, res.select("RIMNO", "source_file", "default_probability").collect()))


@pytest.mark.parametrize("parts", [1, 8, 20])
def test_churn_stream_does_not_depend_on_parts(spark, tmp_path, parts):
    from cardlens.streaming import files as st

    rows = [(str(i), str(i % 40), ["NORM", "CLSB", "N/A", "WROF", "CLSC"][i * 7 % 5], f"m{i % 3}.csv") for i in range(300)]
    df = spark.createDataFrame(rows, "event_id string, RIM_NO string, STATUS string, source_file string")
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    for half in (df.where("event_id < '2'"), df.where("event_id >= '2'")):   # two landings, two batches
        half.repartition(parts).write.mode("append").option("header", True).partitionBy("source_file").csv(landing)
        st.per_file_churn_stream(spark, landing, out, ["event_id", "RIM_NO", "STATUS"],
                                 checkpoint=str(tmp_path / "ckpt")).awaitTermination()
    na = df.withColumn("STATUS", F.expr("nullif(STATUS, 'N/A')"))
    want = {(r.event_id, r.CHURN) for r in ch.churn_per_file(na).collect()}
    assert {(r.event_id, r.CHURN) for r in spark.read.parquet(out).collect()} == want


def test_cluster_needs_a_shared_checkpoint_folder():
    from cardlens import session

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.ensure_checkpoint_dir(Session())
