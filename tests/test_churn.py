"""Churn labeller corner cases."""

from cardlens.operators import churn as ch


def test_latest_vs_history(spark):
    rows = [
        # customer 1: in both, every latest row churned -> 1
        ("h.csv", "1", "NORM"), ("l.csv", "1", "clsb"), ("l.csv", "1", " WROF"),
        # customer 2: in both, mixed -> 0
        ("h.csv", "2", "NORM"), ("l.csv", "2", "CLSB"), ("l.csv", "2", "NORM"),
        # customer 3: only history -> stub with 1
        ("h.csv", "3", "NORM"),
        # customer 4: only latest, churn status -> 0
        ("l.csv", "4", "CLSB"),
    ]
    df = spark.createDataFrame(rows, "source_file string, RIMNO string, STATUS string")
    labelled, presence = ch.churn_latest_vs_history(df)
    got = sorted((r.RIMNO, r.source_file, r.CHURN) for r in labelled.collect())
    assert got == [("1", "l.csv", 1), ("1", "l.csv", 1), ("2", "l.csv", 0), ("2", "l.csv", 0),
                   ("3", None, 1), ("4", "l.csv", 0)]
    o = ch.churn_overlap(presence).first()
    assert (o.history_customers, o.in_both, o.fully_churned, o.missing_from_latest, o.only_in_latest) == \
        (3, 2, 1, 1, 1)


def test_per_file(spark):
    rows = [("a", "1", "CLSB"), ("a", "1", "wrof"), ("a", "2", "NORM"), ("b", "1", "NORM"), ("b", None, "CLSB")]
    df = spark.createDataFrame(rows, "source_file string, RIM_NO string, STATUS string")
    got = sorted(((r.source_file, r.RIM_NO, r.CHURN) for r in ch.churn_per_file(df).collect()),
                 key=lambda x: (x[0], x[1] or ""))
    assert got == [("a", "1", 1), ("a", "1", 1), ("a", "2", 0), ("b", None, None), ("b", "1", 0)]


def test_needs_two_files(spark):
    import pytest
    df = spark.createDataFrame([("a", "1", "NORM")], "source_file string, RIMNO string, STATUS string")
    with pytest.raises(ValueError):
        ch.churn_latest_vs_history(df)
