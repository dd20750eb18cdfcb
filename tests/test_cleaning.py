"""Corner cases of the scalar cleaning expressions (hand-worked values)."""

import math

from pyspark.sql import functions as F

from cardlens.functions import churn_key, finite_or_zero, norm_text, parse_float, parse_int, parse_timestamp


def _one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_parse_int(spark):
    df = _one_col(spark, [" 1,234.00", "12.5", "", None, "\t42\n", "1.00.00", "-7"])
    got = [r[0] for r in df.select(parse_int("x")).collect()]
    assert got == [1234, None, None, None, 42, None, -7]


def test_parse_float(spark):
    df = _one_col(spark, ["1,234.50", "x", None, "1.0d", " 2e3 ", "nan", "inf"])
    got = [r[0] for r in df.select(parse_float("x")).collect()]
    assert got[:6] == [1234.5, None, None, None, 2000.0, None]
    assert math.isinf(got[6])


def test_norm_text_and_churn_key(spark):
    df = _one_col(spark, ["  wrof\t", None, " 1,234.00 "])
    rows = df.select(norm_text("x").alias("n"), churn_key("x").alias("k")).collect()
    assert [r.n for r in rows] == ["WROF", None, "1,234.00"]
    assert [r.k for r in rows] == ["wrof", None, "1234.00"]


def test_finite_or_zero(spark):
    df = _one_col(spark, [1.5, None, float("nan"), float("inf"), float("-inf")], "double")
    assert [r[0] for r in df.select(finite_or_zero("x")).collect()] == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_parse_timestamp(spark):
    df = _one_col(spark, ["2024-03-01", "31/12/2024", "garbage", None, "2024-03-01 10:20:30"])
    got = [r[0] for r in df.select(F.date_format(parse_timestamp("x"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2024-03-01 00:00:00", "2024-12-31 00:00:00", None, None, "2024-03-01 10:20:30"]


def test_days_between_floor_and_timezone(spark):
    import datetime as dt
    from cardlens.functions import as_of_literal, days_between
    rows = [(dt.datetime(2024, 1, 1, 12, 0), ), (dt.datetime(2024, 1, 31, 0, 0),), (dt.datetime(2024, 2, 1, 6, 0),),
            (dt.datetime(2023, 6, 15, 0, 0),), (None,)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r[0] for r in df.select(days_between(as_of_literal("2024-01-31"), "t")).collect()]
            assert got == [29, 0, -2, 230, None], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
