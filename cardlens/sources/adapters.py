"""Card-shaped views over the shared benchmark tables.

The shared test data holds no card data, so four deterministic views turn
its tables into the shapes the library consumes.  Every value is derived
from the given rows, so the work grows with them.  The DuckDB oracle builds
the same views independently (``cardlens.plans.oracle``).

* ``prime_view``  orders x customer   -> monthly account snapshots
* ``txn_view``    lineitem x orders   -> card transactions
* ``churn_view``  events              -> per-day status files (all text)
* ``score_view``  events              -> (id, y, proba) for metrics
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: the extraction date the adapters are built for (latest
# ship date in the data is 2001-11-04).
AS_OF = "2001-12-31"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def prime_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    day = F.col("o_orderdate").cast("timestamp_ntz")
    return j.select(
        k.alias("o_orderkey"),
        F.col("o_custkey").alias("RIMNO"),
        F.concat(F.lit("prime_"), F.year(day).cast("string"), F.lit(".csv")).alias("source_file"),
        F.col("c_nationkey").cast("string").alias("BRANCH_ID"),
        F.concat(F.lit("BRANCH "), F.col("c_nationkey").cast("string")).alias("BRANCH_NAME"),
        day.alias("CREATION_DATE"),
        F.when(k % 10 == 0, F.lit(0.0))
        .when(k % 11 == 0, F.lit(None).cast("double"))
        .when(k % 13 == 0, -price)
        .otherwise(price).alias("CREDIT_LIMIT"),
        F.when(F.col("o_orderstatus") == "F", F.lit("a "))
        .when(F.col("o_orderstatus") == "O", F.lit("I")).alias("ACTIVATED"),
        F.when(F.substring("o_orderpriority", 1, 1) == "1", F.lit(" norm "))
        .when(F.substring("o_orderpriority", 1, 1) == "2", F.lit("CLSB"))
        .when(F.substring("o_orderpriority", 1, 1) == "3", F.lit("90DA"))
        .when(F.substring("o_orderpriority", 1, 1) == "4", F.lit("wrof"))
        .otherwise(F.lit("ZZZZ")).alias("STATUS"),
        F.col("o_orderpriority").alias("STATUS_NAME"),
        (k % 120).cast("double").alias("DELINQUENCY"),
        _plus_days(day, F.lit(30)).alias("LAST_STAEMENT_DATE"),
        F.when(k % 2 == 0, F.lit("CLASSIC")).otherwise(F.lit("GOLD")).alias("NAME"),
        F.when(k % 5 == 0, F.lit(None).cast("double"))
        .otherwise((k % 5).cast("double") * 100.0).alias("JOINING_FEE"),
        F.when(k % 5 == 1, F.lit(None).cast("double"))
        .otherwise(F.lit(250.0) + (F.col("o_custkey") % 4).cast("double") * 50.0).alias("ANNUAL_FEE"),
        F.col("c_acctbal").alias("LEDGER_BALANCE"),
        (price * 0.4).alias("AVAILABLE_LIMIT"),
        (price / 20.0).alias("LAST_PAYMENT_AMOUNT"),
        F.when(k % 17 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_plus_days(day, (k % 90).cast("int"))).alias("LAST_PAYMENT_DATE"),
        ((k % 3).cast("double") * 10.0).alias("TOTAL_HOLD"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("M"))
        .when(F.col("c_nationkey") % 3 == 1, F.lit("F")).alias("GENDER"),
        F.when(F.col("c_custkey") % 23 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_plus_days(day, -(F.lit(6570) + (F.col("c_custkey") % 40).cast("int") * 365))).alias("DOB"),
        F.concat(F.lit("ORG"), (F.col("c_custkey") % 7).cast("string")).alias("ORGANIZATION"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("PRIMARY"))
        .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(" prim "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None).cast("string"))
        .otherwise(F.lit("SUPPLEMENTARY")).alias("CUSTOMER_TYPE"),
        F.when(k % 8 == 0, _plus_days(day, (F.col("o_custkey") % 700).cast("int")))
        .when(k % 19 == 0, _plus_days(day, F.lit(-5))).alias("CLOSURE_DATE"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(price / 10.0).alias("OVERDUEAMOUNT"),
        (k % 36).cast("double").alias("NO_OF_CYCLES"),
        F.when(k % 3 == 0, F.concat(F.lit("C"), k.cast("string"))).alias("FIRST_REPLACED_CARD"),
        F.when(k % 6 == 0, F.concat(F.lit("D"), k.cast("string"))).alias("SECOND_REPLACED_CARD"),
        F.when(k % 12 == 0, F.concat(F.lit("E"), k.cast("string"))).alias("THIRD_REPLACED_CARD"),
        F.when(k % 9 == 0, F.lit(0.0)).otherwise(price / 100.0).alias("MIN_PAYMENT"),
        F.when(k % 6 == 0, F.lit(50.0)).when(k % 6 == 1, F.lit(None).cast("double"))
        .otherwise(F.lit(0.0)).alias("OVER_LIMIT"),
        F.concat(F.lit("GEN"), (F.year(day) - 1994).cast("string")).alias("CARD_PRODUCT"),
    )


def txn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    ln = F.col("l_linenumber")
    ok = F.col("l_orderkey")
    net = F.floor(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).cast("bigint")
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    return j.select(
        ok.alias("l_orderkey"),
        ln.alias("l_linenumber"),
        F.when((ln % 7 == 0) & (F.col("l_suppkey") % 50 == 0), F.lit(None).cast("bigint"))
        .otherwise(F.col("o_custkey")).alias("RIMNO"),
        F.concat(F.lit("ITEM "), F.col("l_partkey").cast("string")).alias("description"),
        _plus_days(ship, F.lit(1)).alias("post_date"),
        ship.alias("trxn_date"),
        F.when((F.col("l_returnflag") == "A") & (ln == 3), F.lit("EGP"))
        .when(F.col("l_returnflag") == "A", F.lit("818"))
        .when(F.col("l_returnflag") == "R", F.lit("840")).alias("ccy"),
        F.col("l_quantity").alias("orig_amount"),
        F.when((ln == 5) & (ok % 3 == 0), F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice")).alias("billing_amt"),
        (F.col("l_partkey") % 50).cast("string").alias("mcc"),
        F.when(ln == 4, F.lit(None).cast("string"))
        .otherwise(F.col("l_suppkey").cast("string")).alias("merch_id"),
        F.when(ok % 9 == 0,
               F.concat(F.floor(net / 1000).cast("bigint").cast("string"), F.lit(","),
                        F.lpad((net % 1000).cast("string"), 3, "0")))
        .otherwise(net.cast("string")).alias("settlement_amt"),
        F.when(ln == 2, F.lit("true"))
        .when(F.col("l_linestatus") == "F", F.lit(" y "))
        .otherwise(F.lit("N")).alias("reversal_flag"),
        F.when(ln == 1, F.lit(None).cast("string"))
        .otherwise(F.substring(F.lit("TTFTFTTTFF"), (ok % 5 + 1).cast("int"), (ln % 4 + 1).cast("int")))
        .alias("payment_history"),
    )


def churn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("RIM_NO"),
        F.concat(F.lit("day_"), F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"), F.lit(".csv"))
        .alias("source_file"),
        F.when(F.col("event_type") == "error", F.lit("CLSB"))
        .when(F.col("event_type") == "signup", F.lit("wrof "))
        .otherwise(F.lit("NORM")).alias("STATUS"),
    )


def score_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "error").cast("int").alias("y"),
        (F.col("value") / 500.0).alias("proba"),
    )
