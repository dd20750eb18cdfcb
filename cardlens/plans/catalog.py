"""Registered queries: one per operator (group) of the blueprint.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
card-shaped views of the shared tables (``cardlens.sources.adapters``).
Floating results are rounded to 4 places and integer results are bigint so
that the DuckDB oracle (``cardlens.plans.oracle``) can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens import schemas
from cardlens.functions import parse_float, parse_int
from cardlens.operators import account_features as af
from cardlens.operators import churn as ch
from cardlens.operators import joins, labels
from cardlens.operators import sketches as sk_
from cardlens.operators import txn_features as tf
from cardlens.sources.adapters import AS_OF, churn_view, prime_view, read_table, txn_view
from cardlens.session import scratch_path, written

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def normalise_output(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles, widen integers to bigint (stable compare against DuckDB)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # half-way nudge + signed-zero removal (mirrored in the oracle SQL)
            c = (F.round(c + F.lit(1e-9), digits) + F.lit(0.0)).alias(f.name)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint").alias(f.name)
        cols.append(c)
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Cleaning (C1, C2, C9, C10)
# ---------------------------------------------------------------------------

def _raw_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    s = lambda x: x.cast("bigint").cast("string")
    cents = F.round(F.abs(F.col("c_acctbal")) * 100).cast("bigint")
    whole = F.floor(cents / 100).cast("bigint")
    raw_int = (
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 0, F.concat(F.lit(" "), s(F.floor(k / 1000)), F.lit(","),
                                   F.lpad(s(k % 1000), 3, "0"), F.lit(".00 ")))
        .when(k % 4 == 1, s(k))
        .when(k % 4 == 2, F.concat(s(k), F.lit(".5")))
        .otherwise(F.concat(F.lit("id"), s(k)))
    )
    raw_float = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 0, F.concat(s(F.floor(whole / 1000)), F.lit(","), F.lpad(s(whole % 1000), 3, "0"),
                                   F.lit("."), F.lpad(s(cents % 100), 2, "0")))
        .when(k % 3 == 1, F.concat(F.lit("\t"), s(k), F.lit(".25")))
        .otherwise(F.lit("n/a"))
    )
    return c.select(k.alias("c_custkey"), raw_int.alias("raw_int"), raw_float.alias("raw_float"))


@register("c1_parse_int")
def q_c1_parse_int(spark, sf_dir):
    df = _raw_number_text(spark, sf_dir)
    return normalise_output(df.select("c_custkey", "raw_int", parse_int("raw_int").alias("parsed_int")))


@register("c2_parse_float")
def q_c2_parse_float(spark, sf_dir):
    df = _raw_number_text(spark, sf_dir)
    return normalise_output(df.select("c_custkey", "raw_float", parse_float("raw_float").alias("parsed_float")))


@register("c9_cap_p99")
def q_c9_cap_p99(spark, sf_dir):
    txn = tf.clean_amounts(txn_view(spark, sf_dir))
    caps = tf.amount_caps(txn)
    counts = tf.outlier_counts(txn, caps)
    names = list(caps)
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(caps[n]).cast("double").alias("p99"),
                 F.col(n).alias("outliers")) for n in names
    ])).alias("r")).select("r.*")
    return normalise_output(stacked)


# ---------------------------------------------------------------------------
# Transaction features (T1-T11), account features
# ---------------------------------------------------------------------------

@register("t_txn_features")
def q_t_txn_features(spark, sf_dir):
    return normalise_output(tf.transaction_features(txn_view(spark, sf_dir), as_of=AS_OF))


@register("f_account_features")
def q_f_account_features(spark, sf_dir):
    df = af.account_features(prime_view(spark, sf_dir), as_of=AS_OF)
    return normalise_output(df.select(
        "o_orderkey", "RIMNO", "GENDER", "ANNUAL_FEE", "JOINING_FEE", "OVERDUEAMOUNT", *af.FEATURE_COLS))


# ---------------------------------------------------------------------------
# Opt-in sketches (C8, C9, P3, T9, T10), held against the exact statistics
# ---------------------------------------------------------------------------

@register("c8_c9_quantile_sketches")
def q_c8_c9_quantile_sketches(spark, sf_dir):
    """Quantiles merged from one stored sketch a file: the rows that count, and whether the value's rank
    is within 0.02 of the wanted one."""
    cols, probs = ["ANNUAL_FEE", "OVERDUEAMOUNT", "CREDIT_LIMIT", "LEDGER_BALANCE"], [0.5, 0.99]
    prime = prime_view(spark, sf_dir).select("source_file", *cols)
    root = scratch_path(spark, f"sketches-{uuid.uuid4().hex}")
    files = sorted(r[0] for r in prime.select("source_file").distinct().collect())
    for part in (files[:-1], files[-1:]):  # the latest month arrives later and is merged with the stored ones
        sk_.store(sk_.quantile_sketches(prime.where(F.col("source_file").isin(part)), cols), root)
    found = sk_.merged_quantiles(spark.read.parquet(root), probs)
    wanted = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("prob"), F.lit(found[c][p]).cast("double").alias("at"),
                                F.col(c).alias("v")) for c in cols for p in probs])
    ranks = prime.select(F.explode(wanted).alias("r")).select("r.*").where("v IS NOT NULL").groupBy("column_name", "prob").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("at")).alias("below"),
        F.count_if(F.col("v") <= F.col("at")).alias("upto"))
    close = (F.col("below") <= (F.col("prob") + 0.02) * F.col("n")) & (F.col("upto") >= (F.col("prob") - 0.02) * F.col("n"))
    return normalise_output(ranks.select("column_name", "prob", "n", close.alias("close")))


@register("t9_t10_distinct_sketches")
def q_t9_t10_distinct_sketches(spark, sf_dir):
    """Distinct merchants and codes a customer from sketches stored a customer and file: the exact counts, and
    whether the estimates are within 5 %."""
    txn = txn_view(spark, sf_dir).withColumn("source_file", F.year("trxn_date").cast("string"))
    cols = ["merch_id", "mcc"]
    root = scratch_path(spark, f"sketches-{uuid.uuid4().hex}")
    sk_.store(sk_.distinct_sketches(txn, schemas.CUSTOMER_ID, cols), root)
    est = sk_.merged_distinct(spark.read.parquet(root), schemas.CUSTOMER_ID, cols)
    exact = txn.where("RIMNO IS NOT NULL").groupBy("RIMNO").agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])
    close = [(F.abs(F.col(c) - F.col(f"n_{c}")) <= 0.05 * F.col(f"n_{c}")).alias(f"{c}_close") for c in cols]
    return normalise_output(exact.join(est, "RIMNO").select("RIMNO", "n_merch_id", "n_mcc", *close))


# ---------------------------------------------------------------------------
# Join + labels (J1, L1-L3) -- the flagship wide labelled frame
# ---------------------------------------------------------------------------

def wide_labelled(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    prime = af.account_features(prime_view(spark, sf_dir), as_of=as_of)
    feats = tf.transaction_features(txn_view(spark, sf_dir), as_of=as_of)
    return labels.with_target(joins.merge_features(prime, feats))


@register("j1_wide_labelled")
def q_j1_wide_labelled(spark, sf_dir):
    df = wide_labelled(spark, sf_dir)
    return normalise_output(df.select(
        "o_orderkey", "RIMNO", schemas.TARGET_COL, *af.FEATURE_COLS, *tf.FEATURE_COLS))


@register("j1_no_txn_match")
def q_j1_no_txn_match(spark, sf_dir):
    """J1 no-match branch: transactions of 2001 only, so most accounts get 0s."""
    txn = txn_view(spark, sf_dir).where(F.col("trxn_date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    feats = tf.transaction_features(txn, as_of=AS_OF)
    prime = prime_view(spark, sf_dir).select("o_orderkey", "RIMNO")
    return normalise_output(joins.merge_features(prime, feats))


@register("l1_default_target")
def q_l1_default_target(spark, sf_dir):
    return normalise_output(labels.with_target(prime_view(spark, sf_dir)).select("o_orderkey", "target"))


@register("l2_unknown_status")
def q_l2_unknown_status(spark, sf_dir):
    return normalise_output(labels.unknown_status_count(prime_view(spark, sf_dir)))


@register("l3_class_balance")
def q_l3_class_balance(spark, sf_dir):
    return normalise_output(labels.class_balance(labels.with_target(prime_view(spark, sf_dir))))


# ---------------------------------------------------------------------------
# Churn (H1-H7)
# ---------------------------------------------------------------------------

def _churn_a(spark, sf_dir):
    prime = prime_view(spark, sf_dir).select(
        F.col("RIMNO").cast("string").alias("RIMNO"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "source_file", "STATUS")
    return ch.churn_latest_vs_history(prime)


@register("h1_churn_latest")
def q_h1_churn_latest(spark, sf_dir):
    labelled, _ = _churn_a(spark, sf_dir)
    return normalise_output(labelled.select("RIMNO", "o_orderkey", "source_file", "STATUS", "CHURN"))


@register("h4_churn_totals")
def q_h4_churn_totals(spark, sf_dir):
    labelled, _ = _churn_a(spark, sf_dir)
    return normalise_output(ch.churn_totals(labelled))


@register("h6_churn_overlap")
def q_h6_churn_overlap(spark, sf_dir):
    _, presence = _churn_a(spark, sf_dir)
    return normalise_output(ch.churn_overlap(presence))


@register("h3_churn_per_file")
def q_h3_churn_per_file(spark, sf_dir):
    return normalise_output(ch.churn_per_file(churn_view(spark, sf_dir))
                            .select("event_id", "source_file", "RIM_NO", "STATUS", "CHURN"))


@register("h5_churn_customers")
def q_h5_churn_customers(spark, sf_dir):
    flags = ch.per_file_flags(churn_view(spark, sf_dir))
    return normalise_output(ch.churn_customers_per_file(flags))


# ---------------------------------------------------------------------------
# Older revision
# ---------------------------------------------------------------------------

@register("v1_v7_statement_features")
def q_v1_v7_statement_features(spark, sf_dir):
    df = af.account_features_statement(prime_view(spark, sf_dir))
    return normalise_output(df.select(
        "o_orderkey", "utilization_ratio_v1", "payment_to_min_ratio", "overdue_severity_v3",
        "overlimit_flag", "account_age_days", "days_since_last_payment_v6", "customer_age_v7"))


@register("v8_v9_txn_uncapped")
def q_v8_v9_txn_uncapped(spark, sf_dir):
    return normalise_output(tf.transaction_features_uncapped(txn_view(spark, sf_dir)))


@register("v10_strict_target")
def q_v10_strict_target(spark, sf_dir):
    return normalise_output(labels.with_target(prime_view(spark, sf_dir), strict=True)
                            .select("o_orderkey", "target"))


@register("v11_join_renamed_key")
def q_v11_join_renamed_key(spark, sf_dir):
    feats = tf.transaction_features_uncapped(txn_view(spark, sf_dir), payment_history=False) \
        .withColumnRenamed("RIMNO", "RIM_NO")
    prime = prime_view(spark, sf_dir).select("o_orderkey", "RIMNO")
    return normalise_output(joins.merge_features(prime, feats, txn_key="RIM_NO"))


# ---------------------------------------------------------------------------
# Feature preparation
# ---------------------------------------------------------------------------

from cardlens.functions import drop_present  # noqa: E402
from cardlens.operators import metrics as mt  # noqa: E402
from cardlens.operators import prepare as pp  # noqa: E402
from cardlens.operators import sampling as sp  # noqa: E402
from cardlens.sources.adapters import score_view  # noqa: E402

PREP_EXCLUDE = ["o_orderkey"]


def prep_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows as loaded (retired columns removed, C4)."""
    return drop_present(prime_view(spark, sf_dir), schemas.RETIRED_PRIME_COLS)


def _fitted(spark, sf_dir):
    df = prep_input(spark, sf_dir)
    return df, pp.fit(df, exclude=PREP_EXCLUDE)


@register("p3_impute_medians")
def q_p3_impute_medians(spark, sf_dir):
    _, art = _fitted(spark, sf_dir)
    return normalise_output(art.stats_frame(spark).where("kind = 'numeric'").select("column_name", "median"))


@register("p4_impute_modes")
def q_p4_impute_modes(spark, sf_dir):
    _, art = _fitted(spark, sf_dir)
    return art.stats_frame(spark).where("kind = 'categorical'").select("column_name", "mode")


@register("p5_label_encode")
def q_p5_label_encode(spark, sf_dir):
    _, art = _fitted(spark, sf_dir)
    return normalise_output(art.label_map)


@register("p6_scale_stats")
def q_p6_scale_stats(spark, sf_dir):
    _, art = _fitted(spark, sf_dir)
    return normalise_output(art.stats_frame(spark).where("kind = 'numeric'").select("column_name", "mean", "std"))


@register("p_fit_transform")
def q_p_fit_transform(spark, sf_dir):
    df, art = _fitted(spark, sf_dir)
    return normalise_output(pp.transform(df, art, keep=["o_orderkey"]))


@register("p10_p12_transform_unseen")
def q_p10_p12_transform_unseen(spark, sf_dir):
    """Fit on history files, transform the latest file: an unseen category
    (-1), a missing feature (0 after scaling) and an extra column (dropped)."""
    df = prep_input(spark, sf_dir)
    latest = ch.latest_file(df)
    art = pp.fit(df.where(F.col("source_file") != F.lit(latest)), exclude=PREP_EXCLUDE)
    new = df.where(F.col("source_file") == F.lit(latest)).drop("TOTAL_HOLD") \
        .withColumn("EXTRA_COL", F.lit(1.0))
    return normalise_output(pp.transform(new, art, keep=["o_orderkey"]))


@register("c13_non_finite")
def q_c13_non_finite(spark, sf_dir):
    df = prep_input(spark, sf_dir)
    types = dict(df.dtypes)
    nums = [c for c in pp.feature_columns(df, exclude=PREP_EXCLUDE) if types[c] == "double"]
    return normalise_output(pp.non_finite_report(df, nums))


# ---------------------------------------------------------------------------
# Metrics (E1-E7, M11, M12) on scored rows
# ---------------------------------------------------------------------------

def _scored(spark, sf_dir):
    return mt.predict_label(score_view(spark, sf_dir), proba="proba")


@register("e1_e2_auc_ks")
def q_e1_e2_auc_ks(spark, sf_dir):
    return normalise_output(mt.ranking_metrics(score_view(spark, sf_dir)))


@register("e3_roc_points")
def q_e3_roc_points(spark, sf_dir):
    return normalise_output(mt.roc_points(score_view(spark, sf_dir)))


@register("e4_threshold_metrics")
def q_e4_threshold_metrics(spark, sf_dir):
    return normalise_output(mt.threshold_metrics(_scored(spark, sf_dir)))


@register("e_evaluate")
def q_e_evaluate(spark, sf_dir):
    return normalise_output(mt.evaluate(score_view(spark, sf_dir)))


@register("e5_confusion")
def q_e5_confusion(spark, sf_dir):
    return normalise_output(mt.confusion(_scored(spark, sf_dir)))


@register("e6_class_report")
def q_e6_class_report(spark, sf_dir):
    return normalise_output(mt.class_report(_scored(spark, sf_dir)))


@register("e7_class_distribution")
def q_e7_class_distribution(spark, sf_dir):
    return normalise_output(labels.class_balance(score_view(spark, sf_dir), target="y"))


@register("m11_threshold")
def q_m11_threshold(spark, sf_dir):
    return normalise_output(_scored(spark, sf_dir).select("id", "predicted_label"))


@register("m12_flag_summary")
def q_m12_flag_summary(spark, sf_dir):
    return normalise_output(mt.flag_summary(_scored(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Split (M1, M2)
# ---------------------------------------------------------------------------

def _labelled_rows(spark, sf_dir):
    return labels.with_target(prime_view(spark, sf_dir)).select("o_orderkey", "RIMNO", "target")


@register("m1_split")
def q_m1_split(spark, sf_dir):
    df = sp.train_test_split(_labelled_rows(spark, sf_dir), id_cols=["o_orderkey"])
    return normalise_output(df.select("o_orderkey", "target", "is_test"))


@register("m1_split_exact")
def q_m1_split_exact(spark, sf_dir):
    df = sp.train_test_split(_labelled_rows(spark, sf_dir), id_cols=["o_orderkey"], exact=True)
    return normalise_output(df.select("o_orderkey", "target", "is_test"))


@register("m2_split_summary")
def q_m2_split_summary(spark, sf_dir):
    df = sp.train_test_split(_labelled_rows(spark, sf_dir), id_cols=["o_orderkey"])
    return normalise_output(sp.split_summary(df, n_features=len(pp.feature_columns(
        prep_input(spark, sf_dir), exclude=PREP_EXCLUDE))))


# ---------------------------------------------------------------------------
# Nearest neighbours (M4)
# ---------------------------------------------------------------------------

from cardlens.operators import neighbours as nb  # noqa: E402


@register("m4_knn")
def q_m4_knn(spark, sf_dir):
    """Exact 5 nearest neighbours of every embedding inside its label."""
    emb = read_table(spark, sf_dir, "embeddings")
    return normalise_output(nb.knn(emb, "vec_id", "embedding", group_col="label", k=schemas.SMOTE_K_NEIGHBORS))


@register("m4_knn_ties")
def q_m4_knn_ties(spark, sf_dir):
    """Exact 5 nearest neighbours on coded vectors, where many distances tie (the smaller id is nearer)."""
    coded = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.array(
            (F.col("c_nationkey") % 5).cast("double"), F.floor(F.abs("c_acctbal") / 2500).cast("double"),
            (F.col("c_custkey") % 2).cast("double")).alias("code"))
    return normalise_output(nb.knn(coded, "c_custkey", "code", group_col="c_mktsegment",
                                   k=schemas.SMOTE_K_NEIGHBORS))


@register("m4_knn_lsh")
def q_m4_knn_lsh(spark, sf_dir):
    """The bucketed search on every embedding, held against the exact one: neighbours wanted a label, and
    whether at least nine of ten are found."""
    from cardlens.operators import lsh
    emb = read_table(spark, sf_dir, "embeddings")
    exact, found = (nb.knn(emb, "vec_id", "embedding", group_col="label", k=schemas.SMOTE_K_NEIGHBORS, mode=m)
                    for m in ("exact", "lsh"))
    rows = lsh.recall(exact, found, "vec_id").join(emb.select("vec_id", "label"), "vec_id")
    return normalise_output(rows.groupBy("label").agg(F.sum("wanted").alias("n_wanted"), F.sum("hits").alias("hits"))
                            .select("label", "n_wanted", (F.col("hits") >= 0.9 * F.col("n_wanted")).alias("nine_of_ten")))


# ---------------------------------------------------------------------------
# Oversampling, boosting, pipelines
# ---------------------------------------------------------------------------

from cardlens.operators import boosting as bt  # noqa: E402
from cardlens.plans import training as tr  # noqa: E402


def _prepared_split(spark, sf_dir):
    """Labelled rows of the joined frame (account and transaction features), prepared (fit on all rows) and hash-split."""
    df = labels.with_target(tr.build_wide(prime_view(spark, sf_dir), txn_view(spark, sf_dir), AS_OF))
    df = written(sp.train_test_split(df, id_cols=["o_orderkey"]), "wide")
    art = pp.fit(df, exclude=PREP_EXCLUDE + ["is_test"], materialize=False)
    # lineage cut: the oversampler, the validation curve and the scoring read it
    prepared = written(pp.transform(df, art, keep=["o_orderkey", "target", "is_test"]), "prepared")
    return prepared, art


@register("m3_smote_class_counts")
def q_m3_smote_class_counts(spark, sf_dir):
    """Training part after oversampling: both classes at the majority size."""
    prepared, art = _prepared_split(spark, sf_dir)
    train = prepared.where("is_test = 0").drop("is_test")
    res = sp.smote(train, art.feature_order, "o_orderkey")
    return normalise_output(res.groupBy("target").agg(F.count(F.lit(1)).alias("n_rows")))


@register("m3_smote_rows")
def q_m3_smote_rows(spark, sf_dir):
    """Every synthetic row of the embeddings' smaller labels, value by value."""
    emb = read_table(spark, sf_dir, "embeddings")
    cols = [f"e{i:02d}" for i in range(64)]
    wide = emb.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    synthetic = sp.smote(wide, cols, "vec_id", "label").where("is_synthetic = 1")
    return normalise_output(synthetic.select("label", *cols))


@register("h7_no_status")
def q_h7_no_status(spark, sf_dir):
    """H7: without a status column nobody of the latest file has churned; history customers that are gone have."""
    prime = prime_view(spark, sf_dir).select(
        F.col("RIMNO").cast("string").alias("RIMNO"), F.col("o_orderkey").cast("string").alias("o_orderkey"), "source_file")
    labelled, _ = ch.churn_latest_vs_history(prime)
    return normalise_output(labelled.select("RIMNO", "o_orderkey", "source_file", "CHURN"))


@register("m5_m10_train_score")
def q_m5_m10_train_score(spark, sf_dir):
    """Oversample, grow boosted trees up to the original's rounds with early stopping on the AUC of
    the test part, score the test part (no SQL twin: model internals)."""
    prepared, art = _prepared_split(spark, sf_dir)
    train = prepared.where("is_test = 0").drop("is_test")
    test = prepared.where("is_test = 1").drop("is_test")
    # read by the bins, the class sizes and the chunks
    oversampled = written(sp.smote(train, art.feature_order, "o_orderkey"), "oversampled")
    model = bt.train(oversampled, art.feature_order, valid_df=test)
    return normalise_output(model.score(test, keep=["o_orderkey", "target"]))


@register("pipeline_train_evaluate")
def q_pipeline_train_evaluate(spark, sf_dir):
    """End-to-end training pipeline on the wide frame; the hold-out metrics."""
    res = tr.run_training(prime_view(spark, sf_dir), txn_view(spark, sf_dir), AS_OF,
                          id_cols=["o_orderkey"])
    return normalise_output(res.metrics)


# ---------------------------------------------------------------------------
# File sources and sinks (S1-S6, U1, K1-K3): round trips through raw files
# written from the given tables into the shared checkpoint folder
# ---------------------------------------------------------------------------

from cardlens.operators import sinks as sk  # noqa: E402
from cardlens.session import scratch_path  # noqa: E402
from cardlens.sources import files as fl  # noqa: E402
from cardlens.functions import days_between, as_of_literal  # noqa: E402


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def write_raw_prime(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Monthly-file layout of the bank extract: text amounts with thousands
    separators, raw ``RIM_NO`` key, Latin-1 text, and older files (before
    1998) without the ``TOTAL_HOLD`` column."""
    p = prime_view(spark, sf_dir)
    fmt = {
        "RIM_NO": F.format_number("RIMNO", 2),
        "CREDIT_LIMIT": F.format_number("CREDIT_LIMIT", 2),
        "OVERDUEAMOUNT": F.format_number("OVERDUEAMOUNT", 4),
        "ORGANIZATION": F.concat(F.lit("Société "), F.col("ORGANIZATION")),
    }
    for c, kind in p.dtypes:
        if kind == "timestamp_ntz":
            fmt[c] = F.date_format(c, "dd/MM/yyyy" if c == "LAST_PAYMENT_DATE" else "yyyy-MM-dd")
    raw = p.withColumns(fmt).drop("RIMNO")
    w = lambda df: df.write.mode("append").option("header", True).option("encoding", fl.LATIN) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .partitionBy("source_file").csv(root)
    w(raw.where(F.col("source_file") < F.lit("prime_1998.csv")).drop("TOTAL_HOLD"))
    w(raw.where(F.col("source_file") >= F.lit("prime_1998.csv")))


def write_raw_transactions(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Transaction files with the bank's raw headers, all columns as text."""
    names = {name: raw for raw, name in schemas.TXN_COLUMN_NAMES.items()}
    t = txn_view(spark, sf_dir)
    t.select(*[(F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind == "timestamp_ntz" else F.col(c)).alias(names.get(c, c))
               for c, kind in t.dtypes]) \
        .write.mode("overwrite").option("header", True).option("encoding", fl.LATIN) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)


@register("s1_prime_csv_load")
def q_s1_prime_csv_load(spark, sf_dir):
    """Load ragged monthly CSVs back into typed rows."""
    root = _fresh(spark, "prime-csv")
    write_raw_prime(spark, sf_dir, root)
    df = fl.load_prime(spark, root, date_formats=["yyyy-MM-dd", "dd/MM/yyyy"])
    now = as_of_literal(AS_OF)
    return normalise_output(df.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "RIMNO", "source_file", "STATUS", "CREDIT_LIMIT",
        "OVERDUEAMOUNT", "TOTAL_HOLD", "ORGANIZATION",
        days_between(now, F.col("CREATION_DATE")).alias("days_created"),
        days_between(now, F.col("LAST_PAYMENT_DATE")).alias("days_paid"),
        F.lit("MIN_PAYMENT" in df.columns).cast("int").alias("has_retired_col")))


@register("s5_s6_churn_from_csv")
def q_s5_s6_churn_from_csv(spark, sf_dir):
    """S5 + S6 + H1: all-text scan of the monthly files, latest file by name."""
    root = _fresh(spark, "prime-csv")
    write_raw_prime(spark, sf_dir, root)
    text = fl.read_text_table(spark, root)
    text = text.withColumnRenamed("RIM_NO", "RIMNO")   # C3
    labelled, _ = ch.churn_latest_vs_history(text, latest=fl.latest_source_file(spark, root))
    return normalise_output(labelled.select("RIMNO", "o_orderkey", "source_file", "STATUS", "CHURN"))


@register("s4_txn_csv_features")
def q_s4_txn_csv_features(spark, sf_dir):
    """Transaction CSVs with raw headers -> canonical frame -> T1-T11."""
    root = _fresh(spark, "txn-csv")
    write_raw_transactions(spark, sf_dir, root)
    txn = fl.load_transactions(spark, root)
    return normalise_output(tf.transaction_features(txn, as_of=AS_OF))


@register("k1_scores_csv")
def q_k1_scores_csv(spark, sf_dir):
    """K1 + K3: write scores as CSV (and per-file folders), read them back."""
    root = _fresh(spark, "scores")
    scored = mt.predict_label(score_view(spark, sf_dir).withColumnRenamed("proba", "default_probability")
                              .withColumnRenamed("id", "RIMNO"))
    sk.write_scores(scored, root + "/flat")
    sk.write_per_file(churn_view(spark, sf_dir), root + "/per_file")
    back = spark.read.option("header", True).schema(schemas.SCORES_SCHEMA).csv(root + "/flat")
    per_file = spark.read.option("header", True).csv(root + "/per_file") \
        .groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_in_file"))
    flat = back.agg(F.count(F.lit(1)).alias("n_scores"), F.sum("predicted_label").alias("n_flagged"),
                    F.sum("default_probability").alias("sum_probability"))
    # the three totals are one row of scalars
    totals = flat.first().asDict()
    return normalise_output(per_file.withColumns({c: F.lit(v) for c, v in totals.items()}))


@register("k2_churn_latest_csv")
def q_k2_churn_latest_csv(spark, sf_dir):
    """K2: the labelled latest snapshot, written as CSV and read back."""
    labelled, _ = _churn_a(spark, sf_dir)
    df = labelled.select("RIMNO", "o_orderkey", "source_file", "STATUS", "CHURN")
    root = _fresh(spark, "churn-latest")
    sk.write_csv(df, root)
    return normalise_output(spark.read.option("header", True).schema(df.schema).csv(root))


@register("k3_churn_per_file_csv")
def q_k3_churn_per_file_csv(spark, sf_dir):
    """K3: every file's rows with CHURN, one folder per file, read back."""
    df = ch.churn_per_file(churn_view(spark, sf_dir)).select("event_id", "source_file", "RIM_NO", "STATUS", "CHURN")
    root = _fresh(spark, "churn-per-file")
    sk.write_per_file(df, root)
    back = spark.read.option("header", True).schema(df.schema).csv(root)
    return normalise_output(back.select(*df.columns))


# ---------------------------------------------------------------------------
# Streaming (per-file churn as files land) and the remaining ML compositions
# ---------------------------------------------------------------------------

from cardlens.streaming import files as st  # noqa: E402


@register("h3_churn_stream")
def q_h3_churn_stream(spark, sf_dir):
    """H3 through Structured Streaming: the per-day status files land in a
    folder (``source_file=<day>/``, many parts per day), the touched days are
    labelled and written idempotently, and the output table is read back."""
    root = _fresh(spark, "stream")
    landing, out = root + "/landing", root + "/out"
    cv = churn_view(spark, sf_dir)
    # rows are dealt at random, so each day's folder holds many parts
    cv.repartition(12).write.option("header", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .partitionBy("source_file").csv(landing)
    q = st.per_file_churn_stream(spark, landing, out, ["event_id", "RIM_NO", "STATUS"],
                                 checkpoint=root + "/ckpt")
    q.awaitTermination()
    res = spark.read.parquet(out)
    return normalise_output(res.select(
        F.col("event_id").cast("bigint").alias("event_id"), "source_file", "RIM_NO", "STATUS", "CHURN"))


@register("m7_draws_folds")
def q_m7_draws_folds(spark, sf_dir):
    """The search's draws (positions in the grid) and the rows held out in each fold of the training part."""
    df = sp.train_test_split(labels.with_target(prep_input(spark, sf_dir)), id_cols=["o_orderkey"])
    folds = df.where("is_test = 0").groupBy(bt.fold_column("o_orderkey").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_held"), F.sum("target").alias("n_held_default"))
    draws = F.array(*[F.struct(F.lit(d).alias("draw"), F.lit(g).alias("grid_index"))
                      for d, g in enumerate(bt.sample_indices())])
    return normalise_output(folds.withColumn("d", F.explode(draws)).select(
        "d.draw", "d.grid_index", "fold", "n_held", "n_held_default"))


def _auc_table(spark, sf_dir):
    """AUC of the scored rows in groups that stand for draws, folds and rounds: draw, fold, round, auc."""
    rows = score_view(spark, sf_dir).where("y IS NOT NULL AND proba IS NOT NULL").select(
        (F.col("id") % 7).cast("int").alias("draw"), (F.col("id") % 3).cast("int").alias("fold"),
        F.col("proba").alias("score"), "y")
    counts = rows.groupBy("draw", "fold", "score").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    return mt.auc_by(counts, ["draw", "fold"])


@register("m8_pick")
def q_m8_pick(spark, sf_dir):
    """The draw that a search picks from its (draw, fold, AUC) table; the AUCs are those of the scored rows."""
    table = _auc_table(spark, sf_dir).select("draw", "fold", F.col("AUC").alias("auc"))
    return normalise_output(bt.pick_draw(table))


@register("m6_early_stop")
def q_m6_early_stop(spark, sf_dir):
    """Rounds kept under the patience rule; each round's AUC is that of a part of the scored rows."""
    aucs = [r.AUC for r in _auc_table(spark, sf_dir).orderBy("draw", "fold").collect()]  # 21 rounds
    kept, stopped = bt.best_prefix(aucs, patience=5)
    rounds = spark.range(1).select(F.posexplode(F.array(*[F.lit(float(a)) for a in aucs])).alias("round", "auc"))
    return normalise_output(rounds.select("round", "auc", (F.col("round") < kept).alias("kept"), F.lit(stopped).alias("stopped")))


#: A fixed ensemble of three trees over three snapshot columns: tree, node, feature, threshold, low, high, value.
FIXED_TREES = [
    (0, 0, 0, 150000.0, 1, 2, 0.0), (0, 1, 1, 2000.0, 3, 4, 0.0), (0, 2, -1, 0.0, 2, 2, -0.25),
    (0, 3, -1, 0.0, 3, 3, 0.5), (0, 4, -1, 0.0, 4, 4, -0.125),
    (1, 0, 2, 30.0, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, -0.75), (1, 2, 0, 0.0, 5, 6, 0.0),
    (1, 5, -1, 0.0, 5, 5, 1.0), (1, 6, 2, 90.0, 13, 14, 0.0), (1, 13, -1, 0.0, 13, 13, 0.25), (1, 14, -1, 0.0, 14, 14, 0.625),
    (2, 0, -1, 0.0, 0, 0, 0.0625),
]


@register("m9_m10_tree_table")
def q_m9_m10_tree_table(spark, sf_dir):
    """A model saved as a table of nodes, loaded again and scored over every snapshot row (NULLs go high)."""
    root = _fresh(spark, "trees")
    cols = ["CREDIT_LIMIT", "OVERDUEAMOUNT", "DELINQUENCY"]
    bt.TrainedModel(FIXED_TREES, cols, -0.5, 3).save(spark, root)
    model = bt.TrainedModel.load(spark, root)
    return normalise_output(model.score(prime_view(spark, sf_dir), keep=["o_orderkey"]), digits=6)


@register("m7_m8_tune")
def q_m7_m8_tune(spark, sf_dir):
    """The training run with the search (20 draws x 3 folds x 100 rounds, oversampling inside each fold,
    refit of the best draw); the per-fold AUC table (no SQL twin)."""
    res = tr.run_training(prime_view(spark, sf_dir), txn_view(spark, sf_dir), AS_OF, id_cols=["o_orderkey"], tune=True)
    return normalise_output(res.tuning)


@register("pipeline_score_latest")
def q_pipeline_score_latest(spark, sf_dir):
    """Folders to outputs: train from the history's CSV files, save model + artifacts + scores, then score the
    latest file's folder from the saved model and read the scores back from disk (S1-S5, M9-M11, K1, K5; no SQL twin)."""
    root = _fresh(spark, "run")
    write_raw_prime(spark, sf_dir, root + "/raw")
    write_raw_transactions(spark, sf_dir, root + "/txn")
    latest = fl.latest_source_file(spark, root + "/raw")
    formats = ["yyyy-MM-dd", "dd/MM/yyyy"]
    tr.train_from_folders(spark, root + "/raw", root + "/txn", AS_OF, root + "/out", id_cols=["o_orderkey"],
                          date_formats=formats, before=latest)
    tr.score_from_folders(spark, root + "/raw", root + "/txn", AS_OF, root + "/out/model", root + "/latest_scores",
                          date_formats=formats, only=latest)
    return normalise_output(spark.read.option("header", True).schema(schemas.SCORES_SCHEMA).csv(root + "/latest_scores"))


@register("u2_u4_id_sets")
def q_u2_u4_id_sets(spark, sf_dir):
    """History ids split into 'in both' (semi join) and
    'missing from latest' (anti join)."""
    prime = prime_view(spark, sf_dir).select(F.col("RIMNO").cast("string").alias("RIMNO"), "source_file")
    latest = ch.latest_file(prime)
    hist = prime.where(F.col("source_file") != F.lit(latest))
    last = prime.where(F.col("source_file") == F.lit(latest))
    both = ch.ids_in_both(hist, last).withColumn("membership", F.lit("in_both"))
    gone = ch.ids_missing(hist, last).withColumn("membership", F.lit("missing_from_latest"))
    return both.unionByName(gone)
