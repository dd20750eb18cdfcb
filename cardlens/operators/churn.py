"""Churn labels.

Latest-vs-history (H1): one ``groupBy(id)`` over all snapshot rows yields,
per customer, whether it appears in the latest file, in history, and
whether every latest row has a churn status.  That single shuffle replaces
the original's separate ID sets, intersection, difference and grouped
``all``; the labelled latest rows are then a join back on the id, and the
stubs for customers missing from the latest file are a filter of the same
per-customer table.

Per-file (H3): ``groupBy(file, id).agg(bool_and)`` over all files at once
(no loop over files), joined back on (file, id).

Both aggregates are written into the shared folder before the join back, so
AQE can split an id that holds a large share of the rows.

``bool_and`` skips NULL, so the status test is coalesced to false first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens import schemas
from cardlens.functions import churn_key, norm_text
from cardlens.session import written


def _normalise(df: DataFrame, id_col: str, status_col: str) -> DataFrame:
    cols = {id_col: churn_key(id_col)}
    if status_col in df.columns:
        cols[status_col] = norm_text(status_col)
    return df.withColumns(cols)


def latest_file(df: DataFrame, file_col: str = schemas.SOURCE_FILE_COL) -> str:
    """The greatest file name; at least two files are required."""
    row = df.agg(F.max(file_col).alias("latest"), F.count_distinct(file_col).alias("n")).first()
    if row is None or row["n"] < 2:
        raise ValueError(f"need at least 2 snapshot files, found {0 if row is None else row['n']}")
    return row["latest"]


def customer_presence(df: DataFrame, latest: str, statuses: Sequence[str] = schemas.CHURN_STATUSES_LATEST,
                      id_col: str = schemas.CUSTOMER_ID, file_col: str = schemas.SOURCE_FILE_COL,
                      status_col: str = schemas.STATUS_COL) -> DataFrame:
    """One row per customer id: in_latest, in_history, all_churn (latest rows only)."""
    is_latest = F.col(file_col) == F.lit(latest)
    if status_col in df.columns:
        churned = F.coalesce(F.col(status_col).isin(list(statuses)), F.lit(False))
        all_churn = F.coalesce(F.bool_and(F.when(is_latest, churned)), F.lit(False))
    else:
        all_churn = F.lit(False)  # H7: no status column -> nobody churned
    return (
        df.where(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(
            F.bool_or(is_latest).alias("in_latest"),
            F.bool_or(~is_latest).alias("in_history"),
            all_churn.alias("all_churn"),
        )
    )


def churn_latest_vs_history(df: DataFrame, statuses: Sequence[str] = schemas.CHURN_STATUSES_LATEST,
                            id_col: str = schemas.CUSTOMER_ID, file_col: str = schemas.SOURCE_FILE_COL,
                            status_col: str = schemas.STATUS_COL,
                            latest: str | None = None) -> tuple[DataFrame, DataFrame]:
    """H1: latest snapshot rows with CHURN, plus one stub row (CHURN = 1,
    other columns NULL) per history customer missing from the latest file.

    Returns ``(labelled, presence)``; ``presence`` feeds H6 counts.
    """
    df = _normalise(df, id_col, status_col)
    latest = latest or latest_file(df, file_col)
    presence = written(customer_presence(df, latest, statuses, id_col, file_col, status_col), "presence")
    churned_ids = presence.where("in_latest AND in_history AND all_churn") \
        .select(id_col, F.lit(1).alias(schemas.CHURN_COL))
    latest_rows = df.where(F.col(file_col) == F.lit(latest))
    labelled = latest_rows.join(churned_ids, on=id_col, how="left") \
        .fillna(0, subset=[schemas.CHURN_COL])
    stubs = presence.where("in_history AND NOT in_latest") \
        .select(id_col, F.lit(1).alias(schemas.CHURN_COL))
    out = labelled.unionByName(stubs, allowMissingColumns=True)
    return out.select(*labelled.columns), presence


def churn_totals(labelled: DataFrame) -> DataFrame:
    """H4: totals over rows."""
    c = F.col(schemas.CHURN_COL)
    return labelled.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(c == 1).alias("churned_rows"),
        F.count_if(c != 1).alias("kept_rows"),
    ).withColumns({
        "churn_share": F.col("churned_rows") / F.col("total_rows"),
        "kept_share": F.col("kept_rows") / F.col("total_rows"),
    })


def churn_overlap(presence: DataFrame) -> DataFrame:
    """H6: history customers, in both, fully churned, missing from latest."""
    return presence.agg(
        F.count_if("in_history").alias("history_customers"),
        F.count_if("in_latest").alias("latest_customers"),
        F.count_if(F.col("in_history") & F.col("in_latest")).alias("in_both"),
        F.count_if(F.col("in_history") & F.col("in_latest") & F.col("all_churn")).alias("fully_churned"),
        F.count_if(F.col("in_history") & ~F.col("in_latest")).alias("missing_from_latest"),
        F.count_if(~F.col("in_history") & F.col("in_latest")).alias("only_in_latest"),
    )


def per_file_flags(df: DataFrame, statuses: Sequence[str] = schemas.CHURN_STATUSES_PER_FILE,
                   id_col: str = schemas.RAW_CUSTOMER_ID, file_col: str = schemas.SOURCE_FILE_COL,
                   status_col: str = schemas.STATUS_COL) -> DataFrame:
    """One row per (file, customer): 1 iff every row of it in that file has a churn status."""
    flag = F.coalesce(norm_text(status_col).isin(list(statuses)), F.lit(False))
    return (
        df.where(F.col(id_col).isNotNull())
        .groupBy(file_col, id_col)
        .agg(F.bool_and(flag).cast("int").alias(schemas.CHURN_COL))
    )


def churn_per_file(df: DataFrame, statuses: Sequence[str] = schemas.CHURN_STATUSES_PER_FILE,
                   id_col: str = schemas.RAW_CUSTOMER_ID, file_col: str = schemas.SOURCE_FILE_COL,
                   status_col: str = schemas.STATUS_COL) -> DataFrame:
    """Every row with the customer-level CHURN of its file (NULL id -> NULL)."""
    flags = written(per_file_flags(df, statuses, id_col, file_col, status_col), "file-flags")
    return df.join(flags, on=[file_col, id_col], how="left")


def churn_customers_per_file(flags: DataFrame, file_col: str = schemas.SOURCE_FILE_COL) -> DataFrame:
    """H5: distinct customers per (file, CHURN) from the per-(file, id) flags."""
    return flags.groupBy(file_col, schemas.CHURN_COL).agg(F.count(F.lit(1)).alias("unique_customers"))


# ---------------------------------------------------------------------------
# Customer-id set operations (U2-U4, J4, J5) as plain joins
# ---------------------------------------------------------------------------

def id_set(df: DataFrame, id_col: str = schemas.CUSTOMER_ID) -> DataFrame:
    """Distinct non-NULL customer ids (a shuffle on the id, map-side dedup)."""
    return df.select(id_col).where(F.col(id_col).isNotNull()).distinct()


def ids_in_both(history: DataFrame, latest: DataFrame, id_col: str = schemas.CUSTOMER_ID) -> DataFrame:
    """Ids of ``history`` that also occur in ``latest`` (left semi join)."""
    return id_set(history, id_col).join(id_set(latest, id_col), on=id_col, how="left_semi")


def ids_missing(history: DataFrame, latest: DataFrame, id_col: str = schemas.CUSTOMER_ID) -> DataFrame:
    """Ids of ``history`` absent from ``latest`` (left anti join)."""
    return id_set(history, id_col).join(id_set(latest, id_col), on=id_col, how="left_anti")
