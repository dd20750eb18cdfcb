"""DuckDB oracle SQL, written independently of the Spark code.

Each entry builds the same card-shaped views as ``cardlens.sources.adapters``
from the shared tables (pre-registered DuckDB views) and states the
operator's semantics directly in SQL.
"""

from __future__ import annotations

PRIME_V = """
prime_v AS (
  SELECT
    o.o_orderkey AS o_orderkey,
    o.o_custkey AS RIMNO,
    'prime_' || CAST(year(o.o_orderdate) AS VARCHAR) || '.csv' AS source_file,
    CAST(c.c_nationkey AS VARCHAR) AS BRANCH_ID,
    'BRANCH ' || CAST(c.c_nationkey AS VARCHAR) AS BRANCH_NAME,
    o.o_orderdate AS CREATION_DATE,
    CASE WHEN o.o_orderkey % 10 = 0 THEN CAST(0 AS DOUBLE)
         WHEN o.o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN o.o_orderkey % 13 = 0 THEN -o.o_totalprice
         ELSE o.o_totalprice END AS CREDIT_LIMIT,
    CASE o.o_orderstatus WHEN 'F' THEN 'a ' WHEN 'O' THEN 'I' ELSE NULL END AS ACTIVATED,
    CASE substr(o.o_orderpriority, 1, 1)
         WHEN '1' THEN ' norm ' WHEN '2' THEN 'CLSB' WHEN '3' THEN '90DA'
         WHEN '4' THEN 'wrof' ELSE 'ZZZZ' END AS STATUS,
    o.o_orderpriority AS STATUS_NAME,
    CAST(o.o_orderkey % 120 AS DOUBLE) AS DELINQUENCY,
    o.o_orderdate + to_days(30) AS LAST_STAEMENT_DATE,
    CASE WHEN o.o_orderkey % 2 = 0 THEN 'CLASSIC' ELSE 'GOLD' END AS NAME,
    CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE CAST(o.o_orderkey % 5 AS DOUBLE) * 100 END AS JOINING_FEE,
    CASE WHEN o.o_orderkey % 5 = 1 THEN CAST(NULL AS DOUBLE)
         ELSE 250 + CAST(o.o_custkey % 4 AS DOUBLE) * 50 END AS ANNUAL_FEE,
    c.c_acctbal AS LEDGER_BALANCE,
    o.o_totalprice * CAST(0.4 AS DOUBLE) AS AVAILABLE_LIMIT,
    o.o_totalprice / CAST(20 AS DOUBLE) AS LAST_PAYMENT_AMOUNT,
    CASE WHEN o.o_orderkey % 17 = 0 THEN CAST(NULL AS TIMESTAMP)
         ELSE o.o_orderdate + to_days(CAST(o.o_orderkey % 90 AS INTEGER)) END AS LAST_PAYMENT_DATE,
    CAST(o.o_orderkey % 3 AS DOUBLE) * 10 AS TOTAL_HOLD,
    CASE c.c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE NULL END AS GENDER,
    CASE WHEN c.c_custkey % 23 = 0 THEN CAST(NULL AS TIMESTAMP)
         ELSE o.o_orderdate - to_days(CAST(6570 + (c.c_custkey % 40) * 365 AS INTEGER)) END AS DOB,
    'ORG' || CAST(c.c_custkey % 7 AS VARCHAR) AS ORGANIZATION,
    CASE c.c_mktsegment WHEN 'BUILDING' THEN 'PRIMARY' WHEN 'AUTOMOBILE' THEN ' prim '
         WHEN 'MACHINERY' THEN NULL ELSE 'SUPPLEMENTARY' END AS CUSTOMER_TYPE,
    CASE WHEN o.o_orderkey % 8 = 0 THEN o.o_orderdate + to_days(CAST(o.o_custkey % 700 AS INTEGER))
         WHEN o.o_orderkey % 19 = 0 THEN o.o_orderdate - to_days(5)
         ELSE NULL END AS CLOSURE_DATE,
    CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE o.o_totalprice / CAST(10 AS DOUBLE) END AS OVERDUEAMOUNT,
    CAST(o.o_orderkey % 36 AS DOUBLE) AS NO_OF_CYCLES,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 'C' || CAST(o.o_orderkey AS VARCHAR) END AS FIRST_REPLACED_CARD,
    CASE WHEN o.o_orderkey % 6 = 0 THEN 'D' || CAST(o.o_orderkey AS VARCHAR) END AS SECOND_REPLACED_CARD,
    CASE WHEN o.o_orderkey % 12 = 0 THEN 'E' || CAST(o.o_orderkey AS VARCHAR) END AS THIRD_REPLACED_CARD,
    CASE WHEN o.o_orderkey % 9 = 0 THEN CAST(0 AS DOUBLE)
         ELSE o.o_totalprice / CAST(100 AS DOUBLE) END AS MIN_PAYMENT,
    CASE WHEN o.o_orderkey % 6 = 0 THEN CAST(50 AS DOUBLE)
         WHEN o.o_orderkey % 6 = 1 THEN CAST(NULL AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS OVER_LIMIT,
    'GEN' || CAST(year(o.o_orderdate) - 1994 AS VARCHAR) AS CARD_PRODUCT
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

TXN_V = """
txn_v AS (
  SELECT
    l.l_orderkey AS l_orderkey,
    l.l_linenumber AS l_linenumber,
    CASE WHEN l.l_linenumber % 7 = 0 AND l.l_suppkey % 50 = 0 THEN CAST(NULL AS BIGINT)
         ELSE o.o_custkey END AS RIMNO,
    'ITEM ' || CAST(l.l_partkey AS VARCHAR) AS description,
    l.l_shipdate + to_days(1) AS post_date,
    l.l_shipdate AS trxn_date,
    CASE WHEN l.l_returnflag = 'A' AND l.l_linenumber = 3 THEN 'EGP'
         WHEN l.l_returnflag = 'A' THEN '818'
         WHEN l.l_returnflag = 'R' THEN '840' ELSE NULL END AS ccy,
    l.l_quantity AS orig_amount,
    CASE WHEN l.l_linenumber = 5 AND l.l_orderkey % 3 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE l.l_extendedprice END AS billing_amt,
    CAST(l.l_partkey % 50 AS VARCHAR) AS mcc,
    CASE WHEN l.l_linenumber = 4 THEN NULL ELSE CAST(l.l_suppkey AS VARCHAR) END AS merch_id,
    CASE WHEN l.l_orderkey % 9 = 0
         THEN CAST(CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) // 1000 AS VARCHAR) || ',' ||
              lpad(CAST(CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
         ELSE CAST(CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) AS VARCHAR) END AS settlement_amt,
    CASE WHEN l.l_linenumber = 2 THEN 'true'
         WHEN l.l_linestatus = 'F' THEN ' y ' ELSE 'N' END AS reversal_flag,
    CASE WHEN l.l_linenumber = 1 THEN NULL
         ELSE substr('TTFTFTTTFF', CAST(l.l_orderkey % 5 + 1 AS INTEGER), CAST(l.l_linenumber % 4 + 1 AS INTEGER))
         END AS payment_history
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

CHURN_V = """
churn_v AS (
  SELECT
    event_id,
    CAST(user_id AS VARCHAR) AS RIM_NO,
    'day_' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || '.csv' AS source_file,
    CASE event_type WHEN 'error' THEN 'CLSB' WHEN 'signup' THEN 'wrof ' ELSE 'NORM' END AS STATUS
  FROM events
)"""

SCORE_V = """
score_v AS (
  SELECT event_id AS id,
         CAST(event_type = 'error' AS INTEGER) AS y,
         value / CAST(500 AS DOUBLE) AS proba
  FROM events
)"""

AS_OF = "TIMESTAMP '2001-12-31 00:00:00'"

# status lists (same fixed values as cardlens.schemas)
DEFAULT_IN = "('30DD','60DA','90DA','SUSP','WROF')"
NON_DEFAULT_IN = ("('NORM','NEW','CLSB','CLSC','CLSD','LOST','CNCD','FRAD','BLOK','NOAU','EXMU',"
                  "'PICK','BLCK','STLC','OFBL','ONBL','WARN','NENC','FREZ','EXPD','ACCA','EXPC')")
STRICT_NON_DEFAULT_IN = "('NORM','CLSB','CLSC')"
CHURN_A_IN = "('CLSB','CLSC','CLSD','WROF','EXPD','EXPC','LOST','STLC','FRAD','PICK')"
CHURN_B_IN = "('CLSB','CLSC','CLSD','WROF','EXPD','EXPC')"


def _with(*views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views) + ",\n"


_RAW_TEXT = """
raw AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 13 = 0 THEN NULL
         WHEN c_custkey % 4 = 0 THEN ' ' || CAST(c_custkey // 1000 AS VARCHAR) || ',' ||
              lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '.00 '
         WHEN c_custkey % 4 = 1 THEN CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 4 = 2 THEN CAST(c_custkey AS VARCHAR) || '.5'
         ELSE 'id' || CAST(c_custkey AS VARCHAR) END AS raw_int,
    CASE WHEN c_custkey % 11 = 0 THEN NULL
         WHEN c_custkey % 3 = 0 THEN
              CAST((CAST(round(abs(c_acctbal) * 100) AS BIGINT) // 100) // 1000 AS VARCHAR) || ',' ||
              lpad(CAST((CAST(round(abs(c_acctbal) * 100) AS BIGINT) // 100) % 1000 AS VARCHAR), 3, '0') || '.' ||
              lpad(CAST(CAST(round(abs(c_acctbal) * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')
         WHEN c_custkey % 3 = 1 THEN chr(9) || CAST(c_custkey AS VARCHAR) || '.25'
         ELSE 'n/a' END AS raw_float
  FROM customer
)"""

# Per-customer transaction features with the p99 cap on billing amount.
_TXN_FEATURES = """
t0 AS (SELECT *, coalesce(TRY_CAST(billing_amt AS DOUBLE), 0) AS amt FROM txn_v),
cap AS (SELECT quantile_cont(amt, 0.99) AS p99 FROM t0),
t1 AS (SELECT t0.*, CASE WHEN amt > cap.p99 THEN cap.p99 ELSE amt END AS amt_c FROM t0, cap),
tf AS (
  SELECT RIMNO,
    count(*) AS txn_count,
    sum(amt_c) AS txn_total_amount,
    avg(amt_c) AS txn_mean_amount,
    max(amt_c) AS txn_max_amount,
    count_if(NOT (TRY_CAST(ccy AS DOUBLE) IS NOT DISTINCT FROM 818)) AS txn_intl_count,
    count_if(coalesce(upper(trim(reversal_flag)) IN ('Y','YES','1','TRUE'), false)) AS txn_reversal_count,
    count(DISTINCT merch_id) AS unique_merchants,
    count(DISTINCT mcc) AS unique_mcc,
    coalesce(datediff('day', max(trxn_date), {as_of}), -1) AS days_since_last_txn
  FROM t1 WHERE RIMNO IS NOT NULL GROUP BY RIMNO
),
tfeat AS (
  SELECT RIMNO, txn_count, txn_total_amount, txn_mean_amount, txn_max_amount,
    txn_intl_count, CAST(txn_intl_count AS DOUBLE) / txn_count AS txn_intl_ratio,
    txn_reversal_count, CAST(txn_reversal_count AS DOUBLE) / txn_count AS txn_reversal_ratio,
    unique_merchants, unique_mcc, days_since_last_txn
  FROM tf
)""".replace("{as_of}", AS_OF)

# Account features F1-F12 after the GENDER / fee / overdue cleaning.
_ACCOUNT_FEATURES = """
stats AS (
  SELECT median(ANNUAL_FEE) AS fee_med, quantile_cont(OVERDUEAMOUNT, 0.99) AS od_p99 FROM prime_v
),
p1 AS (
  SELECT p.*,
    coalesce(p.GENDER, 'Unknown') AS GENDER_c,
    coalesce(p.ANNUAL_FEE, s.fee_med) AS ANNUAL_FEE_c,
    CASE WHEN p.OVERDUEAMOUNT > s.od_p99 THEN s.od_p99 ELSE p.OVERDUEAMOUNT END AS OVERDUE_c
  FROM prime_v p, stats s
),
p2 AS (
  SELECT *,
    coalesce(CREDIT_LIMIT, 0) AS cl, coalesce(AVAILABLE_LIMIT, 0) AS al,
    coalesce(LEDGER_BALANCE, 0) AS lb, coalesce(OVERDUE_c, 0) AS od,
    coalesce(JOINING_FEE, 0) + coalesce(ANNUAL_FEE_c, 0) AS fees
  FROM p1
),
af AS (
  SELECT o_orderkey, RIMNO, STATUS,
    GENDER_c AS GENDER, ANNUAL_FEE_c AS ANNUAL_FEE, JOINING_FEE, OVERDUE_c AS OVERDUEAMOUNT,
    CASE WHEN cl = 0 THEN 0 ELSE lb / cl END AS utilization_ratio,
    CASE WHEN cl = 0 THEN 0 ELSE al / cl END AS available_credit_ratio,
    CASE WHEN cl > 0 THEN od / cl ELSE 0 END AS overdue_severity,
    CASE WHEN cl = 0 THEN 0 ELSE fees / cl END AS fee_to_limit_ratio,
    CAST(FIRST_REPLACED_CARD IS NOT NULL AS INTEGER) + CAST(SECOND_REPLACED_CARD IS NOT NULL AS INTEGER)
      + CAST(THIRD_REPLACED_CARD IS NOT NULL AS INTEGER) AS card_replacements,
    greatest(coalesce(CAST(datediff('day', CREATION_DATE, {as_of}) AS DOUBLE) / 30, 0), 0) AS account_tenure_months,
    coalesce(datediff('day', LAST_PAYMENT_DATE, {as_of}), -1) AS days_since_last_payment,
    coalesce(datediff('day', CREATION_DATE, CLOSURE_DATE), -1) AS time_to_churn_days,
    CAST(coalesce(upper(trim(ACTIVATED)) = 'A', false) AS INTEGER) AS is_active,
    greatest(coalesce(CAST(datediff('day', DOB, {as_of}) AS DOUBLE) / 365, 0), 0) AS customer_age,
    CAST(coalesce(contains(upper(trim(CUSTOMER_TYPE)), 'PRIM'), false) AS INTEGER) AS is_primary,
    CASE WHEN cl > 0 THEN lb / cl ELSE 0 END AS ledger_to_limit_ratio
  FROM p2
)""".replace("{as_of}", AS_OF)

_TARGET = f"""CASE WHEN upper(trim(STATUS)) IN {DEFAULT_IN} THEN 1
          WHEN upper(trim(STATUS)) IN {NON_DEFAULT_IN} THEN 0 END"""

_F_COLS = ("utilization_ratio, available_credit_ratio, overdue_severity, fee_to_limit_ratio, card_replacements, "
           "account_tenure_months, days_since_last_payment, time_to_churn_days, is_active, customer_age, "
           "is_primary, ledger_to_limit_ratio")
_T_COLS = ["txn_count", "txn_total_amount", "txn_mean_amount", "txn_max_amount", "txn_intl_count",
           "txn_intl_ratio", "txn_reversal_count", "txn_reversal_ratio", "unique_merchants", "unique_mcc",
           "days_since_last_txn"]


def _r(col: str, d: int = 4) -> str:
    return f"round({col}, {d}) AS {col}"


def _b(col: str) -> str:
    return f"CAST({col} AS BIGINT) AS {col}"


_F_OUT = ", ".join([_r("utilization_ratio"), _r("available_credit_ratio"), _r("overdue_severity"),
                    _r("fee_to_limit_ratio"), _b("card_replacements"), _r("account_tenure_months"),
                    _b("days_since_last_payment"), _b("time_to_churn_days"), _b("is_active"),
                    _r("customer_age"), _b("is_primary"), _r("ledger_to_limit_ratio")])


def _t_out(prefix: str = "") -> str:
    kinds = {"txn_total_amount": "r", "txn_mean_amount": "r", "txn_max_amount": "r",
             "txn_intl_ratio": "r", "txn_reversal_ratio": "r"}
    parts = []
    for c in _T_COLS:
        src = f"{prefix}{c}"
        if kinds.get(c) == "r":
            parts.append(f"round({src}, 4) AS {c}")
        else:
            parts.append(f"CAST({src} AS BIGINT) AS {c}")
    return ", ".join(parts)


def _t_out_filled() -> str:
    parts = []
    for c in _T_COLS:
        if c in ("txn_total_amount", "txn_mean_amount", "txn_max_amount", "txn_intl_ratio", "txn_reversal_ratio"):
            parts.append(f"round(coalesce(t.{c}, 0), 4) AS {c}")
        else:
            parts.append(f"CAST(coalesce(t.{c}, 0) AS BIGINT) AS {c}")
    return ", ".join(parts)


_CHURN_A = f"""
pa AS (
  SELECT regexp_replace(trim(CAST(RIMNO AS VARCHAR)), ',', '', 'g') AS RIMNO,
         CAST(o_orderkey AS VARCHAR) AS o_orderkey, source_file,
         upper(trim(STATUS)) AS STATUS
  FROM prime_v
),
latest AS (SELECT max(source_file) AS f FROM pa),
hist_ids AS (SELECT DISTINCT RIMNO FROM pa, latest WHERE source_file <> latest.f AND RIMNO IS NOT NULL),
latest_rows AS (SELECT pa.* FROM pa, latest WHERE source_file = latest.f),
latest_ids AS (SELECT DISTINCT RIMNO FROM latest_rows WHERE RIMNO IS NOT NULL),
churned AS (
  SELECT RIMNO FROM latest_rows
  WHERE RIMNO IN (SELECT RIMNO FROM hist_ids)
  GROUP BY RIMNO
  HAVING bool_and(coalesce(STATUS IN {CHURN_A_IN}, false))
),
labelled AS (
  SELECT r.RIMNO, r.o_orderkey, r.source_file, r.STATUS,
         CASE WHEN r.RIMNO IN (SELECT RIMNO FROM churned) THEN 1 ELSE 0 END AS CHURN
  FROM latest_rows r
  UNION ALL
  SELECT h.RIMNO, NULL, NULL, NULL, 1
  FROM hist_ids h WHERE h.RIMNO NOT IN (SELECT RIMNO FROM latest_ids)
)"""


ORACLE: dict[str, str] = {}

ORACLE["c1_parse_int"] = _with(_RAW_TEXT) + r"""
s AS (SELECT c_custkey, raw_int,
        regexp_replace(regexp_replace(regexp_replace(raw_int, '^\s+|\s+$', '', 'g'), ',', '', 'g'), '\.00$', '') AS t
      FROM raw)
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, raw_int,
       CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS parsed_int
FROM s
"""

ORACLE["c2_parse_float"] = _with(_RAW_TEXT) + r"""
s AS (SELECT c_custkey, raw_float,
        regexp_replace(regexp_replace(raw_float, '^\s+|\s+$', '', 'g'), ',', '', 'g') AS t
      FROM raw)
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, raw_float,
       round(CASE WHEN regexp_full_match(lower(t), '[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)')
             AND NOT isnan(TRY_CAST(t AS DOUBLE)) THEN TRY_CAST(t AS DOUBLE) END, 4) AS parsed_float
FROM s
"""

ORACLE["c9_cap_p99"] = _with(TXN_V) + """
a AS (
  SELECT coalesce(TRY_CAST(billing_amt AS DOUBLE), 0) AS billing_amt,
         coalesce(TRY_CAST(settlement_amt AS DOUBLE), 0) AS settlement_amt,
         coalesce(TRY_CAST(orig_amount AS DOUBLE), 0) AS orig_amount
  FROM txn_v
),
q AS (SELECT quantile_cont(billing_amt, 0.99) AS b, quantile_cont(settlement_amt, 0.99) AS s,
             quantile_cont(orig_amount, 0.99) AS o FROM a)
SELECT 'billing_amt' AS column_name, round(q.b, 4) AS p99,
       CAST((SELECT count(*) FROM a WHERE billing_amt > q.b) AS BIGINT) AS outliers FROM q
UNION ALL
SELECT 'settlement_amt', round(q.s, 4), CAST((SELECT count(*) FROM a WHERE settlement_amt > q.s) AS BIGINT) FROM q
UNION ALL
SELECT 'orig_amount', round(q.o, 4), CAST((SELECT count(*) FROM a WHERE orig_amount > q.o) AS BIGINT) FROM q
"""

ORACLE["t_txn_features"] = _with(TXN_V, _TXN_FEATURES) + f"""
x AS (SELECT 1)
SELECT CAST(RIMNO AS BIGINT) AS RIMNO, {_t_out()} FROM tfeat
"""

ORACLE["f_account_features"] = _with(PRIME_V, _ACCOUNT_FEATURES) + f"""
x AS (SELECT 1)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(RIMNO AS BIGINT) AS RIMNO, GENDER,
       round(ANNUAL_FEE, 4) AS ANNUAL_FEE, round(JOINING_FEE, 4) AS JOINING_FEE,
       round(OVERDUEAMOUNT, 4) AS OVERDUEAMOUNT, {_F_OUT}
FROM af
"""

ORACLE["j1_wide_labelled"] = _with(PRIME_V, TXN_V, _ACCOUNT_FEATURES, _TXN_FEATURES) + f"""
w AS (
  SELECT af.*, {_TARGET} AS target
  FROM af
)
SELECT CAST(w.o_orderkey AS BIGINT) AS o_orderkey, CAST(w.RIMNO AS BIGINT) AS RIMNO,
       CAST(w.target AS BIGINT) AS target, {_F_OUT.replace('round(', 'round(w.').replace('CAST(', 'CAST(w.')},
       {_t_out_filled()}
FROM w LEFT JOIN tfeat t ON w.RIMNO = t.RIMNO
WHERE w.target IS NOT NULL
"""

ORACLE["j1_no_txn_match"] = _with(TXN_V) + f"""
f AS (
  SELECT * FROM txn_v WHERE trxn_date >= TIMESTAMP '2001-01-01 00:00:00'
),
t0 AS (SELECT *, coalesce(TRY_CAST(billing_amt AS DOUBLE), 0) AS amt FROM f),
cap AS (SELECT quantile_cont(amt, 0.99) AS p99 FROM t0),
t1 AS (SELECT t0.*, CASE WHEN amt > cap.p99 THEN cap.p99 ELSE amt END AS amt_c FROM t0, cap),
tf AS (
  SELECT RIMNO, count(*) AS txn_count, sum(amt_c) AS txn_total_amount, avg(amt_c) AS txn_mean_amount,
    max(amt_c) AS txn_max_amount,
    count_if(NOT (TRY_CAST(ccy AS DOUBLE) IS NOT DISTINCT FROM 818)) AS txn_intl_count,
    count_if(coalesce(upper(trim(reversal_flag)) IN ('Y','YES','1','TRUE'), false)) AS txn_reversal_count,
    count(DISTINCT merch_id) AS unique_merchants, count(DISTINCT mcc) AS unique_mcc,
    coalesce(datediff('day', max(trxn_date), {AS_OF}), -1) AS days_since_last_txn
  FROM t1 WHERE RIMNO IS NOT NULL GROUP BY RIMNO
),
tfe AS (
  SELECT *, CAST(txn_intl_count AS DOUBLE) / txn_count AS txn_intl_ratio,
         CAST(txn_reversal_count AS DOUBLE) / txn_count AS txn_reversal_ratio FROM tf
),
{PRIME_V.strip()}
SELECT CAST(p.o_orderkey AS BIGINT) AS o_orderkey, CAST(p.RIMNO AS BIGINT) AS RIMNO, {_t_out_filled()}
FROM prime_v p LEFT JOIN tfe t ON p.RIMNO = t.RIMNO
"""

ORACLE["l1_default_target"] = _with(PRIME_V) + f"""
x AS (SELECT o_orderkey, {_TARGET} AS target FROM prime_v)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(target AS BIGINT) AS target FROM x WHERE target IS NOT NULL
"""

ORACLE["l2_unknown_status"] = _with(PRIME_V) + f"""
x AS (SELECT {_TARGET} AS target FROM prime_v)
SELECT CAST(count_if(target IS NULL) AS BIGINT) AS unknown_rows FROM x
"""

ORACLE["l3_class_balance"] = _with(PRIME_V) + f"""
x AS (SELECT {_TARGET} AS target FROM prime_v),
g AS (SELECT target, count(*) AS n_rows FROM x WHERE target IS NOT NULL GROUP BY target)
SELECT CAST(target AS BIGINT) AS target, CAST(n_rows AS BIGINT) AS n_rows,
       round(CAST(n_rows AS DOUBLE) / sum(n_rows) OVER (), 4) AS share
FROM g
"""

ORACLE["h1_churn_latest"] = _with(PRIME_V, _CHURN_A) + """
x AS (SELECT 1)
SELECT RIMNO, o_orderkey, source_file, STATUS, CAST(CHURN AS BIGINT) AS CHURN FROM labelled
"""

ORACLE["h4_churn_totals"] = _with(PRIME_V, _CHURN_A) + """
x AS (SELECT 1)
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count_if(CHURN = 1) AS BIGINT) AS churned_rows,
       CAST(count_if(CHURN <> 1) AS BIGINT) AS kept_rows,
       round(CAST(count_if(CHURN = 1) AS DOUBLE) / count(*), 4) AS churn_share,
       round(CAST(count_if(CHURN <> 1) AS DOUBLE) / count(*), 4) AS kept_share
FROM labelled
"""

ORACLE["h6_churn_overlap"] = _with(PRIME_V, _CHURN_A) + """
x AS (SELECT 1)
SELECT
  CAST((SELECT count(*) FROM hist_ids) AS BIGINT) AS history_customers,
  CAST((SELECT count(*) FROM latest_ids) AS BIGINT) AS latest_customers,
  CAST((SELECT count(*) FROM hist_ids WHERE RIMNO IN (SELECT RIMNO FROM latest_ids)) AS BIGINT) AS in_both,
  CAST((SELECT count(*) FROM churned) AS BIGINT) AS fully_churned,
  CAST((SELECT count(*) FROM hist_ids WHERE RIMNO NOT IN (SELECT RIMNO FROM latest_ids)) AS BIGINT)
    AS missing_from_latest,
  CAST((SELECT count(*) FROM latest_ids WHERE RIMNO NOT IN (SELECT RIMNO FROM hist_ids)) AS BIGINT)
    AS only_in_latest
"""

ORACLE["h3_churn_per_file"] = _with(CHURN_V) + f"""
g AS (
  SELECT source_file, RIM_NO,
         CAST(bool_and(coalesce(upper(trim(STATUS)) IN {CHURN_B_IN}, false)) AS INTEGER) AS CHURN
  FROM churn_v WHERE RIM_NO IS NOT NULL GROUP BY source_file, RIM_NO
)
SELECT CAST(c.event_id AS BIGINT) AS event_id, c.source_file, c.RIM_NO, c.STATUS, CAST(g.CHURN AS BIGINT) AS CHURN
FROM churn_v c LEFT JOIN g ON c.source_file = g.source_file AND c.RIM_NO = g.RIM_NO
"""

ORACLE["h5_churn_customers"] = _with(CHURN_V) + f"""
g AS (
  SELECT source_file, RIM_NO,
         CAST(bool_and(coalesce(upper(trim(STATUS)) IN {CHURN_B_IN}, false)) AS INTEGER) AS CHURN
  FROM churn_v WHERE RIM_NO IS NOT NULL GROUP BY source_file, RIM_NO
)
SELECT source_file, CAST(CHURN AS BIGINT) AS CHURN, CAST(count(DISTINCT RIM_NO) AS BIGINT) AS unique_customers
FROM g GROUP BY source_file, CHURN
"""

ORACLE["v1_v7_statement_features"] = _with(PRIME_V) + """
p AS (
  SELECT *, coalesce(CREDIT_LIMIT, 0) AS cl, coalesce(AVAILABLE_LIMIT, 0) AS al,
         coalesce(LAST_PAYMENT_AMOUNT, 0) AS pay, coalesce(MIN_PAYMENT, 0) AS mn,
         coalesce(OVERDUEAMOUNT, 0) AS od, coalesce(OVER_LIMIT, 0) AS ol
  FROM prime_v
)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
  round(CASE WHEN cl > 0 THEN (cl - al) / cl ELSE 0 END, 4) AS utilization_ratio_v1,
  round(CASE WHEN mn > 0 THEN least(pay / mn, 10) ELSE 0 END, 4) AS payment_to_min_ratio,
  round(CASE WHEN cl > 0 THEN od / cl ELSE 0 END, 4) AS overdue_severity_v3,
  CAST(ol > 0 AS BIGINT) AS overlimit_flag,
  CAST(greatest(coalesce(datediff('day', CREATION_DATE, LAST_STAEMENT_DATE), 0), 0) AS BIGINT) AS account_age_days,
  CAST(coalesce(datediff('day', LAST_PAYMENT_DATE, LAST_STAEMENT_DATE), -1) AS BIGINT) AS days_since_last_payment_v6,
  round(greatest(coalesce(CAST(datediff('day', DOB, LAST_STAEMENT_DATE) AS DOUBLE) / 365.25, 0), 0), 4)
    AS customer_age_v7
FROM p
"""

ORACLE["v8_v9_txn_uncapped"] = _with(TXN_V) + """
t0 AS (SELECT *, coalesce(TRY_CAST(billing_amt AS DOUBLE), 0) AS amt FROM txn_v),
g AS (
  SELECT RIMNO, count(*) AS txn_count, sum(amt) AS txn_total_amount, avg(amt) AS txn_mean_amount,
    max(amt) AS txn_max_amount,
    count_if(NOT (TRY_CAST(ccy AS DOUBLE) IS NOT DISTINCT FROM 818)) AS txn_intl_count,
    count_if(coalesce(upper(trim(reversal_flag)) IN ('Y','YES','1','TRUE'), false)) AS txn_reversal_count,
    count(DISTINCT merch_id) AS unique_merchants, count(DISTINCT mcc) AS unique_mcc,
    sum(length(payment_history) - length(replace(payment_history, 'T', ''))) AS t_chars,
    sum(length(payment_history)) AS all_chars
  FROM t0 WHERE RIMNO IS NOT NULL GROUP BY RIMNO
)
SELECT CAST(RIMNO AS BIGINT) AS RIMNO, CAST(txn_count AS BIGINT) AS txn_count,
  round(txn_total_amount, 4) AS txn_total_amount, round(txn_mean_amount, 4) AS txn_mean_amount,
  round(txn_max_amount, 4) AS txn_max_amount, CAST(txn_intl_count AS BIGINT) AS txn_intl_count,
  round(CAST(txn_intl_count AS DOUBLE) / txn_count, 4) AS txn_intl_ratio,
  CAST(txn_reversal_count AS BIGINT) AS txn_reversal_count,
  round(CAST(txn_reversal_count AS DOUBLE) / txn_count, 4) AS txn_reversal_ratio,
  CAST(unique_merchants AS BIGINT) AS unique_merchants, CAST(unique_mcc AS BIGINT) AS unique_mcc,
  round(coalesce(CAST(t_chars AS DOUBLE) / nullif(all_chars, 0), 0), 4) AS payment_success_rate
FROM g
"""

ORACLE["v10_strict_target"] = _with(PRIME_V) + f"""
x AS (SELECT o_orderkey,
        CASE WHEN upper(trim(STATUS)) IN {DEFAULT_IN} THEN 1
             WHEN upper(trim(STATUS)) IN {STRICT_NON_DEFAULT_IN} THEN 0 END AS target
      FROM prime_v)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(target AS BIGINT) AS target FROM x WHERE target IS NOT NULL
"""

ORACLE["v11_join_renamed_key"] = _with(PRIME_V, TXN_V) + """
t0 AS (SELECT *, coalesce(TRY_CAST(billing_amt AS DOUBLE), 0) AS amt FROM txn_v),
g AS (
  SELECT RIMNO AS RIM_NO, count(*) AS txn_count, sum(amt) AS txn_total_amount, avg(amt) AS txn_mean_amount,
    max(amt) AS txn_max_amount,
    count_if(NOT (TRY_CAST(ccy AS DOUBLE) IS NOT DISTINCT FROM 818)) AS txn_intl_count,
    count_if(coalesce(upper(trim(reversal_flag)) IN ('Y','YES','1','TRUE'), false)) AS txn_reversal_count,
    count(DISTINCT merch_id) AS unique_merchants, count(DISTINCT mcc) AS unique_mcc
  FROM t0 WHERE RIMNO IS NOT NULL GROUP BY RIMNO
)
SELECT CAST(p.o_orderkey AS BIGINT) AS o_orderkey, CAST(p.RIMNO AS BIGINT) AS RIMNO,
  CAST(coalesce(g.txn_count, 0) AS BIGINT) AS txn_count,
  round(coalesce(g.txn_total_amount, 0), 4) AS txn_total_amount,
  round(coalesce(g.txn_mean_amount, 0), 4) AS txn_mean_amount,
  round(coalesce(g.txn_max_amount, 0), 4) AS txn_max_amount,
  CAST(coalesce(g.txn_intl_count, 0) AS BIGINT) AS txn_intl_count,
  round(coalesce(CAST(g.txn_intl_count AS DOUBLE) / g.txn_count, 0), 4) AS txn_intl_ratio,
  CAST(coalesce(g.txn_reversal_count, 0) AS BIGINT) AS txn_reversal_count,
  round(coalesce(CAST(g.txn_reversal_count AS DOUBLE) / g.txn_count, 0), 4) AS txn_reversal_ratio,
  CAST(coalesce(g.unique_merchants, 0) AS BIGINT) AS unique_merchants,
  CAST(coalesce(g.unique_mcc, 0) AS BIGINT) AS unique_mcc
FROM prime_v p LEFT JOIN g ON p.RIMNO = g.RIM_NO
"""


# ---------------------------------------------------------------------------
# Feature preparation (P*)
# ---------------------------------------------------------------------------

PREP_NUMS = ["CREDIT_LIMIT", "DELINQUENCY", "JOINING_FEE", "ANNUAL_FEE", "LEDGER_BALANCE", "AVAILABLE_LIMIT",
             "LAST_PAYMENT_AMOUNT", "TOTAL_HOLD", "OVERDUEAMOUNT", "NO_OF_CYCLES"]
PREP_CATS = ["ACTIVATED", "GENDER", "CUSTOMER_TYPE", "CARD_PRODUCT"]
PREP_ORDER = ["CREDIT_LIMIT", "ACTIVATED", "DELINQUENCY", "JOINING_FEE", "ANNUAL_FEE", "LEDGER_BALANCE",
              "AVAILABLE_LIMIT", "LAST_PAYMENT_AMOUNT", "TOTAL_HOLD", "GENDER", "CUSTOMER_TYPE", "OVERDUEAMOUNT",
              "NO_OF_CYCLES", "CARD_PRODUCT"]


def _prep_fit_ctes(fit_where: str = "TRUE") -> str:
    parts = [f"fit_rows AS (SELECT * FROM prime_v WHERE {fit_where})"]
    parts.append("med AS (SELECT " + ", ".join(f"coalesce(median({c}), 0) AS {c}" for c in PREP_NUMS)
                 + " FROM fit_rows)")
    for c in PREP_CATS:
        parts.append(f"mode_{c} AS (SELECT coalesce((SELECT {c} FROM fit_rows WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1), 'UNKNOWN') AS v)")
    imp_cols = [f"coalesce(f.{c}, med.{c}) AS {c}" for c in PREP_NUMS] + \
               [f"coalesce(f.{c}, mode_{c}.v) AS {c}" for c in PREP_CATS]
    parts.append("imp AS (SELECT " + ", ".join(imp_cols) + " FROM fit_rows f, med, "
                 + ", ".join(f"mode_{c}" for c in PREP_CATS) + ")")
    sd_cols = []
    for c in PREP_NUMS:
        sd_cols.append(f"avg({c}) AS m_{c}")
        sd_cols.append(f"CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN 1 "
                       f"ELSE stddev_pop({c}) END AS s_{c}")
    parts.append("sd AS (SELECT " + ", ".join(sd_cols) + " FROM imp)")
    for c in PREP_CATS:
        parts.append(f"map_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS idx "
                     f"FROM (SELECT DISTINCT {c} AS v FROM imp))")
    return ",\n".join(parts)


def _prep_transform_select(apply_where: str = "TRUE", missing: tuple[str, ...] = ()) -> str:
    cols = ["CAST(a.o_orderkey AS BIGINT) AS o_orderkey"]
    for c in PREP_ORDER:
        if c in missing:
            cols.append(f"round(CAST(0 AS DOUBLE), 4) AS {c}")
        elif c in PREP_NUMS:
            cols.append(f"round((coalesce(a.{c}, med.{c}) - sd.m_{c}) / sd.s_{c}, 4) AS {c}")
        else:
            cols.append(f"round(CAST(coalesce((SELECT idx FROM map_{c} WHERE v = coalesce(a.{c}, mode_{c}.v)), -1)"
                        f" AS DOUBLE), 4) AS {c}")
    return ("SELECT " + ", ".join(cols) + f" FROM (SELECT * FROM prime_v WHERE {apply_where}) a, med, sd, "
            + ", ".join(f"mode_{c}" for c in PREP_CATS))


ORACLE["p3_impute_medians"] = _with(PRIME_V, _prep_fit_ctes()) + "x AS (SELECT 1)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(med.{c}, 4) AS median FROM med" for c in PREP_NUMS)

ORACLE["p4_impute_modes"] = _with(PRIME_V, _prep_fit_ctes()) + "x AS (SELECT 1)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS mode FROM mode_{c}" for c in PREP_CATS)

ORACLE["p5_label_encode"] = _with(PRIME_V, _prep_fit_ctes()) + "x AS (SELECT 1)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS value, idx AS index FROM map_{c}" for c in PREP_CATS)

ORACLE["p6_scale_stats"] = _with(PRIME_V, _prep_fit_ctes()) + "x AS (SELECT 1)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(m_{c}, 4) AS mean, round(s_{c}, 4) AS std FROM sd" for c in PREP_NUMS)

ORACLE["p_fit_transform"] = _with(PRIME_V, _prep_fit_ctes()) + "x AS (SELECT 1)\n" + _prep_transform_select()

_LATEST_FILE = "(SELECT max(source_file) FROM prime_v)"
ORACLE["p10_p12_transform_unseen"] = (
    _with(PRIME_V, _prep_fit_ctes(f"source_file <> {_LATEST_FILE}")) + "x AS (SELECT 1)\n"
    + _prep_transform_select(f"source_file = {_LATEST_FILE}", missing=("TOTAL_HOLD",))
)

ORACLE["c13_non_finite"] = _with(PRIME_V) + "x AS (SELECT 1)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL OR isnan({c}) OR isinf({c})) AS BIGINT) AS non_finite "
    f"FROM prime_v" for c in PREP_NUMS)

# ---------------------------------------------------------------------------
# Metrics (E*, M11, M12)
# ---------------------------------------------------------------------------

_ROC = """
g AS (SELECT proba AS s, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM score_v GROUP BY proba),
tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM g),
c AS (
  SELECT s, pos, neg,
         sum(pos) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
         sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn
  FROM g
),
roc AS (
  SELECT s AS threshold, pos, neg, cp, cn,
         (tot.P - (cp - pos)) / tot.P AS tpr, (tot.N - (cn - neg)) / tot.N AS fpr
  FROM c, tot
)"""

_PRED = """
sc AS (SELECT id, y, proba, CAST(proba >= 0.5 AS INTEGER) AS predicted_label FROM score_v),
cm AS (
  SELECT CAST(count_if(y = 0 AND predicted_label = 0) AS DOUBLE) AS tn,
         CAST(count_if(y = 0 AND predicted_label = 1) AS DOUBLE) AS fp,
         CAST(count_if(y = 1 AND predicted_label = 0) AS DOUBLE) AS fn,
         CAST(count_if(y = 1 AND predicted_label = 1) AS DOUBLE) AS tp
  FROM sc
)"""

ORACLE["e1_e2_auc_ks"] = _with(SCORE_V, _ROC) + """
x AS (SELECT 1)
SELECT round(sum(roc.pos * (roc.cn - roc.neg / 2.0)) / (max(tot.P) * max(tot.N)), 4) AS AUC,
       round(greatest(max(abs(roc.tpr - roc.fpr)), 0), 4) AS KS
FROM roc, tot
"""

ORACLE["e3_roc_points"] = _with(SCORE_V, _ROC) + """
x AS (SELECT 1)
SELECT round(threshold, 4) AS threshold, round(fpr, 4) AS fpr, round(tpr, 4) AS tpr FROM roc
"""

_E4 = """round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS F1,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS Recall,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS Precision,
       round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0), 4) AS Accuracy"""

ORACLE["e4_threshold_metrics"] = _with(SCORE_V, _PRED) + f"""
x AS (SELECT 1)
SELECT {_E4} FROM cm
"""

ORACLE["e_evaluate"] = _with(SCORE_V, _ROC, _PRED) + f"""
r AS (
  SELECT sum(roc.pos * (roc.cn - roc.neg / 2.0)) / (max(tot.P) * max(tot.N)) AS auc,
         greatest(max(abs(roc.tpr - roc.fpr)), 0) AS ks
  FROM roc, tot
)
SELECT round(r.auc, 4) AS AUC, round(r.ks, 4) AS KS, {_E4} FROM r, cm
"""

ORACLE["e5_confusion"] = _with(SCORE_V, _PRED) + """
x AS (SELECT 1)
SELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp FROM cm
"""

ORACLE["e6_class_report"] = _with(SCORE_V, _PRED) + """
k AS (
  SELECT tn, fp, fn, tp, tn + fp AS s0, tp + fn AS s1,
         coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
         coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1
  FROM cm
),
f AS (
  SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
         s0 + s1 AS total
  FROM k
)
SELECT 'Non-default' AS label, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1_score,
       CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT 'Default', round(p1, 4), round(r1, 4), round(f1, 4), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(coalesce((tp + tn) / nullif(total, 0), 0), 4), CAST(total AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4),
       CAST(total AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(coalesce((p0 * s0 + p1 * s1) / nullif(total, 0), 0), 4),
       round(coalesce((r0 * s0 + r1 * s1) / nullif(total, 0), 0), 4),
       round(coalesce((f0 * s0 + f1 * s1) / nullif(total, 0), 0), 4), CAST(total AS BIGINT) FROM f
"""

ORACLE["e7_class_distribution"] = _with(SCORE_V) + """
g AS (SELECT y, count(*) AS n_rows FROM score_v GROUP BY y)
SELECT CAST(y AS BIGINT) AS y, CAST(n_rows AS BIGINT) AS n_rows,
       round(CAST(n_rows AS DOUBLE) / sum(n_rows) OVER (), 4) AS share
FROM g
"""

ORACLE["m11_threshold"] = _with(SCORE_V, _PRED) + """
x AS (SELECT 1)
SELECT CAST(id AS BIGINT) AS id, CAST(predicted_label AS BIGINT) AS predicted_label FROM sc
"""

ORACLE["m12_flag_summary"] = _with(SCORE_V, _PRED) + """
x AS (SELECT 1)
SELECT CAST(count_if(predicted_label = 1) AS BIGINT) AS flagged, CAST(count(*) AS BIGINT) AS total,
       round(CAST(count_if(predicted_label = 1) AS DOUBLE) / count(*), 4) AS flagged_share
FROM sc
"""

# ---------------------------------------------------------------------------
# Split (M1, M2)
# ---------------------------------------------------------------------------

_LABELLED = f"""
lab AS (
  SELECT o_orderkey, RIMNO, {_TARGET} AS target FROM prime_v
),
lr AS (SELECT * FROM lab WHERE target IS NOT NULL),
hs AS (
  SELECT *, md5('42' || '|' || CAST(o_orderkey AS VARCHAR)) AS h FROM lr
)"""

ORACLE["m1_split"] = _with(PRIME_V, _LABELLED) + """
x AS (SELECT 1)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(target AS BIGINT) AS target,
       CAST(substr(h, 1, 8) < '4ccccccd' AS BIGINT) AS is_test
FROM hs
"""

ORACLE["m7_draws_folds"] = _with(PRIME_V, _LABELLED) + """
f AS (
  SELECT CAST('0x' || substr(h, 9, 8) AS BIGINT) % 3 AS fold, count(*) AS n_held, sum(target) AS n_held_default
  FROM hs WHERE substr(h, 1, 8) >= '4ccccccd' GROUP BY 1
),
g AS (
  SELECT i AS grid_index, row_number() OVER (ORDER BY md5('42|' || CAST(i AS VARCHAR))) - 1 AS draw
  FROM range(27648) t(i)
)
SELECT CAST(draw AS BIGINT) AS draw, CAST(grid_index AS BIGINT) AS grid_index, CAST(fold AS BIGINT) AS fold,
       CAST(n_held AS BIGINT) AS n_held, CAST(n_held_default AS BIGINT) AS n_held_default
FROM g JOIN f ON draw < 20
"""

ORACLE["m1_split_exact"] = _with(PRIME_V, _LABELLED) + """
r AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY h || '|' || CAST(o_orderkey AS VARCHAR)) - 1 AS rk,
         count(*) OVER (PARTITION BY target) AS n
  FROM hs
)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(target AS BIGINT) AS target,
       CAST(rk < floor(0.3 * n + 0.5) AS BIGINT) AS is_test
FROM r
"""

ORACLE["m2_split_summary"] = _with(PRIME_V, _LABELLED) + """
s AS (SELECT CAST(substr(h, 1, 8) < '4ccccccd' AS BIGINT) AS is_test, target FROM hs)
SELECT is_test, CAST(count(*) AS BIGINT) AS n_rows, round(avg(CAST(target AS DOUBLE)), 4) AS default_rate,
       CAST(14 AS BIGINT) AS n_features
FROM s GROUP BY is_test
"""


ORACLE["m4_knn"] = """
WITH p AS (
  SELECT a.vec_id, b.vec_id AS neighbour_id,
         list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id) AS rank FROM p)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(neighbour_id AS BIGINT) AS neighbour_id,
       CAST(rank AS BIGINT) AS rank, round(distance, 4) AS distance
FROM r WHERE rank <= 5
"""


ORACLE["m4_knn_ties"] = """
WITH c AS (
  SELECT c_custkey, c_mktsegment,
         [CAST(c_nationkey % 5 AS DOUBLE), CAST(floor(abs(c_acctbal) / 2500) AS DOUBLE), CAST(c_custkey % 2 AS DOUBLE)] AS code
  FROM customer
),
p AS (
  SELECT a.c_custkey, b.c_custkey AS neighbour_id, list_distance(a.code, b.code) AS distance
  FROM c a JOIN c b ON a.c_mktsegment = b.c_mktsegment AND a.c_custkey <> b.c_custkey
),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance, neighbour_id) AS rank FROM p)
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(neighbour_id AS BIGINT) AS neighbour_id,
       CAST(rank AS BIGINT) AS rank, round(distance, 4) AS distance
FROM r WHERE rank <= 5
"""


ORACLE["c8_c9_quantile_sketches"] = _with(PRIME_V) + """
c AS (
  SELECT 'ANNUAL_FEE' AS column_name, count(ANNUAL_FEE) AS n FROM prime_v
  UNION ALL SELECT 'OVERDUEAMOUNT', count(OVERDUEAMOUNT) FROM prime_v
  UNION ALL SELECT 'CREDIT_LIMIT', count(CREDIT_LIMIT) FROM prime_v
  UNION ALL SELECT 'LEDGER_BALANCE', count(LEDGER_BALANCE) FROM prime_v)
SELECT column_name, (round(p + 1e-9, 4) + 0.0) AS prob, CAST(n AS BIGINT) AS n, CAST(1 AS BIGINT) AS "close"
FROM c, (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.99 AS DOUBLE))) v(p)
"""

ORACLE["t9_t10_distinct_sketches"] = _with(TXN_V) + """
x AS (SELECT 1)
SELECT CAST(RIMNO AS BIGINT) AS RIMNO, CAST(count(DISTINCT merch_id) AS BIGINT) AS n_merch_id,
       CAST(count(DISTINCT mcc) AS BIGINT) AS n_mcc, CAST(1 AS BIGINT) AS merch_id_close, CAST(1 AS BIGINT) AS mcc_close
FROM txn_v WHERE RIMNO IS NOT NULL GROUP BY RIMNO
"""


ORACLE["m4_knn_lsh"] = """
SELECT CAST(label AS BIGINT) AS label, CAST(count(*) * least(5, count(*) - 1) AS BIGINT) AS n_wanted,
       CAST(1 AS BIGINT) AS nine_of_ten
FROM embeddings GROUP BY label HAVING count(*) > 1
"""


_AUC_TABLE = """
pairs AS (
  SELECT id % 7 AS draw, id % 3 AS fold, y, proba,
         rank() OVER (PARTITION BY id % 7, id % 3 ORDER BY proba)
         + (count(*) OVER (PARTITION BY id % 7, id % 3, proba) - 1) / CAST(2 AS DOUBLE) AS mid_rank
  FROM score_v WHERE y IS NOT NULL AND proba IS NOT NULL
),
aucs AS (
  SELECT draw, fold, (sum(mid_rank) FILTER (WHERE y = 1) - count_if(y = 1) * (count_if(y = 1) + 1) / CAST(2 AS DOUBLE))
         / (CAST(count_if(y = 1) AS DOUBLE) * CAST(count_if(y <> 1) AS DOUBLE)) AS auc
  FROM pairs GROUP BY draw, fold
)"""

ORACLE["m8_pick"] = _with(SCORE_V, _AUC_TABLE) + """
m AS (SELECT draw, avg(auc) AS mean_auc FROM aucs GROUP BY draw)
SELECT CAST(draw AS BIGINT) AS draw, round(mean_auc, 4) AS mean_auc FROM m ORDER BY m.mean_auc DESC, draw LIMIT 1
"""

ORACLE["m6_early_stop"] = _with(SCORE_V, _AUC_TABLE) + """
r AS (SELECT row_number() OVER (ORDER BY draw, fold) - 1 AS i, auc FROM aucs),
b AS (SELECT i, auc, max(auc) OVER (ORDER BY i) AS best FROM r),
a AS (SELECT b.i, b.auc, (SELECT min(r.i) FROM r WHERE r.i <= b.i AND r.auc = b.best) AS best_i FROM b),
e AS (SELECT min(i) AS stop FROM a WHERE i - best_i >= 5),
k AS (SELECT best_i FROM a, e WHERE i = coalesce(stop, (SELECT max(i) FROM a)))
SELECT CAST(i AS BIGINT) AS round, round(auc, 4) AS auc, CAST(i <= k.best_i AS BIGINT) AS kept,
       CAST(stop IS NOT NULL AS BIGINT) AS stopped
FROM a, e, k
"""

ORACLE["m9_m10_tree_table"] = _with(PRIME_V) + """
t(tree, node, feature, threshold, low, high, value) AS (VALUES
  (0, 0, 0, 150000.0, 1, 2, 0.0), (0, 1, 1, 2000.0, 3, 4, 0.0), (0, 2, -1, 0.0, 2, 2, -0.25),
  (0, 3, -1, 0.0, 3, 3, 0.5), (0, 4, -1, 0.0, 4, 4, -0.125),
  (1, 0, 2, 30.0, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, -0.75), (1, 2, 0, 0.0, 5, 6, 0.0),
  (1, 5, -1, 0.0, 5, 5, 1.0), (1, 6, 2, 90.0, 13, 14, 0.0), (1, 13, -1, 0.0, 13, 13, 0.25), (1, 14, -1, 0.0, 14, 14, 0.625),
  (2, 0, -1, 0.0, 0, 0, 0.0625)),
x AS (SELECT o_orderkey, [CREDIT_LIMIT, OVERDUEAMOUNT, DELINQUENCY] AS f FROM prime_v),
s0 AS (SELECT x.o_orderkey, x.f, t.* FROM x, t WHERE t.node = 0),
s1 AS (SELECT s.o_orderkey, s.f, t.* FROM s0 s JOIN t ON t.tree = s.tree AND t.node = CASE WHEN s.feature < 0 THEN s.node
       WHEN s.f[s.feature + 1] <= s.threshold THEN s.low ELSE s.high END),
s2 AS (SELECT s.o_orderkey, s.f, t.* FROM s1 s JOIN t ON t.tree = s.tree AND t.node = CASE WHEN s.feature < 0 THEN s.node
       WHEN s.f[s.feature + 1] <= s.threshold THEN s.low ELSE s.high END),
s3 AS (SELECT s.o_orderkey, s.f, t.* FROM s2 s JOIN t ON t.tree = s.tree AND t.node = CASE WHEN s.feature < 0 THEN s.node
       WHEN s.f[s.feature + 1] <= s.threshold THEN s.low ELSE s.high END),
m AS (SELECT o_orderkey, CAST(-0.5 AS DOUBLE) + sum(CAST(value AS DOUBLE)) AS margin FROM s3 GROUP BY o_orderkey)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, (round(1 / (1 + exp(-margin)) + 1e-9, 6) + 0.0) AS default_probability,
       CAST(1 / (1 + exp(-margin)) >= 0.5 AS BIGINT) AS predicted_label
FROM m
"""


ORACLE["m3_smote_class_counts"] = _with(PRIME_V, _LABELLED) + """
s AS (SELECT target FROM hs WHERE substr(h, 1, 8) >= '4ccccccd'),
g AS (SELECT target, count(*) AS n FROM s GROUP BY target)
SELECT CAST(target AS BIGINT) AS target, CAST(max(n) OVER () AS BIGINT) AS n_rows FROM g
"""


_SMOTE_DIGITS = "CAST('0x' || substr(md5('42|' || CAST(d.vec_id AS VARCHAR) || '|' || CAST(d.j AS VARCHAR) || '|{}'), 1, 8) AS BIGINT)"

ORACLE["m3_smote_rows"] = f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM e GROUP BY label),
r AS (
  SELECT e.*, s.n, s.need, row_number() OVER (PARTITION BY e.label ORDER BY md5('42|' || CAST(vec_id AS VARCHAR))
         || '|' || CAST(vec_id AS VARCHAR)) - 1 AS rk
  FROM e JOIN s ON e.label = s.label WHERE need > 0),
m AS (SELECT *, need // n + CASE WHEN rk < need % n THEN 1 ELSE 0 END AS m FROM r),
d AS (SELECT vec_id, label, x, unnest(range(1, m + 1)) AS j FROM m WHERE m > 0),
p AS (
  SELECT a.vec_id, b.x AS y,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) - 1 AS k,
         count(*) OVER (PARTITION BY a.vec_id) AS others
  FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
q AS (
  SELECT d.label, d.x, p.y, {_SMOTE_DIGITS.format("gap")} / CAST(4294967296 AS DOUBLE) AS gap
  FROM d JOIN p ON p.vec_id = d.vec_id AND p.k = {_SMOTE_DIGITS.format("nn")} % least(5, p.others))
SELECT CAST(label AS BIGINT) AS label,
       {", ".join(f"round(x[{i + 1}] + gap * (y[{i + 1}] - x[{i + 1}]), 4) AS e{i:02d}" for i in range(64))}
FROM q
"""


ORACLE["h7_no_status"] = _with(PRIME_V) + """
f AS (SELECT max(source_file) AS latest FROM prime_v),
l AS (SELECT CAST(RIMNO AS VARCHAR) AS RIMNO, CAST(o_orderkey AS VARCHAR) AS o_orderkey, source_file
      FROM prime_v, f WHERE source_file = latest),
h AS (SELECT DISTINCT CAST(RIMNO AS VARCHAR) AS RIMNO FROM prime_v, f WHERE source_file <> latest)
SELECT RIMNO, o_orderkey, source_file, CAST(0 AS BIGINT) AS CHURN FROM l
UNION ALL
SELECT RIMNO, NULL, NULL, CAST(1 AS BIGINT) FROM h WHERE RIMNO NOT IN (SELECT RIMNO FROM l)
"""


ORACLE["s1_prime_csv_load"] = _with(PRIME_V) + f"""
x AS (SELECT 1)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(RIMNO AS BIGINT) AS RIMNO, source_file, STATUS,
       round(CREDIT_LIMIT, 4) AS CREDIT_LIMIT, round(OVERDUEAMOUNT, 4) AS OVERDUEAMOUNT,
       round(CASE WHEN source_file < 'prime_1998.csv' THEN NULL ELSE TOTAL_HOLD END, 4) AS TOTAL_HOLD,
       'Société ' || ORGANIZATION AS ORGANIZATION,
       CAST(datediff('day', CREATION_DATE, {AS_OF}) AS BIGINT) AS days_created,
       CAST(datediff('day', LAST_PAYMENT_DATE, {AS_OF}) AS BIGINT) AS days_paid,
       CAST(0 AS BIGINT) AS has_retired_col
FROM prime_v
"""

ORACLE["s5_s6_churn_from_csv"] = ORACLE["h1_churn_latest"].replace(
    "SELECT regexp_replace(trim(CAST(RIMNO AS VARCHAR)), ',', '', 'g') AS RIMNO,",
    "SELECT CAST(RIMNO AS VARCHAR) || '.00' AS RIMNO,")

ORACLE["s4_txn_csv_features"] = ORACLE["t_txn_features"]

ORACLE["k1_scores_csv"] = _with(SCORE_V, CHURN_V) + """
t AS (SELECT CAST(count(*) AS BIGINT) AS n_scores, CAST(count_if(proba >= 0.5) AS BIGINT) AS n_flagged,
             sum(proba) AS sum_probability FROM score_v)
SELECT f.source_file, CAST(count(*) AS BIGINT) AS rows_in_file, max(t.n_scores) AS n_scores,
       max(t.n_flagged) AS n_flagged, round(max(t.sum_probability), 4) AS sum_probability
FROM churn_v f, t GROUP BY f.source_file
"""


ORACLE["h3_churn_stream"] = ORACLE["h3_churn_per_file"]
ORACLE["k2_churn_latest_csv"] = ORACLE["h1_churn_latest"]
ORACLE["k3_churn_per_file_csv"] = ORACLE["h3_churn_per_file"]


ORACLE["u2_u4_id_sets"] = _with(PRIME_V) + """
p AS (SELECT CAST(RIMNO AS VARCHAR) AS RIMNO, source_file FROM prime_v),
l AS (SELECT max(source_file) AS f FROM p),
h AS (SELECT DISTINCT RIMNO FROM p, l WHERE source_file <> l.f AND RIMNO IS NOT NULL),
t AS (SELECT DISTINCT RIMNO FROM p, l WHERE source_file = l.f AND RIMNO IS NOT NULL)
SELECT RIMNO, 'in_both' AS membership FROM h WHERE RIMNO IN (SELECT RIMNO FROM t)
UNION ALL
SELECT RIMNO, 'missing_from_latest' FROM h WHERE RIMNO NOT IN (SELECT RIMNO FROM t)
"""


def _stable_round(sql: str, digits: int = 4) -> str:
    """``round(X, 4)`` -> ``(round((X) + 1e-9, 4) + 0.0)``: the same half-way
    nudge and signed-zero removal the Spark side applies, so last-bit
    differences in summation order cannot flip a rounded digit."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        head, sep, tail = inner.rpartition(",")
        out.append(sql[i:j])
        if sep and tail.strip() == str(digits):
            out.append(f"(round(({_stable_round(head, digits)}) + 1e-9, {digits}) + 0.0)")
        else:
            out.append(key + _stable_round(inner, digits) + ")")
        i = k


def oracle_sql() -> dict[str, str]:
    return {k: _stable_round(v) for k, v in ORACLE.items()}
