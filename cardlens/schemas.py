"""Column names, status presets and typed schemas.

Everything in the block marked FIXED VALUES must equal the behaviour being
rebuilt (status codes, column lists, missing-value tokens); it is stated
plainly, in natural order, and not derived from anything.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original program's behaviour)
# ---------------------------------------------------------------------------

CUSTOMER_ID = "RIMNO"
RAW_CUSTOMER_ID = "RIM_NO"
TARGET_COL = "target"
STATUS_COL = "STATUS"
CHURN_COL = "CHURN"
SOURCE_FILE_COL = "source_file"

# Default target: these statuses are 1 ...
DEFAULT_STATUSES = ["30DD", "60DA", "90DA", "SUSP", "WROF"]
# ... these are 0; anything else (or NULL) is dropped.
NON_DEFAULT_STATUSES = [
    "NORM", "NEW", "CLSB", "CLSC", "CLSD",
    "LOST", "CNCD", "FRAD", "BLOK", "NOAU", "EXMU",
    "PICK", "BLCK", "STLC", "OFBL", "ONBL", "WARN",
    "NENC", "FREZ", "EXPD", "ACCA", "EXPC",
]
# Older revision's strict target: only these are 0.
STRICT_NON_DEFAULT_STATUSES = ["NORM", "CLSB", "CLSC"]

# Churn, latest-vs-history labeller (10 statuses).
CHURN_STATUSES_LATEST = [
    "CLSB", "CLSC", "CLSD", "WROF", "EXPD", "EXPC", "LOST", "STLC", "FRAD", "PICK",
]
# Churn, per-file labeller (6 statuses).
CHURN_STATUSES_PER_FILE = ["CLSB", "CLSC", "CLSD", "WROF", "EXPD", "EXPC"]

# Transaction reversal flag values counted as a reversal (after trim + upper).
REVERSAL_VALUES = ["Y", "YES", "1", "TRUE"]
# Home currency numeric ISO code; anything else (or unparsable) is international.
HOME_CCY = 818.0

PRIME_STRING_COLS = [
    "BRANCH_NAME", "ACTIVATED", "STATUS", "STATUS_NAME", "NAME",
    "GENDER", "CUSTOMER_TYPE", "Card account status ", "ORGANIZATION",
]
PRIME_INT_COLS = ["RIMNO"]
PRIME_FLOAT_COLS = [
    "AVAILABLE_LIMIT", "LEDGER_BALANCE", "LAST_PAYMENT_AMOUNT", "OVERDUEAMOUNT", "CREDIT_LIMIT",
]
# Columns removed on load when present.
RETIRED_PRIME_COLS = ["MAPPING_ACCNO", "MIN_PAYMENT", "OVER_LIMIT"]

TXN_STRING_COLS = [
    "DESCRIPTION", "MERCHNAME", "MERCH ID", "SOURCES",
    "BANKBRANCH", "TRXN COUNTRY", "REVERSAL FLAG",
]

# Columns dropped before modelling.
DROP_COLS = [
    "RIMNO", "BRANCH_ID", "BRANCH_NAME",
    "NAME", "ORGANIZATION", "STATUS_NAME", "STATUS",
    "FIRST_REPLACED_CARD", "SECOND_REPLACED_CARD", "THIRD_REPLACED_CARD",
    "CREATION_DATE", "LAST_STAEMENT_DATE", "LAST_PAYMENT_DATE",
    "CLOSURE_DATE", "DOB", "Card account status ", "source_file",
]

DATE_COLS_PRIME = [
    "CREATION_DATE", "LAST_STAEMENT_DATE", "LAST_PAYMENT_DATE",
    "CLOSURE_DATE", "DOB",
]
DATE_COLS_TXN = ["POST DATE", "TRXN DATE"]

REPLACED_CARD_COLS = ["FIRST_REPLACED_CARD", "SECOND_REPLACED_CARD", "THIRD_REPLACED_CARD"]

# Text tokens a pandas CSV reader treats as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Raw transaction header -> canonical snake_case name used by the library.
TXN_COLUMN_NAMES = {
    "RIMNO": "RIMNO",
    "DESCRIPTION": "description",
    "POST DATE": "post_date",
    "TRXN DATE": "trxn_date",
    "CCY": "ccy",
    "ORIG AMOUNT": "orig_amount",
    "EMBEDDED _FEE": "embedded_fee",
    "BILLING AMT": "billing_amt",
    "MCC": "mcc",
    "MERCHNAME": "merchname",
    "MERCH ID": "merch_id",
    "SOURCES": "sources",
    "SETTLEMENT AMT": "settlement_amt",
    "SETTLEMENT CCY": "settlement_ccy",
    "BANKBRANCH": "bankbranch",
    "TRXN COUNTRY": "trxn_country",
    "REVERSAL FLAG": "reversal_flag",
    "PaymentBehaviourHistory": "payment_history",
}

# Training workload settings.
RANDOM_STATE = 42
TEST_SIZE = 0.3
NUM_BOOST_ROUND = 1000
EARLY_STOPPING_ROUNDS = 50
TUNE_ROUNDS = 100
TUNE_N_ITER = 20
TUNE_CV_FOLDS = 3
BOOSTING_PARAMS = {
    "learning_rate": 0.1,
    "max_depth": 4,
    "num_leaves": 55,
    "min_child_weight": 5,
    "bagging_fraction": 0.9,
    "feature_fraction": 0.9,
    "lambda_l1": 1e-5,
    "lambda_l2": 100,
}
TUNE_PARAM_GRID = {
    "learning_rate": [0.01, 0.05, 0.1],
    "max_depth": [3, 4, 5, 6],
    "num_leaves": [31, 55, 80, 100],
    "min_child_weight": [1, 3, 5, 7],
    "bagging_fraction": [0.7, 0.8, 0.9, 1.0],
    "feature_fraction": [0.7, 0.8, 0.9, 1.0],
    "lambda_l1": [1e-5, 1e-3, 1e-2],
    "lambda_l2": [1, 10, 100],
}
SMOTE_K_NEIGHBORS = 5
DECISION_THRESHOLD = 0.5

# ---------------------------------------------------------------------------
# Canonical typed schemas (after load/cleaning)
# ---------------------------------------------------------------------------

PRIME_SCHEMA = T.StructType([
    T.StructField("RIMNO", T.LongType()),
    T.StructField("BRANCH_ID", T.StringType()),
    T.StructField("BRANCH_NAME", T.StringType()),
    T.StructField("CREATION_DATE", T.TimestampType()),
    T.StructField("CREDIT_LIMIT", T.DoubleType()),
    T.StructField("ACTIVATED", T.StringType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("STATUS_NAME", T.StringType()),
    T.StructField("DELINQUENCY", T.DoubleType()),
    T.StructField("LAST_STAEMENT_DATE", T.TimestampType()),
    T.StructField("NAME", T.StringType()),
    T.StructField("JOINING_FEE", T.DoubleType()),
    T.StructField("ANNUAL_FEE", T.DoubleType()),
    T.StructField("LEDGER_BALANCE", T.DoubleType()),
    T.StructField("AVAILABLE_LIMIT", T.DoubleType()),
    T.StructField("LAST_PAYMENT_AMOUNT", T.DoubleType()),
    T.StructField("LAST_PAYMENT_DATE", T.TimestampType()),
    T.StructField("TOTAL_HOLD", T.DoubleType()),
    T.StructField("GENDER", T.StringType()),
    T.StructField("DOB", T.TimestampType()),
    T.StructField("ORGANIZATION", T.StringType()),
    T.StructField("CUSTOMER_TYPE", T.StringType()),
    T.StructField("CLOSURE_DATE", T.TimestampType()),
    T.StructField("OVERDUEAMOUNT", T.DoubleType()),
    T.StructField("NO_OF_CYCLES", T.DoubleType()),
    T.StructField("FIRST_REPLACED_CARD", T.StringType()),
    T.StructField("SECOND_REPLACED_CARD", T.StringType()),
    T.StructField("THIRD_REPLACED_CARD", T.StringType()),
])

TXN_SCHEMA = T.StructType([
    T.StructField("RIMNO", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("post_date", T.TimestampType()),
    T.StructField("trxn_date", T.TimestampType()),
    T.StructField("ccy", T.StringType()),
    T.StructField("orig_amount", T.StringType()),
    T.StructField("embedded_fee", T.StringType()),
    T.StructField("billing_amt", T.StringType()),
    T.StructField("mcc", T.StringType()),
    T.StructField("merchname", T.StringType()),
    T.StructField("merch_id", T.StringType()),
    T.StructField("sources", T.StringType()),
    T.StructField("settlement_amt", T.StringType()),
    T.StructField("settlement_ccy", T.StringType()),
    T.StructField("bankbranch", T.StringType()),
    T.StructField("trxn_country", T.StringType()),
    T.StructField("reversal_flag", T.StringType()),
])

SCORES_SCHEMA = T.StructType([
    T.StructField("RIMNO", T.LongType()),
    T.StructField("default_probability", T.DoubleType()),
    T.StructField("predicted_label", T.IntegerType()),
])
