"""Scalar column expressions (cleaning, coercion, day arithmetic)."""

from cardlens.functions.cleaning import (  # noqa: F401
    cap_upper, churn_key, drop_present, fill, finite_or_zero, lenient_double,
    nan_to_null, norm_text, parse_float, parse_int, parse_timestamp,
    rename_customer_id, strip_ws,
)
from cardlens.functions.dates import as_of_literal, days_between  # noqa: F401
