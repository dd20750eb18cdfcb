"""Scalar cleaning and coercion expressions.

Every function returns a ``Column`` built from built-in Spark functions, so
it stays inside whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``str.strip()`` removes all whitespace, Spark's ``trim`` only spaces.
_EDGE_WS = r"^\s+|\s+$"
# What Python's ``int()`` accepts after the cleaning steps (no underscores).
_INT_TEXT = r"^[+-]?[0-9]+$"
# What Python's ``float()`` accepts (no underscores); Spark would also take
# a trailing ``d``/``f`` which must stay missing.
_FLOAT_TEXT = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Trim all leading/trailing whitespace (tabs, newlines too)."""
    return F.regexp_replace(_col(c).cast("string"), _EDGE_WS, "")


def norm_text(c: str | Column) -> Column:
    """C11: to text, trim, upper case."""
    return F.upper(strip_ws(c))


def nan_to_null(c: str | Column) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def parse_int(c: str | Column) -> Column:
    """Strip, drop ``,``, drop one trailing ``.00``, else NULL (bigint)."""
    s = F.regexp_replace(strip_ws(c), ",", "")
    s = F.regexp_replace(s, r"\.00$", "")
    return F.when(s.rlike(_INT_TEXT), s.try_cast("bigint"))


def parse_float(c: str | Column) -> Column:
    """Strip, drop ``,``, parse as double, bad text and NaN -> NULL."""
    s = F.regexp_replace(strip_ws(c), ",", "")
    return nan_to_null(F.when(s.rlike(_FLOAT_TEXT), s.try_cast("double")))


def lenient_double(c: str | Column, dtype: str = "string") -> Column:
    """Numeric coercion that does *not* strip commas (bad -> NULL).

    ``dtype`` is the Spark type name of the input (``df.dtypes``) so numeric
    inputs are cast straight away instead of through text.
    """
    c = _col(c)
    if dtype in ("double", "float", "int", "bigint", "smallint", "tinyint") or dtype.startswith("decimal"):
        return nan_to_null(c.cast("double"))
    if dtype == "boolean":
        return c.cast("double")
    s = strip_ws(c)
    return nan_to_null(F.when(s.rlike(_FLOAT_TEXT), s.try_cast("double")))


def fill(c: str | Column, value) -> Column:
    """NULL -> constant."""
    return F.coalesce(_col(c), F.lit(value))


def cap_upper(c: str | Column, cap: float | None) -> Column:
    """Values above ``cap`` become ``cap``; NULL stays NULL (never ``least``)."""
    c = _col(c)
    if cap is None:
        return c
    return F.when(c > F.lit(cap), F.lit(cap)).otherwise(c)


def churn_key(c: str | Column) -> Column:
    """Trim and drop ``,`` (keeps a trailing ``.00``)."""
    return F.regexp_replace(strip_ws(c), ",", "")


def finite_or_zero(c: str | Column) -> Column:
    """NULL, NaN and +-inf -> 0."""
    c = _col(c)
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def rename_customer_id(df, raw: str = "RIM_NO", canonical: str = "RIMNO"):
    """Rename the raw key when present (no-op otherwise)."""
    if raw in df.columns and canonical not in df.columns:
        return df.withColumnRenamed(raw, canonical)
    return df


def drop_present(df, cols: Iterable[str]):
    """C4: drop the listed columns when they exist."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def parse_timestamp(c: str | Column, formats: Iterable[str] | None = None) -> Column:
    """Lenient date parse with declared formats; unparsable -> NULL."""
    c = _col(c)
    fmts = list(formats or DEFAULT_DATE_FORMATS)
    s = strip_ws(c)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in fmts]).cast("timestamp_ntz")


# FIXED VALUES: date layouts tried in order when none are declared.
DEFAULT_DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MMM-yy",
    "dd-MMM-yyyy",
]
