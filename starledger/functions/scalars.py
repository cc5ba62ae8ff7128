"""Column expressions (F1-F18).  All are built-in Spark functions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

__all__ = [
    "as_col", "pad_code", "pad_one_zero", "fips", "district_code", "strip_text",
    "matches", "to_money", "grouped_int", "safe_cast", "date_key", "fiscal_year",
    "fiscal_month", "yes_no", "title_case", "code_to_key_expr",
]


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def pad_code(c, width: int) -> Column:
    """Left-pad a code with zeros to ``width`` (F1).  Longer codes stay as
    they are, so different codes never become equal."""
    s = as_col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def pad_one_zero(c, width: int = 5) -> Column:
    """Prefix a single ``0`` when shorter than ``width`` (F2, draft rule)."""
    s = as_col(c).cast("string")
    return F.when(F.length(s) < width, F.concat(F.lit("0"), s)).otherwise(s)


def fips(state, county) -> Column:
    """State + county code; null when either part is null."""
    return F.concat(as_col(state).cast("string"), as_col(county).cast("string"))


def district_code(state, district, width: int = 2) -> Column:
    """``STATE-NN``; ``concat_ws`` skips a null part."""
    return F.concat_ws("-", as_col(state), pad_code(district, width))


def strip_text(c, pattern: str, replacement: str = "") -> Column:
    """Regex replace, e.g. thousands separators or a name suffix."""
    return F.regexp_replace(as_col(c), pattern, replacement)


def matches(c, pattern: str) -> Column:
    """Partial regex match."""
    return as_col(c).rlike(pattern)


def safe_cast(c, data_type: DataType | str) -> Column:
    """ANSI-safe cast: junk becomes null instead of failing the job."""
    return as_col(c).try_cast(data_type)


def to_money(c, precision: int = 18, scale: int = 2) -> Column:
    return safe_cast(c, DecimalType(precision, scale))


def grouped_int(c, data_type: str = "int") -> Column:
    """``1,234,567`` -> 1234567 (P6); overflow and junk become null."""
    return safe_cast(F.regexp_replace(as_col(c).cast("string"), ",", ""), data_type)


def date_key(c) -> Column:
    """Integer key ``yyyymmdd``."""
    d = as_col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def fiscal_year(c, start_month: int = 10) -> Column:
    """Fiscal year named after its end: October 2018 is in FY2019."""
    d = as_col(c)
    if start_month == 1:
        return F.year(d)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d))


def fiscal_month(c, start_month: int = 10) -> Column:
    """Month number inside the fiscal year, the start month being 1."""
    return (F.month(as_col(c)) + (12 - start_month + 1) - 1) % 12 + 1


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def title_case(c) -> Column:
    return F.initcap(as_col(c))


def code_to_key_expr(c, mapping: dict) -> Column:
    """Membership chain ``code -> small key``; unmapped codes give null."""
    expr = None
    for code, key in mapping.items():
        cond = as_col(c).isin([code] if isinstance(code, str) else list(code))
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr.otherwise(F.lit(None))
