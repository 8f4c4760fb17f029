"""Parsing expressions for dirty loan text: percents, month dates, term, tenure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.schema import EMP_LENGTH_MAP, MONTH_DATE_FORMAT


def nan_to_null(c: Column) -> Column:
    """NaN is not a missing marker in SQL; make it NULL right after parsing."""
    return F.when(~F.isnan(c), c)


def percent_to_double(c: Column) -> Column:
    """'13.5%' -> 13.5; blank, 'n/a', garbage, NULL -> NULL."""
    stripped = F.nullif(F.replace(c.cast("string"), F.lit("%"), F.lit("")), F.lit(""))
    return nan_to_null(stripped.try_cast("double"))


def month_to_date(c: Column) -> Column:
    """'Dec-2015' -> 2015-12-01; anything unparsable -> NULL."""
    return F.try_to_date(c, MONTH_DATE_FORMAT)


def term_months(c: Column) -> Column:
    """' 36 months' -> 36.0: the first digit run; none -> NULL."""
    digits = F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit(""))
    return digits.try_cast("double")


def emp_length_numeric(c: Column) -> Column:
    """Employment-length text to 0.0..10.0 (a double, as a mapped column with
    gaps is); values outside the map -> NULL."""
    pairs = []
    for k, v in EMP_LENGTH_MAP.items():
        pairs += [F.lit(k), F.lit(float(v))]
    return F.try_element_at(F.create_map(*pairs), c)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with NULL (not +-inf, not an ANSI error) on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))
