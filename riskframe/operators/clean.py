"""Raw-table cleaning (P1-P4): percents, month dates, integer narrowing, date parts.

Each step is skipped when its input column is absent (decided on the driver
from ``df.columns``), like the reference's ``if col in df.columns`` guards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.clean import month_to_date, percent_to_double
from riskframe.schema import MONTH_DATE_COLUMNS, PERCENT_COLUMNS


def clean_loans(df: DataFrame, percent_cols: Sequence[str] = PERCENT_COLUMNS,
                date_cols: Sequence[str] = MONTH_DATE_COLUMNS) -> DataFrame:
    """Percent text -> double, month text -> date; one projection."""
    present = set(df.columns)
    changes = {c: percent_to_double(F.col(c)) for c in percent_cols if c in present}
    changes.update({c: month_to_date(F.col(c)) for c in date_cols if c in present})
    return df.withColumns(changes) if changes else df


_INT_TYPES = [(T.ByteType(), -2 ** 7, 2 ** 7 - 1), (T.ShortType(), -2 ** 15, 2 ** 15 - 1),
              (T.IntegerType(), -2 ** 31, 2 ** 31 - 1), (T.LongType(), -2 ** 63, 2 ** 63 - 1)]


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast each integral column to the smallest signed type holding its range.

    One aggregation (min and max of every integral column) returns one row to
    the driver; doubles are left alone, since halving them would move metrics.
    """
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    if not ints:
        return df
    row = df.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(ints)],
                 *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(ints)]).first()
    casts = {}
    for i, c in enumerate(ints):
        lo, hi = row[f"mn_{i}"], row[f"mx_{i}"]
        if lo is None:
            continue
        for t, tmin, tmax in _INT_TYPES:
            if tmin <= lo and hi <= tmax:
                casts[c] = F.col(c).cast(t)
                break
    return df.withColumns(casts) if casts else df


def date_parts(df: DataFrame, date_col: str = "issue_d") -> DataFrame:
    """``{date}_year`` and ``{date}_month`` replace the date column."""
    if date_col not in df.columns:
        return df
    d = F.col(date_col)
    if dict(df.dtypes)[date_col] == "string":
        d = F.to_timestamp(d)   # unparsable raises, as the reference does
    return (df.withColumns({f"{date_col}_year": F.year(d), f"{date_col}_month": F.month(d)})
            .drop(date_col))
