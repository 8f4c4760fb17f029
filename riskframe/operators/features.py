"""Engineered features (F1-F7) and demographic proxies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.bins import membership_label, quantile_labels, right_closed_bins
from riskframe.functions.clean import emp_length_numeric, safe_ratio, term_months
from riskframe.operators.ordered import approx_quantiles, bracketed_quantiles
from riskframe.schema import (CREDIT_MATURITY_EDGES, CREDIT_MATURITY_LABELS, ESSENTIAL_PURPOSES,
                              HIGH_INCOME_STATES, INCOME_QUARTILE_LABELS)

DAYS_PER_MONTH = 30.44


def engineer_features(df: DataFrame) -> DataFrame:
    """Ratios, credit age, tenure and term in one projection, each guarded by presence.

    Zero denominators give NULL (the reference's pandas gives +-inf).
    """
    has = set(df.columns)
    c = F.col
    new = {}
    if {"installment", "annual_inc"} <= has:
        new["payment_to_income"] = safe_ratio(c("installment") * 12, c("annual_inc"))
    if {"revol_bal", "total_rev_hi_lim"} <= has:
        new["credit_utilization"] = safe_ratio(c("revol_bal"), c("total_rev_hi_lim") + 1)
    if {"earliest_cr_line", "issue_d"} <= has:
        new["credit_age_months"] = (F.date_diff(c("issue_d"), c("earliest_cr_line")).cast("double")
                                    / F.lit(DAYS_PER_MONTH))
    if {"loan_amnt", "annual_inc"} <= has:
        new["loan_to_income"] = safe_ratio(c("loan_amnt"), c("annual_inc"))
    if "emp_length" in has:
        new["emp_length_numeric"] = emp_length_numeric(c("emp_length"))
    if "term" in has:
        new["term_months"] = term_months(c("term"))
    return df.withColumns(new) if new else df


def income_quartile(df: DataFrame, income_col: str = "annual_inc",
                    out_col: str = "income_quartile", exact: bool = True) -> DataFrame:
    """Quartile labels from exact interpolated quartiles of ``income_col``.

    The three cuts take two scans (``bracketed_quantiles``) and are read back as
    one scalar subquery: three numbers, no join.
    """
    q = (bracketed_quantiles(df, [income_col], [0.25, 0.5, 0.75]) if exact
         else approx_quantiles(df, income_col, [0.25, 0.5, 0.75]))
    # one scalar subquery (the 3 sorted cuts), projected once as a column
    sq = q.agg(F.array_sort(F.collect_list(F.struct("prob", "quantile"))).alias("q")).scalar()
    cuts = [F.element_at(F.col("_cuts"), i)["quantile"] for i in (1, 2, 3)]
    return (df.withColumn("_cuts", sq)
            .withColumn(out_col, quantile_labels(F.col(income_col), cuts, INCOME_QUARTILE_LABELS))
            .drop("_cuts"))


def demographic_proxies(df: DataFrame) -> DataFrame:
    """All four proxies, each only when its source column exists.

    The state proxy is gated on ``addr_state`` (the column it reads); proxies
    are meant for raw (un-encoded) columns.
    """
    has = set(df.columns)
    out = df
    if "annual_inc" in has:
        out = income_quartile(out)
    new = {}
    if "addr_state" in has:
        new["state_income_level"] = membership_label(F.col("addr_state"), HIGH_INCOME_STATES,
                                                     "High", "Other")
    if "purpose" in has:
        new["loan_purpose_type"] = membership_label(F.col("purpose"), ESSENTIAL_PURPOSES,
                                                    "Essential", "Discretionary")
    if "credit_age_months" in has:
        new["credit_maturity"] = right_closed_bins(F.col("credit_age_months"),
                                                   CREDIT_MATURITY_EDGES, CREDIT_MATURITY_LABELS)
    return out.withColumns(new) if new else out
