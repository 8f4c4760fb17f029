"""Shared prepared frames over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.clean import clean_loans
from riskframe.operators.features import demographic_proxies, engineer_features
from riskframe.operators.label import label_loans, temporal_split
from riskframe.operators.metrics import apply_threshold
from riskframe.sources import tables


def engineered_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loans -> cleaned -> labelled -> engineered (entry B of the reference)."""
    return engineer_features(label_loans(clean_loans(tables.loans(spark, sf_dir))))


def split_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered loans with the fixture's train / val / test split column."""
    return temporal_split(engineered_loans(spark, sf_dir), train_end=tables.FIXTURE_TRAIN_END,
                          val_end=tables.FIXTURE_VAL_END, horizon=tables.FIXTURE_HORIZON)


def audit_frame(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Scored loans, cleaned and engineered, with the four proxies and ``pred``."""
    df = engineer_features(clean_loans(tables.scored(spark, sf_dir)))
    return apply_threshold(demographic_proxies(df), "score", threshold)


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(reference, current): scored loans issued in the training period versus later."""
    df = engineer_features(clean_loans(tables.scored(spark, sf_dir)))
    in_ref = F.col("issue_d") <= F.lit(tables.FIXTURE_TRAIN_END).cast("date")
    return df.where(in_ref), df.where(~in_ref)


def drift_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored loans with the mark of the reference period (rows without a month belong to neither side)."""
    from riskframe.operators.drift import SIDE
    df = engineer_features(clean_loans(tables.scored(spark, sf_dir)))
    return df.withColumn(SIDE, F.col("issue_d") <= F.lit(tables.FIXTURE_TRAIN_END).cast("date")).where(F.col(SIDE).isNotNull())


# --- fixture values (our own): a literal logistic scorer for the explanation queries
EXPLAIN_COEFS = {
    "int_rate": 0.08, "dti": 0.03, "annual_inc": -1e-05, "revol_util": 0.01,
    "loan_to_income": 0.5, "credit_age_months": -0.002, "emp_length_numeric": -0.02,
}
EXPLAIN_INTERCEPT = -1.0

# --- fixture values (our own): descriptions of the loan columns
DICTIONARY = [
    ("addr_state", "State of residence given by the applicant"),
    ("annual_inc", "Yearly income as stated by the applicant, not verified"),
    ("dti", "Monthly debt payments (without the mortgage and this loan) in per cent of the stated monthly income"),
    ("earliest_cr_line", "Month in which the applicant's first credit line began"),
    ("emp_length", "Years in employment, from below one year to ten or more"),
    ("installment", "Monthly payment due on the loan"),
    ("int_rate", "Yearly interest of the loan in per cent"),
    ("issue_d", "Month in which the loan was paid out"),
    ("loan_status", "Where the loan stands now"),
    ("purpose", "What the applicant wants the money for"),
    ("revol_bal", "Balance of all revolving credit lines"),
    ("revol_util", "Used share of all revolving credit lines in per cent"),
    ("term", "Number of monthly payments, 36 or 60"),
]


def dictionary(spark: SparkSession) -> DataFrame:
    """The loan-column slice of the data dictionary as a small table."""
    return spark.createDataFrame(DICTIONARY, "feature string, description string")


def explain_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored loans, cleaned and engineered, as the explanation input."""
    return engineer_features(clean_loans(tables.scored(spark, sf_dir)))


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact linear contributions of the fixture scorer for every scored loan."""
    from riskframe.operators.explain import linear_contributions
    return linear_contributions(explain_frame(spark, sf_dir), EXPLAIN_COEFS, EXPLAIN_INTERCEPT)
