"""Status labels, the time split and split summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.schema import (NEGATIVE_STATUSES, POSITIVE_STATUSES, SPLIT_HORIZON,
                              SPLIT_TRAIN_END, SPLIT_VAL_END, TARGET)


def label_loans(df: DataFrame, status_col: str = "loan_status", target: str = TARGET,
                positive: Sequence[str] = POSITIVE_STATUSES,
                negative: Sequence[str] = NEGATIVE_STATUSES) -> DataFrame:
    """Keep rows whose status is listed; target = 1 for positive statuses, else 0."""
    valid = list(positive) + list(negative)
    return (df.where(F.col(status_col).isin(valid))
            .withColumn(target, F.col(status_col).isin(list(positive)).cast("int")))


def temporal_split(df: DataFrame, date_col: str = "issue_d", train_end: str = SPLIT_TRAIN_END,
                   val_end: str = SPLIT_VAL_END, horizon: str = SPLIT_HORIZON,
                   split_col: str = "split") -> DataFrame:
    """Rows up to ``horizon`` tagged train / val / test by their date.

    One column instead of three frames: a writer can ``partitionBy(split)``
    and later reads prune to one split.
    """
    d = F.col(date_col)
    return (df.where(d <= F.lit(horizon).cast("date"))
            .withColumn(split_col, F.when(d <= F.lit(train_end).cast("date"), "train")
                        .when(d <= F.lit(val_end).cast("date"), "val").otherwise("test")))


def split_summary(df: DataFrame, date_col: str = "issue_d", split_col: str = "split") -> DataFrame:
    """Rows, first and last date per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.min(date_col).alias("min_date"),
                                     F.max(date_col).alias("max_date"))


def dataset_overview(df: DataFrame, label_col: str = TARGET, split_col: str = "split",
                     exclude: Sequence[str] = ()) -> DataFrame:
    """Per split: rows, feature count (columns other than label/split/excluded),
    positive rate and positive count."""
    n_features = len([c for c in df.columns if c not in {label_col, split_col, *exclude}])
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(n_features).alias("n_features"),
        F.avg(F.col(label_col).cast("double")).alias("positive_rate"),
        F.sum(F.col(label_col)).cast("long").alias("n_positive"))
