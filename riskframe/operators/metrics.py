"""Threshold, confusion counts and classification metrics.

Every metric is one aggregation over the scored table; ordered metrics
(AUCs, KS) come from ``curves``. Results are one-row tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators import curves
from riskframe.schema import PERFORMANCE_ADVICE_CUT, PERFORMANCE_BAND_FLOOR, PERFORMANCE_BANDS


def apply_threshold(df: DataFrame, score: str = "score", threshold: float = 0.5,
                    out: str = "pred") -> DataFrame:
    """pred = 1 when score >= threshold (inclusive, one rule everywhere); a NULL
    or NaN score gives no prediction."""
    return df.withColumn(out, (curves.valid_score(df, score) >= F.lit(float(threshold))).cast("int"))


def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """weight = n_neg / n_pos on positives, 1.0 on negatives (ratio as a scalar subquery)."""
    ratio = df.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"),
                                F.count_if(F.col(label) == 1).cast("double"))).scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def _confusion_aggs(label: Column, pred: Column) -> list[Column]:
    return [F.count_if((label == 0) & (pred == 0)).alias("tn"),
            F.count_if((label == 0) & (pred == 1)).alias("fp"),
            F.count_if((label == 1) & (pred == 0)).alias("fn"),
            F.count_if((label == 1) & (pred == 1)).alias("tp")]


def confusion(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    return df.agg(*_confusion_aggs(F.col(label), F.col(pred)))


def _safe(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (the reference's convention)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Classification ratios from confusion counts, 0 on empty denominators."""
    n = tn + fp + fn + tp
    return {
        "accuracy": _safe(tp + tn, n),
        "precision": _safe(tp, tp + fp),
        "recall": _safe(tp, tp + fn),
        "specificity": _safe(tn, tn + fp),
        "f1_score": _safe(2 * tp, 2 * tp + fp + fn),
    }


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row: confusion counts plus accuracy, precision, recall, specificity, F1."""
    c = confusion(df, label, pred)
    return c.withColumns(rates(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def brier_score(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """mean((p - y)^2) over rows with a score."""
    return df.agg(F.avg(F.pow(curves.valid_score(df, score) - F.col(label).cast("double"), 2)).alias("brier_score"))


def _one_row_join(*frames: DataFrame) -> DataFrame:
    """Side-by-side one-row tables: each becomes scalar subqueries of one select."""
    base = frames[0]
    for f in frames[1:]:
        sq = f.select(F.struct(*f.columns).alias("s")).scalar()
        base = base.select("*", *[sq[c].alias(c) for c in f.columns])
    return base


def evaluate(df: DataFrame, label: str = "label", score: str = "score",
             threshold: float = 0.5) -> DataFrame:
    """Full evaluation (A10/A11): roc_auc, pr_auc, ks_statistic, brier_score,
    accuracy, precision, recall, specificity, f1_score, n, positive_rate.

    One pass over the rows: a materialised per-score count table feeds both
    the threshold statistics and the curves."""
    from riskframe.session import cut_lineage
    counts = cut_lineage(curves.score_counts(df, label, score))
    cm = curves.count_metrics(counts, score, threshold=threshold)
    base = cm.select("n", "tn", "fp", "fn", "tp", "positive_rate", "brier_score")
    base = base.withColumns(rates(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    return _one_row_join(base, curves.curve_summary(counts, label, score, counted=True))


def quick_evaluation(df: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = 0.5) -> DataFrame:
    """The short form: roc_auc, pr_auc, accuracy, positive_rate (one pass: a
    materialised per-score count table feeds the accuracy and the curves)."""
    from riskframe.session import cut_lineage
    counts = cut_lineage(curves.score_counts(df, label, score))
    cm = curves.count_metrics(counts, score, threshold=threshold)
    acc = cm.select(_safe(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"), "positive_rate")
    return _one_row_join(acc, curves.curve_summary(counts, label, score, counted=True)
                         .select("roc_auc", "pr_auc"))


def performance_band(metrics: DataFrame, auc_col: str = "roc_auc") -> DataFrame:
    """Band by ROC-AUC (strict lower bounds) and the retrain advice switch."""
    auc = F.coalesce(F.col(auc_col), F.lit(0.0))
    band = None
    for lower, name in PERFORMANCE_BANDS:
        band = F.when(auc > lower, name) if band is None else band.when(auc > lower, name)
    band = band.otherwise(PERFORMANCE_BAND_FLOOR)
    return metrics.withColumns({
        "performance_level": band,
        "needs_retraining": auc < F.lit(PERFORMANCE_ADVICE_CUT),
    })
