"""ROC / precision-recall curves, AUCs, KS and calibration bins.

All curves come from one table: positives and negatives per distinct score
(map-side combined ``groupBy``), with exact running sums in descending score
order from ``ordered.running_sums`` (bucketed, never a single-task window).
``keys`` computes everything per group in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ordered import DEFAULT_BUCKETS, running_sums


def valid_score(df: DataFrame, score: str) -> Column:
    """The score, NaN as NULL (both are left out of every metric)."""
    c = F.col(score)
    return F.when(~F.isnan(c), c) if dict(df.dtypes).get(score) in ("double", "float") else c


def score_counts(df: DataFrame, label: str = "label", score: str = "score",
                 keys: Sequence[str] = ()) -> DataFrame:
    """``keys, score, tp, fp``: positives and negatives at each distinct score."""
    y = F.col(label).cast("long")
    return (df.where(valid_score(df, score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*keys, score)
            .agg(F.sum(y).alias("tp"), F.sum(F.lit(1) - y).alias("fp")))


def cumulative_counts(df: DataFrame, label: str = "label", score: str = "score",
                      keys: Sequence[str] = (), n_buckets: int = DEFAULT_BUCKETS,
                      keep_bucket: bool = False, counted: bool = False) -> DataFrame:
    """``keys, score, tp, fp, cum_tp, cum_fp, P, N`` in descending score order.

    ``counted``: ``df`` already is a ``score_counts`` table (materialised)."""
    keys = list(keys)
    counts = df if counted else score_counts(df, label, score, keys)
    cum = running_sums(counts, score, ["tp", "fp"], keys, descending=True,
                       n_buckets=n_buckets, keep_bucket=keep_bucket, totals=True,
                       materialize=not counted)
    return cum.withColumnsRenamed({"total_tp": "P", "total_fp": "N"})


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            keys: Sequence[str] = ()) -> DataFrame:
    """Area under ROC with ties counted one half; NULL when a class is absent.

    Each negative at score s beats the positives above s and ties half of
    those at s: sum(fp * (cum_tp - tp/2)) / (P * N).
    """
    keys = list(keys)
    c = cumulative_counts(df, label, score, keys)
    part = F.col("fp").cast("double") * (F.col("cum_tp") - F.col("tp") / 2.0)
    return c.groupBy(*keys).agg(
        _ratio(F.sum(part), F.max("P") * F.max("N")).alias("roc_auc"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               keys: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """``keys, threshold, fpr, tpr``: a (0, 0) start at +inf, then one point per
    distinct score, collinear interior points dropped (the library default).

    A point is collinear when the next point's own (tp, fp) equal its own;
    the next point across a bucket edge is the next bucket's first row.
    """
    keys = list(keys)
    c = cumulative_counts(df, label, score, keys, keep_bucket=True)
    own = F.struct(F.col("tp"), F.col("fp"))
    if drop_intermediate:
        firsts = c.groupBy(*keys, "_bucket").agg(F.max_by(own, F.col(score)).alias("_first"))
        wb = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc())
        nxt_bucket = firsts.select(*keys, "_bucket", F.lead("_first").over(wb).alias("_nb"))
        w = Window.partitionBy(*keys, "_bucket").orderBy(F.col(score).desc())
        c = (c.join(nxt_bucket, [*keys, "_bucket"], "inner")
             .withColumn("_next", F.coalesce(F.lead(own).over(w), F.col("_nb"))))
        first = (F.col("cum_tp") == F.col("tp")) & (F.col("cum_fp") == F.col("fp"))
        keep = (first | F.col("_next").isNull() | (F.col("_next.tp") != F.col("tp"))
                | (F.col("_next.fp") != F.col("fp")))
        c = c.where(keep)
    pts = c.select(*keys, F.col(score).cast("double").alias("threshold"),
                   _ratio(F.col("cum_fp"), F.col("N")).alias("fpr"),
                   _ratio(F.col("cum_tp"), F.col("P")).alias("tpr"))
    starts = (score_counts(df, label, score, keys).select(*keys).distinct() if keys
              else df.sparkSession.range(1))
    starts = starts.select(*keys, F.lit(float("inf")).alias("threshold"),
                           F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(starts)


def ks_statistic(df: DataFrame, label: str = "label", score: str = "score",
                 keys: Sequence[str] = ()) -> DataFrame:
    """max(tpr - fpr) over the ROC points, the (0, 0) start included."""
    keys = list(keys)
    c = cumulative_counts(df, label, score, keys)
    gap = _ratio(F.col("cum_tp"), F.col("P")) - _ratio(F.col("cum_fp"), F.col("N"))
    return c.groupBy(*keys).agg(F.greatest(F.max(gap), F.lit(0.0)).alias("ks_statistic"))


def _precision(tp: Column, fp: Column) -> Column:
    return F.coalesce(_ratio(tp, tp + fp), F.lit(0.0))


def _recall(tp: Column, total_pos: Column) -> Column:
    # no positives at all: recall is 1 at every threshold (library behaviour)
    return F.when(total_pos == 0, F.lit(1.0)).otherwise(_ratio(tp, total_pos))


def pr_points(df: DataFrame, label: str = "label", score: str = "score",
              keys: Sequence[str] = ()) -> DataFrame:
    """``keys, threshold, precision, recall`` per distinct score, plus the
    (recall 0, precision 1) end point with a NULL threshold."""
    keys = list(keys)
    c = cumulative_counts(df, label, score, keys)
    pts = c.select(*keys, F.col(score).cast("double").alias("threshold"),
                   _precision(F.col("cum_tp"), F.col("cum_fp")).alias("precision"),
                   _recall(F.col("cum_tp"), F.col("P")).alias("recall"))
    ends = (score_counts(df, label, score, keys).select(*keys).distinct() if keys
            else df.sparkSession.range(1))
    ends = ends.select(*keys, F.lit(None).cast("double").alias("threshold"),
                       F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(ends)


def pr_auc(df: DataFrame, label: str = "label", score: str = "score",
           keys: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under (recall, precision), anchored at (0, 1).

    Each point's predecessor is the point one distinct score higher, whose
    running counts are this point's minus its own, so no lag is needed.
    """
    keys = list(keys)
    c = cumulative_counts(df, label, score, keys)
    prev_tp = F.col("cum_tp") - F.col("tp")
    prev_fp = F.col("cum_fp") - F.col("fp")
    prec = _precision(F.col("cum_tp"), F.col("cum_fp"))
    prev_prec = F.when(prev_tp + prev_fp == 0, F.lit(1.0)).otherwise(_precision(prev_tp, prev_fp))
    rec = _recall(F.col("cum_tp"), F.col("P"))
    prev_rec = F.when(prev_tp + prev_fp == 0, F.lit(0.0)).otherwise(_recall(prev_tp, F.col("P")))
    area = (rec - prev_rec) * (prec + prev_prec) / 2.0
    return c.groupBy(*keys).agg(F.sum(area).alias("pr_auc"))


def calibration_bin(score: Column, n_bins: int = 10) -> Column:
    """Uniform-bin index: number of inner edges of linspace(0, 1 + 1e-8, n + 1)
    strictly below the score (right-closed bins, as the library's edge search)."""
    step = (1.0 + 1e-8) / n_bins
    idx = F.lit(0)
    for k in range(1, n_bins):
        idx = idx + F.when(score > F.lit(k * step), 1).otherwise(0)
    return idx


def calibration_bins(df: DataFrame, label: str = "label", score: str = "score",
                     n_bins: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, bin, n, mean_predicted, fraction_positive``; empty bins absent."""
    return (df.where(valid_score(df, score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*keys, calibration_bin(F.col(score), n_bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(F.col(score)).alias("mean_predicted"),
                 F.avg(F.col(label).cast("double")).alias("fraction_positive")))


def curve_summary(df: DataFrame, label: str = "label", score: str = "score",
                  keys: Sequence[str] = (), counted: bool = False) -> DataFrame:
    """``keys, roc_auc, pr_auc, ks_statistic`` from one cumulative table and
    one aggregation (the three share every shuffle). ``counted``: ``df`` is a
    materialised ``score_counts`` table."""
    keys = list(keys)
    c = cumulative_counts(df, label, score, keys, counted=counted)
    auc_part = F.col("fp").cast("double") * (F.col("cum_tp") - F.col("tp") / 2.0)
    prev_tp = F.col("cum_tp") - F.col("tp")
    prev_fp = F.col("cum_fp") - F.col("fp")
    prec = _precision(F.col("cum_tp"), F.col("cum_fp"))
    prev_prec = F.when(prev_tp + prev_fp == 0, F.lit(1.0)).otherwise(_precision(prev_tp, prev_fp))
    rec = _recall(F.col("cum_tp"), F.col("P"))
    prev_rec = F.when(prev_tp + prev_fp == 0, F.lit(0.0)).otherwise(_recall(prev_tp, F.col("P")))
    gap = _ratio(F.col("cum_tp"), F.col("P")) - _ratio(F.col("cum_fp"), F.col("N"))
    return c.groupBy(*keys).agg(
        _ratio(F.sum(auc_part), F.max("P") * F.max("N")).alias("roc_auc"),
        F.sum((rec - prev_rec) * (prec + prev_prec) / 2.0).alias("pr_auc"),
        F.greatest(F.max(gap), F.lit(0.0)).alias("ks_statistic"))


def count_metrics(counts: DataFrame, score: str = "score", keys: Sequence[str] = (),
                  threshold: float = 0.5) -> DataFrame:
    """Threshold and moment statistics from a ``score_counts`` table (no second
    pass over the rows): ``keys, n, n_pos, positive_rate (labels), pred_rate,
    tn, fp, fn, tp, mean_score, brier_score``; pred = score >= threshold."""
    s_, tp, fp = F.col(score), F.col("tp"), F.col("fp")
    hit = s_ >= F.lit(float(threshold))
    n = tp + fp
    g = counts.groupBy(*keys).agg(
        F.sum(n).alias("n"), F.sum(tp).alias("n_pos"),
        F.sum(F.when(hit, tp).otherwise(0)).alias("tp"), F.sum(F.when(hit, fp).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(tp)).alias("fn"), F.sum(F.when(hit, 0).otherwise(fp)).alias("tn"),
        F.sum(s_ * n).alias("_ss"),
        F.sum(tp * F.pow(s_ - 1.0, 2) + fp * F.pow(s_, 2)).alias("_sq"))
    return g.select(*keys, "n", "n_pos", (F.col("n_pos") / F.col("n")).alias("positive_rate"),
                    ((F.col("tp") + F.col("fp")) / F.col("n")).alias("pred_rate"), "tn", "fp", "fn", "tp",
                    (F.col("_ss") / F.col("n")).alias("mean_score"),
                    (F.col("_sq") / F.col("n")).alias("brier_score"))
