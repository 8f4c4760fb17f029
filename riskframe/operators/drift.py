"""Population drift (B6, D1-D3, J2) and performance monitoring.

One frame holds both sides (a boolean marks the reference rows), so a source
is scanned twice whatever the number of features: the first scan takes the
reference ranges of all numeric features in one wide aggregation, the second counts every numeric bin and every category of
all features and both sides in one long-form aggregation, combined before the
shuffle. Totals and PSI terms come from that small table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.bins import equal_width_bin
from riskframe.functions.text import py_fixed
from riskframe.operators import curves
from riskframe.schema import PERFORMANCE_DRIFT_THRESHOLD, PSI_BINS, PSI_EPSILON

#: marks the reference rows of a frame with both sides
SIDE = "_is_reference"


def both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two populations as one frame with ``SIDE``."""
    cols = list(dict.fromkeys(columns))
    return (reference.select(*cols, F.lit(True).alias(SIDE))
            .unionByName(current.select(*cols, F.lit(False).alias(SIDE))))


def _number(df: DataFrame, c: str) -> Column:
    """A feature as a double: dates as days, times as microseconds, NaN as NULL."""
    kind, v = dict(df.dtypes)[c], F.col(f"`{c}`")
    if kind == "date":
        return F.unix_date(v).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(v.cast("timestamp")).cast("double")
    v = v.cast("int").cast("double") if kind == "boolean" else v.cast("double")
    return F.when(~F.isnan(v), v)


def numeric_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per feature a struct ``lo, hi`` of its reference values; a constant
    feature is widened by 0.5 each side."""
    wide = df.where(F.col(SIDE)).agg(*[f(_number(df, c)).alias(f"{n}{i}") for i, c in enumerate(columns)
                                       for n, f in (("lo", F.min), ("hi", F.max))])
    pairs = []
    for i, c in enumerate(columns):
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        half = F.when(lo == hi, 0.5).otherwise(0.0)
        pairs.append(F.struct(F.lit(c).alias("feature"), (lo - half).alias("lo"), (hi + half).alias("hi")))
    return wide.select(F.array(*pairs).alias("ranges"))


def side_counts(df: DataFrame, numeric: Sequence[str], text: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """``feature, bin, value, ref_count, cur_count``: one row per bin of a numeric
    feature (equal width over its reference range, last bin closed, values
    outside not counted) or category of a text feature that occurs."""
    none = F.lit(None)
    entry = [F.struct(F.lit(c).alias("feature"), _number(df, c).alias("number"), none.cast("string").alias("value"))
             for c in numeric]
    entry += [F.struct(F.lit(c).alias("feature"), none.cast("double").alias("number"),
                       F.col(f"`{c}`").cast("string").alias("value")) for c in text]
    long = df.select(SIDE, F.explode(F.array(*entry)).alias("_e")).select(SIDE, "_e.*")
    if numeric:
        # one row per listed feature
        ranges = numeric_ranges(df, numeric).select(F.explode("ranges").alias("_r")).select("_r.*")
        long = long.join(F.broadcast(ranges), "feature", "left").withColumn(
            "bin", equal_width_bin(F.col("number"), F.col("lo"), F.col("hi"), bins))
    else:
        long = long.withColumn("bin", none.cast("int"))
    # values outside a range are dropped as one counted row: a filter before would compute every bin twice
    counts = long.groupBy("feature", "bin", "value").agg(
        F.count_if(SIDE).alias("ref_count"), F.count_if(~F.col(SIDE)).alias("cur_count"))
    return counts.where("bin is not null or value is not null")


def side_histograms(df: DataFrame, columns: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """``feature, bin, ref_count, cur_count`` of a frame with ``SIDE``: every bin of the grid
    of every feature that has reference values."""
    counts = side_counts(df, columns, [], bins).drop("value")
    ranged = numeric_ranges(df, columns).select(F.explode("ranges").alias("_r")).where("_r.lo is not null")
    grid = ranged.select("_r.feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin", F.coalesce("ref_count", F.lit(0)).alias("ref_count"),
                    F.coalesce("cur_count", F.lit(0)).alias("cur_count")))


def side_psi(df: DataFrame, numeric: Sequence[str], text: Sequence[str], bins: int = PSI_BINS,
             epsilon: float = PSI_EPSILON) -> DataFrame:
    """``feature, kind, psi`` of a frame with ``SIDE``: sum of (c - r) ln(c / r) over
    bins or categories, a share of zero set to ``epsilon`` (shares are not
    renormalised; bins empty on both sides add nothing). NULL when either side
    has no value (numeric: none inside the reference range)."""
    listed = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in text]
    out = df.sparkSession.createDataFrame(listed, "feature string, kind string")
    if not listed:
        return out.select("feature", "kind", F.lit(None).cast("double").alias("psi"))
    counts = side_counts(df, numeric, text, bins)
    a, b = F.col("ref_count").cast("double"), F.col("cur_count").cast("double")

    def total(when: Column, value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0.0)).alias(name)
    shared, new, gone = (a > 0) & (b > 0), a == 0, b == 0
    one, log = F.lit(1.0), F.ln(b / a)
    x = counts.groupBy("feature").agg(
        F.sum(a).alias("all_a"), F.sum(b).alias("all_b"),
        total(shared, a, "a"), total(shared, b, "b"), total(shared, a * log, "a_log"), total(shared, b * log, "b_log"),
        total(new, one, "new"), total(new, b, "new_b"), total(new, F.ln(b), "new_log"), total(new, b * F.ln(b), "new_b_log"),
        total(gone, one, "gone"), total(gone, a, "gone_a"), total(gone, F.ln(a), "gone_log"), total(gone, a * F.ln(a), "gone_a_log"))
    # the sum over bins with shares a / A and b / B written out, so that counts are read once
    A, B, eps, c = F.col("all_a"), F.col("all_b"), float(epsilon), F.col
    log_a, log_b = F.ln(A) + math.log(eps), F.ln(B) + math.log(eps)
    psi = (c("b_log") / B - c("a_log") / A + (c("b") / B - c("a") / A) * (F.ln(A) - F.ln(B))
           + c("new_b_log") / B - c("new_b") / B * log_b - eps * c("new_log") + eps * c("new") * log_b
           + c("gone_a_log") / A - c("gone_a") / A * log_a - eps * c("gone_log") + eps * c("gone") * log_a)
    res = x.select("feature", F.when((A > 0) & (B > 0), psi).alias("psi"))
    return out.join(F.broadcast(res), "feature", "left").select("feature", "kind", "psi")   # one row per listed feature


def histograms(reference: DataFrame, current: DataFrame, columns: Sequence[str],
               bins: int = PSI_BINS) -> DataFrame:
    """``side_histograms`` of two frames."""
    return side_histograms(both_sides(reference, current, columns), columns, bins)


def psi_numeric(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                bins: int = PSI_BINS, epsilon: float = PSI_EPSILON) -> DataFrame:
    """``feature, psi`` of numeric features."""
    return side_psi(both_sides(reference, current, columns), columns, [], bins, epsilon).drop("kind")


def psi_categorical(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                    epsilon: float = PSI_EPSILON) -> DataFrame:
    """``feature, psi`` over category shares; a category seen on one side only
    gets ``epsilon`` on the other."""
    return side_psi(both_sides(reference, current, columns), [], columns, epsilon=epsilon).drop("kind")


def side_drift(df: DataFrame, features: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """``feature, kind, psi`` for every listed feature the frame has: text columns
    by category shares, the rest by equal-width bins. An empty result if there is none."""
    types = dict(df.dtypes)
    have = [f for f in dict.fromkeys(features) if f in types]
    return side_psi(df, [f for f in have if types[f] != "string"], [f for f in have if types[f] == "string"], bins)


def drift_metrics(reference: DataFrame, current: DataFrame, features: Sequence[str],
                  bins: int = PSI_BINS) -> DataFrame:
    """``side_drift`` of two frames, for the listed features both have."""
    both = [f for f in features if f in reference.columns and f in current.columns]
    return side_drift(both_sides(reference, current, both), both, bins)


# --- fixed values: monitoring texts ----------------------------------------------------
MON_AUC = "AUC degradation detected (%s). Consider model retraining."
MON_PR = "PR-AUC degradation detected (%s). Review model performance."
MON_OK = "Model performance is stable. Continue monitoring."


def side_monitor(df: DataFrame, label: str = "label", score: str = "score",
                 threshold: float = PERFORMANCE_DRIFT_THRESHOLD) -> DataFrame:
    """``performance_monitor`` of a frame with ``SIDE``: both sides' curves in one pass."""
    both = curves.curve_summary(df.select(SIDE, label, score), label, score, [SIDE])
    pick = lambda side, c: F.max(F.when(F.col(SIDE) == side, F.col(c)))
    row = both.agg(pick(False, "roc_auc").alias("current_roc_auc"), pick(False, "pr_auc").alias("current_pr_auc"),
                   pick(True, "roc_auc").alias("reference_roc_auc"), pick(True, "pr_auc").alias("reference_pr_auc"))
    return _monitor_row(row, threshold)


def performance_monitor(current: DataFrame, reference_metrics: DataFrame | None = None,
                        label: str = "label", score: str = "score",
                        threshold: float = PERFORMANCE_DRIFT_THRESHOLD) -> DataFrame:
    """One row: current and reference ROC-AUC / PR-AUC, absolute and signed
    drift, alerts (absolute drift > ``threshold``) and recommendations.

    ``reference_metrics`` is a one-row table with ``roc_auc`` / ``pr_auc``
    (for example the best run of the run log); a missing one means zero drift.
    """
    cur = curves.curve_summary(current, label, score).select(
        F.col("roc_auc").alias("current_roc_auc"), F.col("pr_auc").alias("current_pr_auc"))
    if reference_metrics is not None:
        ref = reference_metrics.select(F.struct(
            F.col("roc_auc").alias("r"), F.col("pr_auc").alias("p")).alias("s")).scalar()
        cur = cur.withColumn("_ref", ref).withColumns({
            "reference_roc_auc": F.col("_ref.r"), "reference_pr_auc": F.col("_ref.p")}).drop("_ref")
    else:
        cur = cur.withColumns({"reference_roc_auc": F.lit(None).cast("double"),
                               "reference_pr_auc": F.lit(None).cast("double")})
    return _monitor_row(cur, threshold)


def _monitor_row(cur: DataFrame, threshold: float) -> DataFrame:
    """Changes, alerts and advice from the four AUCs."""
    ref_auc = F.coalesce("reference_roc_auc", "current_roc_auc")
    ref_pr = F.coalesce("reference_pr_auc", "current_pr_auc")
    x = cur.withColumns({
        "auc_change": F.col("current_roc_auc") - ref_auc,
        "pr_auc_change": F.col("current_pr_auc") - ref_pr})
    x = x.withColumns({"auc_drift": F.abs("auc_change"), "pr_auc_drift": F.abs("pr_auc_change")})
    x = x.withColumns({"auc_degradation": F.col("auc_drift") > threshold,
                       "pr_auc_degradation": F.col("pr_auc_drift") > threshold})
    recs = F.array_compact(F.array(
        F.when(F.col("auc_degradation"), F.format_string(MON_AUC, py_fixed(F.col("auc_drift"), 3))),
        F.when(F.col("pr_auc_degradation"), F.format_string(MON_PR, py_fixed(F.col("pr_auc_drift"), 3))),
        F.when(~F.col("auc_degradation") & ~F.col("pr_auc_degradation"), F.lit(MON_OK))))
    return x.withColumns({"recommendations": recs,
                          "performance_stable": ~(F.col("auc_degradation") | F.col("pr_auc_degradation"))})
