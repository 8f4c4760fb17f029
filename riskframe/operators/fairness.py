"""Group fairness: per-group metrics, parity gaps, summary, threshold sweep.

Groupings are unpivoted to ``(grouping_var, group_value)`` so that every
grouping is computed by one aggregation (the grouping-sets shape) instead of
a loop; per-group AUC reuses the bucketed curves keyed by group, so a group
holding a third of the rows is still split across many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators import curves
from riskframe.operators.metrics import _safe
from riskframe.session import cut_lineage
from riskframe.schema import (GAP_THRESHOLD, GROUP_LABELS, GROUPINGS, MIN_AUC_GROUP_SIZE,
                              PARITY_METRICS, SWEEP_THRESHOLDS)

KEYS = ["grouping_var", "group_value"]


def long_groups(df: DataFrame, groupings: Sequence[str], *carry: str) -> DataFrame:
    """One row per (input row, grouping) with a non-NULL group; absent groupings skipped."""
    present = [g for g in groupings if g in df.columns]
    pairs = F.array(*[F.struct(F.lit(g).alias("grouping_var"),
                               F.col(g).cast("string").alias("group_value")) for g in present])
    return (df.select(*carry, F.explode(pairs).alias("_g"))
            .select(*carry, "_g.grouping_var", "_g.group_value")
            .where(F.col("group_value").isNotNull()))


def group_rank(grouping: Column, group: Column) -> Column:
    """Ordinal of a group inside its grouping's fixed label list (unknown labels last)."""
    expr = None
    for g, labels in GROUP_LABELS.items():
        for i, lab in enumerate(labels):
            cond = (grouping == g) & (group == lab)
            expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr.otherwise(F.lit(1000))


def group_metrics(df: DataFrame, groupings: Sequence[str] = GROUPINGS, label: str = "label",
                  score: str = "score", pred: str = "pred",
                  min_auc_size: int = MIN_AUC_GROUP_SIZE, threshold: float | None = None) -> DataFrame:
    """Per (grouping_var, group_value): size, base and positive rate, tpr, tnr,
    fpr, fnr, ppv, npv (0 on empty denominators), mean score, and AUC (NULL
    unless both classes are present and the group has more than
    ``min_auc_size`` rows). NULL groups are excluded.

    With ``threshold`` (pred = score >= threshold) everything comes from one
    materialised per-(group, score) count table: one pass over the rows for
    both the threshold statistics and the AUC. Otherwise ``pred`` is read.
    """
    if threshold is not None:
        return _group_metrics_counted(df, groupings, label, score, threshold, min_auc_size)
    long = long_groups(df, groupings, label, score, pred)
    y, p = F.col(label), F.col(pred)
    stats = long.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(y.cast("double")).alias("base_rate"),
        F.avg(p.cast("double")).alias("positive_rate"),
        F.count_if((y == 0) & (p == 0)).alias("_tn"), F.count_if((y == 0) & (p == 1)).alias("_fp"),
        F.count_if((y == 1) & (p == 0)).alias("_fn"), F.count_if((y == 1) & (p == 1)).alias("_tp"),
        F.avg(F.col(score)).alias("mean_prediction"))
    tn, fp, fn, tp = (F.col(c) for c in ("_tn", "_fp", "_fn", "_tp"))
    stats = stats.withColumns({
        "tpr": _safe(tp, tp + fn), "tnr": _safe(tn, tn + fp), "fpr": _safe(fp, fp + tn),
        "fnr": _safe(fn, fn + tp), "ppv": _safe(tp, tp + fp), "npv": _safe(tn, tn + fn)})
    auc = curves.roc_auc(long, label, score, keys=KEYS)
    out = stats.join(auc, KEYS, "left")
    both = (tp + fn > 0) & (tn + fp > 0) & (F.col("sample_size") > min_auc_size)
    return out.select(*KEYS, "sample_size", "base_rate", "positive_rate", "tpr", "tnr", "fpr",
                      "fnr", "ppv", "npv", "mean_prediction",
                      F.when(both, F.col("roc_auc")).alias("auc"))


def _group_metrics_counted(df: DataFrame, groupings: Sequence[str], label: str, score: str,
                           threshold: float, min_auc_size: int) -> DataFrame:
    long = long_groups(df, groupings, label, score)
    counts = cut_lineage(curves.score_counts(long, label, score, KEYS))
    st = curves.count_metrics(counts, score, KEYS, threshold)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    st = st.select(*KEYS, F.col("n").alias("sample_size"), F.col("positive_rate").alias("base_rate"),
                   F.col("pred_rate").alias("positive_rate"),
                   _safe(tp, tp + fn).alias("tpr"), _safe(tn, tn + fp).alias("tnr"),
                   _safe(fp, fp + tn).alias("fpr"), _safe(fn, fn + tp).alias("fnr"),
                   _safe(tp, tp + fp).alias("ppv"), _safe(tn, tn + fn).alias("npv"),
                   F.col("mean_score").alias("mean_prediction"), "n_pos")
    auc = curves.curve_summary(counts, label, score, KEYS, counted=True).select(*KEYS, "roc_auc")
    out = st.join(auc, KEYS, "left")
    both = (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("sample_size")) & \
        (F.col("sample_size") > min_auc_size)
    return out.select(*KEYS, "sample_size", "base_rate", "positive_rate", "tpr", "tnr", "fpr",
                      "fnr", "ppv", "npv", "mean_prediction",
                      F.when(both, F.col("roc_auc")).alias("auc"))


def parity_gaps(metrics: DataFrame, metric_names: Sequence[str] = PARITY_METRICS) -> DataFrame:
    """``grouping_var, reference_group, group_value, comparison, metric, gap``:
    |reference - group| for each metric, the reference being the lowest-ordinal
    group of its grouping; groupings with fewer than two groups give no rows."""
    # the (small) metrics table feeds both sides of the self-join: materialise it
    # once so the source is not aggregated twice
    metrics = cut_lineage(metrics)
    ranked = metrics.withColumn("_rank", group_rank(F.col("grouping_var"), F.col("group_value")))
    w = Window.partitionBy("grouping_var").orderBy("_rank", "group_value")
    ref = (ranked.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
           .select("grouping_var", F.col("group_value").alias("reference_group"),
                   *[F.col(m).alias(f"_ref_{m}") for m in metric_names]))
    pairs = ranked.join(ref, "grouping_var", "inner").where(
        F.col("group_value") != F.col("reference_group"))
    gaps = F.array(*[F.struct(F.lit(m).alias("metric"),
                              F.abs(F.col(f"_ref_{m}") - F.col(m)).alias("gap")) for m in metric_names])
    return pairs.select(
        "grouping_var", "reference_group", "group_value",
        F.concat_ws("_vs_", F.col("reference_group"), F.col("group_value")).alias("comparison"),
        F.explode(gaps).alias("_m")).select(
        "grouping_var", "reference_group", "group_value", "comparison", "_m.metric", "_m.gap")


# --- fixed values: fairness recommendation texts -------------------------------
REC_TPR = "Consider threshold adjustment to reduce True Positive Rate disparities"
REC_FPR = "Monitor False Positive Rate differences across groups"
REC_MITIGATE = "Implement bias mitigation techniques or post-processing adjustments"
REC_OK = "Model shows acceptable fairness metrics across analyzed groups"


def fairness_summary(gaps: DataFrame, threshold_gap: float = GAP_THRESHOLD) -> DataFrame:
    """One row: max tpr / fpr / ppv gap (0 when none), the gaps above
    ``threshold_gap`` and the recommendation list. ``gaps`` is bounded
    (groupings x groups x metrics), so collecting its flagged rows is bounded."""
    def max_gap(m: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric") == m, F.col("gap"))), F.lit(0.0)) \
            .alias(f"max_{m}_gap")
    flagged = F.when(F.col("gap") > threshold_gap, F.struct(
        "grouping_var", "comparison", "metric", "gap"))
    s = gaps.agg(max_gap("tpr"), max_gap("fpr"), max_gap("ppv"),
                 F.array_sort(F.collect_list(flagged)).alias("problematic_groups"))
    recs = F.array_compact(F.array(
        F.when(F.col("max_tpr_gap") > threshold_gap, F.lit(REC_TPR)),
        F.when(F.col("max_fpr_gap") > threshold_gap, F.lit(REC_FPR)),
        F.when(F.size("problematic_groups") > 0, F.lit(REC_MITIGATE)).otherwise(F.lit(REC_OK))))
    return s.withColumns({"n_problematic": F.size("problematic_groups"), "recommendations": recs})


def threshold_sweep(df: DataFrame, groupings: Sequence[str] = ("income_quartile",),
                    label: str = "label", score: str = "score",
                    thresholds: Sequence[float] = SWEEP_THRESHOLDS) -> DataFrame:
    """``grouping_var, group_value, threshold, tpr, fpr, ppv, positive_rate``.

    One aggregation: the confusion counts of every threshold are conditional
    counts of the same pass (no rescoring, no loop), then unpivoted.
    """
    long = long_groups(df, groupings, label, score)
    y, s = F.col(label), F.col(score)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        aggs += [F.count_if(hit & (y == 1)).alias(f"_tp{i}"), F.count_if(hit & (y == 0)).alias(f"_fp{i}"),
                 F.count_if(~hit & (y == 1)).alias(f"_fn{i}"), F.count_if(~hit & (y == 0)).alias(f"_tn{i}")]
    wide = long.groupBy(*KEYS).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"),
                              F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"),
                              F.col(f"_fn{i}").alias("fn"), F.col(f"_tn{i}").alias("tn"))
                     for i, t in enumerate(thresholds)])
    x = wide.select(*KEYS, "_n", F.explode(rows).alias("_r")).select(*KEYS, "_n", "_r.*")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return x.select(*KEYS, "threshold", _safe(tp, tp + fn).alias("tpr"),
                    _safe(fp, fp + tn).alias("fpr"), _safe(tp, tp + fp).alias("ppv"),
                    _safe(tp + fp, F.col("_n")).alias("positive_rate"))
