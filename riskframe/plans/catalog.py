"""The query catalog: one entry per operator, each ``(spark, sf_dir) -> DataFrame``.

Catalog entries end with ``checked``: doubles rounded to 6 decimals and dates
as ISO text, matching the oracle's projections. The operators themselves
return full-precision typed columns.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators import curves, fairness, metrics
from riskframe.plans import frames
from riskframe.sources import tables
from riskframe.operators import clean as _clean
from riskframe.operators import encode as _enc
from riskframe.operators import label as _label
from riskframe.operators.features import engineer_features
from riskframe.schema import DIRECTIONS, FEATURES, TARGET
from riskframe.operators import drift as _drift
from riskframe.operators import reports as _reports
from riskframe.schema import GROUPINGS
from riskframe.operators import explain as _x
from riskframe.schema import HIGH_RISK_SCORE, KEY_FEATURES
from riskframe.operators import profile as _prof
from riskframe.plans import training as _train
from riskframe.operators import attributions as _attr
from riskframe.operators import boosting as _boost
from riskframe.operators import model as _model
from riskframe.session import checkpoint_dir, cut_lineage
from riskframe.sources import files as _files
from riskframe.sources import sinks as _sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def round6(c):
    """Half-up to 6 decimals with plain IEEE steps (same in the oracle), so
    exact ties such as 4.0140625 round identically in both engines."""
    return F.when(F.abs(c) < 1e12, F.floor(c * 1e6 + 0.5) / 1e6).otherwise(c)


def checked(df: DataFrame) -> DataFrame:
    """Round doubles to 6 decimals, dates/timestamps to ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round6(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: checked(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# --- flagship: fairness per group ----------------------------------------------

@register("group_metrics")
def q_group_metrics(spark, sf):
    """A12 over the four proxy groupings of the scored loans (flagship)."""
    return fairness.group_metrics(frames.audit_frame(spark, sf), threshold=0.5)


# --- curves and metrics on the scored table ---------------------------------------

@register("roc_auc")
def q_roc_auc(spark, sf):
    """ROC-AUC with ties counted one half."""
    return curves.roc_auc(tables.scored(spark, sf))


@register("pr_auc")
def q_pr_auc(spark, sf):
    """C4: PR-AUC anchored at (recall 0, precision 1)."""
    return curves.pr_auc(tables.scored(spark, sf))


@register("ks")
def q_ks(spark, sf):
    """KS statistic."""
    return curves.ks_statistic(tables.scored(spark, sf))


@register("roc_points")
def q_roc_points(spark, sf):
    """ROC points with collinear points dropped."""
    return curves.roc_points(tables.scored(spark, sf))


@register("pr_points")
def q_pr_points(spark, sf):
    """Precision-recall points."""
    return curves.pr_points(tables.scored(spark, sf))


@register("calibration_bins")
def q_calibration(spark, sf):
    """10-bin calibration table."""
    return curves.calibration_bins(tables.scored(spark, sf))


@register("brier")
def q_brier(spark, sf):
    """Brier score."""
    return metrics.brier_score(tables.scored(spark, sf))


@register("confusion")
def q_confusion(spark, sf):
    """A6 at threshold 0.5."""
    return metrics.confusion(metrics.apply_threshold(tables.scored(spark, sf)))


@register("classification_metrics")
def q_classification(spark, sf):
    """A7 at threshold 0.5."""
    return metrics.classification_metrics(metrics.apply_threshold(tables.scored(spark, sf)))


@register("evaluation")
def q_evaluation(spark, sf):
    """The full evaluation row."""
    return metrics.evaluate(tables.scored(spark, sf))


# --- cleaning, labels, split -----------------------------------------------------



@register("clean_loans")
def q_clean_loans(spark, sf):
    """Percent, month, tenure and term parsing."""
    df = engineer_features(_clean.clean_loans(tables.loans(spark, sf)))
    return df.select("id", "int_rate", "revol_util", "issue_d", "earliest_cr_line",
                     "emp_length_numeric", "term_months")


@register("date_parts")
def q_date_parts(spark, sf):
    """Issue year and month replace the issue date."""
    return _clean.date_parts(_clean.clean_loans(tables.loans(spark, sf))).select(
        "id", "issue_d_year", "issue_d_month")


@register("narrow_types")
def q_narrow_types(spark, sf):
    """Integral columns narrowed to the smallest fitting type."""
    df = _clean.narrow_types(tables.loans(spark, sf).select("id", "member_id"))
    t = dict(df.dtypes)
    return df.select(F.col("id").cast("long"), F.col("member_id").cast("long"),
                     F.lit(t["id"]).alias("id_type"), F.lit(t["member_id"]).alias("member_id_type"))


@register("labelled_loans")
def q_labelled(spark, sf):
    """Status label over the six listed statuses."""
    return _label.label_loans(tables.loans(spark, sf)).select("id", "loan_status", TARGET)


@register("engineered_features")
def q_engineered(spark, sf):
    """Ratio and credit-age features."""
    return frames.engineered_loans(spark, sf).select(
        "id", "payment_to_income", "credit_utilization", "credit_age_months", "loan_to_income")


@register("temporal_split")
def q_temporal_split(spark, sf):
    """Train / val / test by issue date."""
    return frames.split_loans(spark, sf).select("id", "split")


@register("split_summary")
def q_split_summary(spark, sf):
    """A5: rows and date range per split."""
    return _label.split_summary(frames.split_loans(spark, sf))


@register("dataset_overview")
def q_dataset_overview(spark, sf):
    """A4: rows, features, positive rate per split."""
    return _label.dataset_overview(frames.split_loans(spark, sf))


@register("demographic_proxies")
def q_proxies(spark, sf):
    """Income quartile, state level, purpose type, credit maturity."""
    return frames.audit_frame(spark, sf).select(
        "id", "income_quartile", "state_income_level", "loan_purpose_type", "credit_maturity")


# --- projections ---------------------------------------------------------------------

@register("origination_projection")
def q_origination(spark, sf):
    """Origination-time columns only."""
    return _enc.origination_projection(tables.loans(spark, sf))


@register("leakage_projection")
def q_leakage(spark, sf):
    """Target, identifiers and leakage columns dropped."""
    return _enc.leakage_projection(frames.engineered_loans(spark, sf))


@register("feature_kinds")
def q_feature_kinds(spark, sf):
    """Categorical (text or < 20 distinct) versus numeric."""
    return _enc.feature_kinds(_enc.leakage_projection(frames.engineered_loans(spark, sf)))


@register("complete_cases")
def q_complete_cases(spark, sf):
    """Complete-case filter report over features and target."""
    df = frames.engineered_loans(spark, sf)
    feats = _enc.leakage_projection(df).columns + [TARGET]
    return _enc.complete_case_report(df, feats)


@register("aligned_features")
def q_aligned(spark, sf):
    """Model column order, missing columns as 0."""
    return _enc.align_features(frames.engineered_loans(spark, sf), FEATURES)


# --- fairness tail and metric extras ---------------------------------------------------

@register("parity_gaps")
def q_parity_gaps(spark, sf):
    """|reference - group| for six metrics."""
    return fairness.parity_gaps(fairness.group_metrics(frames.audit_frame(spark, sf), threshold=0.5))


@register("fairness_summary")
def q_fairness_summary(spark, sf):
    """Max gaps, flagged comparisons, recommendations."""
    s = fairness.fairness_summary(
        fairness.parity_gaps(fairness.group_metrics(frames.audit_frame(spark, sf), threshold=0.5)))
    return s.select("max_tpr_gap", "max_fpr_gap", "max_ppv_gap", "n_problematic",
                    F.concat_ws(";", F.transform("problematic_groups", lambda p: F.concat_ws(
                        "/", p["grouping_var"], p["comparison"], p["metric"]))).alias("problematic"),
                    F.concat_ws(" | ", "recommendations").alias("recommendations"))


@register("threshold_sweep")
def q_threshold_sweep(spark, sf):
    """Tpr, fpr, ppv, positive rate at thresholds 0.1..0.8 per group."""
    return fairness.threshold_sweep(frames.audit_frame(spark, sf), groupings=GROUPINGS)


@register("class_weights")
def q_class_weights(spark, sf):
    """n_neg / n_pos weight on positives."""
    return (metrics.class_weights(tables.scored(spark, sf)).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")))


@register("quick_evaluation")
def q_quick(spark, sf):
    """AUCs, accuracy, positive rate."""
    return metrics.quick_evaluation(tables.scored(spark, sf))


@register("performance_band")
def q_band(spark, sf):
    """F8: band by ROC-AUC and retrain switch."""
    return metrics.performance_band(metrics.evaluate(tables.scored(spark, sf))).select(
        "roc_auc", "performance_level", "needs_retraining")


# --- drift, monitoring, reports ---------------------------------------------------------


# every numeric and text feature of the frame
DRIFT_NUMERIC = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal", "total_rev_hi_lim",
                 "payment_to_income", "credit_utilization", "credit_age_months", "loan_to_income", "emp_length_numeric",
                 "term_months"]
DRIFT_TEXT = ["term", "emp_length", "purpose", "addr_state", "home_ownership", "loan_status"]
DRIFT_ALL = [*DRIFT_NUMERIC, *DRIFT_TEXT, "not_a_column"]


@register("histogram")
def q_histogram(spark, sf):
    """Equal-width bins over the reference range, both sides counted."""
    return _drift.side_histograms(frames.drift_sides(spark, sf), DRIFT_NUMERIC)


@register("psi_numeric")
def q_psi_numeric(spark, sf):
    """PSI of numeric features."""
    return _drift.side_psi(frames.drift_sides(spark, sf), DRIFT_NUMERIC, []).drop("kind")


@register("psi_categorical")
def q_psi_categorical(spark, sf):
    """PSI of categorical features with one-sided categories."""
    return _drift.side_psi(frames.drift_sides(spark, sf), [], DRIFT_TEXT).drop("kind")


@register("psi_all")
def q_psi_all(spark, sf):
    """D3: PSI for a feature list, absent features skipped."""
    return _drift.side_drift(frames.drift_sides(spark, sf), DRIFT_ALL)


def _monitor(spark, sf):
    return _drift.side_monitor(frames.drift_sides(spark, sf))


@register("performance_monitor")
def q_monitor(spark, sf):
    """Current versus reference AUCs, drift, alerts, advice."""
    m = _monitor(spark, sf)
    return m.select("current_roc_auc", "current_pr_auc", "reference_roc_auc", "reference_pr_auc",
                    "auc_change", "pr_auc_change", "auc_drift", "pr_auc_drift", "auc_degradation",
                    "pr_auc_degradation", F.concat_ws(" | ", "recommendations").alias("recommendations"))


def _fairness_summary(spark, sf):
    return fairness.fairness_summary(
        fairness.parity_gaps(fairness.group_metrics(frames.audit_frame(spark, sf), threshold=0.5)))


@register("governance_report")
def q_governance(spark, sf):
    """Drift, fairness and performance folded into one report row."""
    sides = cut_lineage(frames.drift_sides(spark, sf))       # read by the ranges, the bins and the monitor
    g = _reports.governance_report(_drift.side_drift(sides, DRIFT_ALL), _fairness_summary(spark, sf),
                                   _drift.side_monitor(sides), "delinquency_model", "1", len(GROUPINGS))
    return g.select("model_name", "model_version", "drift_detected",
                    F.concat_ws(",", "high_drift_features").alias("high_drift_features"), "avg_psi",
                    "current_roc_auc", "performance_stable", "max_disparity", "groups_analyzed",
                    F.concat_ws(" | ", "action_items").alias("action_items"))


def _model_card(spark, sf):
    overview = _label.dataset_overview(frames.split_loans(spark, sf))
    feats = _enc.leakage_projection(frames.engineered_loans(spark, sf)).columns
    return _reports.model_card(overview, metrics.evaluate(tables.scored(spark, sf)), feats,
                               "delinquency_model", "1", _fairness_summary(spark, sf), GROUPINGS)


def _flat_card(card):
    return card.select(
        F.col("model_details.name").alias("name"), F.col("model_details.version").alias("version"),
        F.col("training_data.features").alias("n_features"),
        F.col("training_data.split_sizes")["train"].alias("train_size"),
        F.col("training_data.split_sizes")["val"].alias("val_size"),
        F.col("training_data.split_sizes")["test"].alias("test_size"),
        F.col("performance.test_metrics.roc_auc").alias("roc_auc"),
        F.col("performance.test_metrics.pr_auc").alias("pr_auc"),
        F.col("performance.test_metrics.ks_statistic").alias("ks_statistic"),
        F.col("performance.test_metrics.brier_score").alias("brier_score"),
        F.concat_ws(",", "technical_details.features").alias("features"),
        F.col("fairness_metrics.max_tpr_gap").alias("max_tpr_gap"),
        F.col("fairness_metrics.max_fpr_gap").alias("max_fpr_gap"),
        F.concat_ws(",", "fairness_metrics.groups_analyzed").alias("groups_analyzed"))


@register("model_card")
def q_model_card(spark, sf):
    """Model card row (flattened)."""
    return _flat_card(_model_card(spark, sf))


@register("model_card_json")
def q_model_card_json(spark, sf):
    """The nested card written as JSON and read back."""
    path, card = _scratch(spark, "card"), _model_card(spark, sf)
    _sinks.write_json_report(card, path)
    return _flat_card(spark.read.schema(card.schema).json(path))


# --- explanation -------------------------------------------------------------------------



@register("linear_contributions")
def q_linear_contributions(spark, sf):
    """X2(a): exact per-row, per-feature contributions of a logistic scorer."""
    return frames.contributions(spark, sf)


@register("global_importance")
def q_global_importance(spark, sf):
    """Mean |contribution| per feature, ranked."""
    return _x.global_importance(frames.contributions(spark, sf))


@register("importance_described")
def q_importance_described(spark, sf):
    """Importance sorted with dictionary descriptions."""
    return _x.describe_features(_x.global_importance(frames.contributions(spark, sf)),
                                frames.dictionary(spark))


@register("importance_topk")
def q_importance_topk(spark, sf):
    """O2: top 3 features with rank."""
    return _x.top_k(_x.global_importance(frames.contributions(spark, sf)), 3)


@register("risk_features")
def q_risk_features(spark, sf):
    """Risk-keyword features, first 5 by importance."""
    return _x.risk_features(_x.global_importance(frames.contributions(spark, sf)))


@register("dependence_pairs")
def q_dependence(spark, sf):
    """(value, contribution) of the first 3 key features, with int_rate alongside."""
    keys = [f for f in KEY_FEATURES if f in frames.EXPLAIN_COEFS][:3]
    rows = _x.linear_contribution_rows(frames.explain_frame(spark, sf), frames.EXPLAIN_COEFS,
                                       frames.EXPLAIN_INTERCEPT)
    return _x.dependence_rows(rows, keys, interaction="int_rate")


@register("waterfall")
def q_waterfall(spark, sf):
    """Waterfalls of the first three high-risk rows."""
    rows = _x.linear_contribution_rows(frames.explain_frame(spark, sf), frames.EXPLAIN_COEFS,
                                       frames.EXPLAIN_INTERCEPT)
    top = rows.where(F.col("probability") > HIGH_RISK_SCORE).orderBy(F.col("logit").desc(), "id").limit(3)
    return _x.waterfall_rows(top)


@register("counterfactuals")
def q_counterfactuals(spark, sf):
    """Up to three suggestions per row with texts and re-scored probability."""
    rows = _x.linear_contribution_rows(frames.explain_frame(spark, sf), frames.EXPLAIN_COEFS,
                                       frames.EXPLAIN_INTERCEPT)
    return _x.counterfactual_rows(rows, frames.EXPLAIN_COEFS)


@register("high_risk")
def q_high_risk(spark, sf):
    """First 10 rows scoring above 0.7."""
    scores = _x.linear_scores(frames.explain_frame(spark, sf), frames.EXPLAIN_COEFS,
                              frames.EXPLAIN_INTERCEPT)
    return _x.high_risk(scores)


@register("seeded_sample")
def q_seeded_sample(spark, sf):
    """100-row seeded sample (in md5 order)."""
    return _x.seeded_sample(tables.scored(spark, sf), 100).select("id", "label", "score")


# --- imputation and encoding ------------------------------------------------------------


IMPUTE_NUMERIC = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal",
                  "total_rev_hi_lim", "payment_to_income", "credit_utilization", "credit_age_months", "loan_to_income",
                  "emp_length_numeric", "term_months"]
FILL_TEXT = ["term", "emp_length", "loan_status", "purpose", "addr_state", "home_ownership"]
ENCODE_TEXT = ["term", "emp_length", "loan_status", "purpose", "addr_state", "home_ownership"]
FITTED_TEXT = ["emp_length", "purpose", "home_ownership", "term"]


@register("median_imputed")
def q_median_imputed(spark, sf):
    """Train medians fill NULL numerics in every split."""
    df = frames.split_loans(spark, sf)
    med = _enc.fit_medians(df.where(F.col("split") == "train"), IMPUTE_NUMERIC)
    return _enc.transform_medians(df, med, IMPUTE_NUMERIC).select("id", "split", *IMPUTE_NUMERIC)


@register("unknown_filled")
def q_unknown_filled(spark, sf):
    """Categorical NULL -> 'Unknown'."""
    return _enc.fill_unknown(frames.split_loans(spark, sf), FILL_TEXT).select("id", *FILL_TEXT)


@register("frame_encoded")
def q_frame_encoded(spark, sf):
    """Per-frame codes (rank among sorted distinct values, NULL -> -1)."""
    return _enc.frame_encode(frames.engineered_loans(spark, sf), ENCODE_TEXT).select("id", *ENCODE_TEXT)


@register("fitted_encoded")
def q_fitted_encoded(spark, sf):
    """Codes fitted on train, unseen -> code of 'Unknown'."""
    return _enc.fitted_encode(frames.split_loans(spark, sf), FITTED_TEXT).select("id", "split", *FITTED_TEXT)


@register("prepared")
def q_prepared(spark, sf):
    """Leakage drop, kinds from train, medians, codes."""
    prepared, _ = _train.prepare(frames.split_loans(spark, sf))
    return prepared


# --- profiling ------------------------------------------------------------------------------

def _profile(spark, sf):
    return _prof.feature_profile(frames.engineered_loans(spark, sf), TARGET, frames.dictionary(spark))


@register("feature_profile")
def q_feature_profile(spark, sf):
    """Per-column dtype, missing, distinct, moments, description."""
    return _profile(spark, sf)


@register("top_values")
def q_top_values(spark, sf):
    """A2: three most frequent values of each text column."""
    return _prof.top_values(frames.engineered_loans(spark, sf).drop(TARGET))


@register("missing_report")
def q_missing_report(spark, sf):
    """Features with missing values, most first."""
    return _prof.missing_report(_profile(spark, sf))


@register("top_missing")
def q_top_missing(spark, sf):
    """O3: five features with the highest missing share."""
    return _prof.top_missing(_profile(spark, sf))


@register("profile_summary")
def q_profile_summary(spark, sf):
    """Numeric versus categorical and missing counts."""
    return _prof.profile_summary(_profile(spark, sf))


# --- models (rows-only checks; properties in tests) ---------------------------------------



_SHARED: dict[tuple, object] = {}


def shared(spark, sf, what, make):
    """A fit that several queries of one session read: made once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


def _prepared(spark, sf):
    """Prepared loans and one row per feature."""
    def make():
        prepared, meta = _train.prepare(frames.split_loans(spark, sf))
        return prepared, meta.orderBy("position").collect()        # one row per feature
    return shared(spark, sf, "prepared", make)


def _model_frame(spark, sf):
    """Assembled loans and their features; those with a monotone direction keep their codes as numbers, other coded ones are categories."""
    def make():
        prepared, rows = _prepared(spark, sf)
        coded = [r["feature"] for r in rows if r["kind"] == "categorical" and not r["direction"]]
        return _train.model_inputs(prepared, [r["feature"] for r in rows], categorical=coded), [r["feature"] for r in rows]
    return shared(spark, sf, "model frame", make)


def _bounded_lr(spark, sf):
    """The sign-bounded logistic regression."""
    return shared(spark, sf, "bounded lr", lambda: _model.train_monotone_lr(*_model_frame(spark, sf)))


def _tree_frame(spark, sf):
    """Prepared loans with class weights as plain columns; the features and the coded ones without a direction."""
    def make():
        prepared, rows = _prepared(spark, sf)
        x = prepared.withColumn("label", F.col(TARGET).cast("double"))
        ratio = metrics.class_weights(x.where("split = 'train'"), "label").select(F.max("weight")).scalar()
        x = x.withColumn("weight", F.when(F.col("label") == 1, ratio).otherwise(F.lit(1.0)))
        return (cut_lineage(x), [r["feature"] for r in rows],
                [r["feature"] for r in rows if r["kind"] == "categorical" and not r["direction"]])
    return shared(spark, sf, "tree frame", make)


def _trees(spark, sf, variant="leafwise"):
    """All rounds of a trainer with its listed parameters, directions included."""
    def make():
        frame, feats, coded = _tree_frame(spark, sf)
        return _boost.train(frame, feats, {"leafwise": _boost.LEAFWISE, "depthwise": _boost.DEPTHWISE}[variant], DIRECTIONS, coded)
    return shared(spark, sf, variant, make)


def _scored_test(spark, sf, variant):
    test = _tree_frame(spark, sf)[0].where("split = 'test'")
    return _boost.score(_boost.best(_trees(spark, sf, variant)), test).select("id", "label", "score")


@register("gbt_scored")
def q_gbt_scored(spark, sf):
    """Leaf-wise monotone trees, rounds chosen by validation AUC; test scores."""
    return _scored_test(spark, sf, "leafwise")


@register("gbt_depthwise_scored")
def q_gbt_depthwise_scored(spark, sf):
    """M1, M2: the depth-wise variant; test scores."""
    return _scored_test(spark, sf, "depthwise")


@register("tree_directions")
def q_tree_directions(spark, sf):
    """M2: every test row with every value of each directed feature, by both trainers' trees: steps against the direction."""
    test = _tree_frame(spark, sf)[0].where("split = 'test'")
    parts = [_boost.direction_sweep(_boost.best(_trees(spark, sf, v)), test, DIRECTIONS).select(
        F.lit(v).alias("variant"), "feature", "direction", "n_rows", "violations") for v in ("leafwise", "depthwise")]
    return parts[0].unionByName(parts[1])


@register("tree_grid")
def q_tree_grid(spark, sf):
    """M6: all 81 points of the leaf-wise grid, 3 stratified folds, 100 rounds each, grown together."""
    frame, feats, coded = _tree_frame(spark, sf)
    train = _model.stratified_folds(frame.where("split = 'train'"), 3)
    return _boost.tune(train, feats, _boost.GRID_LEAFWISE, directions=DIRECTIONS, categorical=coded)


@register("bounded_lr_scored")
def q_bounded_lr(spark, sf):
    """M2: sign-bounded logistic regression; test scores."""
    frame, _ = _model_frame(spark, sf)
    m = _bounded_lr(spark, sf)
    return _model.score(m, frame.where(F.col("split") == "test")).select("id", "label", "score")


@register("isotonic_calibrated")
def q_isotonic(spark, sf):
    """M3: isotonic calibration fitted on validation scores, applied to test."""
    frame, _ = _model_frame(spark, sf)
    s = _model.score(_bounded_lr(spark, sf), frame.where(F.col("split") != "train"))
    iso = _model.calibrate_isotonic(s.where(F.col("split") == "val"))
    return iso.transform(s.where(F.col("split") == "test")).select("id", "label", "score", "calibrated")


@register("sigmoid_calibrated")
def q_sigmoid(spark, sf):
    """M3: Platt calibration with smoothed targets, applied to test."""
    frame, _ = _model_frame(spark, sf)
    s = _model.score(_bounded_lr(spark, sf), frame.where(F.col("split") != "train"))
    sig = _model.calibrate_sigmoid(s.where(F.col("split") == "val"))
    return _model.apply_sigmoid(sig, s.where(F.col("split") == "test")).select("id", "label", "score", "calibrated")


@register("model_importance")
def q_model_importance(spark, sf):
    """M5: summed split gains per feature, ranked."""
    return _boost.importance(_boost.best(_trees(spark, sf)), spark)


@register("stratified_folds")
def q_folds(spark, sf):
    """M6: three folds balanced per class, dealt in md5 order."""
    return _model.stratified_folds(tables.scored(spark, sf), 3).select("id", "label", "fold")


@register("isotonic_points")
def q_isotonic_points(spark, sf):
    """M3: isotonic calibration of the fixture score (two decimals), at every fitted score."""
    s = tables.scored(spark, sf).select("label", (F.floor(F.col("score") * 100) / 100).alias("score"))
    iso = _model.calibrate_isotonic(s.withColumn("label", 1.0 - F.col("label")))
    return iso.transform(s.select("score").distinct()).select("score", "calibrated")


@register("isotonic_fine")
def q_isotonic_fine(spark, sf):
    """M3: the same map fitted on about 3000 different scores, at every one of them."""
    s = tables.scored(spark, sf).select((1.0 - F.col("label")).alias("label"),
                                        (F.col("score") + (F.col("id") % 3) / F.lit(10000.0)).alias("score"))
    return _model.calibrate_isotonic(s).transform(s.select("score").distinct()).select("score", "calibrated")


@register("evaluation_chain")
def q_evaluation_chain(spark, sf):
    """A10: complete cases, model columns, scores of a literal linear scorer, threshold, metrics."""
    cols = list(frames.EXPLAIN_COEFS)
    df = frames.explain_frame(spark, sf)
    clean = _enc.complete_cases(df, [*cols, "label"])
    aligned = _enc.align_features(clean, [*cols, "label"])
    z = F.lit(frames.EXPLAIN_INTERCEPT)
    for c, b in frames.EXPLAIN_COEFS.items():
        z = z + F.lit(b) * F.col(c)
    scored = aligned.select("label", (1.0 / (1.0 + F.exp(-z))).alias("score"))
    removed = _enc.complete_case_report(df, [*cols, "label"]).select("n_removed").scalar()
    return metrics.classification_metrics(metrics.apply_threshold(scored)).withColumn("n_removed", removed)


@register("cv_results")
def q_cv_results(spark, sf):
    """3-fold stratified search (ROC-AUC) of two penalties of the bounded logistic regression."""
    frame, feats = _model_frame(spark, sf)
    train = _model.stratified_folds(frame.where(F.col("split") == "train"), 3).select("features", "label", "weight", "fold")
    lo, hi = _model.monotone_bounds(feats)
    from pyspark.ml.classification import LogisticRegression
    est = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=100,
                             lowerBoundsOnCoefficients=lo, upperBoundsOnCoefficients=hi)
    return _model.cv_results(_model.cross_validate(train, est, {"regParam": [0.01, 0.1]}), spark)


@register("monotonicity_audit")
def q_monotonicity(spark, sf):
    """Decile mean scores against the expected direction."""
    df = frames.explain_frame(spark, sf)
    return _model.monotonicity_audit(df, ["dti", "annual_inc", "int_rate", "revol_util",
                                          "payment_to_income", "loan_to_income", "credit_age_months",
                                          "emp_length_numeric"])


# --- run log (metric rows from two evaluations of the data) -----------------------------



@register("run_log_best")
def q_run_log_best(spark, sf):
    """Metric rows per run and the best run per experiment by ROC-AUC."""
    ref, cur = frames.drift_pair(spark, sf)
    runs = []
    for run_id, part in (("full", tables.scored(spark, sf)), ("recent", cur), ("early", ref)):
        ev = metrics.quick_evaluation(part)
        runs.append(ev.select(F.lit("delinquency").alias("experiment"), F.lit(run_id).alias("run_id"),
                              F.explode(F.array(
                                  F.struct(F.lit("roc_auc").alias("name"), F.col("roc_auc").alias("value")),
                                  F.struct(F.lit("pr_auc").alias("name"), F.col("pr_auc").alias("value")))
                              ).alias("_m")).select("experiment", "run_id", "_m.*"))
    log = runs[0].unionByName(runs[1]).unionByName(runs[2])
    return _sinks.best_runs(log)


def _scratch(spark, name):
    """A new folder that all executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid4().hex}"


@register("run_log_replayed")
def q_run_log_replayed(spark, sf):
    """Three runs written to the log, one of them twice and one more cut off half-way; the best runs read back."""
    base = _scratch(spark, "run-log")
    ref, cur = frames.drift_pair(spark, sf)
    for run_id, part in (("full", tables.scored(spark, sf)), ("recent", cur), ("early", ref), ("recent", cur)):
        ev = metrics.quick_evaluation(part).select("roc_auc", "pr_auc")
        _sinks.log_run(spark, base, "delinquency", "literal", {}, {"threshold": 0.5}, ev, run_id=run_id)
    half = spark.createDataFrame([("roc_auc", 1.0)], "name string, value double")
    _sinks._write(half, base, "metrics", "cut off", "delinquency", "half")
    return _sinks.best_runs(_sinks.read_run_log(spark, base, "metrics"))


@register("importance_logged")
def q_importance_logged(spark, sf):
    """Importances written with a run, twice, and as CSV; the three most important read back from both."""
    base = _scratch(spark, "run-log")
    imp = cut_lineage(_x.global_importance(frames.contributions(spark, sf)))
    for _ in range(2):
        _sinks.log_run(spark, base, "delinquency", "literal", {}, {}, spark.range(1).select(F.lit(1.0).alias("x")), imp, run_id="a")
    _sinks.write_importance_csv(imp, f"{base}/csv")
    text = spark.read.option("header", True).schema("feature string, importance double, rank int").csv(f"{base}/csv")
    logged = _sinks.read_run_log(spark, base, "importance").select("feature", "importance")
    rank = Window.orderBy(F.col("importance").desc(), "feature")       # one row per feature
    both = logged.join(text.select("feature", F.col("importance").alias("_csv")), "feature").where("importance = _csv")
    return both.select("feature", "importance", F.row_number().over(rank).alias("rank")).where("rank <= 3")


@register("saved_models")
def q_saved_models(spark, sf):
    """Trees and logistic regression saved, loaded and run on the test rows: rows whose scores are the same."""
    base, frame = _scratch(spark, "models"), _tree_frame(spark, sf)[0].where("split = 'test'")
    trees = _boost.best(_trees(spark, sf))
    _boost.save(trees, spark, f"{base}/trees")
    vectors, lr = _model_frame(spark, sf)[0], _bounded_lr(spark, sf)
    _model.save_model(lr, f"{base}/lr")
    vectors = vectors.where("split = 'test'")
    out = []
    for name, before, after in (("trees", _boost.score(trees, frame), _boost.score(_boost.load(spark, f"{base}/trees"), frame)),
                                ("lr", _model.score(lr, vectors), _model.score(_model.load_model(f"{base}/lr"), vectors))):
        both = before.select("id", "score").join(after.select("id", F.col("score").alias("_again")), "id")
        out.append(both.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("score") == F.col("_again")).alias("n_equal")))
    return out[0].unionByName(out[1]).select("model", "n_rows", "n_equal")


@register("dictionary_round_trip")
def q_dictionary(spark, sf):
    """Part names as dictionary keys (edge spaces, a missing name) with quoted, broken descriptions; scanned and renamed."""
    path = _scratch(spark, "dictionary")
    part = spark.read.parquet(f"{sf}/part.parquet")
    key = F.when(F.col("p_partkey") % 11 != 0, F.concat("p_name", F.lit("/"), "p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.lit(" \u00a0")).otherwise("")))
    text = F.concat(F.lit('type "'), "p_type", F.lit('",\nbrand '), "p_brand")
    part.select(key.alias("LoanStatNew"), text.alias("Description")).write.option("header", True).option("quote", '"').option(
        "escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    return _files.rename_dictionary(_files.load_data_dictionary(spark, path))


@register("preview")
def q_preview(spark, sf):
    """The first five loans by amount."""
    from riskframe.plans.evaluation import preview
    return preview(tables.loans(spark, sf).select("id", "loan_amnt", "purpose"), 5, ["loan_amnt", "id"])


@register("csv_round_trip")
def q_csv_round_trip(spark, sf):
    """Loans with quotes and line breaks in a text, written as CSV (plain and gzip) and scanned again."""
    base = _scratch(spark, "csv")
    note = F.when(F.col("id") % 50 == 0, F.concat(F.lit('said "no",\nthen '), F.col("purpose"))).when(
        F.col("id") % 7 == 0, F.concat(F.lit('a "quoted", '), F.col("purpose")))
    loans = tables.loans(spark, sf).select("id", "loan_amnt", "int_rate", "term", "emp_length", note.alias("note"))
    schema = "id long, loan_amnt double, int_rate string, term string, emp_length string, note string"
    for name, part in (("train", F.col("id") % 3 != 0), ("test", F.col("id") % 3 == 0)):
        # line breaks in the files of some parts only
        out = loans.where(part).repartition(4, (F.col("id") % 50 == 0).cast("int"), F.col("id") % 5)
        out.write.option("header", True).option("quote", '"').option("escape", '"').option(
            "compression", "gzip" if name == "test" else "none").option("ignoreLeadingWhiteSpace", False).csv(f"{base}/{name}")
    return _files.load_train_test(spark, f"{base}/train", f"{base}/test", schema)


@register("permutation_contributions")
def q_permutation(spark, sf):
    """X2(b): sampled permutation Shapley values of a trained model on a seeded sample."""
    frame, feats = _model_frame(spark, sf)
    m = _bounded_lr(spark, sf)
    cols = frame.select("id", "features", "split")
    from pyspark.ml.functions import vector_to_array
    arr = cols.select("id", "split", vector_to_array("features").alias("_a"))
    wide = arr.select("id", "split", *[F.col("_a")[i].alias(f) for i, f in enumerate(feats)])
    rows = _x.seeded_sample(wide.where(F.col("split") == "test"), 1000)
    return _x.permutation_contributions(m, rows, wide.where(F.col("split") == "train"), feats, n_background=100)


@register("tree_contributions")
def q_tree_contributions(spark, sf):
    """Exact contributions of the leaf-wise trees for every test row."""
    model = _boost.best(_trees(spark, sf))
    return _attr.tree_contributions(model, _tree_frame(spark, sf)[0].where("split = 'test'"))


def _explained(spark, sf):
    """X7 on every test row: exact attributions of all leaf-wise trees of the fit."""
    def make():
        model = _trees(spark, sf)
        return _x.explanation_report(model, _tree_frame(spark, sf)[0].where("split = 'test'"), model.binning.features,
                                     sample_size=None, contributions=lambda rows: _attr.tree_contributions(model, rows))
    return shared(spark, sf, "explained", make)


@register("explanation_report")
def q_explanation_report(spark, sf):
    """Importance table of the explanation report."""
    return _explained(spark, sf)["importance"]


@register("explanation_high_risk")
def q_explanation_high_risk(spark, sf):
    """The first ten high-risk rows of all test rows."""
    return _explained(spark, sf)["high_risk"]


@register("explanation_waterfalls")
def q_explanation_waterfalls(spark, sf):
    """Waterfalls of the three rows of highest risk."""
    return _explained(spark, sf)["waterfalls"]


@register("explanation_dependence")
def q_explanation_dependence(spark, sf):
    """Values and contributions of the key features."""
    return _explained(spark, sf)["dependence"]


@register("importance_display")
def q_importance_display(spark, sf):
    """Printed top-15 importance lines with truncated descriptions."""
    from riskframe.plans.evaluation import importance_lines
    imp = _x.describe_features(_x.global_importance(frames.contributions(spark, sf)), frames.dictionary(spark))
    return importance_lines(imp)


@register("frame_prepared")
def q_frame_prepared(spark, sf):
    """E5: per-frame preparation (date parts, per-frame codes and medians)."""
    return _train.prepare_frame(frames.engineered_loans(spark, sf))
