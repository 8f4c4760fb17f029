"""DuckDB SQL twins of the catalog queries (the correctness oracle).

Written independently of the Spark operators: plain (unbucketed) windows,
rank-sum AUC, ``quantile_cont``, ``lag`` chains. Every double is rounded to
6 decimals here and in the Spark catalog. The tables ``orders`` and
``customer`` etc. are the driver's pre-registered views.
"""

from __future__ import annotations

from riskframe.plans.frames import DICTIONARY
from riskframe.schema import DIRECTIONS
from riskframe.sources.tables import (FIXTURE_HORIZON, FIXTURE_TRAIN_END, FIXTURE_VAL_END,
                                      oracle_prelude)

PRE = oracle_prelude()

CLEANED = """
cleaned AS (
  SELECT * REPLACE (
    TRY_CAST(NULLIF(REPLACE(int_rate, '%', ''), '') AS DOUBLE) AS int_rate,
    TRY_CAST(NULLIF(REPLACE(revol_util, '%', ''), '') AS DOUBLE) AS revol_util,
    CAST(try_strptime(issue_d, '%b-%Y') AS DATE) AS issue_d,
    CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE) AS earliest_cr_line)
  FROM {src})"""

ENGINEERED = """
eng AS (
  SELECT *,
    CASE WHEN annual_inc = 0 THEN NULL ELSE installment * 12 / annual_inc END AS payment_to_income,
    CASE WHEN total_rev_hi_lim + 1 = 0 THEN NULL ELSE revol_bal / (total_rev_hi_lim + 1) END AS credit_utilization,
    date_diff('day', earliest_cr_line, issue_d) / 30.44 AS credit_age_months,
    CASE WHEN annual_inc = 0 THEN NULL ELSE loan_amnt / annual_inc END AS loan_to_income,
    CASE emp_length WHEN '< 1 year' THEN 0 WHEN '1 year' THEN 1 WHEN '2 years' THEN 2
      WHEN '3 years' THEN 3 WHEN '4 years' THEN 4 WHEN '5 years' THEN 5 WHEN '6 years' THEN 6
      WHEN '7 years' THEN 7 WHEN '8 years' THEN 8 WHEN '9 years' THEN 9 WHEN '10+ years' THEN 10
    END::DOUBLE AS emp_length_numeric,
    TRY_CAST(NULLIF(regexp_extract(term, '[0-9]+', 0), '') AS DOUBLE) AS term_months
  FROM cleaned)"""

LABELLED = """
labelled AS (
  SELECT *, CASE WHEN loan_status IN ('Late (31-120 days)', 'Late (16-30 days)', 'Default', 'Charged Off')
                 THEN 1 ELSE 0 END AS delinq_90dpd
  FROM eng
  WHERE loan_status IN ('Late (31-120 days)', 'Late (16-30 days)', 'Default', 'Charged Off',
                        'Current', 'Fully Paid'))"""

SPLIT = f"""
splitted AS (
  SELECT *, CASE WHEN issue_d <= DATE '{FIXTURE_TRAIN_END}' THEN 'train'
                 WHEN issue_d <= DATE '{FIXTURE_VAL_END}' THEN 'val' ELSE 'test' END AS split
  FROM labelled WHERE issue_d <= DATE '{FIXTURE_HORIZON}')"""

PROXIES = """
qcuts AS (SELECT quantile_cont(annual_inc, 0.25) AS q1, quantile_cont(annual_inc, 0.5) AS q2,
                 quantile_cont(annual_inc, 0.75) AS q3 FROM eng),
prox AS (
  SELECT e.*,
    CASE WHEN annual_inc IS NULL THEN NULL WHEN annual_inc <= q1 THEN 'Low'
         WHEN annual_inc <= q2 THEN 'Medium-Low' WHEN annual_inc <= q3 THEN 'Medium-High'
         ELSE 'High' END AS income_quartile,
    CASE WHEN addr_state IN ('CA', 'NY', 'CT', 'MA', 'NJ', 'MD', 'WA') THEN 'High' ELSE 'Other' END
      AS state_income_level,
    CASE WHEN purpose IN ('medical', 'car', 'home_improvement', 'major_purchase') THEN 'Essential'
         ELSE 'Discretionary' END AS loan_purpose_type,
    CASE WHEN credit_age_months > 0 AND credit_age_months <= 60 THEN 'New'
         WHEN credit_age_months > 60 AND credit_age_months <= 120 THEN 'Developing'
         WHEN credit_age_months > 120 AND credit_age_months <= 240 THEN 'Established'
         WHEN credit_age_months > 240 THEN 'Mature' END AS credit_maturity,
    CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM eng e JOIN qcuts ON TRUE)"""

LONG_GROUPS = """
long AS (
  SELECT * FROM (
    SELECT 'income_quartile' AS grouping_var, income_quartile AS group_value, label, score, pred FROM prox
    UNION ALL SELECT 'state_income_level', state_income_level, label, score, pred FROM prox
    UNION ALL SELECT 'loan_purpose_type', loan_purpose_type, label, score, pred FROM prox
    UNION ALL SELECT 'credit_maturity', credit_maturity, label, score, pred FROM prox)
  WHERE group_value IS NOT NULL)"""

GROUP_METRICS = """
ranked AS (
  SELECT *, rank() OVER (PARTITION BY grouping_var, group_value ORDER BY score)
            + (count(*) OVER (PARTITION BY grouping_var, group_value, score) - 1) / 2.0 AS r
  FROM long),
g AS (
  SELECT grouping_var, group_value, count(*) AS sample_size, avg(label) AS base_rate,
    avg(pred) AS positive_rate,
    sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
    sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,
    sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn,
    avg(score) AS mean_prediction, sum(CASE WHEN label = 1 THEN r END) AS rsum
  FROM ranked GROUP BY grouping_var, group_value),
gm AS (
  SELECT grouping_var, group_value, sample_size, base_rate, positive_rate,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS tpr,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS tnr,
    CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END AS fpr,
    CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0 END AS fnr,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS ppv,
    CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS npv,
    mean_prediction,
    CASE WHEN tp + fn > 0 AND tn + fp > 0 AND sample_size > 10
         THEN (rsum - (tp + fn) * (tp + fn + 1) / 2.0) / ((tp + fn) * (tn + fp)) END AS auc
  FROM g)"""

# score-ordered cumulative table over the scored view (no buckets: DuckDB window)
CUM = """
sc AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM scored GROUP BY score),
tot AS (SELECT sum(tp) AS P, sum(fp) AS N FROM sc),
cum AS (
  SELECT sc.*, sum(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
         sum(fp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cfp,
         P, N
  FROM sc JOIN tot ON TRUE)"""

RANK_AUC = """
rk AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
       FROM scored),
auc AS (SELECT (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0)
               / (sum(label) * sum(1 - label)) AS roc_auc FROM rk)"""

PR_AUC = """
pts AS (SELECT score, ctp / P AS rec, ctp / (ctp + cfp) AS prec FROM cum),
seq AS (SELECT rec, prec, lag(rec, 1, 0.0) OVER (ORDER BY score DESC) AS prev_rec,
               lag(prec, 1, 1.0) OVER (ORDER BY score DESC) AS prev_prec FROM pts),
pra AS (SELECT sum((rec - prev_rec) * (prec + prev_prec) / 2) AS pr_auc FROM seq)"""

KS = """
ks AS (SELECT greatest(max(ctp / P - cfp / N), 0.0) AS ks_statistic FROM cum)"""

CONF = """
conf AS (
  SELECT count(*) AS n, avg(label) AS positive_rate, avg(pow(score - label, 2)) AS brier_score,
    count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn,
    count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
    count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn,
    count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp
  FROM scored),
cls AS (
  SELECT *, CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END AS accuracy,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS specificity,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score
  FROM conf)"""


def round6(x: str) -> str:
    """Half-up to 6 decimals by the same IEEE steps the Spark side takes."""
    return f"(CASE WHEN abs({x}) < 1e12 THEN floor(({x}) * 1e6 + 0.5) / 1e6 ELSE ({x}) END)"


def r6(*cols: str) -> str:
    return ", ".join(f"{round6(c)} AS {c}" for c in cols)


def sql(*ctes: str, final: str) -> str:
    body = ",".join(ctes)
    return f"{PRE},{body}\n{final}"


def scored_clean() -> list[str]:
    return [CLEANED.format(src="scored"), ENGINEERED]


def loans_clean() -> list[str]:
    return [CLEANED.format(src="loans"), ENGINEERED]


ORACLE: dict[str, str] = {}

ORACLE["group_metrics"] = sql(
    *scored_clean(), PROXIES, LONG_GROUPS, GROUP_METRICS,
    final=f"SELECT grouping_var, group_value, sample_size, "
          f"{r6('base_rate', 'positive_rate', 'tpr', 'tnr', 'fpr', 'fnr', 'ppv', 'npv', 'mean_prediction', 'auc')} "
          f"FROM gm")

ORACLE["roc_auc"] = sql(RANK_AUC, final="SELECT (CASE WHEN abs(roc_auc) < 1e12 THEN floor((roc_auc) * 1e6 + 0.5) / 1e6 ELSE (roc_auc) END) AS roc_auc FROM auc")
ORACLE["pr_auc"] = sql(CUM, PR_AUC, final="SELECT (CASE WHEN abs(pr_auc) < 1e12 THEN floor((pr_auc) * 1e6 + 0.5) / 1e6 ELSE (pr_auc) END) AS pr_auc FROM pra")
ORACLE["ks"] = sql(CUM, KS, final="SELECT (CASE WHEN abs(ks_statistic) < 1e12 THEN floor((ks_statistic) * 1e6 + 0.5) / 1e6 ELSE (ks_statistic) END) AS ks_statistic FROM ks")
ORACLE["roc_points"] = sql(CUM, """
lc AS (SELECT *, row_number() OVER (ORDER BY score DESC) AS rn,
              lead(tp) OVER (ORDER BY score DESC) AS ntp, lead(fp) OVER (ORDER BY score DESC) AS nfp
       FROM cum)""", final="""
SELECT (CASE WHEN abs(score) < 1e12 THEN floor((score) * 1e6 + 0.5) / 1e6 ELSE (score) END) AS threshold, (CASE WHEN abs(cfp / N) < 1e12 THEN floor((cfp / N) * 1e6 + 0.5) / 1e6 ELSE (cfp / N) END) AS fpr, (CASE WHEN abs(ctp / P) < 1e12 THEN floor((ctp / P) * 1e6 + 0.5) / 1e6 ELSE (ctp / P) END) AS tpr FROM lc
WHERE rn = 1 OR ntp IS NULL OR ntp <> tp OR nfp <> fp
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0, 0.0""")
ORACLE["pr_points"] = sql(CUM, final="""
SELECT (CASE WHEN abs(score) < 1e12 THEN floor((score) * 1e6 + 0.5) / 1e6 ELSE (score) END) AS threshold, (CASE WHEN abs(ctp / (ctp + cfp)) < 1e12 THEN floor((ctp / (ctp + cfp)) * 1e6 + 0.5) / 1e6 ELSE (ctp / (ctp + cfp)) END) AS precision, (CASE WHEN abs(ctp / P) < 1e12 THEN floor((ctp / P) * 1e6 + 0.5) / 1e6 ELSE (ctp / P) END) AS recall
FROM cum UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0""")
ORACLE["calibration_bins"] = sql("""
cb AS (SELECT greatest(CAST(ceil(score * 10) AS INTEGER) - 1, 0) AS bin, score, label FROM scored)""",
    final="SELECT bin, count(*) AS n, (CASE WHEN abs(avg(score)) < 1e12 THEN floor((avg(score)) * 1e6 + 0.5) / 1e6 ELSE (avg(score)) END) AS mean_predicted, "
          "(CASE WHEN abs(avg(label)) < 1e12 THEN floor((avg(label)) * 1e6 + 0.5) / 1e6 ELSE (avg(label)) END) AS fraction_positive FROM cb GROUP BY bin")
ORACLE["brier"] = sql(CONF, final="SELECT (CASE WHEN abs(brier_score) < 1e12 THEN floor((brier_score) * 1e6 + 0.5) / 1e6 ELSE (brier_score) END) AS brier_score FROM conf")
ORACLE["confusion"] = sql(CONF, final="SELECT tn, fp, fn, tp FROM conf")
ORACLE["classification_metrics"] = sql(
    CONF, final=f"SELECT tn, fp, fn, tp, {r6('accuracy', 'precision', 'recall', 'specificity', 'f1_score')} FROM cls")
ORACLE["evaluation"] = sql(
    CONF, RANK_AUC, CUM, PR_AUC, KS,
    final=f"SELECT n, tn, fp, fn, tp, {r6('positive_rate', 'brier_score', 'accuracy', 'precision', 'recall', 'specificity', 'f1_score', 'roc_auc', 'pr_auc', 'ks_statistic')} "
          f"FROM cls JOIN auc ON TRUE JOIN pra ON TRUE JOIN ks ON TRUE")


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {c}"


ORACLE["clean_loans"] = sql(*loans_clean(), final=(
    f"SELECT id, {r6('int_rate', 'revol_util')}, {_iso('issue_d')}, {_iso('earliest_cr_line')}, "
    f"emp_length_numeric, {r6('term_months')} FROM eng"))
ORACLE["date_parts"] = sql(CLEANED.format(src="loans"), final=(
    "SELECT id, CAST(year(issue_d) AS INTEGER) AS issue_d_year, "
    "CAST(month(issue_d) AS INTEGER) AS issue_d_month FROM cleaned"))


def _narrow(c: str) -> str:
    return (f"CASE WHEN min({c}) OVER () >= -128 AND max({c}) OVER () <= 127 THEN 'tinyint' "
            f"WHEN min({c}) OVER () >= -32768 AND max({c}) OVER () <= 32767 THEN 'smallint' "
            f"WHEN min({c}) OVER () >= -2147483648 AND max({c}) OVER () <= 2147483647 THEN 'int' "
            f"ELSE 'bigint' END AS {c}_type")


ORACLE["narrow_types"] = sql("nt AS (SELECT id, member_id FROM loans)", final=(
    f"SELECT CAST(id AS BIGINT) AS id, CAST(member_id AS BIGINT) AS member_id, "
    f"{_narrow('id')}, {_narrow('member_id')} FROM nt"))
ORACLE["labelled_loans"] = sql(*loans_clean(), LABELLED,
                               final="SELECT id, loan_status, delinq_90dpd FROM labelled")
ORACLE["engineered_features"] = sql(*loans_clean(), LABELLED, final=(
    f"SELECT id, {r6('payment_to_income', 'credit_utilization', 'credit_age_months', 'loan_to_income')} "
    f"FROM labelled"))
ORACLE["temporal_split"] = sql(*loans_clean(), LABELLED, SPLIT, final="SELECT id, split FROM splitted")
ORACLE["split_summary"] = sql(*loans_clean(), LABELLED, SPLIT, final=(
    "SELECT split, count(*) AS n_rows, strftime(min(issue_d), '%Y-%m-%d') AS min_date, "
    "strftime(max(issue_d), '%Y-%m-%d') AS max_date FROM splitted GROUP BY split"))
# 18 loan columns + 6 engineered = 24 columns besides the target and split
ORACLE["dataset_overview"] = sql(*loans_clean(), LABELLED, SPLIT, final=(
    "SELECT split, count(*) AS n_rows, 24 AS n_features, (CASE WHEN abs(avg(delinq_90dpd)) < 1e12 THEN floor((avg(delinq_90dpd)) * 1e6 + 0.5) / 1e6 ELSE (avg(delinq_90dpd)) END) AS positive_rate, "
    "CAST(sum(delinq_90dpd) AS BIGINT) AS n_positive FROM splitted GROUP BY split"))
ORACLE["demographic_proxies"] = sql(*scored_clean(), PROXIES, final=(
    "SELECT id, income_quartile, state_income_level, loan_purpose_type, credit_maturity FROM prox"))

ORACLE["origination_projection"] = sql("o AS (SELECT 1)", final=(
    "SELECT loan_amnt, term, int_rate, installment, emp_length, home_ownership, annual_inc, issue_d, "
    "loan_status, purpose, addr_state, dti, earliest_cr_line, revol_bal, revol_util, total_rev_hi_lim "
    "FROM loans"))
_LEAK_NUM = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal",
             "total_rev_hi_lim", "payment_to_income", "credit_utilization", "credit_age_months",
             "loan_to_income", "term_months"]
ORACLE["leakage_projection"] = sql(*loans_clean(), LABELLED, final=(
    f"SELECT {r6(*_LEAK_NUM)}, term, emp_length, purpose, home_ownership, emp_length_numeric "
    f"FROM labelled"))
_KINDS = [(c, "double") for c in _LEAK_NUM] + [
    ("term", "string"), ("emp_length", "string"), ("purpose", "string"),
    ("home_ownership", "string"), ("emp_length_numeric", "double")]
ORACLE["feature_kinds"] = sql(*loans_clean(), LABELLED, "fk AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{t}' AS dtype, count(DISTINCT {c}) AS n_distinct FROM labelled"
    for c, t in _KINDS) + ")", final=(
    "SELECT feature, dtype, n_distinct, CASE WHEN dtype = 'string' OR n_distinct < 20 "
    "THEN 'categorical' ELSE 'numeric' END AS kind FROM fk"))
_ALL_FEATS = [c for c, _ in _KINDS] + ["delinq_90dpd"]
ORACLE["complete_cases"] = sql(*loans_clean(), LABELLED, final=(
    "SELECT count(*) AS n_rows, count(*) FILTER (WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in _ALL_FEATS) + ") AS n_complete, "
    "count(*) - count(*) FILTER (WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _ALL_FEATS)
    + ") AS n_removed FROM labelled"))
_PRESENT = {"term", "revol_util", "annual_inc", "int_rate", "dti", "purpose", "loan_amnt",
            "installment", "addr_state", "revol_bal", "id", "emp_length", "home_ownership"}
_FEATURES = ["sub_grade", "term", "home_ownership", "fico_range_low", "total_acc", "pub_rec",
             "revol_util", "annual_inc", "int_rate", "dti", "purpose", "mort_acc", "loan_amnt",
             "application_type", "installment", "verification_status", "pub_rec_bankruptcies",
             "addr_state", "initial_list_status", "fico_range_high", "revol_bal", "id", "open_acc",
             "emp_length", "time_to_earliest_cr_line", "issue_d_year", "issue_d_month"]
_DOUBLES = {"revol_util", "annual_inc", "int_rate", "dti", "loan_amnt", "installment", "revol_bal"}
ORACLE["aligned_features"] = sql(*loans_clean(), LABELLED, final="SELECT " + ", ".join(
    (f"(CASE WHEN abs({c}) < 1e12 THEN floor(({c}) * 1e6 + 0.5) / 1e6 ELSE ({c}) END) AS {c}" if c in _DOUBLES else c) if c in _PRESENT else f"0 AS {c}"
    for c in _FEATURES) + " FROM labelled")

GROUP_RANK = """
CASE grouping_var || '/' || group_value
  WHEN 'income_quartile/Low' THEN 0 WHEN 'income_quartile/Medium-Low' THEN 1
  WHEN 'income_quartile/Medium-High' THEN 2 WHEN 'income_quartile/High' THEN 3
  WHEN 'state_income_level/High' THEN 0 WHEN 'state_income_level/Other' THEN 1
  WHEN 'loan_purpose_type/Essential' THEN 0 WHEN 'loan_purpose_type/Discretionary' THEN 1
  WHEN 'credit_maturity/New' THEN 0 WHEN 'credit_maturity/Developing' THEN 1
  WHEN 'credit_maturity/Established' THEN 2 WHEN 'credit_maturity/Mature' THEN 3 ELSE 1000 END"""
_PM = ["tpr", "tnr", "fpr", "ppv", "positive_rate", "mean_prediction"]
GAPS = f"""
grk AS (SELECT *, {GROUP_RANK} AS grank FROM gm),
gref AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grouping_var ORDER BY grank, group_value) AS rn
                        FROM grk) WHERE rn = 1),
gpairs AS (SELECT g.*, r.group_value AS reference_group, {', '.join(f'r.{m} AS r_{m}' for m in _PM)}
           FROM grk g JOIN gref r ON g.grouping_var = r.grouping_var WHERE g.group_value <> r.group_value),
gaps AS ({' UNION ALL '.join(
    f"SELECT grouping_var, reference_group, group_value, reference_group || '_vs_' || group_value AS comparison, "
    f"'{m}' AS metric, abs(r_{m} - {m}) AS gap FROM gpairs" for m in _PM)})"""
ORACLE["parity_gaps"] = sql(*scored_clean(), PROXIES, LONG_GROUPS, GROUP_METRICS, GAPS, final=(
    "SELECT grouping_var, reference_group, group_value, comparison, metric, (CASE WHEN abs(gap) < 1e12 THEN floor((gap) * 1e6 + 0.5) / 1e6 ELSE (gap) END) AS gap FROM gaps"))
ORACLE["fairness_summary"] = sql(*scored_clean(), PROXIES, LONG_GROUPS, GROUP_METRICS, GAPS, """
fs AS (SELECT coalesce(max(gap) FILTER (WHERE metric = 'tpr'), 0.0) AS max_tpr_gap,
              coalesce(max(gap) FILTER (WHERE metric = 'fpr'), 0.0) AS max_fpr_gap,
              coalesce(max(gap) FILTER (WHERE metric = 'ppv'), 0.0) AS max_ppv_gap,
              count(*) FILTER (WHERE gap > 0.1) AS n_problematic,
              coalesce(string_agg(CASE WHEN gap > 0.1 THEN grouping_var || '/' || comparison || '/' || metric END,
                                  ';' ORDER BY grouping_var, comparison, metric), '') AS problematic
       FROM gaps)""", final=(
    f"SELECT {r6('max_tpr_gap', 'max_fpr_gap', 'max_ppv_gap')}, CAST(n_problematic AS INTEGER) AS n_problematic, "
    "problematic, concat_ws(' | ', "
    "CASE WHEN max_tpr_gap > 0.1 THEN 'Consider threshold adjustment to reduce True Positive Rate disparities' END, "
    "CASE WHEN max_fpr_gap > 0.1 THEN 'Monitor False Positive Rate differences across groups' END, "
    "CASE WHEN n_problematic > 0 THEN 'Implement bias mitigation techniques or post-processing adjustments' "
    "ELSE 'Model shows acceptable fairness metrics across analyzed groups' END) AS recommendations FROM fs"))
ORACLE["threshold_sweep"] = sql(*scored_clean(), PROXIES, LONG_GROUPS, """
th AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS threshold),
sw AS (SELECT grouping_var, group_value, threshold, count(*) AS n,
         count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
         count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
         count(*) FILTER (WHERE score < threshold AND label = 1) AS fn,
         count(*) FILTER (WHERE score < threshold AND label = 0) AS tn
       FROM long JOIN th ON TRUE
       GROUP BY grouping_var, group_value, threshold)""", final=(
    "SELECT grouping_var, group_value, threshold, "
    "(CASE WHEN abs(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END) < 1e12 THEN floor((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END) * 1e6 + 0.5) / 1e6 ELSE (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END) END) AS tpr, "
    "(CASE WHEN abs(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END) < 1e12 THEN floor((CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END) * 1e6 + 0.5) / 1e6 ELSE (CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END) END) AS fpr, "
    "(CASE WHEN abs(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END) < 1e12 THEN floor((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END) * 1e6 + 0.5) / 1e6 ELSE (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END) END) AS ppv, "
    "(CASE WHEN abs((tp + fp) / n) < 1e12 THEN floor(((tp + fp) / n) * 1e6 + 0.5) / 1e6 ELSE ((tp + fp) / n) END) AS positive_rate FROM sw"))
ORACLE["class_weights"] = sql("""
cw AS (SELECT count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1) AS ratio FROM scored)""",
    final=("SELECT label, count(*) AS n, (CASE WHEN abs(max(CASE WHEN label = 1 THEN ratio ELSE 1.0 END)) < 1e12 THEN floor((max(CASE WHEN label = 1 THEN ratio ELSE 1.0 END)) * 1e6 + 0.5) / 1e6 ELSE (max(CASE WHEN label = 1 THEN ratio ELSE 1.0 END)) END) AS weight "
           "FROM scored JOIN cw ON TRUE GROUP BY label"))
ORACLE["quick_evaluation"] = sql(CONF, RANK_AUC, CUM, PR_AUC, final=(
    f"SELECT {r6('roc_auc', 'pr_auc', 'accuracy', 'positive_rate')} FROM cls JOIN auc ON TRUE JOIN pra ON TRUE"))
ORACLE["performance_band"] = sql(RANK_AUC, final=(
    "SELECT (CASE WHEN abs(roc_auc) < 1e12 THEN floor((roc_auc) * 1e6 + 0.5) / 1e6 ELSE (roc_auc) END) AS roc_auc, CASE WHEN roc_auc > 0.75 THEN 'Excellent' WHEN roc_auc > 0.65 THEN 'Good' "
    "WHEN roc_auc > 0.55 THEN 'Fair' ELSE 'Poor' END AS performance_level, roc_auc < 0.7 AS needs_retraining "
    "FROM auc"))


DRIFT_SRC = f"""
src AS (SELECT *, CASE WHEN issue_d <= DATE '{FIXTURE_TRAIN_END}' THEN 'ref' ELSE 'cur' END AS side FROM eng)"""


def _num_long(cols: list[str]) -> str:
    return "hl AS (SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM src" for c in cols) + \
        ") WHERE value IS NOT NULL AND NOT isnan(value))"


HIST = """
rng0 AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM hl WHERE side = 'ref' GROUP BY feature),
rng AS (SELECT feature, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
               CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM rng0),
hb AS (SELECT hl.feature, side, CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin
       FROM hl JOIN rng ON hl.feature = rng.feature WHERE value >= lo AND value <= hi),
grid AS (SELECT feature, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM rng),
hc AS (SELECT grid.feature, grid.bin, count(*) FILTER (WHERE hb.side = 'ref') AS rc,
              count(*) FILTER (WHERE hb.side = 'cur') AS cc
       FROM grid LEFT JOIN hb ON grid.feature = hb.feature AND grid.bin = hb.bin
       GROUP BY grid.feature, grid.bin)"""

PSI_NUM = """
ht AS (SELECT feature, sum(rc) AS rn, sum(cc) AS cn FROM hc GROUP BY feature),
pn AS (SELECT hc.feature, CASE WHEN rc = 0 THEN 1e-6 ELSE rc / rn END AS r,
              CASE WHEN cc = 0 THEN 1e-6 ELSE cc / cn END AS c, cn
       FROM hc JOIN ht ON hc.feature = ht.feature),
psin AS (SELECT feature, CASE WHEN max(cn) > 0 THEN sum((c - r) * ln(c / r)) END AS psi FROM pn GROUP BY feature)"""


def _cat_long(cols: list[str]) -> str:
    return "cl AS (SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT side, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM src" for c in cols) + \
        ") WHERE value IS NOT NULL)"


PSI_CAT = """
rp AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p
       FROM cl WHERE side = 'ref' GROUP BY feature, value),
cp AS (SELECT feature, value, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p
       FROM cl WHERE side = 'cur' GROUP BY feature, value),
pc0 AS (SELECT coalesce(rp.feature, cp.feature) AS feature, coalesce(rp.p, 1e-6) AS r, coalesce(cp.p, 1e-6) AS c
        FROM rp FULL OUTER JOIN cp ON rp.feature = cp.feature AND rp.value = cp.value),
psic AS (SELECT f.feature, CASE WHEN EXISTS (SELECT 1 FROM rp WHERE rp.feature = f.feature)
                                 AND EXISTS (SELECT 1 FROM cp WHERE cp.feature = f.feature)
                            THEN (SELECT sum((c - r) * ln(c / r)) FROM pc0 WHERE pc0.feature = f.feature) END AS psi
         FROM (SELECT DISTINCT feature FROM pc0) f)"""

_DN = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal", "total_rev_hi_lim",
       "payment_to_income", "credit_utilization", "credit_age_months", "loan_to_income", "emp_length_numeric", "term_months"]
_DC = ["term", "emp_length", "purpose", "addr_state", "home_ownership", "loan_status"]
ORACLE["histogram"] = sql(*scored_clean(), DRIFT_SRC, _num_long(_DN), HIST,
                          final="SELECT feature, bin, rc AS ref_count, cc AS cur_count FROM hc")
ORACLE["psi_numeric"] = sql(*scored_clean(), DRIFT_SRC, _num_long(_DN), HIST, PSI_NUM,
                            final=f"SELECT feature, {r6('psi')} FROM psin")
ORACLE["psi_categorical"] = sql(*scored_clean(), DRIFT_SRC, _cat_long(_DC), PSI_CAT,
                                final=f"SELECT feature, {r6('psi')} FROM psic")
ORACLE["psi_all"] = sql(*scored_clean(), DRIFT_SRC, _num_long(_DN), HIST, PSI_NUM,
                        _cat_long(_DC), PSI_CAT, final=(
    f"SELECT feature, 'numeric' AS kind, {r6('psi')} FROM psin "
    f"UNION ALL SELECT feature, 'categorical' AS kind, {r6('psi')} FROM psic"))

_SIDE_AUC = """
{n}rk AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
       FROM src WHERE side = '{s}'),
{n}auc AS (SELECT (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0)
               / (sum(label) * sum(1 - label)) AS roc_auc FROM {n}rk),
{n}sc AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM src WHERE side = '{s}' GROUP BY score),
{n}cum AS (SELECT score, sum(tp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ctp,
                  sum(fp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cfp,
                  (SELECT sum(tp) FROM {n}sc) AS P FROM {n}sc),
{n}seq AS (SELECT ctp / P AS rec, ctp / (ctp + cfp) AS prec,
                  lag(ctp / P, 1, 0.0) OVER (ORDER BY score DESC) AS prev_rec,
                  lag(ctp / (ctp + cfp), 1, 1.0) OVER (ORDER BY score DESC) AS prev_prec FROM {n}cum),
{n}pra AS (SELECT sum((rec - prev_rec) * (prec + prev_prec) / 2) AS pr_auc FROM {n}seq)"""
MONITOR = (_SIDE_AUC.format(n="r_", s="ref") + "," + _SIDE_AUC.format(n="c_", s="cur") + """,
mon0 AS (SELECT c_auc.roc_auc AS current_roc_auc, c_pra.pr_auc AS current_pr_auc,
                r_auc.roc_auc AS reference_roc_auc, r_pra.pr_auc AS reference_pr_auc
         FROM c_auc JOIN c_pra ON TRUE JOIN r_auc ON TRUE JOIN r_pra ON TRUE),
mon AS (SELECT *, current_roc_auc - reference_roc_auc AS auc_change, current_pr_auc - reference_pr_auc AS pr_auc_change,
               abs(current_roc_auc - reference_roc_auc) AS auc_drift, abs(current_pr_auc - reference_pr_auc) AS pr_auc_drift,
               abs(current_roc_auc - reference_roc_auc) > 0.05 AS auc_degradation,
               abs(current_pr_auc - reference_pr_auc) > 0.05 AS pr_auc_degradation FROM mon0)""")
ORACLE["performance_monitor"] = sql(*scored_clean(), DRIFT_SRC, MONITOR, final=(
    f"SELECT {r6('current_roc_auc', 'current_pr_auc', 'reference_roc_auc', 'reference_pr_auc', 'auc_change', 'pr_auc_change', 'auc_drift', 'pr_auc_drift')}, "
    "auc_degradation, pr_auc_degradation, concat_ws(' | ', "
    "CASE WHEN auc_degradation THEN printf('AUC degradation detected (%.3f). Consider model retraining.', auc_drift) END, "
    "CASE WHEN pr_auc_degradation THEN printf('PR-AUC degradation detected (%.3f). Review model performance.', pr_auc_drift) END, "
    "CASE WHEN NOT auc_degradation AND NOT pr_auc_degradation THEN 'Model performance is stable. Continue monitoring.' END"
    ") AS recommendations FROM mon"))
ORACLE["governance_report"] = sql(
    *scored_clean(), DRIFT_SRC, _num_long(_DN), HIST, PSI_NUM, _cat_long(_DC), PSI_CAT,
    "psiall AS (SELECT feature, psi FROM psin UNION ALL SELECT feature, psi FROM psic)",
    MONITOR, PROXIES, LONG_GROUPS, GROUP_METRICS, GAPS, """
fs AS (SELECT coalesce(max(gap) FILTER (WHERE metric = 'tpr'), 0.0) AS max_tpr_gap,
              count(*) FILTER (WHERE gap > 0.1) AS n_problematic FROM gaps),
dq AS (SELECT coalesce(bool_or(psi > 0.2), false) AS drift_detected,
              coalesce(string_agg(CASE WHEN psi > 0.2 THEN feature END, ',' ORDER BY feature), '') AS high_drift_features,
              avg(psi) AS avg_psi FROM psiall),
gov AS (SELECT dq.*, mon.current_roc_auc, NOT (mon.auc_degradation OR mon.pr_auc_degradation) AS performance_stable,
               fs.max_tpr_gap AS max_disparity, fs.n_problematic FROM dq JOIN mon ON TRUE JOIN fs ON TRUE)""",
    final=(
        f"SELECT 'delinquency_model' AS model_name, '1' AS model_version, drift_detected, high_drift_features, "
        f"{r6('avg_psi', 'current_roc_auc')}, performance_stable, {r6('max_disparity')}, 4 AS groups_analyzed, "
        "CASE WHEN NOT drift_detected AND performance_stable AND n_problematic = 0 "
        "THEN 'No immediate action required. Continue regular monitoring.' ELSE concat_ws(' | ', "
        "CASE WHEN drift_detected THEN 'High data drift detected. Review feature distributions and consider retraining.' END, "
        "CASE WHEN NOT performance_stable THEN 'Performance degradation detected. Investigate causes and retrain if necessary.' END, "
        "CASE WHEN n_problematic > 0 THEN 'Fairness issues identified. Review model decisions for affected groups.' END) END "
        "AS action_items FROM gov"))
ORACLE["model_card"] = sql(
    *loans_clean(), LABELLED, SPLIT, CONF, RANK_AUC, CUM, PR_AUC, KS,
    "ov AS (SELECT split, count(*) AS n FROM splitted GROUP BY split)",
    CLEANED.format(src="scored").replace("cleaned AS", "scleaned AS"),
    ENGINEERED.replace("eng AS", "seng AS").replace("FROM cleaned", "FROM scleaned"),
    PROXIES.replace("FROM eng", "FROM seng"), LONG_GROUPS, GROUP_METRICS, GAPS, """
fs AS (SELECT coalesce(max(gap) FILTER (WHERE metric = 'tpr'), 0.0) AS max_tpr_gap,
              coalesce(max(gap) FILTER (WHERE metric = 'fpr'), 0.0) AS max_fpr_gap FROM gaps)""",
    final=(
        "SELECT 'delinquency_model' AS name, '1' AS version, 18 AS n_features, "
        "(SELECT n FROM ov WHERE split = 'train') AS train_size, (SELECT n FROM ov WHERE split = 'val') AS val_size, "
        "(SELECT n FROM ov WHERE split = 'test') AS test_size, "
        f"{r6('roc_auc', 'pr_auc', 'ks_statistic', 'brier_score')}, "
        "'loan_amnt,installment,annual_inc,int_rate,revol_util,term,emp_length,purpose,home_ownership,dti,"
        "revol_bal,total_rev_hi_lim,payment_to_income,credit_utilization,credit_age_months,loan_to_income,"
        "emp_length_numeric,term_months' AS features, "
        f"{r6('max_tpr_gap', 'max_fpr_gap')}, "
        "'income_quartile,state_income_level,loan_purpose_type,credit_maturity' AS groups_analyzed "
        "FROM conf JOIN auc ON TRUE JOIN pra ON TRUE JOIN ks ON TRUE JOIN fs ON TRUE"))


_COEFS = {"int_rate": 0.08, "dti": 0.03, "annual_inc": -1e-05, "revol_util": 0.01,
          "loan_to_income": 0.5, "credit_age_months": -0.002, "emp_length_numeric": -0.02}


def _lit(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def _logit_sql(prefix: str) -> str:
    z = "CAST('-1.0' AS DOUBLE)"
    for f, b in _COEFS.items():
        z = f"({z} + {_lit(b)} * {prefix}{f})"
    return z


CONTRIB = ("bgm AS (SELECT " + ", ".join(f"avg({f}) AS m_{f}" for f in _COEFS) + " FROM eng),\n"
           "xf AS (SELECT id, " + ", ".join(f"coalesce({f}, m_{f}) AS {f}" for f in _COEFS) + ", "
           + ", ".join(f"m_{f}" for f in _COEFS) + " FROM eng JOIN bgm ON TRUE),\n"
           "xs AS (SELECT *, " + _logit_sql("") + " AS logit, " + _logit_sql("m_") + " AS base_value FROM xf),\n"
           "contrib AS (" + " UNION ALL ".join(
               f"SELECT id, '{f}' AS feature, {f} AS value, {_lit(b)} * ({f} - m_{f}) AS contribution, "
               f"base_value, logit, 1.0 / (1.0 + exp(-logit)) AS probability FROM xs"
               for f, b in _COEFS.items()) + ")")
GIMP = """
gimp AS (SELECT feature, avg(abs(contribution)) AS importance,
                row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS rank
         FROM contrib GROUP BY feature)"""
ORACLE["linear_contributions"] = sql(*scored_clean(), CONTRIB, final=(
    f"SELECT id, feature, {r6('value', 'contribution', 'base_value', 'logit', 'probability')}, "
    "CAST(row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS abs_rank "
    "FROM contrib"))
ORACLE["global_importance"] = sql(*scored_clean(), CONTRIB, GIMP, final=(
    f"SELECT feature, {r6('importance')}, CAST(rank AS INTEGER) AS rank FROM gimp "))
_DICT = ("dict AS (SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in DICTIONARY) + ") AS t(feature, description))")
ORACLE["importance_described"] = sql(*scored_clean(), CONTRIB, GIMP, _DICT, final=(
    f"SELECT g.feature, {r6('importance')}, CAST(rank AS INTEGER) AS rank, "
    "coalesce(d.description, 'No description available') AS description "
    "FROM gimp g LEFT JOIN dict d ON g.feature = d.feature "))
ORACLE["importance_topk"] = sql(*scored_clean(), CONTRIB, GIMP, final=(
    f"SELECT feature, {r6('importance')}, CAST(rank AS INTEGER) AS rank FROM gimp WHERE rank <= 3"))
ORACLE["risk_features"] = sql(*scored_clean(), CONTRIB, GIMP, final=(
    f"SELECT feature, {r6('importance')}, CAST(rank AS INTEGER) AS rank, CAST(risk_rank AS INTEGER) AS risk_rank "
    "FROM (SELECT *, row_number() OVER (ORDER BY rank) AS risk_rank FROM gimp WHERE ("
    "lower(feature) LIKE '%delinq%' OR lower(feature) LIKE '%dti%' OR lower(feature) LIKE '%revol_util%' "
    "OR lower(feature) LIKE '%pub_rec%' OR lower(feature) LIKE '%inq%' OR lower(feature) LIKE '%fico%')) "
    "WHERE risk_rank <= 5"))
ORACLE["dependence_pairs"] = sql(*scored_clean(), CONTRIB, final=(
    f"SELECT c.id, c.feature, {r6('c.value')}, {r6('c.contribution')}, {r6('i.value')} "
    "FROM contrib c LEFT JOIN contrib i ON c.id = i.id AND i.feature = 'int_rate' "
    "WHERE c.feature IN ('dti', 'revol_util', 'annual_inc')").replace(
    "AS c.value", "AS value").replace("AS c.contribution", "AS contribution").replace(
    "AS i.value", "AS interaction_value"))
ORACLE["waterfall"] = sql(*scored_clean(), CONTRIB, """
top3 AS (SELECT id FROM (SELECT DISTINCT id, probability, logit FROM contrib) WHERE probability > 0.7
         ORDER BY logit DESC, id LIMIT 3),
wf0 AS (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS INTEGER)
               AS position, feature, value, contribution FROM contrib WHERE id IN (SELECT id FROM top3)
        UNION ALL SELECT DISTINCT id, 0, 'base_value', CAST(NULL AS DOUBLE), base_value FROM contrib
        WHERE id IN (SELECT id FROM top3))""", final=(
    "SELECT id, position, feature, " + r6("value", "contribution") + ", "
    + round6("sum(contribution) OVER (PARTITION BY id ORDER BY position ROWS UNBOUNDED PRECEDING)")
    + " AS cumulative FROM wf0"))
_CF_TEXT = ("CASE feature WHEN 'dti' THEN printf('Reduce debt-to-income ratio from %.2f to %.2f', value, sug) "
            "WHEN 'revol_util' THEN printf('Reduce credit utilization from %.1f%% to %.1f%%', value, sug) "
            "WHEN 'annual_inc' THEN 'Increase annual income from $' || format('{:,.0f}', value) || ' to $' "
            "|| format('{:,.0f}', sug) "
            "WHEN 'delinq_2yrs' THEN printf('Reduce recent delinquencies (currently %.0f)', value) "
            "ELSE printf('%s %s from %.2f to %.2f', CASE dir WHEN 'increase' THEN 'Increase' ELSE 'Decrease' END, "
            "feature, value, sug) END")
_CF_DELTA = "CASE feature " + " ".join(f"WHEN '{f}' THEN {_lit(b)}" for f, b in _COEFS.items()) + " ELSE 0.0 END"
ORACLE["counterfactuals"] = sql(*scored_clean(), CONTRIB, f"""
cr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS ar FROM contrib),
cf0 AS (SELECT *, CASE WHEN contribution > 0 THEN 'decrease' ELSE 'increase' END AS dir,
               CASE WHEN contribution > 0 THEN value * {_lit(0.8)} ELSE value * {_lit(1.2)} END AS sug
        FROM cr WHERE ar <= 6 AND NOT (contribution > 0 AND value <= 0)),
cf1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ar) AS sr FROM cf0),
cf AS (SELECT *, logit + sum(({_CF_DELTA}) * (sug - value)) OVER (PARTITION BY id) AS z FROM cf1 WHERE sr <= 3)""",
    final=("SELECT id, CAST(sr AS INTEGER) AS suggestion_rank, feature, "
           f"{round6('value')} AS current_value, {round6('sug')} AS suggested_value, dir AS change_direction, "
           f"{round6('contribution')} AS shap_impact, {round6('abs(sug - value)')} AS change_magnitude, "
           f"{_CF_TEXT} AS recommendation, {round6('probability')} AS current_probability, "
           f"{round6('probability + ' + _lit(-0.1))} AS target_probability, "
           f"{round6('1.0 / (1.0 + exp(-z))')} AS rescored_probability FROM cf"))
ORACLE["high_risk"] = sql(*scored_clean(), CONTRIB, final=(
    f"SELECT id, {r6('probability')} FROM (SELECT DISTINCT id, probability, logit FROM contrib) "
    "WHERE probability > 0.7 ORDER BY logit DESC, id LIMIT 10"))


# --- imputation and encoding ------------------------------------------------------------------

_IMP = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal", "total_rev_hi_lim",
        "payment_to_income", "credit_utilization", "credit_age_months", "loan_to_income", "emp_length_numeric", "term_months"]
ORACLE["median_imputed"] = sql(*loans_clean(), LABELLED, SPLIT,
                               "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _IMP)
                               + " FROM splitted WHERE split = 'train')", final=(
    "SELECT id, split, " + ", ".join(f"{round6(f'coalesce({c}, m_{c})')} AS {c}" for c in _IMP)
    + " FROM splitted JOIN med ON TRUE"))
ORACLE["unknown_filled"] = sql(*loans_clean(), LABELLED, SPLIT, final=(
    "SELECT id, " + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in
                              ("term", "emp_length", "loan_status", "purpose", "addr_state", "home_ownership"))
    + " FROM splitted"))


def _codes(src: str, cols: list[str], where: str = "") -> str:
    return ",\n".join(
        f"k_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {src} WHERE {c} IS NOT NULL {where}))"
        for c in cols)


_ENC = ["term", "emp_length", "loan_status", "purpose", "addr_state", "home_ownership"]
ORACLE["frame_encoded"] = sql(*loans_clean(), LABELLED, _codes("labelled", _ENC), final=(
    "SELECT id, " + ", ".join(f"coalesce(k_{c}.code, -1) AS {c}" for c in _ENC) + " FROM labelled "
    + " ".join(f"LEFT JOIN k_{c} ON labelled.{c} = k_{c}.v" for c in _ENC)))


def _fitted(src: str, cols: list[str], keep: str, numeric_src_cols: list[str] = ()) -> tuple[str, str]:
    fe = (f"fe AS (SELECT {keep}, " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in cols)
        + (", " + ", ".join(numeric_src_cols) if numeric_src_cols else "") + f" FROM {src})")
    ks = _codes("fe", cols, "AND split = 'train'")
    us = ",\n".join(f"u_{c} AS (SELECT coalesce(max(CASE WHEN v = 'Unknown' THEN code END), count(*)) AS u FROM k_{c})"
                    for c in cols)
    joins = " ".join(f"LEFT JOIN k_{c} ON fe.{c} = k_{c}.v JOIN u_{c} ON TRUE" for c in cols)
    return f"{fe},\n{ks},\n{us}", joins


_FIT = ["emp_length", "purpose", "home_ownership", "term"]
_fit_ctes, _fit_joins = _fitted("splitted", _FIT, "id, split")
ORACLE["fitted_encoded"] = sql(*loans_clean(), LABELLED, SPLIT, _fit_ctes, final=(
    "SELECT fe.id, fe.split, " + ", ".join(f"CAST(coalesce(k_{c}.code, u_{c}.u) AS INTEGER) AS {c}" for c in _FIT)
    + f" FROM fe {_fit_joins}"))

_PREP_NUM = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal",
             "total_rev_hi_lim", "payment_to_income", "credit_utilization", "credit_age_months",
             "loan_to_income"]
_PREP_CAT = ["term", "emp_length", "purpose", "home_ownership", "emp_length_numeric", "term_months"]
_p_ctes, _p_joins = _fitted("splitted", _PREP_CAT, "id, split, delinq_90dpd", _PREP_NUM)
ORACLE["prepared"] = sql(
    *loans_clean(), LABELLED, SPLIT,
    "pmed AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _PREP_NUM)
    + " FROM splitted WHERE split = 'train')", _p_ctes, final=(
        "SELECT fe.id, fe.split, fe.delinq_90dpd, "
        + ", ".join(f"{round6(f'coalesce(fe.{c}, m_{c})')} AS {c}" for c in _PREP_NUM) + ", "
        + ", ".join(f"CAST(coalesce(k_{c}.code, u_{c}.u) AS INTEGER) AS {c}" for c in _PREP_CAT)
        + f" FROM fe {_p_joins} JOIN pmed ON TRUE"))

# --- profiling -------------------------------------------------------------------------------------

_PROF_COLS = [("id", "bigint"), ("member_id", "bigint"), ("loan_amnt", "double"), ("installment", "double"),
              ("annual_inc", "double"), ("int_rate", "double"), ("revol_util", "double"), ("term", "string"),
              ("emp_length", "string"), ("issue_d", "date"), ("earliest_cr_line", "date"),
              ("loan_status", "string"), ("purpose", "string"), ("addr_state", "string"),
              ("home_ownership", "string"), ("dti", "double"), ("revol_bal", "double"),
              ("total_rev_hi_lim", "double"), ("payment_to_income", "double"),
              ("credit_utilization", "double"), ("credit_age_months", "double"),
              ("loan_to_income", "double"), ("emp_length_numeric", "double"), ("term_months", "double")]
_PROF_DICT = _DICT


def _prof_row(c: str, t: str) -> str:
    num = t in ("bigint", "double")
    stats = (f"avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std, "
             f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max") if num else (
        "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, "
        "CAST(NULL AS DOUBLE) AS max")
    return (f"SELECT '{c}' AS feature_name, '{t}' AS dtype, {str(num).upper()} AS is_numeric, "
            f"count(*) - count({c}) AS missing_count, (count(*) - count({c})) * 100.0 / count(*) AS missing_pct, "
            f"count(DISTINCT {c}) AS unique_values, {stats} FROM labelled")


PROFILE = ("prof0 AS (" + " UNION ALL ".join(_prof_row(c, t) for c, t in _PROF_COLS) + "),\n" + _PROF_DICT
           + ",\nprof AS (SELECT p.*, coalesce(d.description, 'No description available') AS description "
             "FROM prof0 p LEFT JOIN dict d ON p.feature_name = d.feature)")
ORACLE["feature_profile"] = sql(*loans_clean(), LABELLED, PROFILE, final=(
    "SELECT feature_name, dtype, is_numeric, missing_count, " + r6("missing_pct")
    + ", unique_values, description, " + r6("mean", "std", "min", "max") + " FROM prof"))
_TXT = [c for c, t in _PROF_COLS if t in ("string", "date")]
ORACLE["top_values"] = sql(*loans_clean(), LABELLED, "tv AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM labelled" for c in _TXT) + "),\n"
    "tc AS (SELECT feature, value, count(*) AS count FROM tv WHERE value IS NOT NULL GROUP BY feature, value)",
    final=("SELECT feature, value, count, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
           "(PARTITION BY feature ORDER BY count DESC, value) AS rank FROM tc) WHERE rank <= 3"))
MISSING = """
mr AS (SELECT feature_name, missing_count, missing_pct,
              row_number() OVER (ORDER BY missing_pct DESC, feature_name) AS rank FROM prof WHERE missing_pct > 0)"""
ORACLE["missing_report"] = sql(*loans_clean(), LABELLED, PROFILE, MISSING, final=(
    f"SELECT feature_name, missing_count, {r6('missing_pct')}, CAST(rank AS INTEGER) AS rank FROM mr"))
ORACLE["top_missing"] = sql(*loans_clean(), LABELLED, PROFILE, MISSING, final=(
    f"SELECT feature_name, missing_count, {r6('missing_pct')}, CAST(rank AS INTEGER) AS rank FROM mr WHERE rank <= 5"))
ORACLE["profile_summary"] = sql(*loans_clean(), LABELLED, PROFILE, final=(
    "SELECT count(*) AS n_features, count(*) FILTER (WHERE missing_pct > 0) AS n_with_missing, "
    "count(*) FILTER (WHERE is_numeric) AS n_numeric, count(*) FILTER (WHERE NOT is_numeric) AS n_categorical "
    "FROM prof"))


_MONO = {"dti": 1, "annual_inc": -1, "int_rate": 1, "revol_util": 1, "payment_to_income": 1,
         "loan_to_income": 1, "credit_age_months": -1, "emp_length_numeric": -1}
ORACLE["monotonicity_audit"] = sql(*scored_clean(), "ml AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {d} AS direction, CAST({f} AS DOUBLE) AS value, score FROM eng WHERE {f} IS NOT NULL"
    for f, d in _MONO.items()) + "),\n"
    "mc AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM ml GROUP BY feature),\n"
    "mb AS (SELECT ml.feature, direction, score, (" + " + ".join(
        f"CASE WHEN value > q[{i}] THEN 1 ELSE 0 END" for i in range(1, 10)) + ") AS bin "
    "FROM ml JOIN mc ON ml.feature = mc.feature),\n"
    "mm AS (SELECT feature, bin, max(direction) AS direction, avg(score) AS ms FROM mb GROUP BY feature, bin),\n"
    "md AS (SELECT *, ms - lag(ms) OVER (PARTITION BY feature ORDER BY bin) AS d FROM mm)",
    final=("SELECT feature, CAST(max(direction) AS INTEGER) AS direction, count(*) AS n_bins, "
           "count(*) FILTER (WHERE d * direction < 0) AS violations, "
           + round6("count(*) FILTER (WHERE d * direction < 0) / (count(*) - 1)") + " AS violation_rate "
           "FROM md GROUP BY feature"))


ORACLE["run_log_best"] = sql(*scored_clean(), DRIFT_SRC, RANK_AUC,
                             _SIDE_AUC.format(n="r_", s="ref"), _SIDE_AUC.format(n="c_", s="cur"), """
rl AS (SELECT 'full' AS run_id, roc_auc AS value FROM auc
       UNION ALL SELECT 'recent', roc_auc FROM c_auc UNION ALL SELECT 'early', roc_auc FROM r_auc)""",
    final=(f"SELECT 'delinquency' AS experiment, run_id, {r6('value')}, "
           "CAST(row_number() OVER (ORDER BY value DESC, run_id) AS INTEGER) AS rank FROM rl"))


ORACLE["importance_display"] = sql(*scored_clean(), CONTRIB, GIMP, _DICT, final=(
    "SELECT CAST(rank AS INTEGER) AS rank, printf('%2d. %-25s (%6.3f) - %s...', rank, g.feature, importance, "
    "substr(coalesce(d.description, 'No description available'), 1, 50)) AS line "
    "FROM gimp g LEFT JOIN dict d ON g.feature = d.feature WHERE rank <= 15"))


_FP_TEXT = ["term", "emp_length", "loan_status", "purpose", "addr_state", "home_ownership"]
_FP_NUM = ["loan_amnt", "installment", "annual_inc", "int_rate", "revol_util", "dti", "revol_bal",
           "total_rev_hi_lim", "payment_to_income", "credit_utilization", "credit_age_months",
           "loan_to_income", "emp_length_numeric", "term_months"]
ORACLE["frame_prepared"] = sql(
    *loans_clean(), LABELLED, _codes("labelled", _FP_TEXT),
    "fmed AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _FP_NUM)
    + ", quantile_cont(CAST(year(issue_d) AS INTEGER), 0.5) AS m_issue_d_year, "
      "quantile_cont(CAST(month(issue_d) AS INTEGER), 0.5) AS m_issue_d_month FROM labelled)",
    final=("SELECT id, member_id, " + ", ".join(f"{round6(f'coalesce({c}, m_{c})')} AS {c}" for c in _FP_NUM)
           + ", " + ", ".join(f"coalesce(k_{c}.code, -1) AS {c}" for c in _FP_TEXT)
           + ", strftime(earliest_cr_line, '%Y-%m-%d') AS earliest_cr_line, delinq_90dpd, "
             "CAST(year(issue_d) AS INTEGER) AS issue_d_year, CAST(month(issue_d) AS INTEGER) AS issue_d_month "
             "FROM labelled JOIN fmed ON TRUE "
           + " ".join(f"LEFT JOIN k_{c} ON labelled.{c} = k_{c}.v" for c in _FP_TEXT)))


# --- samples, folds, calibration, the evaluation chain ----------------------------------------------

ORACLE["seeded_sample"] = sql("s AS (SELECT id, label, score FROM scored)", final=(
    "SELECT id, label, score FROM s ORDER BY md5(CAST(id AS VARCHAR) || '/42'), id LIMIT 100"))
ORACLE["stratified_folds"] = sql("s AS (SELECT id, label FROM scored)", final=(
    "SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR) || '/42'), id) - 1) % 3 "
    "AS INTEGER) AS fold FROM s"))
# greatest mean of a range that ends at or after the score, over the smallest that begin before it


def _isotonic(score: str) -> str:
    return sql(f"""
g AS (SELECT {score} AS score, sum(1.0 - label) AS y, count(*) AS w FROM scored GROUP BY 1),
c AS (SELECT score, row_number() OVER (ORDER BY score) AS k, sum(y) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cy,
             sum(w) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cw, y, w FROM g),
m AS (SELECT a.k AS i, b.k AS j, (b.cy - a.cy + a.y) / (b.cw - a.cw + a.w) AS mean FROM c a JOIN c b ON a.k <= b.k),
lo AS (SELECT i, j, min(mean) OVER (PARTITION BY i ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mean FROM m),
iso AS (SELECT j AS k, max(mean) AS calibrated FROM lo GROUP BY j)""", final=(
    f"SELECT {r6('score', 'calibrated')} FROM c JOIN iso ON c.k = iso.k"))


ORACLE["isotonic_points"] = _isotonic("floor(score * 100) / 100")
ORACLE["isotonic_fine"] = _isotonic("score + (id % 3) / 10000.0::DOUBLE")
_CHAIN = list(_COEFS)
ORACLE["evaluation_chain"] = sql(*scored_clean(), "good AS (SELECT * FROM eng WHERE label IS NOT NULL AND "
    + " AND ".join(f"{c} IS NOT NULL" for c in _CHAIN) + ")",
    "ps AS (SELECT label, 1.0 / (1.0 + exp(-(-1.0 + " + " + ".join(f"{_lit(b)} * {c}" for c, b in _COEFS.items())
    + "))) AS score FROM good)", """
cf AS (SELECT count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
              count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM ps)""",
    final=("SELECT tn, fp, fn, tp, " + r6("accuracy", "precision", "recall", "specificity", "f1_score") + ", n_removed FROM ("
           "SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, "
           "coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, "
           "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score, "
           "(SELECT count(*) FROM eng) - (SELECT count(*) FROM good) AS n_removed FROM cf)"))

# what the trees must obey: no step against a direction on any test row
ORACLE["tree_directions"] = sql(*loans_clean(), LABELLED, SPLIT, final=(
    "SELECT v.variant, d.feature, d.direction, t.n_rows, CAST(0 AS BIGINT) AS violations "
    "FROM (VALUES ('leafwise'), ('depthwise')) v(variant), "
    f"(VALUES {', '.join(f"('{f}', {d})" for f, d in DIRECTIONS.items() if f not in ('delinq_2yrs', 'inq_last_6mths'))}) d(feature, direction), "
    "(SELECT count(*) AS n_rows FROM splitted WHERE split = 'test') t"))

ORACLE["run_log_replayed"] = ORACLE["run_log_best"]
ORACLE["importance_logged"] = ORACLE["importance_topk"]
ORACLE["csv_round_trip"] = sql(final=f"""
SELECT id, {r6("loan_amnt")}, int_rate, term, emp_length,
  CASE WHEN id % 50 = 0 THEN 'said "no",' || chr(10) || 'then ' || purpose WHEN id % 7 = 0 THEN 'a "quoted", ' || purpose END AS note,
  CASE WHEN id % 3 = 0 THEN 'test' ELSE 'train' END AS split
FROM loans""")
ORACLE["model_card_json"] = ORACLE["model_card"]
ORACLE["saved_models"] = sql(*loans_clean(), LABELLED, SPLIT, final=(
    "SELECT model, count(*) AS n_rows, count(*) AS n_equal FROM splitted, (VALUES ('trees'), ('lr')) m(model) WHERE split = 'test' GROUP BY model"))
ORACLE["dictionary_round_trip"] = """
SELECT p_name || '/' || p_partkey AS feature_name, 'type "' || p_type || '",' || chr(10) || 'brand ' || p_brand AS description
FROM part WHERE p_partkey % 11 <> 0"""
ORACLE["preview"] = sql(final=f"SELECT id, {r6('loan_amnt')}, purpose FROM loans ORDER BY loans.loan_amnt, id LIMIT 5")
