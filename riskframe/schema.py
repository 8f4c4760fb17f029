"""Fixed values that must equal the reference's for identical results.

Everything in this module is a constant list or map stated as text, in the
order the reference states it.
"""

# --- fixed values: target -------------------------------------------------
TARGET = "delinq_90dpd"

# --- fixed values: loan status label (positive, then negative) -------------
POSITIVE_STATUSES = ["Late (31-120 days)", "Late (16-30 days)", "Default", "Charged Off"]
NEGATIVE_STATUSES = ["Current", "Fully Paid"]

# --- fixed values: cleaning ------------------------------------------------
PERCENT_COLUMNS = ["int_rate", "revol_util"]
MONTH_DATE_COLUMNS = ["issue_d", "earliest_cr_line", "last_pymnt_d", "next_pymnt_d",
                      "last_credit_pull_d"]
MONTH_DATE_FORMAT = "MMM-yyyy"

# --- fixed values: employment length map -----------------------------------
EMP_LENGTH_MAP = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}

# --- fixed values: temporal split defaults ----------------------------------
SPLIT_TRAIN_END = "2014-12-31"
SPLIT_VAL_END = "2015-12-31"
SPLIT_HORIZON = "2016-01-01"

# --- fixed values: origination-time features (as listed, repeats included) --
ORIGINATION_FEATURES = [
    "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
    "emp_title", "emp_length", "home_ownership", "annual_inc", "verification_status",
    "issue_d", "loan_status", "purpose", "title", "zip_code", "addr_state",
    "dti", "delinq_2yrs", "earliest_cr_line", "inq_last_6mths", "open_acc",
    "pub_rec", "revol_bal", "revol_util", "total_acc", "initial_list_status",
    "application_type", "mort_acc", "pub_rec_bankruptcies",
    "acc_open_past_24mths", "all_util", "inq_fi", "total_cu_tl",
    "inq_last_12m", "acc_now_delinq", "tot_coll_amt", "tot_cur_bal",
    "open_acc_6m", "open_act_il", "open_il_12m", "open_il_24m",
    "mths_since_rcnt_il", "total_bal_il", "il_util", "open_rv_12m",
    "open_rv_24m", "max_bal_bc", "all_util", "total_rev_hi_lim",
    "inq_fi", "total_cu_tl", "inq_last_12m",
]

# --- fixed values: leakage / identifier exclusions (target added at use) ----
EXCLUDED_COLUMNS = [
    "loan_status", "issue_d", "earliest_cr_line",
    "last_pymnt_d", "next_pymnt_d", "last_credit_pull_d",
    "id", "member_id", "url", "desc", "title", "zip_code",
    "emp_title", "addr_state",
]

# --- fixed values: default model feature list -------------------------------
FEATURES = [
    "sub_grade", "term", "home_ownership", "fico_range_low", "total_acc",
    "pub_rec", "revol_util", "annual_inc", "int_rate", "dti", "purpose",
    "mort_acc", "loan_amnt", "application_type", "installment",
    "verification_status", "pub_rec_bankruptcies", "addr_state",
    "initial_list_status", "fico_range_high", "revol_bal", "id",
    "open_acc", "emp_length", "time_to_earliest_cr_line",
    "issue_d_year", "issue_d_month",
]

# --- fixed values: monotone directions --------------------------------------
DIRECTIONS = {
    "dti": 1, "delinq_2yrs": 1, "inq_last_6mths": 1, "revol_util": 1,
    "annual_inc": -1, "payment_to_income": 1, "loan_to_income": 1,
    "credit_age_months": -1, "emp_length_numeric": -1, "int_rate": 1,
}

# --- fixed values: demographic proxies ---------------------------------------
INCOME_QUARTILE_LABELS = ["Low", "Medium-Low", "Medium-High", "High"]
HIGH_INCOME_STATES = ["CA", "NY", "CT", "MA", "NJ", "MD", "WA"]
STATE_LEVEL_LABELS = ["High", "Other"]
ESSENTIAL_PURPOSES = ["medical", "car", "home_improvement", "major_purchase"]
PURPOSE_TYPE_LABELS = ["Essential", "Discretionary"]
CREDIT_MATURITY_EDGES = [0, 60, 120, 240]          # right-closed, last bin open
CREDIT_MATURITY_LABELS = ["New", "Developing", "Established", "Mature"]
GROUPINGS = ["income_quartile", "state_income_level", "loan_purpose_type", "credit_maturity"]
GROUP_LABELS = {
    "income_quartile": INCOME_QUARTILE_LABELS,
    "state_income_level": STATE_LEVEL_LABELS,
    "loan_purpose_type": PURPOSE_TYPE_LABELS,
    "credit_maturity": CREDIT_MATURITY_LABELS,
}

# --- fixed values: fairness -------------------------------------------------
PARITY_METRICS = ["tpr", "tnr", "fpr", "ppv", "positive_rate", "mean_prediction"]
GAP_THRESHOLD = 0.1
SWEEP_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
MIN_AUC_GROUP_SIZE = 10

# --- fixed values: drift and monitoring ---------------------------------------
PSI_BINS = 10
PSI_EPSILON = 1e-6
PSI_DRIFT_THRESHOLD = 0.2
PERFORMANCE_DRIFT_THRESHOLD = 0.05

# --- fixed values: performance bands (strict lower bounds) --------------------
PERFORMANCE_BANDS = [(0.75, "Excellent"), (0.65, "Good"), (0.55, "Fair")]
PERFORMANCE_BAND_FLOOR = "Poor"
PERFORMANCE_ADVICE_CUT = 0.7

# --- fixed values: explanation ------------------------------------------------
HIGH_RISK_SCORE = 0.7
KEY_FEATURES = ["dti", "revol_util", "annual_inc", "int_rate"]
RISK_KEYWORDS = ["delinq", "dti", "revol_util", "pub_rec", "inq", "fico"]
COUNTERFACTUAL_DECREASE = 0.8
COUNTERFACTUAL_INCREASE = 1.2
NO_DESCRIPTION = "No description available"
