"""Driver contract: entry runs at sf0.001, catalog and oracle agree on names."""

import __spark_entry__ as entry

ROWS_ONLY = {"gbt_scored", "gbt_depthwise_scored", "bounded_lr_scored", "isotonic_calibrated",
             "sigmoid_calibrated", "model_importance", "cv_results", "permutation_contributions", "tree_grid",
             "tree_contributions",
             "explanation_report", "explanation_high_risk", "explanation_waterfalls", "explanation_dependence"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["grouping_var", "group_value"]


def own(names):
    """Names of this package's catalog (without those of the optional subpackage)."""
    return set(names) - set(entry.LLM_QUERIES)


def test_every_query_has_oracle_unless_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert own(q) - set(o) == ROWS_ONLY
    assert set(o) <= set(q)


def test_light_queries_run_at_smoke_scale(spark):
    q = entry.queries()
    for name in ("roc_points", "psi_all", "fairness_summary", "feature_profile", "counterfactuals"):
        assert q[name](spark, "/root/testdata/sf0.001").count() > 0


def test_every_sql_checked_query_runs_at_smoke_scale(spark):
    q = entry.queries()
    failures = []
    # those two fit trees over 100 rounds, which tests/test_boosting.py covers
    for name in sorted(own(q) - ROWS_ONLY - {"tree_directions", "saved_models"}):
        try:
            q[name](spark, "/root/testdata/sf0.001").count()
        except Exception as e:  # noqa: BLE001
            failures.append((name, str(e)[:200]))
    assert not failures, failures
