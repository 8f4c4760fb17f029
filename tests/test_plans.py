"""End-to-end compositions on the smallest driver tables."""

import tempfile

from riskframe.plans import frames
from riskframe.plans.audit import audit
from riskframe.plans.training import train_and_evaluate

SF = "/root/testdata/sf0.001"


def test_train_and_evaluate_end_to_end(spark):
    out = train_and_evaluate(frames.split_loans(spark, SF), run_log=tempfile.mkdtemp(prefix="rf-log-"),
                             gbt_params={"n_estimators": 5})
    row = out["gbt"].first()
    assert row["n"] > 0 and (row["roc_auc"] is None or 0.0 <= row["roc_auc"] <= 1.0)
    lr = out["models"]["lr"].stages[-1].coefficients.toArray()
    feats = out["features"]
    from riskframe.schema import DIRECTIONS
    for f, c in zip(feats, lr):
        if DIRECTIONS.get(f, 0) > 0:
            assert c >= 0
        elif DIRECTIONS.get(f, 0) < 0:
            assert c <= 0
    assert out["importance"].count() == len(feats)


def test_audit_end_to_end(spark):
    ref, cur = frames.drift_pair(spark, SF)
    from riskframe.operators.clean import clean_loans
    from riskframe.operators.features import engineer_features
    from riskframe.sources import tables
    scored = engineer_features(clean_loans(tables.scored(spark, SF)))
    res = audit(scored, ref, cur, ["loan_amnt", "dti", "purpose"], "m", "1")
    g = res["governance"].first()
    assert g["groups_analyzed"] == 4 and len(g["action_items"]) >= 1
    assert res["group_metrics"].count() > 0 and res["drift"].count() == 3
