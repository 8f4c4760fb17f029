"""Property checks (hypothesis) on small random frames; few examples, each a Spark job."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskframe.operators import curves, drift
from riskframe.operators.ordered import exact_quantiles

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=120),
       st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_equals_numpy(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_quantiles(df, "v", [p], n_buckets=8).first()["quantile"]
    assert got == pytest.approx(float(np.quantile(values, p)), abs=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=150))
def test_auc_bounds_and_symmetry(spark, rows):
    labels = {y for y, _ in rows}
    df = spark.createDataFrame([(y, s / 20.0) for y, s in rows], "label int, score double")
    auc = curves.roc_auc(df).first()["roc_auc"]
    if labels != {0, 1}:
        assert auc is None
        return
    neg = spark.createDataFrame([(y, -s / 20.0) for y, s in rows], "label int, score double")
    flipped = curves.roc_auc(neg).first()["roc_auc"]
    assert 0.0 <= auc <= 1.0
    assert auc + flipped == pytest.approx(1.0, abs=1e-12)


@SETTINGS
@given(st.lists(st.integers(0, 30), min_size=3, max_size=100), st.lists(st.integers(0, 30), min_size=1, max_size=100))
def test_psi_non_negative_and_zero_on_itself(spark, ref, cur):
    r = spark.createDataFrame([(float(v),) for v in ref], "x double")
    c = spark.createDataFrame([(float(v),) for v in cur], "x double")
    same = drift.psi_numeric(r, r, ["x"]).first()["psi"]
    assert same == pytest.approx(0.0, abs=1e-12)
    psi = drift.psi_numeric(r, c, ["x"]).first()["psi"]
    assert psi is None or psi >= -1e-12
