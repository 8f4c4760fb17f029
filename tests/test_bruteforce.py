"""Brute-force comparisons for profile, top values, sampling, binning and formatting."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.functions.bins import equal_width_bin
from riskframe.functions.text import py_fixed
from riskframe.operators.explain import seeded_sample
from riskframe.operators.profile import feature_profile, top_values


def test_top_values_match_pandas_with_value_ties(spark):
    rng = np.random.default_rng(3)
    vals = [f"v{int(x)}" for x in rng.integers(0, 40, 2000)] + [None] * 30
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [(r["value"], r["count"]) for r in top_values(df, ["c"], k=3, n_buckets=7).orderBy("rank").collect()]
    vc = pd.Series([v for v in vals if v is not None]).value_counts()
    expect = sorted(vc.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert got == [(k, int(c)) for k, c in expect]


def test_seeded_sample_is_stable_under_repartition(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "id")
    a = {r["id"] for r in seeded_sample(df, 50).collect()}
    b = {r["id"] for r in seeded_sample(df.repartition(13), 50).collect()}
    assert a == b and len(a) == 50


def test_profile_moments_match_pandas(spark):
    rng = np.random.default_rng(4)
    x = [float(v) if i % 7 else None for i, v in enumerate(rng.normal(5, 2, 300))]
    s = [("abc"[i % 3] if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(list(zip(x, s)), "x double, s string")
    prof = {r["feature_name"]: r for r in feature_profile(df, target="none").collect()}
    px = pd.Series(x, dtype="float64")
    assert prof["x"]["missing_count"] == int(px.isna().sum())
    assert prof["x"]["mean"] == pytest.approx(px.mean())
    assert prof["x"]["std"] == pytest.approx(px.std())
    assert prof["x"]["unique_values"] == px.nunique()
    assert prof["s"]["unique_values"] == 3 and prof["s"]["mean"] is None
    assert prof["s"]["missing_pct"] == pytest.approx(pd.Series(s).isna().mean() * 100)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e4, 1e4, allow_nan=False), min_size=2, max_size=200))
def test_equal_width_bins_match_numpy_histogram(spark, vals):
    lo, hi = min(vals), max(vals)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    b = df.select(equal_width_bin(F.col("v"), F.lit(lo), F.lit(hi), 10).alias("b")).groupBy("b").count()
    got = {r["b"]: r["count"] for r in b.collect()}
    counts, _ = np.histogram(vals, bins=10, range=(lo, hi))
    assert [got.get(i, 0) for i in range(10)] == list(counts)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e7, 1e7, allow_nan=False), min_size=1, max_size=50), st.integers(0, 3))
def test_py_fixed_matches_python_format(spark, vals, d):
    vals = list(vals) + [-0.0, 0.0, -0.004, 2.5, -2.5, 6888.5]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    rows = df.select("v", py_fixed(F.col("v"), d).alias("a"), py_fixed(F.col("v"), d, True).alias("b")).collect()
    for r in rows:
        assert r["a"] == format(r["v"], f".{d}f")
        assert r["b"] == format(r["v"], f",.{d}f")
        assert not math.isnan(r["v"])
