"""Ordered statistics and curves against brute force on small literal frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import curves
from riskframe.operators.ordered import exact_quantiles, running_sums


def _frame(spark, labels, scores, groups=None):
    rows = [(int(y), float(s), (groups[i] if groups else "g")) for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "label int, score double, grp string")


def brute_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def brute_pr_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    th = np.unique(s)[::-1]
    P = y.sum()
    pts = [(0.0, 1.0)]
    for t in th:
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        fp = (pred & (y == 0)).sum()
        pts.append((tp / P, tp / (tp + fp)))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(pts, pts[1:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_pr_auc_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.5 + y * 0.3, 2)      # many ties
    df = _frame(spark, y, s)
    assert curves.roc_auc(df).first()["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert curves.pr_auc(df).first()["pr_auc"] == pytest.approx(brute_pr_auc(y, s), abs=1e-12)


def test_ks_and_roc_points(spark):
    y = [0, 0, 1, 1, 0, 1, 1, 0]
    s = [0.1, 0.2, 0.2, 0.4, 0.5, 0.7, 0.9, 0.9]
    df = _frame(spark, y, s)
    ks = curves.ks_statistic(df).first()["ks_statistic"]
    best = max(np.mean([si >= t for si, yi in zip(s, y) if yi == 1]) -
               np.mean([si >= t for si, yi in zip(s, y) if yi == 0]) for t in set(s))
    assert ks == pytest.approx(max(best, 0.0))
    pts = curves.roc_points(df).orderBy(F.col("threshold").desc()).collect()
    assert pts[0]["threshold"] == float("inf") and pts[0]["fpr"] == 0 and pts[0]["tpr"] == 0
    assert pts[-1]["fpr"] == 1.0 and pts[-1]["tpr"] == 1.0


def test_single_class_auc_is_null(spark):
    df = _frame(spark, [1, 1, 1], [0.2, 0.5, 0.9])
    assert curves.roc_auc(df).first()["roc_auc"] is None


def test_running_sums_spread_over_buckets(spark):
    df = spark.range(0, 5000).select((F.col("id") % 997).alias("v"), F.lit(1).alias("n"))
    c = df.groupBy("v").agg(F.sum("n").alias("n"))
    out = {r["v"]: r["cum_n"] for r in running_sums(c, "v", ["n"], n_buckets=16).collect()}
    counts = np.bincount(np.arange(5000) % 997)
    assert all(out[v] == counts[: v + 1].sum() for v in range(997))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.lognormal(3, 1, 2001), 1)
    df = spark.createDataFrame([(float(v), "a" if i % 3 else "b") for i, v in enumerate(vals)], "v double, k string")
    q = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "v", [0.1, 0.25, 0.5, 0.99]).collect()}
    for p, expect in zip([0.1, 0.25, 0.5, 0.99], np.quantile(vals, [0.1, 0.25, 0.5, 0.99])):
        assert q[p] == pytest.approx(expect, rel=1e-12)
    by = {r["k"]: r["quantile"] for r in exact_quantiles(df, "v", [0.5], keys=["k"]).collect()}
    ks = np.array(["a" if i % 3 else "b" for i in range(len(vals))])
    assert by["b"] == pytest.approx(np.median(vals[ks == "b"]))


def test_calibration_bins_right_closed(spark):
    df = _frame(spark, [0, 1, 1, 0], [0.1, 0.1000001, 1.0, 0.0])
    b = {r["bin"]: r["n"] for r in curves.calibration_bins(df).collect()}
    assert b == {0: 2, 1: 1, 9: 1}


def test_approx_quantiles_close_to_exact(spark):
    from riskframe.operators.ordered import approx_quantiles
    df = spark.range(0, 20000).select((F.col("id") * 7 % 10007).cast("double").alias("v"))
    ex = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9]).collect()}
    ap = {r["prob"]: r["quantile"] for r in approx_quantiles(df, "v", [0.1, 0.5, 0.9]).collect()}
    for p in ex:
        assert abs(ap[p] - ex[p]) <= 10007 * 2e-3
