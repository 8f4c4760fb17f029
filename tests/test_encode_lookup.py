"""Codes by a map of the frequent categories and one join for the rest."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import encode

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("xyz"), None if i % 17 == 0 else f"v{int(rng.paretovariate(0.6)) % 90}", f"k{rng.randrange(40)}",
             rng.choice(["", " ", "q", None]), "train" if i % 3 else "test") for i in range(900)]
    rows += [(900 + i, "new", "unseen", None, "ü", "test") for i in range(30)]
    return spark.createDataFrame(rows, "id long, a string, b string, c string, d string, split string").cache()


def _want(rows, fit_rows, fill, missing):
    out = {}
    for c in COLUMNS:
        cats = sorted({fill(r[c]) for r in fit_rows} - {None}, key=lambda v: v.encode())
        code = {v: i for i, v in enumerate(cats)}
        other = code.get("Unknown", len(cats)) if missing == "unknown" else missing
        for r in rows:
            out[r.id, c] = code.get(fill(r[c]), other)
    return out


@pytest.mark.parametrize("heavy", [encode.HEAVY, 2, 0])
def test_codes_do_not_depend_on_the_split(frame, monkeypatch, heavy):
    monkeypatch.setattr(encode, "HEAVY", heavy)
    rows = frame.collect()
    got = encode.frame_encode(frame, COLUMNS)
    assert got.columns == frame.columns
    want = _want(rows, rows, lambda v: v, -1)
    assert {(r.id, c): r[c] for r in got.collect() for c in COLUMNS} == want
    got = encode.fitted_encode(frame, COLUMNS)
    want = _want(rows, [r for r in rows if r.split == "train"], lambda v: "Unknown" if v is None else v, "unknown")
    assert {(r.id, c): r[c] for r in got.collect() for c in COLUMNS} == want
    assert got.count() == 930


def test_exchanges_do_not_grow_with_the_columns(frame, spark, monkeypatch):
    def exchanges(columns, heavy):
        monkeypatch.setattr(encode, "HEAVY", heavy)
        codes = encode.cut_lineage(encode.fit_codes(frame, columns))
        df = encode.lookup_codes(frame, codes, columns, lambda c: F.lit(-1))
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("hashpartitioning(_row"), plan.count("Join")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert exchanges(["b", "c"], 2) == exchanges(COLUMNS, 2) != (0, 0)
        assert exchanges(["a", "c", "d"], 64) == (0, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_features_and_target_are_split(frame):
    x, y = encode.split_features_target(frame.withColumn("y", F.lit(1)), "y")
    assert x.columns == frame.columns and y.columns == ["y"]
    x, y = encode.split_features_target(frame, "y")
    assert x.columns == frame.columns and y is None
