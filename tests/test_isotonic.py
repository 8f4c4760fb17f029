"""Isotonic fit by merged blocks against the max-min formula."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import isotonic


def _max_min(points):
    """Fitted value of every (score, total, weight), by the largest of the smallest means."""
    y, w = np.array([p[1] for p in points]), np.array([p[2] for p in points])
    cy, cw = np.concatenate([[0], np.cumsum(y)]), np.concatenate([[0], np.cumsum(w)])
    n = len(points)
    return [max(min((cy[j + 1] - cy[i]) / (cw[j + 1] - cw[i]) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


@pytest.mark.parametrize("limit", [isotonic.MAX_BLOCKS, 3])
def test_continuous_scores(spark, monkeypatch, limit):
    monkeypatch.setattr(isotonic, "MAX_BLOCKS", limit)       # 3: applied in several passes
    rng = np.random.default_rng(1)
    score = rng.random(400)
    rows = [(float(s), int(rng.random() < s), float(rng.integers(1, 4))) for s in score]
    df = spark.createDataFrame(rows, "score double, label int, w double").repartition(7)
    for weight in (None, "w"):
        fitted = isotonic.fit(df, weight=weight)
        points = sorted((s, y * (w if weight else 1), w if weight else 1.0) for s, y, w in rows)
        want = dict(zip([p[0] for p in points], _max_min(points)))
        got = fitted.transform(df).collect()
        assert len(got) == 400 and all(r.calibrated == pytest.approx(want[r.score], abs=1e-12) for r in got)
        assert 3 < fitted.n < 100
    ends = fitted.transform(spark.createDataFrame([(-9.0,), (9.0,), (None,), (float("nan"),)], "score double")).collect()
    assert [r.calibrated for r in ends] == [pytest.approx(min(want.values())), pytest.approx(max(want.values())), None, None]


def test_between_blocks_and_odd_tables(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.4, 1), (None, 1), (float("nan"), 0), (0.9, None)], "score double, label int")
    fitted = isotonic.fit(df)
    assert {(r.lo, r.hi, r.value) for r in fitted.blocks.collect()} == {(0.1, 0.2, 0.0), (0.4, 0.4, 1.0)}
    x = spark.createDataFrame([(0.15,), (0.3,), (0.25,)], "score double")
    assert [r.calibrated for r in fitted.transform(x).collect()] == pytest.approx([0.0, 0.5, 0.25])
    none = isotonic.fit(df.limit(0))
    assert none.n == 0 and none.transform(x).where("calibrated is not null").count() == 0
    # a hot score is one row, descending labels are one block
    hot = spark.range(1000).select(F.lit(0.5).alias("score"), (F.col("id") % 2).cast("int").alias("label"))
    assert [tuple(r) for r in isotonic.fit(hot).blocks.collect()] == [(0.5, 0.5, 0.5, 1000.0)]
    down = spark.range(300).select((F.col("id") / 300.0).alias("score"), (F.col("id") < 150).cast("int").alias("label"))
    assert isotonic.fit(down).n == 1
