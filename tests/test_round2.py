"""CSV dialect, NaN scores, bracketed quantiles, text ranks, drift types, explanation tables, folds."""

import gzip
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boosting, curves, drift, encode, explain, features, metrics, model, reports
from riskframe.operators.ordered import bracketed_quantiles
from riskframe.session import checkpoint_dir
from riskframe.sources import files

CSV = 'id,title,dti\n1,"line one\nline two",3.5\n2,"he said ""hi"", ok",4.5\n3,,\n4,"trailing, comma",0.5\n'
SCHEMA = "id int, title string, dti double"


@pytest.mark.parametrize("packed", [False, True])
def test_csv_records_like_pandas(spark, tmp_path, packed):
    path = str(tmp_path / ("loans.csv.gz" if packed else "loans.csv"))
    with (gzip.open if packed else open)(path, "wt") as f:
        f.write(CSV)
    want = pd.read_csv(path)
    frames = [files.load_raw_loans(spark, path, SCHEMA),
              files.load_train_test(spark, path, path, SCHEMA).where("split = 'test'").drop("split")]
    for df in frames:
        got = df.orderBy("id").toPandas()
        pd.testing.assert_frame_equal(got.fillna(-1), want.fillna(-1), check_dtype=False)


def test_csv_without_line_breaks_can_be_split(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as f:
        f.write('id,title,dti\n2,"he said ""hi"", ok",4.5\n')
    assert files.load_raw_loans(spark, path, SCHEMA, line_breaks=False).first().title == 'he said "hi", ok'


def test_nan_scores_are_left_out(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.1), (1, math.nan), (0, None)]
    df = spark.createDataFrame(rows, "label int, score double")
    kept = df.limit(3)
    assert metrics.brier_score(df).first()[0] == pytest.approx(metrics.brier_score(kept).first()[0])
    assert curves.roc_auc(df).first()[0] == 1.0
    m = metrics.classification_metrics(metrics.apply_threshold(df)).first()
    assert (m.tn, m.fp, m.fn, m.tp) == (1, 0, 0, 2)
    assert sum(r.n for r in curves.calibration_bins(df).collect()) == 3


def test_bracketed_quantiles_are_exact(spark):
    rng = np.random.default_rng(0)
    columns = {"few": [1.0, 2.0, 4.0], "one": [7.0], "ties": np.repeat([1.0, 2.0, 3.0], [5, 3000, 5]).tolist(),
               "wide": rng.normal(size=40_001).tolist(), "even": rng.integers(0, 50, 20_000).astype(float).tolist()}
    n = max(map(len, columns.values()))
    data = pd.DataFrame({c: v + [None] * (n - len(v)) for c, v in columns.items()})
    data["nothing"], data.loc[n - 1, "few"] = None, math.nan
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), ", ".join(f"{c} double" for c in data)).repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    for accuracy in (100, 10_000):
        got = {(r.feature, r.prob): r.quantile for r in bracketed_quantiles(df, list(data), probs, accuracy).collect()}
        assert set(got) == {(c, p) for c in columns for p in probs}
        for (c, p), q in got.items():
            assert q == pytest.approx(np.quantile(columns[c], p), abs=1e-12)


def test_bracketed_quantiles_shuffle_little(spark):
    df = spark.range(100_000).select(F.rand(3).alias("x"))
    margin, (lo, hi) = 3 / 10_000, df.agg(F.percentile_approx("x", [0.5 - 3 / 10_000, 0.5 + 3 / 10_000], 10_000)).first()[0]
    assert df.where(F.col("x").between(lo, hi)).count() < 10 * margin * 100_000


def test_text_ranks_with_a_common_prefix(spark):
    names = [f"https://example.org/loans/{i:05d}" for i in range(10_000)]
    df = spark.createDataFrame([(n, "a" if i % 2 else "b") for i, n in enumerate(names)], "url string, k string").repartition(5)
    codes = encode.fit_codes(df, ["url", "k"])
    got = {(r.feature, r.category): r.code for r in codes.collect()}
    assert got == {("url", n): i for i, n in enumerate(names)} | {("k", "a"): 0, ("k", "b"): 1}


def test_categorical_columns_equal_feature_kinds(spark):
    df = spark.range(2000).select(
        F.col("id").alias("many"), (F.col("id") % 19).alias("n19"), (F.col("id") % 20).alias("n20"),
        (F.col("id") % 25).alias("n25"), F.col("id").cast("string").alias("text"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day3"))
    kinds = {r.feature: r.kind for r in encode.feature_kinds(df).collect()}
    assert kinds == {"many": "numeric", "n19": "categorical", "n20": "numeric", "n25": "numeric",
                     "text": "categorical", "day": "numeric", "day3": "categorical"}
    assert encode.categorical_columns(df, df.columns) == [c for c in df.columns if kinds[c] == "categorical"]


def test_drift_of_no_feature_and_of_dates(spark):
    ref = spark.range(100).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
                                  (F.col("id") % 2 == 0).alias("b"), F.lit("x").alias("t"))
    assert drift.drift_metrics(ref, ref, ["absent"]).collect() == []
    assert drift.drift_metrics(ref, ref.drop("d"), ["d"]).collect() == []
    got = {r.feature: (r.kind, r.psi) for r in drift.drift_metrics(ref, ref.limit(50), ["d", "b", "t"]).collect()}
    assert got["t"] == ("categorical", pytest.approx(0)) and got["b"][0] == got["d"][0] == "numeric"
    assert got["d"][1] > 1


def test_drift_reads_each_side_twice(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(1000).select((F.col("id") % 7).cast("double").alias("a"), F.col("id").cast("double").alias("b"),
                             F.col("id").cast("string").alias("c")).write.parquet(path)
    df = spark.read.parquet(path).withColumn(drift.SIDE, F.col("a") > 3)
    out = drift.side_drift(df, ["a", "b", "c"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan parquet") <= 2


def test_stratified_folds_cover_each_class_evenly(spark):
    df = spark.range(3001).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    folds = model.stratified_folds(df, 3)
    n = {(r.label, r.fold): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    for label in (0, 1):
        sizes = [n[label, k] for k in range(3)]
        assert max(sizes) - min(sizes) <= 1
    assert {tuple(r) for r in folds.collect()} == {tuple(r) for r in model.stratified_folds(df.repartition(9), 3).collect()}


def test_weighted_isotonic_fit_is_the_plain_one(spark):
    rng = np.random.default_rng(5)
    score = np.round(rng.random(2000), 2)
    df = spark.createDataFrame([(float(s), float(rng.random() < s)) for s in score], "score double, label double")
    from pyspark.ml.regression import IsotonicRegression
    plain = IsotonicRegression(featuresCol="score", labelCol="label", predictionCol="p").fit(df).transform(df)
    ours = model.calibrate_isotonic(df).transform(df)
    a = {r.score: r.p for r in plain.collect()}
    assert all(r.calibrated == pytest.approx(a[r.score]) for r in ours.collect())


def test_explanation_report_carries_values(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    rng = np.random.default_rng(8)
    rows = [(i, *map(float, x), float(x[0] + x[1] > 0.2)) for i, x in enumerate(rng.normal(size=(300, 4)))]
    names = [f"f{i}" for i in range(2)] + ["dti", "int_rate"]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + ", label double")
    fit = LogisticRegression().fit(model.assemble(df, names))
    train, test = df.where("id < 150"), df.where("id >= 150")
    rep = explain.explanation_report(PipelineModel(stages=[fit]), test, names, sample_size=40, n_background=20,
                                     n_permutations=3, background=train)
    value = {(r.id, n): r[n] for r in test.collect() for n in names}
    contrib = rep["contributions"].collect()
    assert len(contrib) == 160 and all(r.value == value[r.id, r.feature] for r in contrib)
    assert rep["importance"].count() == 4
    assert all(r.value == value[r.id, r.feature] for r in rep["dependence"].collect()) and rep["dependence"].count() == 80
    risky = [r.id for r in rep["high_risk"].collect()]
    steps = rep["waterfalls"].collect()
    assert {r.id for r in steps} == set(risky[:3]) and risky
    for r in steps:
        if r.feature in names:
            assert r.value == value[r.id, r.feature]
    last = {r.id: r.cumulative for r in sorted(steps, key=lambda r: r.position)}
    full = {r.id: r.prediction for r in contrib}
    assert all(last[i] == pytest.approx(full[i], abs=1e-9) for i in last)


def test_dependence_rows_equal_pairs(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(-i), 1.0 * i) for i in range(50)], "id long, a double, b double, c double")
    coefs = {"a": 0.3, "b": -0.1, "c": 0.02}
    long = explain.linear_contributions(df, coefs, 0.1)
    rows = explain.linear_contribution_rows(df, coefs, 0.1)
    want = explain.dependence_pairs(long, ["a", "c"], interaction="b")
    got = explain.dependence_rows(rows, ["a", "c"], interaction="b")
    assert {tuple(r) for r in got.select(*want.columns).collect()} == {tuple(r) for r in want.collect()}


def test_importance_is_not_cut(spark):
    long = spark.createDataFrame([(1, f"f{i:02d}", float(i)) for i in range(30)], "id long, feature string, contribution double")
    assert explain.global_importance(long).count() == 30 and explain.global_importance(long, 20).count() == 20


def test_card_states_facts(spark):
    ov = spark.createDataFrame([("train", 10)], "split string, n_rows long")
    ev = spark.createDataFrame([(0.7,)], "roc_auc double")
    card = reports.model_card(ov, ev, ["dti", "annual_inc", "x"], "m", "1", estimator="trees", steps=["train medians"],
                              directions={"dti": 1, "annual_inc": -1}).first()
    assert card.technical_details.rising_features == ["dti"] and card.technical_details.falling_features == ["annual_inc"]
    assert card.model_details.estimator == "trees" and "Default" in card.label_statuses.positive


def test_quartiles_of_a_column_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "annual_inc double")
    assert [r.income_quartile for r in features.income_quartile(df).collect()] == [None, None]


def test_a_cluster_needs_a_shared_checkpoint_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None  # noqa: E704
    class Session:
        sparkContext = Context()
        class conf:
            @staticmethod
            def get(key, default=None): return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_best_round_waits_for_the_patience():
    aucs = [(1, 0.6), (2, 0.55), (3, 0.7), (4, 0.65), (5, 0.66), (6, 0.71)]
    assert boosting.best_round(aucs, patience=2) == 3
    assert boosting.best_round(aucs, patience=3) == 6
    assert boosting.best_round([(1, None)], patience=3) == 0


@pytest.mark.parametrize(("name", "variant"), [("gbt_scored", "LEAFWISE"), ("gbt_depthwise_scored", "DEPTHWISE"), ("model_importance", "LEAFWISE")])
def test_registered_trees_have_the_listed_parameters(spark, monkeypatch, name, variant):
    from riskframe.plans import catalog

    class Called(Exception):
        pass

    def fit(frame, feats, params, directions, coded, patience=boosting.PATIENCE):
        raise Called(params, directions, patience)
    monkeypatch.setattr(catalog, "_tree_frame", lambda spark, sf: (spark.range(1).withColumn("split", F.lit("test")), [], []))
    monkeypatch.setattr(boosting, "train", fit)
    with pytest.raises(Called) as e:
        catalog.QUERIES[name](spark, "nowhere")
    assert e.value.args == (getattr(boosting, variant), catalog.DIRECTIONS, 100) and e.value.args[0]["n_estimators"] == 1000
