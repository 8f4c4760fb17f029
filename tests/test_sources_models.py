"""Scans, sinks, encoders, models, explanations and streaming on small inputs."""

import gzip
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import encode, explain, model
from riskframe.sources import files, sinks


def test_dictionary_csv_quirks(spark):
    d = tempfile.mkdtemp(prefix="rf-dict-")
    p = os.path.join(d, "dict.csv")
    with open(p, "wb") as f:
        f.write(b'LoanStatNew,Description\r\n'
                b'annual_inc,The self-reported annual income.\r\n'
                b'desc,"Loan description\r\nprovided by the borrower"\r\n'
                b'total_rev_hi_lim \xc2\xa0,Total revolving high credit\r\n'
                b',\r\n'
                b',"note without a name"\r\n')
    df = files.load_data_dictionary(spark, p)
    rows = {r["feature"]: r["description"] for r in df.collect()}
    assert set(rows) == {"annual_inc", "desc", "total_rev_hi_lim"}
    assert "borrower" in rows["desc"]


def test_train_test_and_gzip_scans(spark):
    d = tempfile.mkdtemp(prefix="rf-csv-")
    for name, rows in (("train.csv", "1,0.5\n2,0.7\n"), ("test.csv", "3,0.1\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write("id,x\n" + rows)
    tt = files.load_train_test(spark, os.path.join(d, "train.csv"), os.path.join(d, "test.csv"),
                               "id long, x double")
    assert {r["split"]: r["n"] for r in tt.groupBy("split").agg(F.count("*").alias("n")).collect()} == \
        {"train": 2, "test": 1}
    gz = os.path.join(d, "raw.csv.gz")
    with gzip.open(gz, "wt") as f:
        f.write("id,int_rate\n1,13.5%\n2,n/a\n")
    raw = files.load_raw_loans(spark, gz, "id long, int_rate string", partitions=2)
    assert raw.count() == 2 and raw.rdd.getNumPartitions() == 2


def test_run_log_and_json_sinks(spark):
    base = tempfile.mkdtemp(prefix="rf-runs-")
    m1 = spark.createDataFrame([(0.7, 0.8)], "roc_auc double, pr_auc double")
    m2 = spark.createDataFrame([(0.75, 0.7)], "roc_auc double, pr_auc double")
    sinks.log_run(spark, base, "exp", "gbt", {"train": 10}, {"maxDepth": 5}, m1, run_id="a")
    sinks.log_run(spark, base, "exp", "lr", {"train": 10}, {"regParam": 0.1}, m2, run_id="b")
    best = sinks.best_runs(sinks.read_run_log(spark, base, "metrics")).where("rank = 1").first()
    assert best["run_id"] == "b"
    sinks.write_json_report(m1.select(F.struct("roc_auc").alias("perf")), os.path.join(base, "card"))
    assert spark.read.json(os.path.join(base, "card")).first()["perf"]["roc_auc"] == 0.7


def test_fitted_encoding_unseen_and_unknown(spark):
    df = spark.createDataFrame([("train", "a"), ("train", "b"), ("test", "b"), ("test", "c"), ("test", None)],
                               "split string, cat string")
    out = {(r["split"], i): r["cat"] for i, r in enumerate(encode.fitted_encode(df, ["cat"]).collect())}
    codes = [r["cat"] for r in encode.fitted_encode(df, ["cat"]).orderBy("split", F.col("cat")).collect()]
    # train classes {a:0, b:1}; 'Unknown' appended as 2; unseen c and NULL -> 2
    assert sorted(codes) == [0, 1, 1, 2, 2]
    assert out


def test_frame_encoding_matches_sorted_codes(spark):
    vals = ["pear", "apple", None, "fig", "apple", "Zoo", "élan"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v string")
    got = {r["id"]: r["v"] for r in encode.frame_encode(df, ["v"]).collect()}
    cats = sorted({v for v in vals if v is not None})
    assert all(got[i] == (cats.index(v) if v is not None else -1) for i, v in enumerate(vals))


def _model_frame(spark, n=600):
    rng = np.random.default_rng(0)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    y = (x1 - 0.5 * x2 + rng.normal(scale=0.5, size=n) > 0).astype(int)
    split = np.where(np.arange(n) % 5 == 0, "val", "train")
    df = spark.createDataFrame([(int(i), float(a), float(b), int(c), str(s))
                                for i, a, b, c, s in zip(range(n), x1, x2, y, split)],
                               "id long, dti double, annual_inc double, y int, split string")
    return model.model_frame(df, ["dti", "annual_inc"], "y")


def test_bounded_lr_signs_and_isotonic(spark):
    frame = _model_frame(spark)
    m = model.train_monotone_lr(frame, ["dti", "annual_inc"], {"dti": -1, "annual_inc": 1})
    coef = m.stages[-1].coefficients.toArray()
    assert coef[0] <= 0 and coef[1] >= 0          # forced against the data's signs
    s = model.score(model.train_monotone_lr(frame, ["dti", "annual_inc"]), frame)
    iso = model.calibrate_isotonic(s.where("split = 'val'"))
    cal = iso.transform(s).select("score", "calibrated").orderBy("score").collect()
    c = [r["calibrated"] for r in cal]
    assert all(b >= a - 1e-12 for a, b in zip(c, c[1:]))
    sig = model.apply_sigmoid(model.calibrate_sigmoid(s.where("split = 'val'")), s)
    assert sig.agg(F.min("calibrated"), F.max("calibrated")).first()[0] >= 0.0


def test_stratified_folds_balanced(spark):
    frame = _model_frame(spark).where("split = 'train'")
    f = model.stratified_folds(frame, 3)
    counts = {(r["label"], r["fold"]): r["n"] for r in
              f.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
    for lab in (0.0, 1.0):
        n = [counts[(lab, k)] for k in range(3)]
        assert max(n) - min(n) <= 1


def test_permutation_contributions_add_up(spark):
    frame = _model_frame(spark)
    m = model.train_monotone_lr(frame, ["dti", "annual_inc"])
    wide = frame.select("id", "dti", "annual_inc")
    c = explain.permutation_contributions(m, wide.limit(20), wide, ["dti", "annual_inc"],
                                          n_permutations=4, n_background=10)
    per = c.groupBy("id").agg(F.sum("contribution").alias("s"), F.max("prediction").alias("p"),
                              F.max("base_value").alias("b")).collect()
    assert len(per) == 20
    assert all(abs(r["s"] - (r["p"] - r["b"])) < 1e-9 for r in per)


def test_linear_contributions_additive_and_counterfactual_rules(spark):
    df = spark.createDataFrame([(1, 10.0, 2.0), (2, -5.0, None), (3, 0.0, 8.0)], "id long, a double, b double")
    coefs = {"a": 0.5, "b": -1.0}
    c = explain.linear_contributions(df, coefs, 0.3)
    for r in c.groupBy("id").agg(F.sum("contribution").alias("s"), F.max("logit").alias("z"),
                                 F.max("base_value").alias("b")).collect():
        assert r["s"] == pytest.approx(r["z"] - r["b"])
    cf = explain.counterfactuals(c, coefs=coefs).collect()
    for r in cf:
        if r["shap_impact"] > 0:
            assert r["current_value"] > 0 and r["suggested_value"] == pytest.approx(r["current_value"] * 0.8)
        else:
            assert r["suggested_value"] == pytest.approx(r["current_value"] * 1.2)


def test_model_save_load(spark):
    frame = _model_frame(spark)
    m = model.train_monotone_lr(frame, ["dti", "annual_inc"])
    p = os.path.join(tempfile.mkdtemp(prefix="rf-model-"), "m")
    model.save_model(m, p)
    a = model.score(m, frame).agg(F.sum("score")).first()[0]
    b = model.score(model.load_model(p), frame).agg(F.sum("score")).first()[0]
    assert a == pytest.approx(b)


def test_monitor_stream(spark):
    from riskframe.streaming.monitor import monitor_stream
    d = tempfile.mkdtemp(prefix="rf-stream-")
    src = os.path.join(d, "in")
    rows = [(i, i % 2, (i % 10) / 10.0, float(i % 7)) for i in range(200)]
    spark.createDataFrame(rows, "id long, label int, score double, dti double").write.parquet(src)
    ref = spark.createDataFrame(rows, "id long, label int, score double, dti double")
    ref_m = spark.createDataFrame([(0.6, 0.6)], "roc_auc double, pr_auc double")
    stream = spark.readStream.schema("id long, label int, score double, dti double").parquet(src)
    q = monitor_stream(stream, ref, ref_m, ["dti"], os.path.join(d, "out"), os.path.join(d, "ckpt"),
                       trigger={"availableNow": True})
    q.awaitTermination(120)
    mon = spark.read.parquet(os.path.join(d, "out", "monitor")).first()
    assert mon["current_roc_auc"] is not None
    assert spark.read.parquet(os.path.join(d, "out", "drift")).first()["psi"] == pytest.approx(0.0)


def test_evaluate_model_and_display(spark):
    from riskframe.plans.evaluation import evaluate_model, importance_lines, preview
    frame = _model_frame(spark)
    m = model.train_monotone_lr(frame, ["dti", "annual_inc"])
    raw = frame.select("id", "dti", "annual_inc", F.col("label").cast("int").alias("y"))
    row = evaluate_model(m, raw, ["dti", "annual_inc"], "y").first()
    assert 0.5 < row["roc_auc"] <= 1.0 and row["n_removed"] == 0
    imp = spark.createDataFrame([("int_rate", 8.2854, 1, "Interest Rate on the loan")],
                                "feature string, importance double, rank int, description string")
    assert importance_lines(imp).first()["line"] == f"{1:2d}. {'int_rate':<25} ({8.2854:6.3f}) - Interest Rate on the loan..."
    assert [r["id"] for r in preview(raw, 3, ["id"]).collect()] == [0, 1, 2]


def test_dictionary_rename(spark):
    df = spark.createDataFrame([("a", "b")], "LoanStatNew string, Description string")
    assert files.rename_dictionary(df).columns == ["feature_name", "description"]


def test_row_form_matches_long_form(spark):
    rng = np.random.default_rng(11)
    rows = [(int(i), float(rng.normal()), float(rng.normal() * 3), float(abs(rng.normal())) if i % 4 else None)
            for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    coefs = {"a": 0.7, "b": -0.2, "c": 1.1}
    r = explain.linear_contribution_rows(df, coefs, -0.5)
    long = explain.linear_contributions(df, coefs, -0.5)
    cf_row = sorted((x["id"], x["suggestion_rank"], x["feature"], round(x["rescored_probability"], 12))
                    for x in explain.counterfactual_rows(r, coefs, max_changes=2).collect())
    cf_long = sorted((x["id"], x["suggestion_rank"], x["feature"], round(x["rescored_probability"], 12))
                     for x in explain.counterfactuals(long, max_changes=2, coefs=coefs).collect())
    assert cf_row == cf_long
    wf_row = sorted((x["id"], x["position"], x["feature"], round(x["cumulative"], 12))
                    for x in explain.waterfall_rows(r, max_display=3).collect())
    wf_long = sorted((x["id"], x["position"], x["feature"], round(x["cumulative"], 12))
                     for x in explain.waterfall(long, max_display=3).collect())
    assert wf_row == wf_long


def test_latest_run_and_set_membership(spark):
    base = tempfile.mkdtemp(prefix="rf-runs2-")
    m = spark.createDataFrame([(0.7,)], "roc_auc double")
    sinks.log_run(spark, base, "e", "gbt", {}, {}, m, run_id="r1")
    sinks.log_run(spark, base, "e", "lr", {}, {}, m, run_id="r2")
    runs = sinks.read_run_log(spark, base, "runs")
    assert sinks.latest_runs(runs).count() == 1
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    members = spark.createDataFrame([("a",), ("a",), ("c",)], "v string")
    assert sorted(r["v"] for r in encode.in_set(df, "v", members).collect()) == ["a", "c"]
    assert sorted(str(r["v"]) for r in encode.in_set(df, "v", members, keep=False).collect()) == ["None", "b"]


def test_calibrate_dispatch_and_best_params(spark):
    from pyspark.ml.classification import LogisticRegression
    frame = _model_frame(spark)
    s = model.score(model.train_monotone_lr(frame, ["dti", "annual_inc"]), frame)
    for method in ("isotonic", "sigmoid"):
        cal = model.calibrate(s.where("split = 'val'"), method)
        out = model.apply_calibration(cal, s)
        lo, hi = out.agg(F.min("calibrated"), F.max("calibrated")).first()
        assert 0.0 <= lo <= hi <= 1.0
    train = model.stratified_folds(frame.where("split = 'train'"), 3)
    est = LogisticRegression(featuresCol="features", labelCol="label", maxIter=20)
    cvm = model.cross_validate(train, est, {"regParam": [0.0, 10.0]}, parallelism=2)
    assert model.best_params(cvm) == {"regParam": 0.0}


def test_split_partitioned_table_prunes(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="rf-split-"), "t")
    df = spark.createDataFrame([(i, ("train", "val", "test")[i % 3]) for i in range(30)], "id int, split string")
    sinks.write_split_table(df, base)
    part = sinks.read_split(spark, base, "val")
    assert part.count() == 10
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "val" in plan


def test_score_falls_back_to_prediction(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import LinearRegression
    frame = _model_frame(spark)
    lr = LinearRegression(featuresCol="features", labelCol="label", maxIter=5).fit(frame)
    out = model.score(PipelineModel(stages=[lr]), frame)
    assert "score" in out.columns and "prediction" not in out.columns


def test_monitor_against_logged_run(spark):
    from riskframe.operators import drift
    base = tempfile.mkdtemp(prefix="rf-runs3-")
    sinks.log_run(spark, base, "e", "gbt", {}, {},
                  spark.createDataFrame([(0.9, 0.95)], "roc_auc double, pr_auc double"), run_id="best")
    ref = sinks.run_metrics_row(sinks.read_run_log(spark, base, "metrics"), "best")
    cur = spark.createDataFrame([(i % 2, (i % 10) / 10.0) for i in range(100)], "label int, score double")
    mon = drift.performance_monitor(cur, ref).first()
    assert mon["reference_roc_auc"] == pytest.approx(0.9)
    assert mon["auc_degradation"] == (abs(mon["current_roc_auc"] - 0.9) > 0.05)
