"""CSV scans in splits, and a run log that survives replays."""

import pytest
from pyspark.sql import functions as F

from riskframe.sources import files, sinks

SCHEMA = "id long, title string, dti double"


def _csv(path, rows):
    with open(path, "w", newline="") as f:
        f.write("id,title,dti\n" + "".join(f'{i},"{t}",{d}\n' for i, t, d in rows))


def test_files_without_quoted_line_breaks_are_split(spark, tmp_path):
    plain = [(i, f'he said ""hi"", line {i}', i / 2) for i in range(4000)]
    broken = [(10_000 + i, 'two\nlines, ""quoted"" ""\n""' if i % 3 else "one", 1.5) for i in range(50)]
    (tmp_path / "loans csv").mkdir()
    for name, rows in (("plain a.csv", plain), ("broken.csv", broken)):
        _csv(tmp_path / "loans csv" / name, rows)
    path = str(tmp_path / "loans csv")
    found = files.files_with_line_breaks(spark, path)
    assert {f.rsplit("/", 1)[1]: odd for f, odd in found.items()} == {"plain a.csv": False, "broken.csv": True}
    want = {(i, t.replace('""', '"'), float(d)) for i, t, d in plain + broken}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = files.load_raw_loans(spark, path, SCHEMA)
        assert df.rdd.getNumPartitions() > 5
        got = df.collect()
        assert len(got) == 4050 and {tuple(r) for r in got} == want
        tt = files.load_train_test(spark, path, str(tmp_path / "loans csv" / "broken.csv"), SCHEMA)
        assert tt.groupBy("split").count().collect() and tt.where("split = 'test'").count() == 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_replayed_and_unfinished_runs(spark, tmp_path):
    base = str(tmp_path / "log")
    row = lambda auc: spark.createDataFrame([(auc, 0.5)], "roc_auc double, pr_auc double")
    imp = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "feature string, importance double")
    sinks.log_run(spark, base, "1", "gbt", {"train": 3}, {"x": 1, "y": 2}, row(0.6), imp, run_id="007")
    sinks.log_run(spark, base, "1", "gbt", {"train": 4}, {"x": 1}, row(0.7), run_id="8")
    sinks.log_run(spark, base, "2", "gbt", {}, {"x": 1}, row(0.9), run_id="007")
    # the same run again: with another result, fewer parameters and no importances
    sinks.log_run(spark, base, "1", "gbt", {"train": 5}, {"x": 9}, row(0.65), run_id="007")
    read = lambda t: sorted(tuple(r) for r in sinks.read_run_log(spark, base, t).drop("ts").collect())
    assert read("runs") == [("1", "007", "gbt", 5, 0, 0, 0), ("1", "8", "gbt", 4, 0, 0, 0), ("2", "007", "gbt", 0, 0, 0, 0)]
    assert read("params") == [("1", "007", "x", "9"), ("1", "8", "x", "1"), ("2", "007", "x", "1")]
    assert ("1", "007", "roc_auc", 0.65) in read("metrics") and len(read("metrics")) == 6
    assert read("importance") == []          # the attempt that had them is not the complete one
    # an attempt that died before its row in runs
    sinks._write(spark.createDataFrame([("roc_auc", 1.0)], "name string, value double"), base, "metrics", "late", "1", "9")
    assert len(read("metrics")) == 6
    best = sinks.best_runs(sinks.read_run_log(spark, base, "metrics")).where("rank = 1").collect()
    assert {(r.experiment, r.run_id) for r in best} == {("1", "8"), ("2", "007")}
    sinks.write_importance_csv(imp, str(tmp_path / "imp"))
    assert [r.feature for r in spark.read.option("header", True).csv(str(tmp_path / "imp")).collect()] == ["b", "a"]


def test_sizes_of_the_written_frame(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 60, "train").when(F.col("id") < 90, "val").otherwise("test"))
    out, sizes = sinks.written_with_sizes(df)
    assert sizes == {"train": 60, "val": 30, "test": 10} and out.count() == 100
    assert sinks.written_with_sizes(df.limit(0))[1] == {"train": 0, "val": 0, "test": 0}
    with pytest.raises(Exception, match="split"):
        sinks.written_with_sizes(spark.range(3))
