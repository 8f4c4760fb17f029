"""Sinks (S4-S7): run log tables, importance table, JSON reports, models.

The run log is four Parquet tables (``params``, ``metrics``, ``importance``, ``runs``)
partitioned by experiment and run. A run overwrites its own partitions only, so a
replayed run leaves one set of rows. ``runs`` is written last and names the attempt
that is complete; ``read_run_log`` shows rows of complete attempts only, so a run that
died half-way is not seen. The best or latest run is a window over the
experiment, not a tracking server.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

_KEYS = "attempt string, experiment string, run_id string"
TABLES = {
    "runs": "model_type string, train_size long, val_size long, test_size long, n_features long, ts timestamp, " + _KEYS,
    "params": "key string, value string, " + _KEYS,
    "metrics": "name string, value double, " + _KEYS,
    "importance": "feature string, importance double, " + _KEYS,
}


def _write(df: DataFrame, base: str, table: str, attempt: str, experiment: str, run_id: str) -> None:
    """Replaces the run's partition of a table, no other."""
    (df.withColumns({"attempt": F.lit(attempt), "experiment": F.lit(experiment), "run_id": F.lit(run_id)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("experiment", "run_id")
     .parquet(os.path.join(base, table)))


def log_run(spark: SparkSession, base: str, experiment: str, model_type: str,
            sizes: Mapping[str, int], params: Mapping[str, object], metrics: DataFrame,
            importance: DataFrame | None = None, run_id: str | None = None) -> str:
    """Write one run. ``metrics`` is a one-row table (e.g. ``metrics.evaluate``);
    its numeric columns become ``(name, value)`` rows. Writing a run id again
    replaces that run."""
    run_id, attempt = run_id or uuid.uuid4().hex, uuid.uuid4().hex
    if params:
        _write(spark.createDataFrame([(str(k), str(v)) for k, v in params.items()], "key string, value string"),
               base, "params", attempt, experiment, run_id)
    num = [f.name for f in metrics.schema.fields if f.dataType.typeName() in ("double", "float", "long", "integer")]
    long = metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                                              for c in num])).alias("_m")).select("_m.*")
    _write(long, base, "metrics", attempt, experiment, run_id)
    if importance is not None:
        _write(importance.select("feature", F.col("importance").cast("double").alias("importance")),
               base, "importance", attempt, experiment, run_id)
    row = (model_type, *[int(sizes.get(k, 0)) for k in ("train", "val", "test", "n_features")])
    runs = spark.createDataFrame([row], "model_type string, train_size long, val_size long, test_size long, n_features long")
    _write(runs.withColumn("ts", F.current_timestamp()), base, "runs", attempt, experiment, run_id)
    return run_id


def written_with_sizes(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, dict[str, int]]:
    """``df`` written to the shared checkpoint folder, and its rows per split counted from what was written.

    (``DataFrame.observe`` would count in the writing job, but in Spark 4.1.2 an observation leaves the
    session with a part that can't be serialised, and later jobs with Spark ML models fail.)"""
    out = cut_lineage(df)
    row = out.agg(*[F.count_if(F.col(split_col) == s).alias(s) for s in ("train", "val", "test")]).first()
    return out, {k: int(v or 0) for k, v in row.asDict().items()}


def best_runs(metrics: DataFrame, metric: str = "roc_auc", higher_is_better: bool = True) -> DataFrame:
    """``experiment, run_id, value, rank`` of each run on ``metric`` within its experiment."""
    order = F.col("value").desc() if higher_is_better else F.col("value").asc()
    m = metrics.where(F.col("name") == metric)
    return m.select("experiment", "run_id", "value", F.row_number().over(
        Window.partitionBy("experiment").orderBy(order, F.col("run_id"))).alias("rank"))


def read_run_log(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rows of a table of the log, of complete attempts only."""
    def rows(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(os.path.join(base, name))
    keys = ["experiment", "run_id", "attempt"]
    out = rows(table)
    if table != "runs":
        out = out.join(rows("runs").select(*keys), keys, "left_semi")
    return out.select(*keys[:2], *[c for c in out.columns if c not in keys])


def write_importance_csv(importance: DataFrame, path: str) -> None:
    """Importances as CSV in descending order (one row per feature, so one file)."""
    importance.orderBy(F.col("importance").desc(), "feature").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """One-row report (nested structs) as a JSON file, overwriting."""
    report.coalesce(1).write.mode("overwrite").json(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """``experiment, run_id, ts, model_type`` of the most recent run per experiment."""
    w = Window.partitionBy("experiment").orderBy(F.col("ts").desc(), F.col("run_id").desc())
    return (runs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select("experiment", "run_id", "ts", "model_type"))


def write_split_table(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Write a prepared table partitioned by split; readers that filter on the
    split read only that directory (partition pruning)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split of a table written by ``write_split_table``."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


def run_metrics_row(metrics: DataFrame, run_id: str, names=("roc_auc", "pr_auc")) -> DataFrame:
    """One logged run's metrics as one row (``roc_auc, pr_auc`` by default):
    the reference input of ``drift.performance_monitor``."""
    m = metrics.where(F.col("run_id") == run_id)
    return m.agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
