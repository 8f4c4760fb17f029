"""Evaluation compositions (A9-A11 with a model, O2/F9 display, O5 previews)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.text import py_fixed
from riskframe.operators import encode, metrics, model, profile
from riskframe.schema import TARGET


def evaluate_model(m: PipelineModel, df: DataFrame, features: Sequence[str], target: str = TARGET,
                   threshold: float = 0.5) -> DataFrame:
    """A10: complete cases only (report how many were removed), columns aligned
    to the model's list, scored, then the evaluation row."""
    report = encode.complete_case_report(df, [*features, target]).select("n_removed").scalar()
    clean = encode.complete_cases(df, [*features, target])
    aligned = encode.align_features(clean, [*features, target])
    scored = model.score(m, model.assemble(aligned, features).withColumn("label", F.col(target)))
    return metrics.evaluate(scored, "label", "score", threshold).withColumn("n_removed", report)


def _pad_left(s: Column, width: int) -> Column:
    return F.when(F.length(s) < width, F.lpad(s, width, " ")).otherwise(s)


def importance_lines(importance: DataFrame, n: int = 15, width: int = 50) -> DataFrame:
    """``rank, line`` as printed: rank, name padded to 25, importance
    with 3 decimals in 6 columns, description cut to ``width`` characters."""
    top = importance.where(F.col("rank") <= n)
    line = F.format_string("%2d. %-25s (%s) - %s...", F.col("rank"), F.col("feature"),
                           _pad_left(py_fixed(F.col("importance"), 3), 6),
                           F.substring(F.col("description"), 1, width))
    return top.select("rank", line.alias("line"))


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in an explicit order (a top-n, not a scan)."""
    return df.orderBy(*order).limit(n)


def evaluation_tables(m: PipelineModel, train: DataFrame, test: DataFrame, features: Sequence[str],
                      dictionary: DataFrame | None = None, target: str = TARGET) -> dict[str, DataFrame]:
    """Entry A of the reference as tables: test metrics, model importance with
    descriptions, feature profile of the training data, missing report."""
    imp = model.feature_importance(m, features)
    if dictionary is not None:
        from riskframe.operators.explain import describe_features
        imp = describe_features(imp, dictionary)
    prof = profile.feature_profile(train, target, dictionary)
    return {"metrics": metrics.performance_band(evaluate_model(m, test, features, target)),
            "importance": imp, "profile": prof, "missing": profile.missing_report(prof),
            "summary": profile.profile_summary(prof)}
