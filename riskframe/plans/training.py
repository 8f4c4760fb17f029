"""Fit-on-train preparation (E6) and the model-training composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import encode
from riskframe.schema import DIRECTIONS, EXCLUDED_COLUMNS, TARGET
from riskframe.session import written


def prepare(df: DataFrame, target: str = TARGET, split_col: str = "split",
            excluded: Sequence[str] = EXCLUDED_COLUMNS, keep: Sequence[str] = ("id",),
            fit_split: str = "train") -> tuple[DataFrame, DataFrame]:
    """Leakage drop, kinds from the fit split, train medians for numerics,
    'Unknown' + train codes for categoricals.

    Returns ``(prepared, metadata)``: the prepared frame keeps ``keep``
    columns, the split and the target; metadata is ``feature, kind, position,
    direction`` (monotone direction from the fixed table, 0 if none). The
    kinds (one per feature) are the only thing read back to the driver: they
    decide which columns get which transform. The columns of the prepared frame
    are written once: kinds, medians, codes and the result each scan them.
    """
    feats = [c for c in df.columns if c not in {*excluded, target, split_col, *keep}]
    cols = [c for c in keep if c in df.columns] + [split_col] + ([target] if target in df.columns else [])
    df = written(df.select(*cols, *feats))
    cats = encode.categorical_columns(df.where(F.col(split_col) == fit_split), feats)
    kind = {c: "categorical" if c in cats else "numeric" for c in feats}
    nums = [c for c in feats if kind[c] == "numeric"]
    x = df
    if nums:
        med = encode.fit_medians(df.where(F.col(split_col) == fit_split), nums)
        x = encode.transform_medians(x, med, nums)
    if cats:
        x = encode.fitted_encode(x, cats, split_col, fit_split)
    prepared = x.select(*cols, *feats)
    meta = df.sparkSession.createDataFrame(
        [(f, kind[f], i, DIRECTIONS.get(f, 0)) for i, f in enumerate(feats)],
        "feature string, kind string, position int, direction int")
    return prepared, meta


def model_inputs(prepared: DataFrame, meta_features: Sequence[str], target: str = TARGET,
                 categorical: Sequence[str] = ()) -> DataFrame:
    """Assembled, weighted model frame, checkpointed into the shared folder
    before the iterative fits (long lineage, many passes). ``categorical``: coded
    columns that trees split as categories."""
    from riskframe.operators.model import model_frame
    from riskframe.session import cut_lineage
    frame = model_frame(prepared, meta_features, target, categorical=categorical)
    return cut_lineage(frame).withMetadata("features", frame.schema["features"].metadata)


def prepare_frame(df: DataFrame, target: str = TARGET, date_col: str = "issue_d") -> DataFrame:
    """E5, the per-frame variant: date parts replace the date, every text column
    becomes its rank among the frame's sorted values (NULL -> -1), every numeric
    column's NULLs take the frame's own median; the target is left as is."""
    from riskframe.operators.clean import date_parts
    x = date_parts(df, date_col)
    text = [c for c, t in x.dtypes if t == "string" and c != target]
    x = encode.frame_encode(x, text, target)
    nums = [c for c, t in x.dtypes if c != target and t in ("double", "float", "int", "bigint", "smallint",
                                                              "tinyint") and c not in text]
    if nums:
        x = encode.transform_medians(x, encode.fit_medians(x, nums), nums)
    return x


def train_and_evaluate(split_df: DataFrame, target: str = TARGET, run_log: str | None = None,
                       experiment: str = "delinquency", gbt_params: dict | None = None,
                       calibration: str = "isotonic") -> dict:
    """Entry B wired end to end: prepare (fit on train) -> weighted boosted
    trees and sign-bounded logistic regression -> calibration of the tree
    scores on the validation split -> test evaluation -> run log.

    Returns the fitted models and the result tables (lazy DataFrames)."""
    from riskframe.operators import boosting, metrics, model
    from riskframe.sources import sinks
    split_df, sizes = sinks.written_with_sizes(split_df)
    prepared, meta = prepare(split_df, target)
    feats = [r["feature"] for r in meta.orderBy("position").collect()]      # one row per feature
    coded = [r["feature"] for r in meta.where("kind = 'categorical' and direction = 0").collect()]
    frame = model_inputs(prepared, feats, target, coded)
    directions = {r["feature"]: r["direction"] for r in meta.collect()}
    gbt = boosting.best(boosting.train(frame, feats, gbt_params, directions, coded))
    lr = model.train_monotone_lr(frame, feats, directions)
    holdout = frame.where(F.col("split") != "train")
    scored = model.score(gbt, holdout)
    cal = model.calibrate(scored.where(F.col("split") == "val"), calibration)
    test = model.apply_calibration(cal, scored.where(F.col("split") == "test"))
    results = {
        "gbt": metrics.evaluate(test),
        "gbt_calibrated": metrics.evaluate(test.select("label", F.col("calibrated").alias("score"))),
        "lr": metrics.evaluate(model.score(lr, frame.where(F.col("split") == "test"))),
        "importance": model.feature_importance(gbt, feats),
        "monotonicity": model.monotonicity_audit(
            model.score(gbt, frame.where(F.col("split") == "test")), feats),
    }
    if run_log:
        sizes["n_features"] = len(feats)
        tree_params = {**boosting.LEAFWISE, **(gbt_params or {}), "rounds": len(gbt.trees)}
        lr_params = {p.name: v for p, v in lr.stages[-1].extractParamMap().items()}
        for name, m, params in (("gbt", gbt, tree_params), ("lr", lr, lr_params)):
            sinks.log_run(split_df.sparkSession, run_log, experiment, name, sizes, params,
                          results[name], model.feature_importance(m, feats))
    return {"models": {"gbt": gbt, "lr": lr, "calibration": cal}, "features": feats, **results}
