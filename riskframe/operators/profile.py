"""Feature profile, top values, missing-value report.

Counts, missing counts and numeric moments come from one wide aggregation
(a single scan, one result row, unpivoted afterwards); distinct counts from
the long form (``encode.distinct_counts``); top values from an exact
two-level top-k (top k inside hash buckets of the value, then top k of those
candidates), so no task ranks all distinct values of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.encode import distinct_counts
from riskframe.schema import NO_DESCRIPTION, TARGET

TOP_BUCKETS = 64


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def feature_profile(df: DataFrame, target: str = TARGET,
                    dictionary: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """One row per column except ``target``: ``feature_name, dtype, is_numeric,
    missing_count, missing_pct, unique_values, description, mean, std, min, max``
    (sample std; moments NULL for non-numeric columns)."""
    fields = [f for f in df.schema.fields if f.name != target]
    nums = {f.name for f in fields if _numeric(f.dataType)}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"c{i}"))
        if f.name in nums:
            d = c.cast("double")
            aggs += [F.avg(d).alias(f"a{i}"), F.stddev_samp(d).alias(f"s{i}"),
                     F.min(d).alias(f"m{i}"), F.max(d).alias(f"x{i}")]
    wide = df.agg(*aggs)
    none = F.lit(None).cast("double")
    rows = F.array(*[F.struct(
        F.lit(f.name).alias("feature_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
        F.lit(f.name in nums).alias("is_numeric"), (F.col("_n") - F.col(f"c{i}")).alias("missing_count"),
        (F.col(f"a{i}") if f.name in nums else none).alias("mean"),
        (F.col(f"s{i}") if f.name in nums else none).alias("std"),
        (F.col(f"m{i}") if f.name in nums else none).alias("min"),
        (F.col(f"x{i}") if f.name in nums else none).alias("max"))
        for i, f in enumerate(fields)])
    long = wide.select("_n", F.explode(rows).alias("_r")).select("_n", "_r.*")
    long = long.withColumn("missing_pct", F.col("missing_count") * 100.0 / F.col("_n")).drop("_n")
    uniq = distinct_counts(df, [f.name for f in fields], exact).withColumnRenamed("feature", "feature_name")
    out = long.join(uniq, "feature_name", "left").withColumn(
        "unique_values", F.coalesce(F.col("n_distinct"), F.lit(0)).cast("long")).drop("n_distinct")
    if dictionary is not None:
        d = dictionary.groupBy("feature").agg(F.min("description").alias("description"))
        out = out.join(d.withColumnRenamed("feature", "feature_name"), "feature_name", "left")
        out = out.withColumn("description", F.coalesce("description", F.lit(NO_DESCRIPTION)))
    else:
        out = out.withColumn("description", F.lit("Data dictionary not loaded"))
    return out.select("feature_name", "dtype", "is_numeric", "missing_count", "missing_pct",
                      "unique_values", "description", "mean", "std", "min", "max")


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 3,
               n_buckets: int = TOP_BUCKETS) -> DataFrame:
    """``feature, value, count, rank``: the ``k`` most frequent non-NULL values of
    each (non-numeric by default) column, ties by value."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if not _numeric(f.dataType)]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value"))
                      for c in columns])
    counts = (df.select(F.explode(pairs).alias("_p")).select("_p.feature", "_p.value")
              .where(F.col("value").isNotNull()).groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("count")))
    order = [F.col("count").desc(), F.col("value")]
    bucket = F.pmod(F.xxhash64("value"), F.lit(n_buckets))
    local = counts.withColumn("_b", bucket).withColumn(
        "_r", F.row_number().over(Window.partitionBy("feature", "_b").orderBy(*order)))
    cand = local.where(F.col("_r") <= k).drop("_b", "_r")
    return cand.withColumn("rank", F.row_number().over(Window.partitionBy("feature").orderBy(*order))) \
        .where(F.col("rank") <= k)


def missing_report(profile: DataFrame) -> DataFrame:
    """Features with missing values, most missing first (ties by name)."""
    return (profile.where(F.col("missing_pct") > 0)
            .select("feature_name", "missing_count", "missing_pct")
            .withColumn("rank", F.row_number().over(
                Window.orderBy(F.col("missing_pct").desc(), F.col("feature_name")))))


def top_missing(profile: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` features with the highest missing share."""
    return missing_report(profile).where(F.col("rank") <= n)


def profile_summary(profile: DataFrame) -> DataFrame:
    """One row: total, with-missing, numeric and categorical feature counts."""
    return profile.agg(F.count(F.lit(1)).alias("n_features"),
                       F.count_if(F.col("missing_pct") > 0).alias("n_with_missing"),
                       F.count_if(F.col("is_numeric")).alias("n_numeric"),
                       F.count_if(~F.col("is_numeric")).alias("n_categorical"))
