"""Feature selection, imputation and encoding.

Fitted state is a table, not a Python object: medians are ``(feature,
median)`` rows and category codes are ``(feature, category, code, n)`` rows.
Transform is a bounded map plus at most one join against that state, so fit and
transform both scale with the data and the state can be written next to the model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.ordered import approx_quantiles, bracketed_quantiles
from riskframe.session import cut_lineage
from riskframe.schema import EXCLUDED_COLUMNS, FEATURES, ORIGINATION_FEATURES, TARGET

UNKNOWN = "Unknown"
CATEGORICAL_MAX_DISTINCT = 20


def origination_features(df: DataFrame, listed: Sequence[str] = ORIGINATION_FEATURES) -> list[str]:
    """Listed origination-time columns present in ``df``, first occurrence order."""
    seen, out = set(), []
    for c in listed:
        if c in df.columns and c not in seen:
            seen.add(c)
            out.append(c)
    return out


def origination_projection(df: DataFrame) -> DataFrame:
    """Only the origination-time columns (leakage guard by projection)."""
    return df.select(*origination_features(df))


def leakage_projection(df: DataFrame, target: str = TARGET,
                       excluded: Sequence[str] = EXCLUDED_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the target, identifiers and post-origination columns."""
    drop = [c for c in [target, *excluded] if c in df.columns and c not in keep]
    return df.drop(*drop)


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True,
                    rsd: float = 0.01) -> DataFrame:
    """``feature, n_distinct`` (NULLs not counted) via one long-form aggregation.

    A wide ``count(DISTINCT ..)`` per column expands every row once per column
    before a single shuffle; the long form (one per column type, values as they
    are) first combines ``(feature, value)`` map-side, then counts values per
    feature. ``exact=False`` uses mergeable
    HyperLogLog sketches instead (one partial aggregate per task, no value
    shuffle), relative error ``rsd``: the option for very wide or very
    high-cardinality tables.
    """
    if not exact:
        row = df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(f"d{i}") for i, c in enumerate(columns)])
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"d{i}").cast("long").alias("n_distinct"))
                          for i, c in enumerate(columns)])
        return row.select(F.explode(pairs).alias("_p")).select("_p.*")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    parts = []
    for kind in sorted({types[c] for c in columns}):
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("value"))
                          for i, c in enumerate(columns) if types[c] == kind])
        long = df.select(F.explode(pairs).alias("_p")).select("_p.i", "_p.value")
        parts.append(long.where(F.col("value").isNotNull()).distinct().groupBy("i").agg(F.count(F.lit(1)).alias("n_distinct")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = F.array(*[F.lit(c) for c in columns])
    return out.select(F.get(names, F.col("i")).alias("feature"), "n_distinct")


def categorical_columns(df: DataFrame, columns: Sequence[str],
                        max_distinct: int = CATEGORICAL_MAX_DISTINCT) -> list[str]:
    """The categorical ones of ``columns`` (see ``feature_kinds``) without
    counting every value: sketches settle all columns but those whose estimate
    is near the limit, and only these are counted exactly."""
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in columns if isinstance(types[c], T.StringType)]
    rest = [c for c in columns if c not in text]
    if not rest:
        return text
    row = df.agg(*[F.approx_count_distinct(F.col(c), 0.02).alias(f"d{i}") for i, c in enumerate(rest)]).first()
    few = {c for i, c in enumerate(rest) if row[i] < 0.7 * max_distinct}
    near = [c for i, c in enumerate(rest) if 0.7 * max_distinct <= row[i] < 1.5 * max_distinct]
    if near:
        few |= {r["feature"] for r in distinct_counts(df, near).where(F.col("n_distinct") < max_distinct).collect()}
    return [c for c in columns if c in text or c in few]


def feature_kinds(df: DataFrame, columns: Sequence[str] | None = None,
                  max_distinct: int = CATEGORICAL_MAX_DISTINCT, exact: bool = True) -> DataFrame:
    """``feature, dtype, n_distinct, kind``: categorical when the column is text
    or has fewer than ``max_distinct`` distinct values, else numeric (dates with
    many values included, as listed)."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    meta = df.sparkSession.createDataFrame(
        [(c, types[c].simpleString(), isinstance(types[c], T.StringType)) for c in columns],
        "feature string, dtype string, is_text boolean")
    counts = distinct_counts(df, columns, exact)
    k = meta.join(counts, "feature", "left").withColumn(
        "n_distinct", F.coalesce(F.col("n_distinct"), F.lit(0)).cast("long"))
    return k.select("feature", "dtype", "n_distinct", F.when(
        F.col("is_text") | (F.col("n_distinct") < max_distinct), "categorical")
        .otherwise("numeric").alias("kind"))


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no NULL (or NaN) in ``columns`` (all columns by default)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def complete_case_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: n_rows, n_complete, n_removed (one aggregation)."""
    cols = list(columns or df.columns)
    types = dict(df.dtypes)
    ok = None
    for c in cols:
        cond = F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            cond = cond & ~F.isnan(F.col(c))
        ok = cond if ok is None else ok & cond
    r = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_complete"))
    return r.withColumn("n_removed", F.col("n_rows") - F.col("n_complete"))


def split_features_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame | None]:
    """(features, target) projections; target is None when absent."""
    feats = df.drop(target) if target in df.columns else df
    return feats, (df.select(target) if target in df.columns else None)


def align_features(df: DataFrame, expected: Sequence[str] = FEATURES) -> DataFrame:
    """Model column order; missing columns become 0, extra columns are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(0).alias(c) for c in expected])


# --- imputation -------------------------------------------------------------------

def fit_medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Fitted state ``feature, median``: exact interpolated medians, NULLs ignored.

    Two scans for all columns (``bracketed_quantiles``); only the values close
    to a median are shuffled.
    """
    if exact:
        q = bracketed_quantiles(df, columns, [0.5])
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                          for c in columns])
        long = df.select(F.explode(pairs).alias("_p")).select("_p.feature", "_p.value")
        q = approx_quantiles(long, "value", [0.5], keys=["feature"])
    return q.select("feature", F.col("quantile").alias("median"))


def transform_medians(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULL (and NaN) numerics with their fitted median.

    The state (one row per feature, bounded by the schema) is read as one
    scalar-subquery map, so the transform is a projection, not a join.
    """
    sq = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    types = dict(df.dtypes)
    x = df.withColumn("_med", sq)
    fills = {}
    for c in columns:
        v = F.col(c)
        if types[c] in ("double", "float"):
            v = F.when(~F.isnan(v), v)
        fills[c] = F.coalesce(v, F.col("_med")[c].cast(types[c]))
    return x.withColumns(fills).drop("_med")


def fill_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categorical NULL -> 'Unknown' (values cast to text first)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in columns})


# --- label encoding ----------------------------------------------------------------

def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fitted state ``feature, category, code, n``: 0-based rank of each category
    among the column's sorted distinct text values (NULLs not coded), and its rows.

    Ranks come from bucketed running counts over ``(feature, category)``, so a
    high-cardinality text column is not ranked inside one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
                      for c in columns])
    cats = (df.select(F.explode(pairs).alias("_p")).select("_p.feature", "_p.category")
            .where(F.col("category").isNotNull()).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n")))
    ranked = _rank_text(cats)
    return ranked.select("feature", "category", (F.col("cum__one") - 1).cast("int").alias("code"), "n")


def _rank_text(cats: DataFrame) -> DataFrame:
    """Running count of categories per feature in binary string order.

    Categories are range-partitioned by sampled edges of ``(feature,
    category)``, so values that share a long prefix are split like any others;
    the range is kept with the row (checkpoint) and offsets make ranks exact.
    """
    x = cut_lineage(cats.repartitionByRange("feature", "category").withColumn("_bucket", F.spark_partition_id()))
    totals = x.groupBy("feature", "_bucket").agg(F.count(F.lit(1)).alias("_t"))
    wb = Window.partitionBy("feature").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("feature", "_bucket", F.coalesce(F.sum("_t").over(wb), F.lit(0)).alias("_o"))
    w = (Window.partitionBy("feature", "_bucket").orderBy("category")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (x.join(offsets, ["feature", "_bucket"], "inner")
            .withColumn("cum__one", F.count(F.lit(1)).over(w) + F.col("_o")).drop("_bucket", "_o"))


#: most frequent categories of a column that are looked up in a map instead of a join
HEAVY = 64


def lookup_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], default: Callable[[str], Column]) -> DataFrame:
    """Each column replaced by the code of its text, ``default(column)`` where it has none.

    The ``HEAVY`` most frequent categories of every column are one scalar-subquery map, so
    the values that would be hot join keys need no shuffle. The rare ones of all columns
    are joined at once: ``(row, feature, category)`` meets the fitted table, one row per
    row comes back. The wide table is exchanged once however many columns there are, and not at all
    when no column has more than ``HEAVY`` categories.
    """
    codes = codes.where(F.col("feature").isin(list(columns)))
    codes = codes if "n" in codes.columns else codes.withColumn("n", F.lit(1))
    first = Window.partitionBy("feature").orderBy(F.col("n").desc(), "category")
    heavy = (codes.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= HEAVY)
             .groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("category", "code"))).alias("_m"))
             .agg(F.map_from_entries(F.collect_list(F.struct("feature", "_m")))).scalar())
    # one row per column at most
    more = {r["feature"] for r in codes.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY).collect()}
    rare = [c for c in columns if c in more]
    text = lambda c: F.col(c).cast("string")
    common = lambda c: F.col("_heavy")[c][text(c)]
    x = df
    if rare:
        x = cut_lineage(x.withColumn("_row", F.monotonically_increasing_id()))     # both sides of the join read these numbers
        left = F.array_compact(F.array(*[F.when(text(c).isNotNull() & common(c).isNull(), F.struct(
            F.lit(c).alias("feature"), text(c).alias("category"))) for c in rare]))
        pairs = x.withColumn("_heavy", heavy).select("_row", F.explode(left).alias("_p")).select("_row", "_p.feature", "_p.category")
        found = (pairs.join(codes.select("feature", "category", "code"), ["feature", "category"]).groupBy("_row")
                 .agg(F.map_from_entries(F.collect_list(F.struct("feature", "code"))).alias("_rare")))      # one entry per column at most
        x = x.join(found, "_row", "left").drop("_row")
    x = x.withColumn("_heavy", heavy)
    x = x.withColumns({c: F.coalesce(common(c), *([F.col("_rare")[c]] if c in rare else []), default(c)).cast("int") for c in columns})
    return x.drop("_heavy", "_rare")


def transform_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str],
                    missing_code: int | None = -1) -> DataFrame:
    """Replace each categorical column by its code (``lookup_codes``). Unmatched -> ``missing_code``."""
    return lookup_codes(df, codes, columns, lambda c: F.lit(missing_code))


def frame_encode(df: DataFrame, columns: Sequence[str] | None = None, target: str = TARGET) -> DataFrame:
    """Per-frame label encoding of every text column (NULL -> -1)."""
    cols = list(columns) if columns is not None else [
        c for c, t in df.dtypes if t == "string" and c != target]
    if not cols:
        return df
    # the fitted table is read for the map, the counts and the join: fit once, keep it as a table
    return transform_codes(df, cut_lineage(fit_codes(df, cols)), cols, -1)


def fitted_encode(df: DataFrame, columns: Sequence[str], split_col: str = "split",
                  fit_split: str = "train") -> DataFrame:
    """Codes fitted on ``fit_split`` rows (after NULL -> 'Unknown'); in every
    split, values unseen in the fit split map to the code of 'Unknown', which is
    appended after the fitted categories when the fit split had none."""
    filled = fill_unknown(df, columns)
    # fitted once and kept as a table: the map, the counts and the join read it
    codes = cut_lineage(fit_codes(filled.where(F.col(split_col) == fit_split), columns))
    n_cat = codes.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("category") == UNKNOWN, F.col("code"))).alias("_unk"))
    unknown = n_cat.select("feature", F.coalesce("_unk", "_n").cast("int").alias("unknown_code"))
    # one scalar subquery for all columns: feature -> code of 'Unknown'
    umap = unknown.agg(F.map_from_entries(F.collect_list(F.struct("feature", "unknown_code")))).scalar()
    return lookup_codes(filled.withColumn("_umap", umap), codes, columns, lambda c: F.col("_umap")[F.lit(c)]).drop("_umap")


def in_set(df: DataFrame, column: str, members: DataFrame, member_col: str | None = None,
           keep: bool = True) -> DataFrame:
    """J3 with a table of members: ``left_semi`` keeps rows whose value is a
    member, ``left_anti`` (``keep=False``) the others. No row of ``df`` is
    duplicated, whatever the member table holds."""
    m = members.select(F.col(member_col or column).alias("_member")).distinct()
    return df.join(m, df[column] == m["_member"], "left_semi" if keep else "left_anti")
