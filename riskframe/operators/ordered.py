"""Exact ordered statistics without a single-task global window.

A window ``ORDER BY v`` with no partition key runs in one task. Here the
ordered value is first cut into value buckets (approximate quantile edges,
so buckets hold similar numbers of distinct values), the per-bucket totals
(at most ``keys x n_buckets`` rows) give exclusive offsets, and the running
sum inside each ``(keys, bucket)`` partition plus its offset is the exact
global running sum. A hot key is spread over many buckets, so no task holds
more than roughly ``distinct values / n_buckets`` rows of it.

Inputs must already hold one row per ``(keys, value)``: callers aggregate
by value first (map-side combined), which also removes heavy single values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

DEFAULT_BUCKETS = 1024
EDGE_ACCURACY = 10000


def _edges(df: DataFrame, value: str, n_buckets: int) -> Column:
    """Global approximate quantile edges of the distinct values (one scalar
    subquery, ``n_buckets - 1`` numbers). Per-key partitions reuse the global
    edges: a (key, bucket) partition is a subset of its global bucket, so it
    is bounded by about ``distinct values / n_buckets`` rows for every key."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    return df.agg(F.percentile_approx(F.col(value), probs, EDGE_ACCURACY).alias("_edges")).scalar()


def with_bucket(df: DataFrame, value: str, keys: Sequence[str] = (),
                n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``_bucket``: the number of edges strictly below the value (monotone).

    Two-level lookup in generated code, no per-row lambda: with blocks of
    ``b = ceil(sqrt(n_buckets))`` edges, the coarse step counts the block
    boundaries (every b-th edge) below the value, the fine step counts the
    edges below it inside that one block: about ``2 * sqrt(n_buckets)`` flat
    comparisons. The edges array (one scalar subquery) is projected once.
    ``keys`` need no edges of their own: each (key, bucket) is a subset of
    its global bucket.
    """
    x = df.withColumn("_edges", _edges(df, value, n_buckets))
    v, edges = F.col(value), F.col("_edges")
    n_edges = n_buckets - 1
    block = max(1, math.isqrt(n_buckets - 1) + 1)
    coarse = F.lit(0)
    for b in range(1, n_edges // block + 1):
        coarse = coarse + F.when(F.try_element_at(edges, F.lit(b * block)) < v, 1).otherwise(0)
    x = x.withColumn("_c", coarse)
    fine = F.lit(0)
    for k in range(1, block):
        below = F.try_element_at(edges, F.col("_c") * block + k) < v
        fine = fine + F.when(F.coalesce(below, F.lit(False)), 1).otherwise(0)
    return x.withColumn("_bucket", F.col("_c") * block + fine).drop("_edges", "_c")


def running_sums(df: DataFrame, value: str, measures: Sequence[str],
                 keys: Sequence[str] = (), descending: bool = False,
                 n_buckets: int = DEFAULT_BUCKETS, prefix: str = "cum_",
                 keep_bucket: bool = False, totals: bool = False,
                 materialize: bool = True) -> DataFrame:
    """Inclusive running sums of ``measures`` over ``value`` order within ``keys``.

    ``df`` has one row per ``(keys, value)``. Adds ``{prefix}{m}`` columns, and
    with ``totals`` also ``total_{m}`` (the sum over the whole key), read off the
    same small offsets window instead of a separate aggregation and join.
    """
    keys = list(keys)
    if materialize:
        # the distinct-value table feeds the edges subquery and the sums; write
        # it once to the shared checkpoint folder instead of computing it twice
        df = cut_lineage(df)
    x = with_bucket(df, value, keys, n_buckets)
    t = x.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    border = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    wb = Window.partitionBy(*keys).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(f"_t_{m}").over(wb), F.lit(0)).alias(f"_o_{m}") for m in measures]
    if totals:
        wk = Window.partitionBy(*keys)
        cols += [F.sum(f"_t_{m}").over(wk).alias(f"total_{m}") for m in measures]
    offsets = t.select(*keys, "_bucket", *cols)
    vorder = F.col(value).desc() if descending else F.col(value).asc()
    w = (Window.partitionBy(*keys, "_bucket").orderBy(vorder)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = x.join(offsets, [*keys, "_bucket"], "inner")
    out = out.withColumns({f"{prefix}{m}": F.sum(m).over(w) + F.col(f"_o_{m}") for m in measures})
    out = out.drop(*[f"_o_{m}" for m in measures])
    return out if keep_bucket else out.drop("_bucket")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    keys: Sequence[str] = (), n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` (nulls ignored) per ``keys``.

    Returns ``keys..., prob, quantile``: position ``h = (n-1)p``, result
    ``v[floor h] + (h - floor h)(v[ceil h] - v[floor h])`` over sorted values.
    Distributed: value counts, bucketed running counts, then each target
    rank picks the one distinct value whose count interval covers it.
    """
    keys = list(keys)
    keep = F.col(value).isNotNull()
    if dict(df.dtypes).get(value) in ("double", "float"):
        keep = keep & ~F.isnan(F.col(value))
    counts = df.where(keep).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    x = running_sums(counts, value, ["_n"], keys, n_buckets=n_buckets, totals=True)
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    # per row (of its key): target ranks (0-based) of the lower and upper neighbour of each prob
    n1 = F.col("total__n") - 1
    x = x.withColumn("_targets", F.transform(prob_arr, lambda p: F.struct(
        p.alias("prob"), F.floor(n1 * p).alias("lo"), F.ceil(n1 * p).alias("hi"),
        (n1 * p - F.floor(n1 * p)).alias("frac"))))
    tcol = F.col("_targets")
    before = F.col("cum__n") - F.col("_n")
    hit_structs = []
    for j in range(1, len(probs) + 1):
        t = F.element_at(tcol, j)
        for kind in ("lo", "hi"):
            inside = (t[kind] >= before) & (t[kind] < F.col("cum__n"))
            hit_structs.append(F.when(inside, F.struct(
                t["prob"].alias("prob"), t["frac"].alias("frac"), F.lit(kind).alias("kind"))))
    hits = x.select(*keys, F.col(value).alias("_v"),
                    F.explode(F.array_compact(F.array(*hit_structs))).alias("_t"))
    picked = hits.select(
        *keys, F.col("_t.prob").alias("prob"), F.col("_t.frac").alias("_frac"),
        F.when(F.col("_t.kind") == "lo", F.col("_v")).alias("_lo"),
        F.when(F.col("_t.kind") == "hi", F.col("_v")).alias("_hi"))
    res = picked.groupBy(*keys, "prob").agg(
        F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_frac").alias("_frac"))
    return res.select(*keys, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac"))
                      .alias("quantile"))


def bracketed_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                        accuracy: int = EDGE_ACCURACY) -> DataFrame:
    """Exact linear-interpolated quantiles of several columns in two scans.

    Returns ``feature, prob, quantile`` (NULL and NaN ignored; a column without
    values has no rows). The first scan brackets every target rank with
    mergeable quantile sketches (rank error 1 / ``accuracy``). The second
    counts the values between brackets as one row each, and only the few
    values inside a bracket one by one; both are combined before the shuffle,
    which therefore carries about ``6 / accuracy`` of the distinct values. The
    running counts of that small table then pick the exact ones; a rank that
    falls next to a bracket is the smallest or largest value counted there.
    """
    columns = list(columns)

    def valid(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)
    margin = 3.0 / accuracy
    around = [q for p in probs for q in (max(0.0, p - margin), min(1.0, p + margin))]
    # columns x probs x 2 numbers: the plan of the second scan
    sketch = df.agg(*[F.percentile_approx(valid(c), around, accuracy).alias(f"e{i}")
                      for i, c in enumerate(columns)]).first()
    cells = []
    for i, c in enumerate(columns):
        if sketch[i] is None:
            continue
        v, cell, inside = valid(c), F.lit(0), F.lit(False)
        for lo, hi in sorted(set(zip(sketch[i][0::2], sketch[i][1::2], strict=True))):
            cell = cell + F.when(v >= F.lit(lo), 1).otherwise(0) + F.when(v > F.lit(hi), 1).otherwise(0)
            inside = inside | v.between(F.lit(lo), F.lit(hi))
        cells.append(F.struct(F.lit(c).alias("feature"), v.alias("value"), cell.alias("cell"), inside.alias("inside")))
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, prob double, quantile double")
    long = df.select(F.explode(F.array(*cells)).alias("_p")).select("_p.*").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", F.when(~F.col("inside"), F.col("cell")).alias("_cell"),
                          F.when(F.col("inside"), F.col("value")).alias("_val")).agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    x = running_sums(counts.drop("_cell", "_val"), "_lo", ["_n"], ["feature"], totals=True)
    before, n1 = F.col("cum__n") - F.col("_n"), F.col("total__n") - 1
    hits = []
    for p in probs:
        p = F.lit(float(p))
        for kind, target in (("lo", F.floor(n1 * p)), ("hi", F.ceil(n1 * p))):
            value = F.when(target == before, F.col("_lo")).when(target == F.col("cum__n") - 1, F.col("_hi")).when(
                F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
                F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
            hits.append(F.when((target >= before) & (target < F.col("cum__n")), F.struct(
                p.alias("prob"), (n1 * p - F.floor(n1 * p)).alias("frac"), F.lit(kind).alias("kind"), value.alias("value"))))
    picked = x.select("feature", F.explode(F.array_compact(F.array(*hits))).alias("_t")).select("feature", "_t.*")
    both = picked.groupBy("feature", "prob").agg(
        F.max(F.when(F.col("kind") == "lo", F.col("value"))).alias("_lo"),
        F.max(F.when(F.col("kind") == "hi", F.col("value"))).alias("_hi"), F.max("frac").alias("_frac"))
    return both.select("feature", "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("quantile"))


def quantile_row(df: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """One row ``q0, q1, ...`` of exact quantiles (for attaching as scalars)."""
    q = exact_quantiles(df, value, probs)
    return q.agg(*[F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(f"q{i}")
                   for i, p in enumerate(probs)])


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                     accuracy: int = EDGE_ACCURACY) -> DataFrame:
    """Same output as ``exact_quantiles`` from mergeable quantile sketches
    (``percentile_approx``, rank error about 1 / accuracy): one partial
    aggregate per task and key, for when exact order statistics are not needed."""
    keys = list(keys)
    agg = F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs], accuracy).alias("_q")
    q = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(agg)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("_q").alias("quantile"))
    return q.select(*keys, F.explode(pairs).alias("_z")).select(
        *keys, F.col("_z.prob").alias("prob"), F.col("_z.quantile").alias("quantile"))
