"""Explanations.

Contributions are a long table ``(id, feature, value, contribution)``. For a
linear (logistic) scorer they are exact: ``coef * (x - mean(x))`` in log-odds,
adding up to ``logit(p) - base``. For any other scorer, permutation Shapley
values are computed as one Spark job (rows x permutations x positions,
one ``model.transform``, differences by ``lag``). Every per-row step is a
window partitioned by ``id``: a row's features are one small group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.text import py_fixed
from riskframe.session import written
from riskframe.schema import (COUNTERFACTUAL_DECREASE, COUNTERFACTUAL_INCREASE, HIGH_RISK_SCORE,
                              RISK_KEYWORDS)

SAMPLE_SEED = 42


def seeded_sample(df: DataFrame, n: int, key: str = "id", seed: int = SAMPLE_SEED) -> DataFrame:
    """Fixed-size sample: the ``n`` rows with the smallest seeded md5 of ``key``.

    Stable under repartitioning and recomputation (unlike ``sample``); runs as
    a distributed top-n (partial top-n per task, then a merge of n rows each).
    """
    return df.orderBy(F.md5(F.concat_ws("/", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)


def _logit(coefs: Mapping[str, float], intercept: float, cols: Mapping[str, Column]) -> Column:
    z = F.lit(float(intercept))
    for f, b in coefs.items():
        z = z + F.lit(float(b)) * cols[f]
    return z


def linear_scores(df: DataFrame, coefs: Mapping[str, float], intercept: float,
                  key: str = "id", background: DataFrame | None = None) -> DataFrame:
    """``key, logit, probability, base_value`` for a logistic scorer; missing
    inputs take the background mean (so they contribute nothing)."""
    x, means = _filled(df, coefs, key, background)
    z = _logit(coefs, intercept, {f: F.col(f) for f in coefs})
    base = _logit(coefs, intercept, {f: F.col(f"_mean.{f}") for f in coefs})
    return x.select(key, z.alias("logit"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("probability"),
                    base.alias("base_value"))


def _filled(df: DataFrame, coefs: Mapping[str, float], key: str,
            background: DataFrame | None) -> tuple[DataFrame, Column]:
    bg = background if background is not None else df
    means = bg.select(F.struct(*[F.avg(F.col(f).cast("double")).alias(f) for f in coefs]).alias("m"))
    sq = means.scalar()
    x = df.select(key, *[F.col(f).cast("double").alias(f) for f in coefs]).withColumn("_mean", sq)
    x = x.withColumns({f: F.coalesce(F.col(f), F.col(f"_mean.{f}")) for f in coefs})
    return x, F.col("_mean")


def linear_contribution_rows(df: DataFrame, coefs: Mapping[str, float], intercept: float,
                             key: str = "id", background: DataFrame | None = None) -> DataFrame:
    """One row per input row: ``key, base_value, logit, probability, contribs``
    where ``contribs`` is the array of ``(feature, value, contribution)`` sorted
    by |contribution| (ties by name). Per-row ordering happens inside the row,
    so nothing is shuffled to rank a row's features."""
    x, _ = _filled(df, coefs, key, background)
    z = _logit(coefs, intercept, {f: F.col(f) for f in coefs})
    base = _logit(coefs, intercept, {f: F.col(f"_mean.{f}") for f in coefs})
    # sort key first so the native (codegen) struct ordering gives |c| desc, then name
    items = F.array(*[F.struct(
        (-F.abs(F.lit(float(b)) * (F.col(f) - F.col(f"_mean.{f}")))).alias("_k"), F.lit(f).alias("feature"),
        F.col(f).alias("value"), (F.lit(float(b)) * (F.col(f) - F.col(f"_mean.{f}"))).alias("contribution"))
        for f, b in coefs.items()])
    # (the ``_k`` field stays in the elements: dropping it with a lambda costs more
    # than the sort itself)
    return x.select(key, base.alias("base_value"), z.alias("logit"),
                    (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("probability"),
                    F.sort_array(items).alias("contribs"))


def linear_contributions(df: DataFrame, coefs: Mapping[str, float], intercept: float,
                         key: str = "id", background: DataFrame | None = None) -> DataFrame:
    """``key, feature, value, contribution, abs_rank, base_value, logit, probability``
    (exact Shapley values of a linear model in log-odds; ``abs_rank`` orders a
    row's features by |contribution|)."""
    rows = linear_contribution_rows(df, coefs, intercept, key, background)
    # the array always has one element per coefficient; the outer form keeps the
    # optimizer from inferring a size(contribs) > 0 filter and pushing the whole
    # contribution expression down into the scan's join condition
    return rows.select(key, "base_value", "logit", "probability",
                       F.posexplode_outer("contribs").alias("_pos", "_c")).select(
        key, "_c.feature", "_c.value", "_c.contribution", (F.col("_pos") + 1).alias("abs_rank"),
        "base_value", "logit", "probability")


def global_importance(contrib: DataFrame, top: int | None = None) -> DataFrame:
    """``feature, importance, rank``: mean |contribution| per feature, ranked
    (all features; ``top`` only for a report that shows so many)."""
    g = contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    ranked = g.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("importance").desc(), F.col("feature"))))   # one row per feature
    return ranked.where(F.col("rank") <= top) if top else ranked


def describe_features(importance: DataFrame, dictionary: DataFrame,
                      default: str = "No description available") -> DataFrame:
    """Attach dictionary descriptions (first match per name; default when absent)."""
    d = dictionary.groupBy("feature").agg(F.min("description").alias("description"))
    return importance.join(d, "feature", "left").withColumn(
        "description", F.coalesce(F.col("description"), F.lit(default)))


def top_k(importance: DataFrame, k: int) -> DataFrame:
    """Top ``k`` by importance with a 1-based rank (ties by name)."""
    return importance.where(F.col("rank") <= k)


def risk_features(importance: DataFrame, keywords: Sequence[str] = RISK_KEYWORDS,
                  k: int = 5) -> DataFrame:
    """Features whose lower-cased name contains a risk keyword, first ``k`` by rank."""
    hit = None
    for kw in keywords:
        c = F.lower(F.col("feature")).contains(kw)
        hit = c if hit is None else hit | c
    r = importance.where(hit)
    return r.withColumn("risk_rank", F.row_number().over(Window.orderBy("rank"))).where(
        F.col("risk_rank") <= k)


def dependence_pairs(contrib: DataFrame, features: Sequence[str], key: str = "id",
                     interaction: str | None = None) -> DataFrame:
    """``key, feature, value, contribution`` (+ ``interaction_value``) for the
    listed features; the interaction value comes from the same row (join on key)."""
    out = contrib.where(F.col("feature").isin(list(features))).select(key, "feature", "value", "contribution")
    if interaction:
        inter = contrib.where(F.col("feature") == interaction).select(
            key, F.col("value").alias("interaction_value"))
        out = out.join(inter, key, "left")
    return out


def dependence_rows(rows: DataFrame, features: Sequence[str], key: str = "id",
                    interaction: str | None = None) -> DataFrame:
    """``dependence_pairs`` on ``linear_contribution_rows`` output: value,
    contribution and interaction value all come from the row's own array."""
    of = lambda names: F.filter("contribs", lambda c: c["feature"].isin(*names))
    cols = [key, of(list(features)).alias("_kept")]
    if interaction:
        cols.append(F.get(of([interaction]), F.lit(0))["value"].alias("interaction_value"))
    # outer + filter: no inferred size(..) > 0 filter with the array copied into the scan
    x = rows.select(*cols).select("*", F.explode_outer("_kept").alias("_c")).where(F.col("_c").isNotNull())
    return x.select(key, "_c.feature", "_c.value", "_c.contribution", *(["interaction_value"] if interaction else []))


def ordered_contributions(contrib: DataFrame, key: str = "id") -> DataFrame:
    """Per row, features ranked by |contribution| (ties by name); a rank
    already computed inside the row (``abs_rank``) is kept as is."""
    if "abs_rank" in contrib.columns:
        return contrib
    w = Window.partitionBy(key).orderBy(F.abs("contribution").desc(), F.col("feature"))
    return contrib.withColumn("abs_rank", F.row_number().over(w))


def waterfall(contrib: DataFrame, key: str = "id", max_display: int = 10) -> DataFrame:
    """``key, position, feature, value, contribution, cumulative``: base value
    first (position 0), the ``max_display - 1`` largest |contributions|, the rest
    pooled as 'other features', with a running total from the base value."""
    r = ordered_contributions(contrib, key)
    shown = r.where(F.col("abs_rank") <= max_display - 1).select(
        key, F.col("abs_rank").alias("position"), "feature", "value", "contribution", "base_value")
    rest = (r.where(F.col("abs_rank") > max_display - 1).groupBy(key)
            .agg(F.sum("contribution").alias("contribution"), F.max("base_value").alias("base_value"))
            .select(key, F.lit(max_display).alias("position"), F.lit("other features").alias("feature"),
                    F.lit(None).cast("double").alias("value"), "contribution", "base_value"))
    base = (r.where(F.col("abs_rank") == 1).select(
        key, F.lit(0).alias("position"), F.lit("base_value").alias("feature"),
        F.lit(None).cast("double").alias("value"), F.col("base_value").alias("contribution"), "base_value"))
    allr = shown.unionByName(rest).unionByName(base)
    w = Window.partitionBy(key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return allr.withColumn("cumulative", F.sum("contribution").over(w)).drop("base_value")


def waterfall_rows(rows: DataFrame, key: str = "id", max_display: int = 10) -> DataFrame:
    """``waterfall`` on ``linear_contribution_rows`` output, inside each row:
    base value, the ``max_display - 1`` largest contributions, the rest pooled,
    running totals by ``aggregate`` over the row's own array (no window)."""
    plain = F.transform("contribs", lambda c: F.struct(
        c["feature"].alias("feature"), c["value"].alias("value"), c["contribution"].alias("contribution")))
    shown = F.slice(plain, 1, max_display - 1)
    rest = F.slice(plain, F.lit(max_display), F.greatest(F.size(plain), F.lit(0)))
    pooled = F.when(F.size(rest) > 0, F.array(F.struct(
        F.lit("other features").alias("feature"), F.lit(None).cast("double").alias("value"),
        F.aggregate(rest, F.lit(0.0), lambda a, c: a + c["contribution"]).alias("contribution")))) \
        .otherwise(F.array().cast("array<struct<feature:string,value:double,contribution:double>>"))
    base = F.array(F.struct(F.lit("base_value").alias("feature"), F.lit(None).cast("double").alias("value"),
                            F.col("base_value").alias("contribution")))
    items = F.concat(base, shown, pooled)
    steps = F.transform(items, lambda c, i: F.struct(
        i.alias("position"), c["feature"].alias("feature"), c["value"].alias("value"),
        c["contribution"].alias("contribution"),
        F.aggregate(F.slice(items, 1, i + 1), F.lit(0.0), lambda a, e: a + e["contribution"])
        .alias("cumulative")))
    return rows.select(key, F.explode(steps).alias("_w")).select(
        key, F.col("_w.position").alias("position"), "_w.feature", "_w.value", "_w.contribution",
        "_w.cumulative")


def high_risk(scores: DataFrame, key: str = "id", score: str = "probability",
              threshold: float = HIGH_RISK_SCORE, n: int = 10, order_by: str | None = "logit") -> DataFrame:
    """Rows scoring above ``threshold``: the first ``n`` by score (ties by key).

    ``order_by`` names a column monotone in the score that does not saturate
    (the logit), so near-1 probabilities keep a stable order.
    """
    o = order_by if order_by and order_by in scores.columns else score
    return (scores.where(F.col(score) > threshold).orderBy(F.col(o).desc(), F.col(key))
            .limit(n).select(key, score))


# --- fixed values: counterfactual recommendation texts (%s = formatted number) ------
CF_TEXT = {
    "dti": "Reduce debt-to-income ratio from %s to %s",
    "revol_util": "Reduce credit utilization from %s%% to %s%%",
    "annual_inc": "Increase annual income from $%s to $%s",
}
CF_DELINQ = "Reduce recent delinquencies (currently %s)"
CF_DEFAULT = "%s %s from %s to %s"


def _recommendation(feature: Column, cur: Column, sug: Column, direction: Column) -> Column:
    f2 = (py_fixed(cur, 2), py_fixed(sug, 2))
    expr = F.when(feature == "dti", F.format_string(CF_TEXT["dti"], *f2))
    expr = expr.when(feature == "revol_util", F.format_string(
        CF_TEXT["revol_util"], py_fixed(cur, 1), py_fixed(sug, 1)))
    expr = expr.when(feature == "annual_inc", F.format_string(
        CF_TEXT["annual_inc"], py_fixed(cur, 0, True), py_fixed(sug, 0, True)))
    expr = expr.when(feature == "delinq_2yrs", F.format_string(CF_DELINQ, py_fixed(cur, 0)))
    return expr.otherwise(F.format_string(CF_DEFAULT, F.initcap(direction), feature, *f2))


def counterfactual_rows(rows: DataFrame, coefs: Mapping[str, float], key: str = "id",
                        max_changes: int = 3, target_change: float = -0.1,
                        categorical: Sequence[str] = ()) -> DataFrame:
    """``counterfactuals`` on ``linear_contribution_rows`` output, computed inside
    each row with array functions over at most ``2 * max_changes`` elements (no
    shuffle): the same rules, texts and re-scored probability, one output row
    per kept suggestion."""
    cand = F.slice("contribs", 1, 2 * max_changes)
    cats = [F.lit(c) for c in categorical]
    keep = F.filter(cand, lambda c: ~((c["contribution"] > 0) & (c["value"] <= 0))
                    & (~F.array_contains(F.array(*cats), c["feature"]) if cats else F.lit(True)))
    top = F.slice(keep, 1, max_changes)
    cmap = F.create_map(*[v for f, b in coefs.items() for v in (F.lit(f), F.lit(float(b)))])
    x = rows.select(key, "probability", "logit", top.alias("_top"))
    sugg = F.transform("_top", lambda c: F.struct(
        c["feature"].alias("feature"), c["value"].alias("value"), c["contribution"].alias("contribution"),
        F.when(c["contribution"] > 0, c["value"] * COUNTERFACTUAL_DECREASE)
        .otherwise(c["value"] * COUNTERFACTUAL_INCREASE).alias("suggested"),
        F.when(c["contribution"] > 0, F.lit("decrease")).otherwise(F.lit("increase")).alias("direction")))
    x = x.select(key, "probability", "logit", sugg.alias("_sugg"))
    delta = F.aggregate("_sugg", F.lit(0.0), lambda acc, s_: acc + F.coalesce(
        cmap[s_["feature"]], F.lit(0.0)) * (s_["suggested"] - s_["value"]))
    # outer + explicit filter: same rows as posexplode, but no inferred
    # size(_sugg) > 0 filter pushed down with the lambdas copied into the scan
    x = x.select(key, "probability", (F.col("logit") + delta).alias("_z"),
                 F.posexplode_outer("_sugg").alias("_pos", "_s")).where(F.col("_s").isNotNull())
    v, sug = F.col("_s.value"), F.col("_s.suggested")
    return x.select(
        key, (F.col("_pos") + 1).alias("suggestion_rank"), F.col("_s.feature").alias("feature"),
        v.alias("current_value"), sug.alias("suggested_value"),
        F.col("_s.direction").alias("change_direction"), F.col("_s.contribution").alias("shap_impact"),
        F.abs(sug - v).alias("change_magnitude"),
        _recommendation(F.col("_s.feature"), v, sug, F.col("_s.direction")).alias("recommendation"),
        F.col("probability").alias("current_probability"),
        (F.col("probability") + F.lit(float(target_change))).alias("target_probability"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z")))).alias("rescored_probability"))


def counterfactuals(contrib: DataFrame, key: str = "id", max_changes: int = 3,
                    target_change: float = -0.1, categorical: Sequence[str] = (),
                    coefs: Mapping[str, float] | None = None) -> DataFrame:
    """Suggestions for every row at once: of the ``2 * max_changes`` largest
    |contributions|, non-categorical features with positive contribution and
    positive value are decreased by 20%, positive contribution with value <= 0
    is skipped, the rest increased by 20%; the first ``max_changes`` are kept.
    With ``coefs`` the row is re-scored with its suggestions applied."""
    r = ordered_contributions(contrib, key).where(F.col("abs_rank") <= 2 * max_changes)
    if categorical:
        r = r.where(~F.col("feature").isin(list(categorical)))
    c, v = F.col("contribution"), F.col("value")
    r = r.where(~((c > 0) & (v <= 0)))
    r = r.withColumns({
        "change_direction": F.when(c > 0, "decrease").otherwise("increase"),
        "suggested_value": F.when(c > 0, v * COUNTERFACTUAL_DECREASE).otherwise(v * COUNTERFACTUAL_INCREASE)})
    w = Window.partitionBy(key).orderBy("abs_rank")
    r = r.withColumn("suggestion_rank", F.row_number().over(w)).where(
        F.col("suggestion_rank") <= max_changes)
    r = r.withColumns({
        "change_magnitude": F.abs(F.col("suggested_value") - v),
        "recommendation": _recommendation(F.col("feature"), v, F.col("suggested_value"),
                                          F.col("change_direction")),
        "current_probability": F.col("probability"),
        "target_probability": F.col("probability") + F.lit(float(target_change))})
    out = r.select(key, "suggestion_rank", "feature", F.col("value").alias("current_value"),
                   "suggested_value", "change_direction", F.col("contribution").alias("shap_impact"),
                   "change_magnitude", "recommendation", "current_probability", "target_probability",
                   "logit")
    if coefs:
        delta = F.lit(0.0)
        for f, b in coefs.items():
            delta = F.when(F.col("feature") == f, F.lit(float(b))).otherwise(delta)
        step = delta * (F.col("suggested_value") - F.col("current_value"))
        wr = Window.partitionBy(key)
        z = F.col("logit") + F.sum(step).over(wr)
        out = out.withColumn("rescored_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    return out.drop("logit")


def permutation_contributions(model, rows: DataFrame, background: DataFrame, features: Sequence[str],
                              key: str = "id", n_permutations: int = 8, n_background: int = 50,
                              seed: int = SAMPLE_SEED, positive_index: int = 1) -> DataFrame:
    """Sampled permutation Shapley values of any Spark ML model (X2 b).

    Each (row, permutation) draws one background row by a seeded hash: an
    equi-join on the drawn index against a background sample of bounded size
    ``n_background`` (never all row x background pairs). Along the permutation
    the row's values replace the background's one feature at a time; all
    ``F + 1`` coalitions of all rows are scored by one ``model.transform``, and
    the step between consecutive coalitions (``lag`` inside the small
    ``(row, permutation)`` window) is the feature's marginal contribution,
    averaged over permutations. Per row the contributions add up to the mean
    over its permutations of ``f(x) - f(z)``.

    Returns ``key, feature, value, contribution, base_value, prediction``; ``value``
    is the row's own value of the feature.
    """
    from pyspark.ml.functions import array_to_vector
    feats = list(features)
    nf = len(feats)
    bg = seeded_sample(background, n_background, key, seed).select(
        F.array(*[F.col(f).cast("double") for f in feats]).alias("_z"), F.col(key).alias("_bk"))
    bg = bg.withColumn("_bidx", F.row_number().over(Window.orderBy(
        F.xxhash64("_bk", F.lit(seed)), "_bk")) - 1).drop("_bk")     # n_background rows
    x = rows.select(key, F.array(*[F.col(f).cast("double") for f in feats]).alias("_x"))
    x = x.select(key, "_x", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))).alias("_p"))
    nbg = bg.agg(F.count(F.lit(1))).scalar()
    x = x.withColumn("_bidx", F.pmod(F.xxhash64(F.col(key), F.col("_p"), F.lit(seed)), nbg).cast("int"))
    x = x.join(F.broadcast(bg), "_bidx", "inner")      # broadcast side: n_background rows
    idx = F.sequence(F.lit(0), F.lit(nf - 1))
    order = F.transform(F.array_sort(F.transform(idx, lambda i: F.struct(
        F.xxhash64(F.col(key), F.col("_p"), i, F.lit(seed)).alias("h"), i.alias("i")))), lambda s: s["i"])
    x = x.withColumn("_ord", order).withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(nf))))
    mixed = F.transform(idx, lambda i: F.when(F.array_position("_ord", i) - 1 < F.col("_j"), F.col("_x")[i])
                        .otherwise(F.col("_z")[i]))
    x = x.withColumn("_features", array_to_vector(mixed))
    pred = model.transform(x.withColumnRenamed("_features", "features").drop(*[c for c in ("features",) if c in x.columns]))
    pred = pred.withColumn("_v", vector_to_array_col(F.col("probability"), positive_index))
    w = Window.partitionBy(key, "_p").orderBy("_j")
    steps = pred.select(key, "_p", "_j", "_v", "_x", F.when(F.col("_j") > 0, F.element_at("_ord", F.col("_j"))).alias("_fi"),
                        (F.col("_v") - F.lag("_v").over(w)).alias("_step"),
                        F.first("_v").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                        .alias("_base"),
                        F.last("_v").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                        .alias("_full"))
    names = F.array(*[F.lit(f) for f in feats])
    contrib = (steps.where(F.col("_j") > 0).groupBy(key, "_fi")
               .agg(F.avg("_step").alias("contribution"), F.avg("_base").alias("base_value"),
                    F.avg("_full").alias("prediction"), F.first(F.get("_x", F.col("_fi"))).alias("value")))
    return contrib.select(key, F.element_at(names, F.col("_fi") + 1).alias("feature"), "value", "contribution",
                          "base_value", "prediction")


def vector_to_array_col(v: Column, index: int) -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(v)[index]


def explanation_report(model, data: DataFrame, features: Sequence[str], key: str = "id",
                       sample_size: int | None = 1000, n_background: int = 100,
                       key_features: Sequence[str] = ("dti", "revol_util", "annual_inc", "int_rate"),
                       background: DataFrame | None = None,
                       contributions: Callable[[DataFrame], DataFrame] | None = None, **kw) -> dict[str, DataFrame]:
    """Sample -> contributions -> importance (all features) -> high-risk rows
    -> waterfalls (first three) -> dependence pairs with the rows' own values
    (first three key features present). ``sample_size`` and ``n_background`` bound
    the work, ``None`` explains all rows; ``background`` are the rows the model was trained on (default: ``data``).
    ``contributions`` gives a sample's contributions by another way than permutations
    (``attributions.tree_contributions`` for boosted trees, exact)."""
    sample = data if sample_size is None else seeded_sample(data, sample_size, key)
    # every table below reads some columns of the contributions: score the coalitions once
    if contributions is None:
        contrib = permutation_contributions(
            model, sample, data if background is None else background, features, key, n_background=n_background, **kw)
    else:
        contrib = contributions(sample)
    contrib = written(contrib)
    importance = global_importance(contrib)
    scores = contrib.groupBy(key).agg(F.max("prediction").alias("probability"))
    risky = high_risk(scores, key, "probability", order_by=None)
    first3 = risky.orderBy(F.col("probability").desc(), F.col(key)).limit(3).select(key)
    kf = [f for f in key_features if f in features][:3]
    return {"sample": sample, "contributions": contrib, "importance": importance,
            "high_risk": risky,
            "waterfalls": waterfall(contrib.join(first3, key, "left_semi"), key),
            "dependence": dependence_pairs(contrib, kf, key), "key_features": kf}
