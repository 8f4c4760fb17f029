"""Binning expressions with the reference's interval closure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed_bins(c: Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """(e0, e1] -> labels[0], ..., (e_last, inf) -> labels[-1]; <= e0 or NULL -> NULL.

    ``edges`` are the lower bounds of each label (``len(edges) == len(labels)``),
    the last bin is open above. ``Bucketizer`` is left-closed, so not used.
    """
    expr = None
    for i, lab in enumerate(labels):
        lo = F.lit(edges[i])
        cond = c > lo
        if i + 1 < len(labels):
            cond = cond & (c <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def quantile_labels(c: Column, cuts: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label by inner quantile cuts: v <= cut0 -> labels[0], ..., else labels[-1].

    The lowest value is included in the first bin (quantile cut semantics);
    equal cuts leave the upper label empty instead of failing.
    """
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for cut, lab in zip(cuts, labels[:-1]):
        expr = expr.when(c <= cut, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def membership_label(c: Column, members: Sequence[str], inside: str, outside: str) -> Column:
    """``inside`` when the value is in ``members``; otherwise (NULL included) ``outside``."""
    return F.when(c.isin(list(members)), F.lit(inside)).otherwise(F.lit(outside))


def equal_width_bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin index of an equal-width histogram over [lo, hi], last bin closed.

    Same edges as a linspace of ``bins + 1`` points (last edge = hi exactly),
    with the index corrected against those edges the way a histogram does;
    values outside [lo, hi] give NULL.
    """
    step = (hi - lo) / F.lit(float(bins))
    raw = F.floor((v - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int")
    idx = F.least(raw, F.lit(bins - 1))

    def edge(i: Column) -> Column:
        return F.when(i >= F.lit(bins), hi).otherwise(i.cast("double") * step + lo)

    # at most one correction applies; written as two steps from the same index the
    # expression stays small
    down = F.when(v < edge(idx), 1).otherwise(0)
    up = F.when((v >= edge(idx + 1)) & (idx != F.lit(bins - 1)), 1).otherwise(0)
    return F.when((v >= lo) & (v <= hi), idx - down + up)
