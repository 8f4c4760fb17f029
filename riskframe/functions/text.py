"""Text formatting with Python's fixed-point semantics.

Java's ``%.nf`` rounds the shortest decimal form half-up; Python rounds the
exact binary value half-to-even. Reports that must read like the reference
use ``py_fixed``: the exact product ``x * 10^n`` (Dekker's two-product, plain
IEEE steps) decides ties, then Java prints a value that needs no rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0   # 2^27 + 1


def _split(a: Column) -> tuple[Column, Column]:
    t = F.lit(_SPLIT) * a
    hi = t - (t - a)
    return hi, a - hi


def py_fixed(x: Column, decimals: int, grouping: bool = False) -> Column:
    """Python ``f"{x:.{decimals}f}"`` (``f"{x:,.{decimals}f}"`` with grouping)."""
    c = float(10 ** decimals)
    a = F.abs(x.cast("double"))
    p = a * F.lit(c)
    ah, al = _split(a)
    bh, bl = _split(F.lit(c))
    err = ((ah * bh - p) + ah * bl + al * bh) + al * bl      # a*c == p + err exactly
    n = F.floor(p).cast("double")
    frac = p - n
    up = (F.when(frac > 0.5, True).when(frac < 0.5, False)
          .when(err > 0, True).when(err < 0, False)
          .otherwise(F.pmod(n, F.lit(2.0)) == 1.0))
    m = F.when(up, n + 1.0).otherwise(n) / F.lit(c)
    body = F.format_string(f"%{',' if grouping else ''}.{decimals}f", m)
    xd = x.cast("double")
    # negative zero prints with a sign too; its Java text keeps the sign
    negative = (xd < 0) | ((xd == 0) & F.format_string("%s", xd).startswith("-"))
    signed = F.when(negative, F.concat(F.lit("-"), body)).otherwise(body)
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(signed)
