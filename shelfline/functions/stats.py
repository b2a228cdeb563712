"""Float results from exact sums.

Means and standard deviations are built from exact integer / DECIMAL sums and
one final IEEE division (or square root).  The result is then independent of
how rows were split across tasks, and any engine that performs the same final
operation returns the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from .expr import col


def mean(c) -> Column:
    """Mean of the non-null values (null if none)."""
    x = col(c)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def window_mean(c, w: WindowSpec) -> Column:
    x = col(c)
    return F.try_divide(F.sum(x).over(w).cast("double"), F.count(x).over(w).cast("double"))


def window_stddev_pop(c, w: WindowSpec) -> Column:
    """Population standard deviation over a frame: sqrt((n*S2 - S1^2) / n^2)."""
    x = col(c).cast("decimal(38,0)")
    n = F.count(x).over(w).cast("decimal(38,0)")
    s1 = F.sum(x).over(w).cast("decimal(38,0)")
    s2 = F.sum(x * x).over(w).cast("decimal(38,0)")
    num = (n * s2 - s1 * s1).cast("double")
    return F.sqrt(F.try_divide(num, (n * n).cast("double")))


def round_half_away(x: Column, digits: int) -> Column:
    """round(x, digits) as ``round(x * 10^d) / 10^d`` on binary doubles."""
    m = float(10 ** digits)
    return F.round(x * F.lit(m), 0) / F.lit(m)
