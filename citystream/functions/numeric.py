"""Rounding that reproduces round-half-even on the binary double.

``F.round`` rounds the double's shortest decimal text half-up, so an exact
rational tie such as 55,149,000 ms / 60,000 = 919.15 becomes 919.2, whereas
rounding the binary value (919.1499999...) gives 919.1. For a ratio of
integers the only inputs where the two disagree are exact decimal ties;
those are settled here by comparing the double against the tie exactly in
integer arithmetic (a double is m / 2^k with integer m); a double that is
exactly the tie rounds half to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(num: Column, den: int, digits: int = 1) -> Column:
    """round(num / den, digits) for non-negative integer ``num`` (LONG),
    rounding the binary double of the quotient. ``den`` must be a multiple
    of 10**digits."""
    scale = 10 ** digits
    step = den // scale
    assert step * scale == den, "den must be a multiple of 10**digits"
    q = F.floor(num / F.lit(step)).cast("long")
    rem = num - q * F.lit(step)
    d = num / F.lit(float(den))
    k = F.lit(53) - F.floor(F.log2(d)).cast("int")
    two_k = F.pow(F.lit(2.0), k)
    m = (d * two_k).cast("long")
    lhs, rhs = m * F.lit(2 * scale), (q * 2 + 1) * two_k.cast("long")
    # Exact decimal tie: the double lies below / above it, or is it exactly
    # (then half-to-even, as Python's round does).
    up = F.when(rem * 2 > F.lit(step), 1).when(rem * 2 < F.lit(step), 0) \
          .when(lhs < rhs, 0).when(lhs > rhs, 1).otherwise(q % 2)
    return F.when(num.isNull(), F.lit(None).cast("double")) \
            .otherwise((q + up) / F.lit(float(scale)))
