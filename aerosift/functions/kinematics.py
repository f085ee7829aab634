"""Climb rate and altitude-jump test in exact integer arithmetic.

Altitudes carry one decimal (staging rounds them), so ``d`` below is an
exact count of decimetres. ``ROUND(d / (10*dt), 2)`` half away from zero is
then ``sign(d) * ((20*|d| + dt) div (2*dt)) / 100`` -- no binary-float tie
can flip a digit, and the result is identical in every SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decimetre_delta(alt, prev_alt) -> Column:
    return (F.round(_c(alt) * 10, 0) - F.round(_c(prev_alt) * 10, 0)).cast("long")


def in_gap(dt, max_gap_s: int = 120) -> Column:
    return (_c(dt) > 0) & (_c(dt) <= max_gap_s)


def climb_rate(alt, prev_alt, dt, max_gap_s: int = 120) -> Column:
    """m/s rounded to 2 decimals when 0 < dt <= max_gap_s, else NULL."""
    d = decimetre_delta(alt, prev_alt)
    dt = _c(dt).cast("long")
    num, den = F.abs(d) * 20 + dt, dt * 2
    q = ((num - F.pmod(num, den)) / den).cast("long")  # exact integer division
    rate = F.signum(d) * q / F.lit(100.0)
    return F.when(in_gap(dt, max_gap_s), rate)


def altitude_jump(alt, prev_alt, dt, max_gap_s: int = 120, max_rate: int = 100) -> Column:
    """TRUE when |Δalt/Δt| > max_rate m/s within the gap, else FALSE (never NULL)."""
    d = decimetre_delta(alt, prev_alt)
    dt = _c(dt).cast("long")
    cond = in_gap(dt, max_gap_s) & (F.abs(d) > dt * (10 * max_rate))
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))
