"""Scalar column expressions (OP-12, OP-33, OP-34, OP-35, OP-39, OP-40, OP-41).

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogcast.functions.categories import ALARM_LEVEL


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_number(x, default) -> Column:
    """OP-12: null / NaN / +-inf / uncastable text -> ``default``."""
    v = _c(x).try_cast("double")
    v = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
    return F.coalesce(v, F.lit(default).cast("double"))


def log_target(x) -> Column:
    """OP-33 forward transform."""
    return F.log1p(_c(x))


def exp_target(x) -> Column:
    """OP-33 inverse transform."""
    return F.expm1(_c(x))


def clip(x, lo: float | None = None, hi: float | None = None) -> Column:
    """OP-34: clip that keeps NULL as NULL (greatest/least skip nulls)."""
    v = _c(x)
    out = v
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(v.isNotNull(), out)


def alarm(x, level: float = ALARM_LEVEL) -> Column:
    """OP-35: 1 where x >= level, 0 otherwise (NULL compares false -> 0)."""
    return F.coalesce(_c(x) >= F.lit(level), F.lit(False)).cast("int")


def argmax_index(arr) -> Column:
    """OP-40: 0-based position of the first maximum of an array of doubles."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def trend_label(slope) -> Column:
    """OP-41: negative slope is improving, otherwise worsening."""
    return F.when(_c(slope) < 0, F.lit("Improving Trend")).otherwise(F.lit("Worsening Trend"))


def signed_text(x) -> Column:
    """OP-41: '+1.5' for positive values, plain text otherwise."""
    v = _c(x)
    return F.when(v > 0, F.concat(F.lit("+"), v.cast("string"))).otherwise(v.cast("string"))


def round_half_up(x, digits: int = 6) -> Column:
    """Rounding computed as floor(x*10^d + 0.5)/10^d in IEEE doubles.

    Written this way so that any engine evaluating the same arithmetic gets the
    same bits (Spark's ``round`` works on the exact decimal expansion, other
    engines multiply first; they disagree on binary halves).
    """
    scale = float(10 ** digits)
    return (F.floor(_c(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


QUANT_BITS = 20


def quantize(x, bits: int = QUANT_BITS) -> Column:
    """Snap a double to the nearest multiple of 2^-bits (about 1e-6).

    Used only to present results for cross-engine comparison: scaling by a
    power of two is exact in IEEE arithmetic, and decimal-origin values (the
    usual source of rounding ties) are essentially never odd multiples of
    2^-(bits+1), so two engines that computed the same double print the same
    double.
    """
    scale = float(2 ** bits)
    return F.floor(_c(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
