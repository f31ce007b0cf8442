"""Calendar parts, cyclic encodings and the seasonal interval flag (OP-36..38)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Seasonal burning interval: October 15 through November 15, inclusive.
SEASON_START = (10, 15)
SEASON_END = (11, 15)
# Period of the annual cycle in days used by the day-of-year encoding.
YEAR_DAYS = 365.25
# --- end of fixed values ----------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def season_flag(date) -> Column:
    """OP-38: 1 inside Oct-15 .. Nov-15, else 0."""
    d = _c(date)
    m, day = F.month(d), F.dayofmonth(d)
    inside = ((m == SEASON_START[0]) & (day >= SEASON_START[1])) | (
        (m == SEASON_END[0]) & (day <= SEASON_END[1]))
    return F.coalesce(inside, F.lit(False)).cast("int")


def add_calendar_parts(df: DataFrame, date_col: str) -> DataFrame:
    """OP-36: numeric and named calendar parts of a date column."""
    d = F.col(date_col)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "month_name": F.date_format(d, "MMMM"),
        "weekday_name": F.date_format(d, "EEEE"),
    })


def add_cyclic_encodings(df: DataFrame, date_col: str) -> DataFrame:
    """OP-37: sine/cosine of month (period 12) and day of year (period 365.25)."""
    d = F.col(date_col)
    two_pi = 2.0 * math.pi
    m = F.month(d).cast("double")
    doy = F.dayofyear(d).cast("double")
    return df.withColumns({
        "Month_sin": F.sin(F.lit(two_pi) * m / F.lit(12.0)),
        "Month_cos": F.cos(F.lit(two_pi) * m / F.lit(12.0)),
        "DayOfYear_sin": F.sin(F.lit(two_pi) * doy / F.lit(YEAR_DAYS)),
        "DayOfYear_cos": F.cos(F.lit(two_pi) * doy / F.lit(YEAR_DAYS)),
    })
