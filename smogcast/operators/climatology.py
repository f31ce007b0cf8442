"""Climatologies and climatological fallbacks (OP-42, OP-43, OP-50, OP-51, OP-52).

All climatologies are aggregates keyed by (series, calendar position): their
size is bounded by series x 366, never by the number of observations, and
they are joined back on equality keys (no range or cross joins).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogcast.functions.scalars import round_half_up, safe_number
from smogcast.session import materialize

# --- fixed values -----------------------------------------------------------
WEATHER_DEFAULTS = {"temp": 25.0, "humidity": 50.0, "precip": 0.0, "windspeed": 10.0,
                    "sealevelpressure": 1010.0}
TREND_DEFAULT = 150.0
TREND_DAYS = 7
FALLBACK_DOY = 365
# --- end of fixed values ----------------------------------------------------


def doy_climatology(df: DataFrame, cols: list[str], key="series_key", date="date") -> DataFrame:
    """OP-42: mean of ``cols`` per (series, day of year)."""
    return df.groupBy(key, F.dayofyear(date).alias("dayofyear")).agg(*[F.avg(c).alias(c) for c in cols])


def closed_doy(clim: DataFrame, cols: list[str], key="series_key", fallback_doy: int = FALLBACK_DOY) -> DataFrame:
    """OP-43: the climatology of all 366 days of each series, days absent from it
    taking ``fallback_doy``'s values (presence decided by the key, not by NULL values)."""
    own = F.struct(*cols)
    days = F.explode(F.sequence(F.lit(1), F.lit(366))).alias("dayofyear")
    fallback = clim.groupBy(key).agg(F.max(F.when(F.col("dayofyear") == fallback_doy, own)).alias("__fb")).select(key, "__fb", days)
    found = clim.select(key, "dayofyear", own.alias("__own"))
    out = fallback.join(found, [key, "dayofyear"], "left").withColumn("__v", F.coalesce("__own", "__fb"))
    return out.select(key, "dayofyear", *[F.col(f"__v.{c}").alias(c) for c in cols])


def join_doy_climatology(target: DataFrame, clim: DataFrame, cols: list[str], key="series_key",
                         date="ds", fallback_doy: int | None = None) -> DataFrame:
    """OP-42 / OP-43: left-join the climatology on (series, day of year); with
    ``fallback_doy`` the closed one of :func:`closed_doy`. One equi-join either way."""
    if fallback_doy is not None:
        clim = closed_doy(clim, cols, key, fallback_doy)
    t = target.withColumn("__doy", F.dayofyear(date))
    c = clim.select(F.col(key).alias("__k"), F.col("dayofyear").alias("__cd"), *[F.col(x).alias(f"__c_{x}") for x in cols])
    out = t.join(c, (t[key] == c["__k"]) & (t["__doy"] == c["__cd"]), "left")
    out = out.withColumns({x: F.col(f"__c_{x}") for x in cols})
    return out.drop("__k", "__cd", "__doy", *[f"__c_{x}" for x in cols])


@dataclass
class ClosedCalendar:
    """Every lookup of OP-50 and OP-52 resolved once: one row per series and day of a common or leap year.

    ``table``: key, leap, doy, clim_level, the columns (all fallbacks applied),
    ``raw_<name>`` (none but the choice of the group) and ``trend`` (the seven days
    before, oldest first). ``fills``: the all-series means, for series without rows.
    """
    table: DataFrame
    cols: list[str]
    raw: tuple
    fills: dict
    key: str = "series_key"

    def lookup(self, requests: DataFrame, date: str = "date") -> DataFrame:
        """``requests`` with the calendar's columns of their day: one equi-join."""
        y, key = F.year(date), self.key
        leap = ((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))).cast("int")
        r = requests.withColumns({"__l": leap, "__d": F.dayofyear(date)})
        t = self.table.withColumnRenamed(key, "__k")
        out = r.join(t, (r[key] == t["__k"]) & (r["__l"] == t["leap"]) & (r["__d"] == t["doy"]), "left")
        fills = {c: F.coalesce(F.col(c), F.lit(self.fills.get(c)).cast("double"), F.lit(0.0)) for c in self.cols}
        if "trend" in self.table.columns:
            fills["trend"] = F.coalesce("trend", F.array_repeat(F.lit(TREND_DEFAULT), TREND_DAYS))
        return out.withColumns(fills).drop("__k", "__l", "__d", "leap", "doy")


def closed_calendar(df: DataFrame, cols: list[str], key="series_key", date="Date", raw: tuple = (),
                    trend: str | None = None) -> ClosedCalendar:
    """OP-50 and OP-52, resolved for every day a request can name.

    A day takes the (month, day) group's means if that group has rows, else the
    month's, else the series'; a NULL mean then falls to the all-series mean and
    finally 0. ``trend``: the column whose seven preceding days are listed, each the
    mean of its (month, day), else of its month, else 150, rounded to 2 decimals.

    The rows are aggregated once, to sums and counts per (series, month, day); the
    coarser levels add those up. Common and leap years differ in the days before 1 to
    7 March, so both are listed: 731 rows a series, whatever the requests.
    """
    read = list(dict.fromkeys([*cols, *([trend] if trend else [])]))
    parts = {f"s{i}": F.col(c).cast("double") for i, c in enumerate(read)}
    sums = [f"s{i}" for i in range(len(read))] + [f"n{i}" for i in range(len(read))]
    day = materialize(df.groupBy(key, F.month(date).alias("month"), F.dayofmonth(date).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(c) for c, x in parts.items()],
        *[F.count(x).alias(c.replace("s", "n")) for c, x in parts.items()]))
    month = day.groupBy(key, "month").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])
    series = month.groupBy(key).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])

    def means(level: DataFrame, name: str, keys: list[str]) -> DataFrame:
        return level.select(*keys, F.struct(*[F.try_divide(F.col(f"s{i}"), F.col(f"n{i}")).alias(c) for i, c in enumerate(read)]).alias(name))
    total = series.agg(*[F.try_divide(F.sum(f"s{i}"), F.sum(f"n{i}")).alias(c) for i, c in enumerate(read)]).first().asDict()

    # one year of each kind, each led by the last days of December
    kinds = F.array(*[F.struct(F.lit(leap).alias("leap"), F.expr(
        f"sequence(date'{first}-12-{32 - TREND_DAYS}', date'{first + 1}-12-31')").alias("days")) for leap, first in ((0, 2022), (1, 2023))])
    days = means(series, "all", [key]).select("*", F.inline(kinds)).select(key, "all", "leap", F.explode("days").alias("__date"))
    days = days.withColumns({"month": F.month("__date"), "day": F.dayofmonth("__date")})
    both = (days.join(means(month, "by_month", [key, "month"]), [key, "month"], "left")
            .join(means(day, "by_day", [key, "month", "day"]), [key, "month", "day"], "left"))
    level = F.when(F.col("by_day").isNotNull(), "month_day").when(F.col("by_month").isNotNull(), "month").otherwise("series")
    both = both.withColumns({"clim_level": level, "__v": F.coalesce("by_day", "by_month", "all")})
    out = {c: F.coalesce(F.col(f"__v.`{c}`"), F.lit(total[c]).cast("double"), F.lit(0.0)) for c in cols}
    out |= {f"raw_{c}": F.col(f"__v.`{c}`") for c in raw}
    if trend:
        near = F.coalesce("by_day", "by_month")[trend]
        value = round_half_up(safe_number(near, TREND_DEFAULT), 2)
        w = Window.partitionBy(key, "leap").orderBy("__date")
        out["trend"] = F.array(*[F.lag(value, k).over(w) for k in range(TREND_DAYS, 0, -1)])
    both = both.select(key, "leap", "__date", F.dayofyear("__date").alias("doy"), "clim_level", *[x.alias(c) for c, x in out.items()])
    return ClosedCalendar(both.where(F.year("__date") >= 2023).where((F.year("__date") == 2024) == (F.col("leap") == 1)).drop("__date"),
                          list(cols), tuple(raw), total, key)


def weather_with_defaults(df: DataFrame, defaults: dict[str, float] = WEATHER_DEFAULTS) -> DataFrame:
    """OP-51: weather made safe (NULL/NaN/inf -> fixed default), from the
    ``raw_<name>`` column where there is one: feature fills must not hide gaps."""
    raw = {c: F.col(f"raw_{c}" if f"raw_{c}" in df.columns else c) for c in defaults if c in df.columns}
    return df.withColumns({c: safe_number(x, defaults[c]) for c, x in raw.items()}).drop(*[f"raw_{c}" for c in raw])


def climatology_trend(requests: DataFrame, calendar: ClosedCalendar, date="date", days: int = TREND_DAYS) -> DataFrame:
    """OP-52: one row per request and offset days..1 with the closed calendar's value of that day."""
    out = calendar.lookup(requests, date).select(*requests.columns, F.posexplode("trend").alias("__pos", "trend_aqi"))
    return out.withColumn("offset", F.lit(days) - F.col("__pos")).withColumn(
        "trend_date", F.date_sub(F.col(date), F.col("offset"))).drop("__pos")
