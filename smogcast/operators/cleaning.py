"""Projection, filtering and cleaning operators (OP-07 .. OP-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogcast.operators.timeseries import series_window


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """OP-07."""
    return df.withColumnsRenamed(mapping)


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """OP-09 (all columns) / OP-10 (a subset)."""
    return df.na.drop("any", subset=subset)


def fill_with_means(df: DataFrame, cols: list[str], key: str | None = "series_key",
                    then: float = 0.0) -> DataFrame:
    """OP-11: NULLs take the column mean (per series when ``key`` is given),
    then ``then`` where the mean itself is NULL.

    The per-series mean is a window aggregate over ``partitionBy(key)``: the
    feature table is already hash-partitioned by the key after the feature
    windows, so this adds no exchange.
    """
    if key:
        w = Window.partitionBy(key)
        return df.withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.avg(F.col(c)).over(w), F.lit(float(then)))
            for c in cols
        })
    # Whole-table means: one partial aggregate, a single row of len(cols)
    # values brought back as literals (never an unpartitioned window).
    means = df.agg(*[F.avg(F.col(c)).alias(c) for c in cols]).first().asDict()
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double"), F.lit(float(then)))
        for c in cols
    })


def where_date(df: DataFrame, date_col: str = "Date", equals=None, before=None,
               month: int | None = None, day: int | None = None) -> DataFrame:
    """OP-13: date equality / order / month / day predicates (pushed to scans)."""
    cond = F.lit(True)
    d = F.col(date_col)
    if equals is not None:
        cond = cond & (d == F.lit(equals).cast("date"))
    if before is not None:
        cond = cond & (d < F.lit(before).cast("date"))
    if month is not None:
        cond = cond & (F.month(d) == month)
    if day is not None:
        cond = cond & (F.dayofmonth(d) == day)
    return df.where(cond)


def row_slice(df: DataFrame, start: int, stop: int, key="series_key", date="Date") -> DataFrame:
    """OP-16: rows ``start`` .. ``stop-1`` (0-based positions) of each series."""
    rn = F.row_number().over(series_window(key, date)) - 1
    return df.withColumn("__pos", rn).where(F.col("__pos").between(start, stop - 1)).drop("__pos")
