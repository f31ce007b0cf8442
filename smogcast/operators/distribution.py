"""Monthly distribution statistics, multi-year slope, density curve (OP-53..55)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogcast.operators.timeseries import attach

PDF_POINTS = 40
BINS = 1024


def _median(counts: DataFrame, ranges: DataFrame, groups: list[str], refine: int) -> DataFrame:
    """Exact medians of ``counts`` (groups, v, c) by refining histograms.

    ``ranges``: groups, lo, hi, n. Each step counts the values in ``BINS`` equal ranges
    and keeps the one or two that hold the middle ranks, with the number of values below
    them; what is left after ``refine`` steps is ranked by a running sum.
    """
    left = attach(counts, ranges.withColumn("below", F.lit(0)), groups)
    first, last = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    for step in range(refine):
        width = (F.col("hi") - F.col("lo")) / F.lit(float(BINS))
        left = left.withColumn("bin", F.when(width > 0, F.least(F.lit(BINS - 1), F.floor((F.col("v") - F.col("lo")) / width))).otherwise(0))
        bins = left.groupBy(*groups, "bin").agg(F.sum("c").alias("held"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                                                F.first("n").alias("n"), F.first("below").alias("below"))
        run = Window.partitionBy(*groups).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("below", F.col("below") + F.coalesce(F.sum("held").over(run), F.lit(0)))
        bins = bins.where((F.col("below") < last) & (F.col("below") + F.col("held") >= first))
        kept = bins.select(*groups, "bin", "lo", "hi", "n", "below")
        span = kept.groupBy(*groups).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("below").alias("below"), F.first("n").alias("n"))
        inside = attach(left.select(*groups, "v", "c", "bin"), kept.select(*groups, "bin"), [*groups, "bin"], "left_semi")
        left = attach(inside.drop("bin"), span, groups)
    run = Window.partitionBy(*groups).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = left.withColumn("to", F.col("below") + F.sum("c").over(run)).withColumn("from", F.col("to") - F.col("c") + 1)
    middle = ranked.where((F.col("from") <= last) & (F.col("to") >= first))
    # one value holds both middle ranks, or two hold one each
    return middle.groupBy(*groups).agg(((F.min("v") + F.max("v")) / 2).alias("median"))


def month_stats(df: DataFrame, value: str = "AQI", key="series_key", date="Date",
                by_month: bool = True, refine: int = 1) -> DataFrame:
    """OP-53: per (series, month): n, mean, median, mode, sample variance and
    std (0 when n <= 1). ``by_month=False``: of the whole series (month NULL).

    Mean and variance come from mergeable moments (count, mean, squared
    deviations), the mode (lowest of the most frequent values) from a table of
    counts per distinct value, the median from refined histograms of it. No step
    gathers a group's values; every aggregate combines map-side.
    """
    month = F.month(date) if by_month else F.lit(None).cast("int")
    base = df.where(F.col(value).isNotNull()).select(key, month.alias("month"), F.col(value).cast("double").alias("v"))
    groups = [key, "month"]
    moments = base.groupBy(*groups).agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("var"),
                                        F.min("v").alias("lo"), F.max("v").alias("hi"))
    counts = base.groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("c"))
    mode = counts.groupBy(*groups).agg((-F.max(F.struct("c", (-F.col("v")).alias("neg")))["neg"]).alias("mode"))
    median = _median(counts, moments.select(*groups, "lo", "hi", "n"), groups, refine)
    out = attach(attach(moments, mode, groups), median, groups)
    var = F.when(F.col("n") > 1, F.col("var")).otherwise(F.lit(0.0))
    return out.select(*groups, "n", "mean", "median", var.alias("variance"), F.sqrt(var).alias("std_dev"), "mode")


def month_trend_slope(df: DataFrame, value: str = "AQI", key="series_key", date="Date",
                      by_month: bool = True) -> DataFrame:
    """OP-54: least-squares slope of the yearly means within each month (or of
    the whole series, month NULL); 0 when fewer than two years."""
    month = F.month(date) if by_month else F.lit(None).cast("int")
    yearly = (df.where(F.col(value).isNotNull())
                .groupBy(key, month.alias("month"), F.year(date).alias("year"))
                .agg(F.avg(value).alias("ym")))
    slope = F.regr_slope(F.col("ym"), F.col("year").cast("double"))
    return yearly.groupBy(key, "month").agg(
        F.count(F.lit(1)).alias("n_years"),
        F.when(F.count(F.lit(1)) > 1, F.coalesce(slope, F.lit(0.0))).otherwise(F.lit(0.0)).alias("trend_slope"))


def normal_pdf_points(stats: DataFrame, mean: str = "mean", std: str = "std_dev",
                      points: int = PDF_POINTS) -> DataFrame:
    """OP-55: for each row with std > 0, ``points`` evenly spaced x from
    max(0, mean-3 std) to mean+3 std (last exactly the end), x rounded to one
    decimal and the normal density at the unrounded x. One output row per
    point (rows with std = 0 produce none)."""
    mu, sd = F.col(mean), F.col(std)
    lo = F.greatest(F.lit(0.0), mu - F.lit(3.0) * sd)
    hi = mu + F.lit(3.0) * sd
    out = stats.where(sd > 0).select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    step = (hi - lo) / F.lit(float(points - 1))
    x = F.when(F.col("i") == points - 1, hi).otherwise(F.col("i").cast("double") * step + lo)
    z = (x - mu) / sd
    y = (F.lit(1.0) / (sd * F.lit(math.sqrt(2.0 * math.pi)))) * F.exp(F.lit(-0.5) * (z * z))
    return out.withColumns({"x": F.floor(x * F.lit(10.0) + F.lit(0.5)).cast("double") / F.lit(10.0),
                            "y": y})
