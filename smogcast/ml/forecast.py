"""Seasonal forecaster (OP-77) and date forecasts (OP-78).

Model per series on the log scale (multiplicative seasonality):
log(1 + y) = intercept + slope*t + sum_j d_j*max(0, t - s_j)      (piecewise trend)
        + yearly Fourier (order 10) + weekly Fourier (order 3)
        + event flag + standardised regressors.
Values below 0 count as 0 (an index is not negative).

The slope changes d_j have a Laplace prior of scale ``changepoint_prior``, so most of
them are exactly 0; all else but the intercept and slope is ridge. With noise
variance s2 that is least squares plus (s2 / scale) * sum |d_j|: the unpenalised and
ridge coordinates are eliminated from the normal equations, the changes are found by
coordinate descent with soft thresholds on what is left, and s2 is updated.

1. every scan task computes partial X'X, X'y, y'y, n of the series it meets
   (``mapInPandas``, numpy on an Arrow batch) and emits them when it ends or
   holds ``HELD`` series; no row is shuffled, and a series that holds a third
   of all rows is spread like all rows are;
2. the partial matrices (upper triangles) are summed element-wise by a Spark
   aggregate keyed by (series, cell) with map-side combine;
3. each series' totals are solved with numpy (``applyInPandas``; the group
   size is fixed by the number of features p, not by the data).

Prediction joins the per-series coefficients (one row per series) and takes a
dot product with ``aggregate(zip_with(...))`` on the JVM. The interval is
expm1(mean +- z * sd) with sd^2 = sigma^2 + drift * max(0, t - 1)^3: beyond the
training part (t > 1) slopes go on changing at the fitted rate, by changes of the
fitted mean size m; changes at rate r that are Laplace with scale m give the trend a
variance of r * 2 m^2 * (t - 1)^3 / 3.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogcast.functions.categories import CATEGORY_NAMES, aqi_category
from smogcast.functions.scalars import clip

HELD = 256  # series whose partial matrices a task holds at a time
Z95 = 1.959963984540054


def _fourier(days: Column, period: float, order: int) -> list[Column]:
    out = []
    for k in range(1, order + 1):
        ang = F.lit(2.0 * math.pi * k / period) * days
        out += [F.sin(ang), F.cos(ang)]
    return out


def fit_changes(xtx: np.ndarray, xty: np.ndarray, yty: float, n: float, changes: np.ndarray, ridge: float,
                prior: float) -> tuple[np.ndarray, float]:
    """(coefficients, noise sd) from normal equations: Laplace prior on ``changes``, ridge on the rest but the first two."""
    p = len(xty)
    rest = np.setdiff1d(np.arange(p), changes)
    penalty = np.where(rest < 2, 0.0, ridge)
    a = xtx[np.ix_(rest, rest)] + np.diag(penalty)
    cross = xtx[np.ix_(rest, changes)]
    solved = np.linalg.lstsq(a, np.column_stack([cross, xty[rest]]), rcond=None)[0]
    s = xtx[np.ix_(changes, changes)] - cross.T @ solved[:, :-1]
    b = xty[changes] - cross.T @ solved[:, -1]
    d, beta, sigma = np.zeros(len(changes)), np.zeros(p), 0.0
    floor = 1e-9 * max(float(np.max(np.diag(s), initial=0.0)), 1e-300)
    for turn in range(20):
        least = sigma ** 2 / prior if turn else 0.0
        for _ in range(500):
            step = 0.0
            for j in range(len(changes)):
                if s[j, j] > floor:
                    r = b[j] - s[j] @ d + s[j, j] * d[j]
                    new = np.sign(r) * max(abs(r) - least, 0.0) / s[j, j]
                    step, d[j] = max(step, abs(new - d[j])), new
            if step < 1e-8:
                break
        beta[rest], beta[changes] = solved[:, -1] - solved[:, :-1] @ d, d
        sse = max(yty - 2.0 * beta @ xty + beta @ xtx @ beta, 0.0)
        before, sigma = sigma, math.sqrt(sse / max(n - len(rest) - np.count_nonzero(d), 1.0))
        if abs(sigma - before) <= 1e-6 * sigma:
            break
    return beta, sigma


@dataclass
class SeasonalForecaster:
    key: str = "series_key"
    date: str = "ds"
    value: str = "y"
    regressors: tuple = ("temperature", "wind_speed", "is_stubble_burning")
    event_col: str | None = "near_event"
    yearly_order: int = 10
    weekly_order: int = 3
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior: float = 0.1
    ridge: float = 1.0
    interval: float = 0.95

    @property
    def n_features(self) -> int:
        return (2 + self.n_changepoints + 2 * self.yearly_order + 2 * self.weekly_order
                + (1 if self.event_col else 0) + len(self.regressors))

    def _stats(self, df: DataFrame) -> DataFrame:
        days = F.datediff(F.col(self.date), F.lit("1970-01-01").cast("date"))
        aggs = [F.min(days).alias("__t0"), F.max(days).alias("__t1")]
        for r in self.regressors:
            aggs += [F.avg(F.col(r).cast("double")).alias(f"__mu_{r}"),
                     F.stddev_pop(F.col(r).cast("double")).alias(f"__sd_{r}")]
        return df.groupBy(self.key).agg(*aggs)

    def design(self, df: DataFrame, stats: DataFrame) -> DataFrame:
        """Adds ``__x`` (array of p doubles) using per-series scaling stats."""
        j = df.join(stats.withColumnRenamed(self.key, "__sk"), F.col(self.key).eqNullSafe(F.col("__sk")), "left").drop("__sk")
        days = F.datediff(F.col(self.date), F.lit("1970-01-01").cast("date")).cast("double")
        span = F.greatest(F.col("__t1") - F.col("__t0"), F.lit(1)).cast("double")
        t = (days - F.col("__t0").cast("double")) / span
        cols = [F.lit(1.0), t]
        for i in range(1, self.n_changepoints + 1):
            s = self.changepoint_range * i / self.n_changepoints
            cols.append(F.greatest(t - F.lit(s), F.lit(0.0)))
        cols += _fourier(days, 365.25, self.yearly_order)
        cols += _fourier(days, 7.0, self.weekly_order)
        if self.event_col:
            cols.append(F.coalesce(F.col(self.event_col).cast("double"), F.lit(0.0)))
        for r in self.regressors:
            sd = F.col(f"__sd_{r}")
            z = (F.col(r).cast("double") - F.col(f"__mu_{r}")) / F.when(sd > 0, sd).otherwise(F.lit(1.0))
            cols.append(F.coalesce(z, F.lit(0.0)))
        return j.withColumn("__x", F.array(*cols))

    def fit(self, df: DataFrame) -> "SeasonalForecastModel":
        p = self.n_features
        stats = self._stats(df)
        d = self.design(df.where(F.col(self.value).isNotNull() & F.col(self.key).isNotNull()
                                 & F.col(self.date).isNotNull()), stats)
        d = d.select(F.col(self.key).cast("string").alias("k"), "__x",
                     F.log1p(F.greatest(F.col(self.value).cast("double"), F.lit(0.0))).alias("__y"))
        def emit(held):
            for k, cells in held.items():
                yield pd.DataFrame({"k": k, "cell": np.arange(len(cells), dtype=np.int32), "v": cells})

        upper = np.triu_indices(p)

        def partial(batches):
            held = {}
            for pdf in batches:
                for k, g in pdf.groupby("k", sort=False):
                    X = np.vstack(g["__x"].to_numpy())
                    y = g["__y"].to_numpy(dtype=float)
                    cells = np.concatenate([(X.T @ X)[upper], X.T @ y, [float(y @ y), float(len(y))]])
                    held[k] = held[k] + cells if k in held else cells
                    if len(held) >= HELD:
                        yield from emit(held)
                        held = {}
            yield from emit(held)

        parts = d.mapInPandas(partial, "k string, cell int, v double")
        totals = parts.groupBy("k", "cell").agg(F.sum("v").alias("v"))
        changes = np.arange(2, 2 + self.n_changepoints)
        ridge, prior = self.ridge, self.changepoint_prior

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            v = pdf.sort_values("cell")["v"].to_numpy()
            m = len(upper[0])
            xtx = np.zeros((p, p))
            xtx[upper] = v[:m]
            xtx = xtx + np.triu(xtx, 1).T
            beta, sigma = fit_changes(xtx, v[m:m + p], v[m + p], v[m + p + 1], changes, ridge, prior)
            size = float(np.abs(beta[changes]).mean()) if len(changes) else 0.0
            return pd.DataFrame({"k": [pdf["k"].iloc[0]], "beta": [beta.tolist()], "sigma": [sigma],
                                 "drift": [2.0 / 3.0 * len(changes) * size ** 2], "n": [int(v[m + p + 1])]})

        coef = totals.groupBy("k").applyInPandas(solve, "k string, beta array<double>, sigma double, drift double, n long")
        coef = coef.withColumnRenamed("k", "__kstr")   # key carried as text through Arrow
        return SeasonalForecastModel(self, stats, coef)


@dataclass
class SeasonalForecastModel:
    spec: SeasonalForecaster
    stats: DataFrame
    coef: DataFrame

    def transform(self, df: DataFrame, clip_range: tuple = (0.0, 500.0)) -> DataFrame:
        s = self.spec
        coef = self.coef.select("__kstr", "beta", "sigma", "drift")
        d = s.design(df, self.stats)
        d = d.join(coef, F.col(s.key).cast("string") == F.col("__kstr"), "left")
        d = d.withColumn("status", F.when(F.col(s.key).isNull(), F.lit("missing_series"))
                         .when(F.col("__kstr").isNull(), F.lit("unknown_series"))
                         .when(F.col(s.date).isNull(), F.lit("missing_date")).otherwise(F.lit("ok"))).drop("__kstr")
        dot = F.aggregate(F.zip_with("__x", "beta", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        n_trend = 2 + s.n_changepoints
        trend = F.aggregate(F.slice(F.zip_with("__x", "beta", lambda a, b: a * b), 1, n_trend),
                            F.lit(0.0), lambda acc, x: acc + x)
        z = F.lit(Z95 if abs(s.interval - 0.95) < 1e-12 else _z(s.interval))
        lo, hi = clip_range
        out = d.withColumns({
            "__m": dot,
            "trend": F.expm1(trend),
            "__sd": F.sqrt(F.pow("sigma", 2) + F.col("drift") * F.pow(F.greatest(F.col("__x")[1] - 1.0, F.lit(0.0)), 3)),
        }).withColumns({
            "yhat": clip(F.expm1(F.col("__m")), lo, hi),
            "yhat_lower": clip(F.expm1(F.col("__m") - z * F.col("__sd")), lo, hi),
            "yhat_upper": clip(F.expm1(F.col("__m") + z * F.col("__sd")), lo, hi),
        })
        code = aqi_category(F.col("yhat"))
        out = out.withColumn("aqi_category",
                             F.element_at(F.array(*[F.lit(n) for n in CATEGORY_NAMES]), code + 1))
        return out.drop(*[c for c in out.columns if c.startswith("__")], "beta", "sigma", "drift")


def _z(level: float) -> float:
    from statistics import NormalDist
    return NormalDist().inv_cdf(0.5 + level / 2.0)
