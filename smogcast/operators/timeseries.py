"""Keyed time-series window operators (OP-17 .. OP-31).

Every operator runs on ``W = Window.partitionBy(key).orderBy(date)``: rows of
one series are contiguous and sorted inside one task, there is never an
unkeyed window (which would plan ``Exchange SinglePartition``). Sources are
unique on (key, date), so a window partition holds at most one row per
calendar day of one series: its size is bounded by the calendar span, not by
the table size. All frames are row frames (the reference shifts and rolls by
row position; calendar gaps are not expanded).

Frames are bounded (``rowsBetween(-k, -1)``) or running
(``unboundedPreceding .. currentRow``), both evaluated incrementally by Spark.
Frames that end at ``unboundedFollowing`` are quadratic in Spark, so backward
passes use a descending window with a running frame instead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from smogcast.functions.categories import aqi_category, category_color, category_name

# --- fixed values -----------------------------------------------------------
LAGS = [2, 3, 7, 14]
ROLL_WINDOWS = [3, 7, 14]
EWM_SPAN = 7
SPIKE_JUMP = 50.0
LEAKY_COLUMNS = ["AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1"]
# --- end of fixed values ----------------------------------------------------

#: A value that has decayed by exp(-HORIZON) is below the last bit of a double.
EWM_HORIZON = 40.0


def series_window(key: str | list[str] = "series_key", date: str = "Date",
                  descending: bool = False) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    order = F.col(date).desc() if descending else F.col(date).asc()
    return Window.partitionBy(*keys).orderBy(order)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def attach(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on ``cols``, of which null equals null; ``right`` brings its other columns."""
    named = right.toDF(*[f"__on_{c}" if c in cols else c for c in right.columns])
    on = None
    for c in cols:
        same = left[c].eqNullSafe(named[f"__on_{c}"])
        on = same if on is None else on & same
    return left.join(named, on, how).drop(*[f"__on_{c}" for c in cols])


# ---- OP-17 / OP-18 ----------------------------------------------------------
def lag_col(x, k: int, w: WindowSpec) -> Column:
    return F.lag(_c(x), k).over(w)


def add_lags(df: DataFrame, col: str, ks: list[int], key="series_key", date="Date",
             prefix: str | None = None) -> DataFrame:
    """OP-17: ``{prefix}_lag_{k}`` = value k rows earlier in the same series."""
    w = series_window(key, date)
    prefix = prefix or col
    return df.withColumns({f"{prefix}_lag_{k}": lag_col(col, k, w) for k in ks})


def leak_shift(df: DataFrame, cols: list[str], key="series_key", date="Date") -> DataFrame:
    """OP-18: move already-computed columns one row later (replacing them)."""
    w = series_window(key, date)
    return df.withColumns({c: F.lag(F.col(c), 1).over(w) for c in cols})


# ---- OP-19 .. OP-22 -----------------------------------------------------------
def trailing_stat(x, stat: str, size: int, w: WindowSpec, include_current: bool = False,
                  guard: bool = True) -> Column:
    """Trailing statistic over ``size`` rows; by default the current row is
    excluded (rows t-size .. t-1). With ``guard`` the result is NULL unless all
    ``size`` values are present (pandas ``rolling(size)`` semantics)."""
    lo, hi = (-(size - 1), 0) if include_current else (-size, -1)
    frame = w.rowsBetween(lo, hi)
    v = _c(x)
    agg = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min,
           "sum": F.sum}[stat](v).over(frame)
    if not guard:
        return agg
    return F.when(F.count(v).over(frame) == F.lit(size), agg)


def rolling_columns(x: str, windows: list[int], w: WindowSpec, prefix: str | None = None) -> dict:
    """OP-19/20/21: mean, sample std and max over the preceding w rows."""
    prefix = prefix or x
    cols = {}
    for n in windows:
        cols[f"{prefix}_roll_mean_{n}"] = trailing_stat(x, "mean", n, w)
        cols[f"{prefix}_roll_std_{n}"] = trailing_stat(x, "std", n, w)
        cols[f"{prefix}_roll_max_{n}"] = trailing_stat(x, "max", n, w)
    return cols


def add_rolling(df: DataFrame, col: str, windows: list[int] = ROLL_WINDOWS, key="series_key",
                date="Date") -> DataFrame:
    return df.withColumns(rolling_columns(col, windows, series_window(key, date)))


# ---- OP-23 ------------------------------------------------------------------
def _ewm_map(value: Column, gap: Column, alpha: float) -> tuple[Column, Column, Column]:
    """The affine map y -> A y + b that a value ``gap`` rows after the one before applies to the mean.

    A is given as (n, e) with A = (1 - alpha)^n exp(-e), exact for neighbours; a
    NULL is the identity and a series' first value (no gap) forgets what was before.
    """
    d = F.pow(F.lit(1.0 - alpha), gap.cast("double"))
    known, apart = value.isNotNull() & gap.isNotNull(), gap > 1
    n = F.when(known & ~apart, F.lit(1)).otherwise(F.lit(0))
    e = F.when(known & apart, F.log1p(F.lit(alpha) / d)).otherwise(F.lit(0.0))
    b = F.when(gap.isNull(), value).when(apart, F.lit(alpha) * value / (d + F.lit(alpha))).otherwise(F.lit(alpha) * value)
    return n, e, F.coalesce(b, F.lit(0.0))


def _ewm_maps(df: DataFrame, value: str, keys: list[str], date: str, alpha: float) -> DataFrame:
    """Adds ``__n``, ``__e`` (decay from the series' first value to this row) and ``__b``."""
    w, v = series_window(keys, date), F.col(value).cast("double")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("__at", F.when(v.isNotNull(), F.row_number().over(w)))
    out = out.withColumn("__gap", F.col("__at") - F.last("__at", ignorenulls=True).over(before))
    n, e, b = _ewm_map(v, F.col("__gap"), alpha)
    return out.withColumns({"__n": F.sum(n).over(w), "__e": F.sum(e).over(w), "__b": b}).drop("__at", "__gap")


def _ewm_maps_chunked(df: DataFrame, value: str, keys: list[str], date: str, alpha: float, chunk: str) -> DataFrame:
    """:func:`_ewm_maps` by an associative scan: maps are composed inside time chunks, chunks by a window over one row each."""
    v, whole = F.col(value).cast("double"), [*keys, "__chunk"]
    df = df.withColumn("__chunk", F.date_trunc(chunk, F.col(date)))
    w = series_window(whole, date)
    rows = df.withColumn("__rn", F.row_number().over(w)).withColumn("__at", F.when(v.isNotNull(), F.col("__rn")))
    rows = rows.withColumn("__gap", F.col("__at") - F.last("__at", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    n, e, _ = _ewm_map(v, F.col("__gap"), alpha)
    chunks = rows.withColumns({"__n": n, "__e": e}).groupBy(*whole).agg(
        F.count(F.lit(1)).alias("rows"), F.min("__at").alias("first"), F.max("__at").alias("last"),
        F.sum("__n").alias("n"), F.sum("__e").alias("e"))
    order = Window.partitionBy(*keys).orderBy("__chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("off", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    chunks = chunks.withColumn("__lead", F.col("off") + F.col("first") - F.last(F.col("off") + F.col("last"), True).over(before))
    n1, e1, _ = _ewm_map(F.col("first").cast("double"), F.col("__lead"), alpha)   # of the chunk's first value
    chunks = chunks.withColumns({"n1": n1, "e1": e1})
    start = chunks.select(*whole, "__lead",
                          F.coalesce(F.sum(F.col("n") + F.col("n1")).over(before), F.lit(0)).alias("__n0"),
                          F.coalesce(F.sum(F.col("e") + F.col("e1")).over(before), F.lit(0.0)).alias("__e0"))
    out = attach(rows, start, whole).withColumn("__gap", F.coalesce("__gap", F.when(v.isNotNull(), F.col("__lead"))))
    n, e, b = _ewm_map(v, F.col("__gap"), alpha)
    return out.withColumns({"__n": F.col("__n0") + F.sum(n).over(w), "__e": F.col("__e0") + F.sum(e).over(w), "__b": b}).drop(
        "__chunk", "__rn", "__at", "__gap", "__lead", "__n0", "__e0")


def ewm(df: DataFrame, value: str, out: str, span: int = EWM_SPAN, key: str | list[str] = "series_key", date: str = "Date",
        chunk: str | None = None) -> DataFrame:
    """OP-23: exponentially weighted mean, ``adjust=False`` recursion seeded by the
    first value, a = 2/(span+1), the current row included.

    A NULL doesn't count but the older weight decays across it: after a gap of g
    rows a value x gives (d*y + a*x)/(d + a) with d = (1-a)^g; a NULL row keeps
    the mean so far.

    Each value is an affine map of the mean, so the mean is a sum of values times
    the decay since. Rows are cut into stretches of ``EWM_HORIZON`` e-folds: inside
    one the decays fit a double, and the sum up to a row is a running sum; what lies
    before the preceding stretch has decayed below the last bit, so the totals of that
    one stretch are all that must be carried over. No lists, no recursion.

    With ``chunk`` (a unit of ``date_trunc``) no window holds more than such a chunk
    or stretch of a series, and tables of one row a chunk or stretch carry the rest, so a
    series of any length spreads over many tasks; the results are the same.
    """
    alpha, keys = 2.0 / (span + 1.0), [key] if isinstance(key, str) else list(key)
    maps = _ewm_maps_chunked(df, value, keys, date, alpha, chunk) if chunk else _ewm_maps(df, value, keys, date, alpha)
    decayed = F.col("__n") * F.lit(-math.log(1.0 - alpha)) + F.col("__e")
    maps = maps.withColumn("__k", F.floor(decayed / F.lit(EWM_HORIZON)))
    w = series_window([*keys, "__k"], date)

    def decay(n: Column, e: Column) -> Column:
        return F.pow(F.lit(1.0 - alpha), n.cast("double")) * F.exp(-e)
    maps = maps.withColumns({"__nk": F.first("__n").over(w), "__ek": F.first("__e").over(w)})
    own = F.sum(F.col("__b") * decay(F.col("__nk") - F.col("__n"), F.col("__ek") - F.col("__e"))).over(w)
    maps = maps.withColumns({"__s": own, "__any": F.max(F.col(value).isNotNull()).over(w)})
    carried = (F.lag("__s"), F.lag("__nk"), F.lag("__ek"))
    if chunk:
        ends = maps.groupBy(*keys, "__k").agg(F.max(F.struct(date, "__s", "__nk", "__ek")).alias("z")).select(
            *keys, "__k", F.col("z.__s").alias("__s"), F.col("z.__nk").alias("__nk"), F.col("z.__ek").alias("__ek"))
        order = Window.partitionBy(*keys).orderBy("__k")
        ps, pn, pe = (c.over(order) for c in carried)
        ends = ends.select(*keys, "__k", (ps * decay(F.col("__nk") - pn, F.col("__ek") - pe)).alias("__r"))
        maps = attach(maps, ends, [*keys, "__k"])
    else:
        ps, pn, pe = (c.over(series_window(keys, date)) for c in carried)
        other = F.lag("__k").over(series_window(keys, date)) != F.col("__k")
        maps = maps.withColumn("__r", F.when(other, ps * decay(F.col("__nk") - pn, F.col("__ek") - pe)))
        maps = maps.withColumn("__r", F.first("__r").over(w))
    mean = decay(F.col("__n") - F.col("__nk"), F.col("__e") - F.col("__ek")) * (F.col("__s") + F.coalesce("__r", F.lit(0.0)))
    return maps.withColumn(out, F.when(F.col("__any") | (F.col("__k") > 0), mean)).drop(
        "__n", "__e", "__b", "__k", "__nk", "__ek", "__s", "__any", "__r")


def add_ewm(df: DataFrame, value: str, outs: dict[str, bool], span: int = EWM_SPAN,
            key: str | list[str] = "series_key", date: str = "Date") -> DataFrame:
    """Columns of :func:`ewm`; ``outs``: output name -> whether the current row
    counts (False: the leak-free value of the row before)."""
    out = ewm(df, value, "__ewm", span, key, date)
    w = series_window(key, date)
    return out.withColumns({name: F.col("__ewm") if current else F.lag("__ewm", 1).over(w)
                            for name, current in outs.items()}).drop("__ewm")


# ---- OP-24 .. OP-26 -------------------------------------------------------------
def diff_columns(x: str, w: WindowSpec, prefix: str | None = None) -> dict:
    """OP-24/25: first difference, its leak-free shift and the spike flag."""
    prefix = prefix or x
    v = _c(x)
    lag1, lag2 = F.lag(v, 1).over(w), F.lag(v, 2).over(w)
    delta = lag1 - lag2
    return {
        f"{prefix}_diff_1": v - lag1,
        f"{prefix}_delta_1": delta,
        "is_spike": F.coalesce(F.abs(delta) > F.lit(SPIKE_JUMP), F.lit(False)).cast("int"),
    }


def ventilation(wind: Column | str = "windspeed", humidity: Column | str = "humidity") -> Column:
    """OP-26: windspeed / (humidity + 1); NULL (not an error) when humidity = -1."""
    return F.try_divide(_c(wind), _c(humidity) + F.lit(1.0))


def weather_lag_columns(w: WindowSpec) -> dict:
    return {
        "ventilation_lag1": F.lag(ventilation(), 1).over(w),
        "windspeed_lag1": F.lag(F.col("windspeed"), 1).over(w),
        "humidity_lag1": F.lag(F.col("humidity"), 1).over(w),
        "temp_lag1": F.lag(F.col("temp"), 1).over(w),
    }


# ---- OP-27 / OP-28 --------------------------------------------------------------
def _with_chunk_edges(df: DataFrame, cols: list[str], keys: list[str], date: str, chunk: str) -> DataFrame:
    """Carry scan over time chunks: adds ``__chunk``, ``__at`` (row position in the series) and per column ``i`` the
    last value before the chunk and the first one after it, ``__p{i}`` and ``__q{i}`` (structs at, v).

    A chunk is summarised by its number of rows and its first and last values, and
    only these rows, one a chunk, meet in a window over the series.
    """
    whole = [*keys, "__chunk"]
    rows = df.withColumn("__chunk", F.date_trunc(chunk, F.col(date)))
    rows = rows.withColumn("__rn", F.row_number().over(series_window(whole, date)))
    ends = []
    for i, c in enumerate(cols):
        known = F.when(F.col(c).isNotNull(), F.struct("__rn", F.col(c).alias("v")))
        ends += [F.min(known).alias(f"f{i}"), F.max(known).alias(f"l{i}")]
    order = Window.partitionBy(*keys).orderBy("__chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("__chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = rows.groupBy(*whole).agg(F.count(F.lit(1)).alias("rows"), *ends)
    edges = edges.withColumn("__off", F.coalesce(F.sum("rows").over(before), F.lit(0)))

    def placed(name: str) -> Column:
        x = F.col(name)
        return F.when(x.isNotNull(), F.struct((F.col("__off") + x["__rn"]).alias("at"), x["v"].alias("v")))
    edges = edges.select(*whole, "__off", *[F.last(placed(f"l{i}"), True).over(before).alias(f"__p{i}") for i in range(len(cols))],
                         *[F.last(placed(f"f{i}"), True).over(after).alias(f"__q{i}") for i in range(len(cols))])
    return attach(rows, edges, whole).withColumn("__at", F.col("__off") + F.col("__rn")).drop("__off", "__rn")


def interpolate_linear(df: DataFrame, col: str, key="series_key", date="Date",
                       out: str | None = None, chunk: str | None = None) -> DataFrame:
    """OP-27: fill interior NULLs linearly by row position; trailing NULLs
    repeat the last value; leading NULLs stay NULL.

    Previous known value/position come from a running ``last(ignorenulls)`` in
    ascending order, the next ones from the same running frame in descending
    order (a running frame is incremental; an unbounded-following one is not).
    With ``chunk`` (a unit of ``date_trunc``) the windows hold such a chunk of a
    series only, and what lies beyond comes from :func:`_with_chunk_edges`.
    """
    out, keys = out or col, [key] if isinstance(key, str) else list(key)
    if chunk:
        df, keys = _with_chunk_edges(df, [col], keys, date, chunk), [*keys, "__chunk"]
    asc, desc = series_window(keys, date), series_window(keys, date, descending=True)
    run_a = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run_d = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(col)
    tmp = df if chunk else df.withColumn("__at", F.row_number().over(asc))
    item = F.when(v.isNotNull(), F.struct(F.col("__at").alias("at"), v.alias("v")))
    p, q = F.last(item, True).over(run_a), F.last(item, True).over(run_d)
    tmp = tmp.withColumns({"__p": F.coalesce(p, "__p0") if chunk else p, "__q": F.coalesce(q, "__q0") if chunk else q})
    p, q = F.col("__p"), F.col("__q")
    filled = (F.when(v.isNotNull(), v)
               .when(p.isNotNull() & q.isNotNull(),
                     p["v"] + (q["v"] - p["v"]) / (q["at"] - p["at"]).cast("double") * (F.col("__at") - p["at"]).cast("double"))
               .when(p.isNotNull(), p["v"]))
    return tmp.withColumn(out, filled).drop("__at", "__p", "__q", "__p0", "__q0", "__chunk")


def forward_fill(x, key="series_key", date="Date") -> Column:
    return F.last(_c(x), True).over(series_window(key, date).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def backward_fill(x, key="series_key", date="Date") -> Column:
    return F.last(_c(x), True).over(series_window(key, date, descending=True).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))


def fill_forward_backward(df: DataFrame, cols: list[str], key="series_key", date="Date",
                          chunk: str | None = None) -> DataFrame:
    """OP-28: forward fill, then backward fill what is still NULL (leading gap).
    With ``chunk``, as :func:`interpolate_linear`."""
    keys = [key] if isinstance(key, str) else list(key)
    if chunk:
        df, keys = _with_chunk_edges(df, cols, keys, date, chunk), [*keys, "__chunk"]
    filled = {}
    for i, c in enumerate(cols):
        ways = [forward_fill(c, keys, date), backward_fill(c, keys, date)]
        if chunk:
            ways = [ways[0], F.col(f"__p{i}.v"), ways[1], F.col(f"__q{i}.v")]
        filled[c] = F.coalesce(*ways)
    return df.withColumns(filled).drop("__chunk", "__at", *[f"__{x}{i}" for x in "pq" for i in range(len(cols))])


# ---- OP-29 / OP-30 --------------------------------------------------------------
def preceding_context(df: DataFrame, value: str = "AQI", rows: int = 7, key="series_key",
                      date="Date", out: str = "trend") -> DataFrame:
    """OP-29: for each row, the preceding ``rows`` rows as an ordered array of
    (date, aqi, category, color) structs (NULL category and colour for a NULL value); computed once per series with one
    bounded frame, so requests are answered by an equi-join, not a range join."""
    w = series_window(key, date).rowsBetween(-rows, -1)
    code = F.when(F.col(value).isNotNull(), aqi_category(F.col(value)))   # a missing value has no category
    item = F.struct(F.col(date).alias("date"), F.col(value).alias("aqi"),
                    F.when(code.isNotNull(), category_name(code)).alias("category"),
                    F.when(code.isNotNull(), category_color(code)).alias("color"))
    return df.withColumn(out, F.collect_list(item).over(w))


def sequence_windows(df: DataFrame, features: list[str], target: str, steps: int = 7,
                     key: str | list[str] = "series_key", date="Date") -> DataFrame:
    """OP-30: the ``steps`` preceding feature rows (oldest first) paired with
    the current row's target; only rows with a full history are kept."""
    w = series_window(key, date).rowsBetween(-steps, -1)
    seq = F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(w)
    keys = [key] if isinstance(key, str) else list(key)
    return (df.select(*keys, date, F.col(target).alias("target"), seq.alias("sequence"))
              .where(F.size("sequence") == steps))


# ---- OP-79 (feature pipeline) -------------------------------------------------
def feature_columns(value: str = "AQI", w: WindowSpec | None = None) -> dict:
    """The engineered features but the EWM (see :func:`ewm`) as one dict of
    column expressions over one shared window spec, so Catalyst plans a single
    Exchange + Sort + Window.

    The three "precomputed" columns of the reference's input (inclusive
    rolling mean, inclusive EWM and first difference) are derived here and
    already leak-shifted: the shift of an inclusive frame ending at t-1 is the
    exclusive frame ending at t.
    """
    w = w or series_window()
    v = value
    cols = {f"{v}_lag_1": lag_col(v, 1, w)}
    for k in LAGS:
        cols[f"{v}_lag_{k}"] = lag_col(v, k, w)
    cols.update(rolling_columns(v, ROLL_WINDOWS, w))
    cols["ventilation"] = ventilation()
    cols.update(weather_lag_columns(w))
    d = diff_columns(v, w)
    cols[f"{v}_diff_1"] = d[f"{v}_delta_1"]        # leak-shifted first difference
    cols[f"{v}_delta_1"] = d[f"{v}_delta_1"]
    cols["is_spike"] = d["is_spike"]
    return cols


def leakage_audit(df: DataFrame, stored_roll: str | None = None, stored_ewm: str | None = None,
                  value: str = "AQI", size: int = 7, span: int = EWM_SPAN, key="series_key",
                  date="Date", tol: float = 1e-6) -> DataFrame:
    """OP-31 (with OP-22): compare stored rolling-mean / EWM columns against
    their inclusive (leaky: the current day included) and exclusive (safe)
    recomputations. One window pass, one aggregate: one row per series with
    the share of comparable rows matching each variant."""
    w = series_window(key, date)
    sel = [F.col(key)]
    pairs = []
    if stored_ewm:
        df = add_ewm(df, value, {"__ei": True, "__ex": False}, span, key, date)
    if stored_roll:
        sel += [F.col(stored_roll).alias("__sr"),
                trailing_stat(value, "mean", size, w, include_current=True).alias("__ri"),
                trailing_stat(value, "mean", size, w, include_current=False).alias("__rx")]
        pairs += [("roll_share_inclusive", "__sr", "__ri"), ("roll_share_exclusive", "__sr", "__rx")]
    if stored_ewm:
        sel += [F.col(stored_ewm).alias("__se"), F.col("__ei"), F.col("__ex")]
        pairs += [("ewm_share_inclusive", "__se", "__ei"), ("ewm_share_exclusive", "__se", "__ex")]
    t = df.select(*sel)

    def share(a, b):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        hit = F.sum(F.when(both & (F.abs(F.col(a) - F.col(b)) <= F.lit(tol)), 1).otherwise(0))
        n = F.sum(F.when(both, 1).otherwise(0))
        return F.try_divide(hit.cast("double"), n.cast("double"))

    return t.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                              *[share(a, b).alias(name) for name, a, b in pairs])


# ---- long series: exact computation in bounded chunks ---------------------------
def max_lookback() -> int:
    """Longest row lookback of :func:`feature_columns`."""
    return max(max(ROLL_WINDOWS), max(LAGS), 2)


def with_series_position(df: DataFrame, key: str = "series_key", date: str = "Date",
                         bucket: str = "month") -> DataFrame:
    """Adds ``__pos``, the 0-based row position inside the series, without a
    window over the whole series: rows are counted per (series, time bucket)
    by an aggregate, bucket offsets are running sums over that count table
    (one row per bucket), and positions inside a bucket come from a window
    partitioned by (series, bucket)."""
    b = F.date_trunc(bucket, F.col(date)).alias("__bucket")
    counts = df.groupBy(key, b).agg(F.count(F.lit(1)).alias("__n"))
    wb = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(wb), F.lit(0))).drop("__n")
    inner = Window.partitionBy(key, "__bucket").orderBy(F.col(date))
    return (df.withColumn("__bucket", F.date_trunc(bucket, F.col(date)))
              .join(offsets, [key, "__bucket"], "inner")
              .withColumn("__pos", F.col("__off") + F.row_number().over(inner) - 1)
              .drop("__bucket", "__off"))


def chunk_with_halo(df: DataFrame, chunk_rows: int, halo: int, key: str = "series_key",
                    date: str = "Date") -> DataFrame:
    """Assign rows to chunks of ``chunk_rows`` consecutive rows of a series and
    copy the last ``halo`` rows of every chunk into the next one. Output
    columns ``__chunk`` (the partition to compute in) and ``__home`` (the
    chunk that owns the row). Every row frame reaching at most ``halo`` rows
    back sees exactly the rows it would see in the whole series."""
    if chunk_rows < halo:
        raise ValueError("chunk_rows must be at least the halo size")
    p = with_series_position(df, key, date)
    home = F.floor(F.col("__pos") / F.lit(chunk_rows)).cast("long")
    tail = (F.col("__pos") % F.lit(chunk_rows)) >= F.lit(chunk_rows - halo)
    return (p.withColumn("__home", home)
             .withColumn("__chunk", F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))))
             .drop("__pos"))


def chunked_window(key: str = "series_key", date: str = "Date") -> WindowSpec:
    return Window.partitionBy(key, "__chunk").orderBy(F.col(date).asc())
