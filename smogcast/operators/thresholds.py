"""Boundary thresholds over class probabilities (OP-40, OP-48, OP-62)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogcast.functions.scalars import argmax_index

# --- fixed values -----------------------------------------------------------
# Adjacent class boundaries, applied in this order.
BOUNDARIES = [(1, 2), (2, 3), (3, 4), (4, 5)]
# Threshold grid: 90 evenly spaced points from 0.05 to 0.95 inclusive.
GRID_START, GRID_STOP, GRID_NUM = 0.05, 0.95, 90
REL_EPS = 1e-9
DEFAULT_THRESHOLD = 0.5
# Fixed single boundary threshold of the ensemble experiment (Moderate/Poor).
FIXED_MODERATE_POOR = 0.585
# --- end of fixed values ----------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def grid_value(i: Column, start=GRID_START, stop=GRID_STOP, num=GRID_NUM) -> Column:
    """Grid point i computed as i*step + start (last point exactly ``stop``),
    the arithmetic of an evenly spaced grid."""
    step = (stop - start) / (num - 1)
    return F.when(i == num - 1, F.lit(float(stop))).otherwise(
        i.cast("double") * F.lit(step) + F.lit(float(start)))


def grid_rank(r: Column, start=GRID_START, stop=GRID_STOP, num=GRID_NUM) -> Column:
    """Number of grid points strictly below ``r`` (0..num), exact: an
    arithmetic first guess corrected by one comparison on each side."""
    step = (stop - start) / (num - 1)
    k0 = F.least(F.greatest(F.floor((r - F.lit(start)) / F.lit(step)) + 1, F.lit(0)), F.lit(num))
    k1 = F.when((k0 > 0) & (grid_value(k0 - 1, start, stop, num) >= r), k0 - 1).otherwise(k0)
    k2 = F.when((k1 < num) & (grid_value(k1, start, stop, num) < r), k1 + 1).otherwise(k1)
    return k2.cast("int")


def relative_prob(probs: Column, low: int, high: int) -> Column:
    p_lo = F.element_at(probs, low + 1)
    p_hi = F.element_at(probs, high + 1)
    return p_hi / (p_lo + p_hi + F.lit(REL_EPS))


def apply_thresholds(df: DataFrame, probs: str, thresholds: list[tuple[int, int, float]],
                     out: str = "predicted") -> DataFrame:
    """OP-48: start from the argmax, then for each boundary in order move rows
    currently at low/high to high when p_high/(p_low+p_high+eps) > t, else to
    low. Rows can cascade through several boundaries. Each step is its own
    projection so the argmax is not re-evaluated per reference."""
    df = df.withColumn(out, argmax_index(F.col(probs)))
    for lo, hi, t in thresholds:
        rel = relative_prob(F.col(probs), lo, hi)
        df = df.withColumn(out, F.when(F.col(out).isin(lo, hi),
                                       F.when(rel > F.lit(float(t)), F.lit(hi)).otherwise(F.lit(lo)))
                                 .otherwise(F.col(out)).cast("int"))
    return df


def collect_thresholds(tuned: DataFrame) -> list[tuple[int, int, float]]:
    """The tuned table has exactly one row per boundary (four rows)."""
    rows = tuned.orderBy("ord").select("low", "high", "t").collect()
    return [(int(r["low"]), int(r["high"]), float(r["t"])) for r in rows]


def tune_thresholds(df: DataFrame, probs: str, label: str,
                    boundaries: list[tuple[int, int]] = BOUNDARIES,
                    start=GRID_START, stop=GRID_STOP, num=GRID_NUM) -> DataFrame:
    """OP-62: per boundary, the grid threshold maximising the mean of the two
    one-vs-rest F1 scores when only that boundary is re-decided from the
    argmax; first (smallest) maximum wins; 0.5 when no threshold scores above 0
    or no row sits at the boundary.

    No row is multiplied by the grid: each row at a boundary is reduced to the
    rank of its relative probability among the grid points, counts are
    aggregated per (boundary, rank), and the F1 of every grid point follows
    from running sums over the (boundaries x (num+1))-row count table.
    """
    spark = df.sparkSession
    nb = len(boundaries)
    lo_arr = F.array(*[F.lit(lo) for lo, _ in boundaries])
    hi_arr = F.array(*[F.lit(hi) for _, hi in boundaries])
    p = F.col(probs)
    y = F.col(label).cast("int")
    base = df.select(y.alias("y"), p.alias("p"), argmax_index(p).alias("a"))

    # Class supports over all rows (<= number of classes rows).
    support = base.groupBy(F.col("y").alias("cls")).agg(F.count(F.lit(1)).alias("n_cls"))

    masked = base.select(
        "y", "p", "a",
        F.explode(F.filter(F.array(*[F.lit(b) for b in range(nb)]),
                           lambda b: (F.element_at(lo_arr, b + 1) == F.col("a"))
                           | (F.element_at(hi_arr, b + 1) == F.col("a")))).alias("b"))
    masked = masked.withColumns({"lo": F.element_at(lo_arr, F.col("b") + 1),
                                 "hi": F.element_at(hi_arr, F.col("b") + 1)})
    p_lo = F.element_at(F.col("p"), F.col("lo") + 1)
    p_hi = F.element_at(F.col("p"), F.col("hi") + 1)
    masked = masked.withColumn("k", grid_rank(p_hi / (p_lo + p_hi + F.lit(REL_EPS)), start, stop, num))
    counts = masked.groupBy("b", "k").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.sum(F.when(F.col("y") == F.col("lo"), 1).otherwise(0)).alias("n_lo"),
        F.sum(F.when(F.col("y") == F.col("hi"), 1).otherwise(0)).alias("n_hi"))

    dense = spark.range(nb * (num + 1)).select(
        (F.col("id") / (num + 1)).cast("int").alias("b"),
        (F.col("id") % (num + 1)).cast("int").alias("k"))
    dense = dense.withColumns({"lo": F.element_at(lo_arr, F.col("b") + 1),
                               "hi": F.element_at(hi_arr, F.col("b") + 1)})
    t = (dense.join(counts, ["b", "k"], "left").na.fill(0, ["n_all", "n_lo", "n_hi"])
              .join(support.select(F.col("cls").alias("lo"), F.col("n_cls").alias("act_lo")), "lo", "left")
              .join(support.select(F.col("cls").alias("hi"), F.col("n_cls").alias("act_hi")), "hi", "left")
              .na.fill(0, ["act_lo", "act_hi"]))
    run = Window.partitionBy("b").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("b")
    t = t.withColumns({
        "cum_all": F.sum("n_all").over(run), "cum_lo": F.sum("n_lo").over(run),
        "cum_hi": F.sum("n_hi").over(run),
        "tot_all": F.sum("n_all").over(whole), "tot_hi": F.sum("n_hi").over(whole),
    })

    def f1(tp, pred, act):
        den = (pred + act).cast("double")
        return F.when(den > 0, (F.lit(2) * tp).cast("double") / den).otherwise(F.lit(0.0))

    t = t.where(F.col("k") < num).withColumns({
        "f1_lo": f1(F.col("cum_lo"), F.col("cum_all"), F.col("act_lo")),
        "f1_hi": f1(F.col("tot_hi") - F.col("cum_hi"), F.col("tot_all") - F.col("cum_all"),
                    F.col("act_hi")),
    }).withColumn("score", (F.col("f1_lo") + F.col("f1_hi")) / F.lit(2.0))
    best = Window.partitionBy("b").orderBy(F.col("score").desc(), F.col("k").asc())
    t = t.withColumn("__rn", F.row_number().over(best)).where(F.col("__rn") == 1)
    ok = (F.col("score") > 0) & (F.col("tot_all") > 0)
    return t.select(
        F.col("b").alias("ord"), F.col("lo").alias("low"), F.col("hi").alias("high"),
        F.when(ok, grid_value(F.col("k"), start, stop, num)).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("t"),
        F.when(ok, F.col("score")).otherwise(F.lit(0.0)).alias("best_score"),
        F.col("tot_all").cast("long").alias("n_at_boundary"))


def distance_probabilities(x, centers=(25.0, 75.0, 150.0, 250.0, 350.0, 450.0),
                           scale: float = 50.0) -> Column:
    """Class probabilities from a value by inverse-quadratic distance to one
    centre per category, normalised to sum 1: a model-free soft assignment
    written in plain arithmetic (so any SQL engine reproduces it bit for bit)."""
    v = _c(x)
    qs = []
    for c in centers:
        d = (v - F.lit(float(c))) / F.lit(float(scale))
        qs.append(F.lit(1.0) / (F.lit(1.0) + d * d))
    s = qs[0]
    for q in qs[1:]:
        s = s + q
    return F.array(*[q / s for q in qs])
