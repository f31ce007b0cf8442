"""Train/validation/test splits (OP-63 .. OP-67)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogcast.operators.timeseries import series_window


def chronological_split(df: DataFrame, train_frac: float = 0.70, val_end: float = 0.85,
                        key="series_key", date="Date", out: str = "split") -> DataFrame:
    """OP-64: per series, the first floor(n*0.70) rows are train, up to
    floor(n*0.85) validation, the rest test (row positions, 1-based).

    ``n`` is a window count over the same partitioning as the row number, so
    both come from one Window operator with no extra exchange.
    """
    w = series_window(key, date)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    pos = F.row_number().over(w)
    cut1 = F.floor(n.cast("double") * F.lit(float(train_frac)))
    cut2 = F.floor(n.cast("double") * F.lit(float(val_end)))
    return df.withColumn(out, F.when(pos <= cut1, F.lit("train"))
                                .when(pos <= cut2, F.lit("val"))
                                .otherwise(F.lit("test")))


def global_chronological_split(df: DataFrame, train_frac: float = 0.70, val_end: float = 0.85,
                              key="series_key", date="Date", out: str = "split") -> DataFrame:
    """OP-64, global form: all rows ordered by (date, key), first
    floor(n*0.70) train, up to floor(n*0.85) validation, rest test.

    No global sort: rows are counted per date (a table bounded by the
    calendar), running sums over that table give each date's offset, and a
    row's position is its date offset plus its rank among the rows of that
    date (a window partitioned by date)."""
    per_day = df.groupBy(date).agg(F.count(F.lit(1)).alias("__c"))
    run = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select(date, F.coalesce(F.sum("__c").over(run), F.lit(0)).alias("__off"),
                             F.sum("__c").over(Window.partitionBy()).alias("__n"))
    pos = F.col("__off") + F.row_number().over(Window.partitionBy(date).orderBy(key))
    j = df.join(offsets, date, "inner").withColumn("__pos", pos)
    n = F.col("__n").cast("double")
    return (j.withColumn(out, F.when(F.col("__pos") <= F.floor(n * F.lit(float(train_frac))), F.lit("train"))
                               .when(F.col("__pos") <= F.floor(n * F.lit(float(val_end))), F.lit("val"))
                               .otherwise(F.lit("test")))
             .drop("__off", "__n", "__pos"))


def cutoff_split(df: DataFrame, days: int = 180, key="series_key", date="Date",
                 out: str = "split") -> DataFrame:
    """OP-65: dates after (series max - ``days``) are test (strict >)."""
    mx = F.max(F.col(date)).over(Window.partitionBy(key))
    return df.withColumn(out, F.when(F.col(date) <= F.date_sub(mx, days), F.lit("train"))
                                .otherwise(F.lit("test")))


def split_summary(df: DataFrame, split: str = "split", key="series_key", date="Date") -> DataFrame:
    """OP-63: min/max date and row count per split."""
    return df.groupBy(key, split).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                                      F.count(F.lit(1)).alias("n_rows"))


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.15, seed: int = 42,
                     id_cols: tuple[str, ...] = ("series_key", "Date"), out: str = "split") -> DataFrame:
    """OP-66: stratified split with exact class counts: of each class's n rows,
    floor(n * test_frac + 0.5) are test, those first by a seeded MD5 of the row's
    identity (so the split doesn't depend on partitioning).

    No class is sorted as a whole: rows are counted per (class, hash bucket), the
    counts tell which bucket holds the class's last test row, and only that
    bucket's rows are ranked. A NULL label is a class of its own.
    """
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))))
    d = df.withColumns({"__h": h, "__b": F.conv(F.substring(h, 1, 4), 16, 10).cast("int")})
    hist = d.groupBy(F.col(label).alias("__l"), F.col("__b").alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    run = Window.partitionBy("__l").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    goal = F.floor(F.sum("__n").over(Window.partitionBy("__l")) * F.lit(float(test_frac)) + F.lit(0.5))
    cut = (hist.withColumns({"__before": F.coalesce(F.sum("__n").over(run), F.lit(0)), "__goal": goal})
           .where((F.col("__before") < F.col("__goal")) & (F.col("__goal") <= F.col("__before") + F.col("__n")))
           .select("__l", "__c", (F.col("__goal") - F.col("__before")).alias("__room")))
    d = d.join(cut, d[label].eqNullSafe(cut["__l"]), "left").drop("__l")
    clear = d.where(F.col("__c").isNull() | (F.col("__b") != F.col("__c"))).withColumn(
        out, F.when(F.col("__b") < F.col("__c"), F.lit("test")).otherwise(F.lit("train")))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("__h", *id_cols))
    edge = d.where(F.col("__b") == F.col("__c")).withColumn(
        out, F.when(rank <= F.col("__room"), F.lit("test")).otherwise(F.lit("train")))
    return clear.unionByName(edge).drop("__h", "__b", "__c", "__room")
