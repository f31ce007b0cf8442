"""Min-max scaling fitted on one part, applied to another (OP-76)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_minmax(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    """Per-key (or global) minimum and range of each column. A constant column
    gets range 1, so it scales to 0 (MLlib's MinMaxScaler would give the
    midpoint instead). One aggregate; output bounded by the number of keys."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    g = df.groupBy(key) if key else df.groupBy()
    st = g.agg(*aggs)
    return st.select(*([key] if key else []), *[
        x for c in cols for x in (
            F.col(f"{c}__min"),
            F.when((F.col(f"{c}__max") - F.col(f"{c}__min")) == 0, F.lit(1.0))
             .otherwise(F.col(f"{c}__max") - F.col(f"{c}__min")).alias(f"{c}__range"))])


def transform_minmax(df: DataFrame, stats: DataFrame, cols: list[str], key: str | None = None,
                     suffix: str = "_scaled") -> DataFrame:
    if key:
        j = df.join(stats, key, "left")
    else:
        vals = stats.collect()[0].asDict()   # one row: 2 values per column
        j = df.withColumns({k: F.lit(v) for k, v in vals.items()})
    out = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"{c}__min")) / F.col(f"{c}__range")
                         for c in cols})
    return out


def inverse_minmax(df: DataFrame, stats: DataFrame, scaled: str, source: str, out: str,
                   key: str | None = None) -> DataFrame:
    """Inverse transform of one scaled column with the statistics of
    ``source`` (the target's own scaler)."""
    if f"{source}__min" not in df.columns:
        df = df.join(stats.select(key, f"{source}__min", f"{source}__range"), key, "left")
    res = df.withColumn(out, F.col(scaled) * F.col(f"{source}__range") + F.col(f"{source}__min"))
    return res.drop(*[c for c in res.columns if "__" in c])
