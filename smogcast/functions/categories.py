"""Ordered health categories: breakpoints, names, colours, advice (OP-32, OP-46)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the published scale) -------------------------
# Inclusive upper breakpoints of categories 0..4; anything above (or null/NaN)
# is category 5.
BREAKPOINTS = [50.0, 100.0, 200.0, 300.0, 400.0]
CATEGORY_NAMES = ["Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"]
CATEGORY_COLORS = ["#4ade80", "#facc15", "#fb923c", "#f87171", "#a855f7", "#881337"]
DEFAULT_COLOR = "#000000"
ADVICE = [
    ("Good", "Excellent Air Quality",
     "Air quality is considered satisfactory, and air pollution poses little or no risk. "
     "Perfect time for outdoor exercises and recreational activities."),
    ("Satisfactory", "Satisfactory Air Quality",
     "Air quality is acceptable. However, minor health effects may occur for extremely "
     "sensitive individuals. Enjoy the day outdoors!"),
    ("Moderate", "Moderate Health Alert",
     "Sensitive individuals might experience minor breathing discomfort. Consider reducing "
     "intense outdoor workouts if you experience fatigue or irritation."),
    ("Poor", "Active Pollution Warning",
     "May cause breathing discomfort to most people on prolonged exposure. People with heart "
     "or lung diseases should limit prolonged outdoor exertion."),
    ("Very Poor", "Severe Health Precaution",
     "Significant health risk for everyone. Everyone may experience respiratory discomfort on "
     "prolonged exposure. Avoid strenuous outdoor activities; keep windows closed."),
    ("Severe", "Emergency Health Hazard",
     "Extremely critical condition. Serious respiratory impact even on healthy people. Stay "
     "indoors, run air purifiers, and wear certified N95 masks if outdoor travel is essential."),
]
DEFAULT_ADVICE = ("Unknown Air Condition", "No guidance available.")
# Alarm level used by the stage-2 features.
ALARM_LEVEL = 200.0
# --- end of fixed values ----------------------------------------------------


def aqi_category(value: Column | str) -> Column:
    """Category code 0..5 from the inclusive-upper breakpoints.

    A ``when`` chain, not ``Bucketizer``: the scale's buckets are closed on the
    right. NULL (and NaN, which compares false) falls through to 5, as in the
    reference's if/elif chain.
    """
    v = F.col(value) if isinstance(value, str) else value
    expr = F.lit(5)
    for code in range(len(BREAKPOINTS) - 1, -1, -1):
        expr = F.when(v <= F.lit(BREAKPOINTS[code]), F.lit(code)).otherwise(expr)
    return expr.cast("int")


def category_name(code: Column | str) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return F.element_at(F.array(*[F.lit(n) for n in CATEGORY_NAMES]), c + 1)


def category_color(code: Column | str) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return F.coalesce(
        F.element_at(F.array(*[F.lit(n) for n in CATEGORY_COLORS]),
                     F.when((c >= 0) & (c < len(CATEGORY_COLORS)), c + 1)),
        F.lit(DEFAULT_COLOR))


def category_dim(spark: SparkSession) -> DataFrame:
    """Six-row dimension: code, name, lower (exclusive), upper (inclusive), colour,
    advice title and text. Fixed size, so it is always safe to broadcast."""
    rows = []
    for code, name in enumerate(CATEGORY_NAMES):
        lower = None if code == 0 else BREAKPOINTS[code - 1]
        upper = BREAKPOINTS[code] if code < len(BREAKPOINTS) else None
        rows.append((code, name, lower, upper, CATEGORY_COLORS[code], ADVICE[code][1], ADVICE[code][2]))
    schema = T.StructType([
        T.StructField("code", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("lower", T.DoubleType(), True),
        T.StructField("upper", T.DoubleType(), True),
        T.StructField("color", T.StringType(), False),
        T.StructField("advice_title", T.StringType(), False),
        T.StructField("advice_text", T.StringType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def with_category_info(df: DataFrame, code_col: str, spark: SparkSession | None = None,
                       prefix: str = "") -> DataFrame:
    """Left-join the six-row dimension (broadcast) and default unknown codes."""
    spark = spark or df.sparkSession
    dim = category_dim(spark).select(
        F.col("code").alias("__code"),
        F.col("name").alias(f"{prefix}category_name"),
        F.col("color").alias(f"{prefix}color"),
        F.col("advice_title").alias(f"{prefix}advice_title"),
        F.col("advice_text").alias(f"{prefix}advice_text"),
    )
    out = df.join(F.broadcast(dim), df[code_col] == dim["__code"], "left").drop("__code")
    return (out
            .withColumn(f"{prefix}color", F.coalesce(F.col(f"{prefix}color"), F.lit(DEFAULT_COLOR)))
            .withColumn(f"{prefix}advice_title",
                        F.coalesce(F.col(f"{prefix}advice_title"), F.lit(DEFAULT_ADVICE[0])))
            .withColumn(f"{prefix}advice_text",
                        F.coalesce(F.col(f"{prefix}advice_text"), F.lit(DEFAULT_ADVICE[1]))))
