"""Tables, lineage cuts and connected components shared by the operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where nothing is set (tests)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session is gone; the folder belongs to the cluster's clean-up
        pass


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation. The files go when
    the Python process ends, since callers hold lazy frames over them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def own_names(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` with every column but ``keep`` renamed by position, so that helper columns clash with none."""
    return docs.toDF(*[c if c in keep else f"_x{i}" for i, c in enumerate(docs.columns)])


def numbered(docs: DataFrame, *keep: str) -> DataFrame:
    """``own_names`` with a number ``_row`` of each row, written down so that it stays."""
    return stored(own_names(docs, *keep).withColumn("_row", F.monotonically_increasing_id()))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable over undirected ``edges`` (src, dst).

    Alternating large-star and small-star steps; every step is a grouped minimum
    and an equi-join, so a hub is pre-aggregated and its join side can be split.
    Ids without an edge to another id are not returned.
    """
    e = stored(edges.select("src", "dst").where("src <> dst")
               .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    before = _signature(e)
    while before[0]:
        both = e.union(e.select("dst", "src"))
        low = both.groupBy("src").agg(F.min(F.least("src", "dst")).alias("low"))
        e = (both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
             .union(both.where("dst < src").groupBy("src").agg(F.min("dst").alias("dst")))
             .where("src <> dst").distinct())
        low = e.groupBy("src").agg(F.min("dst").alias("low"))
        e = stored(e.join(low, "src").select(F.explode(F.array(
            F.struct("src", F.col("low").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("low").alias("dst"))))
            .alias("e")).select("e.src", "e.dst").where("src <> dst").distinct())
        after = _signature(e)
        if after == before:
            break
        before = after
    return e.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("component_id")).union(
        e.select(F.col("dst").alias("id"), F.col("dst").alias("component_id")).distinct()).groupBy("id").agg(
        F.min("component_id").alias("component_id"))
