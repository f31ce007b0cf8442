"""Mixing sources to target weights by capped water-filling.

Targets: every source starts with its weight's share of the wanted words; a
source above ``epochs`` times its own size is clamped there and the excess is
dealt out again by weight among the others, until no target is above its cap.
Sampling: ``floor(target / source size)`` whole repetitions of every document,
then a fractional one: documents in the order of a seeded hash until the
remainder is used up, the last one in part. The order is a histogram of hash
buckets per source (a few thousand rows), and only documents of the bucket that
holds the end are ranked, so no source is sorted or gathered as a whole.

Edge cases: a null text has size 0; a null source is a source of its own, last;
sources without words have target 0; an empty table gives no rows; repeated rows
are documents of their own; other columns are carried along by ``mix``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogcast.llm import common, text

SHARE, EPOCHS, SEED, BUCKETS = 1.5, 2.0, 17, 16384
WEIGHTS = (3.0, 1.0, 2.0)


def _sizes(batches):
    for rows, raw, at in text.pieces(batches, "_text"):
        n = rows.num_rows
        _, _, doc = text.words(raw, at)
        rest = rows.drop_columns(["_text"])
        yield rest.append_column("size", pa.array(np.bincount(doc, minlength=n), pa.int64()))


def sizes(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``size``, the number of words of every text."""
    d = docs.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([f for f in d.schema if f.name != "_text"] + [T.StructField("size", T.LongType())])
    return d.mapInArrow(_sizes, schema)


def weights_in_turn(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(source, weight): ``weights`` in turn by code point order, null last. One row per source is ordered."""
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    return sources.select("source").distinct().withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))


def water_fill(sources: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """``target`` for (source, weight, source_size); one aggregate row a round comes to the driver."""
    s = sources.withColumn("cap", F.lit(float(epochs)) * F.col("source_size")).withColumn("clamped", F.lit(False))
    wanted = None
    while True:
        total, held, free, n = s.agg(
            F.sum("source_size"), F.sum(F.when(F.col("clamped"), F.col("cap"))),
            F.sum(F.when(~F.col("clamped"), F.col("weight"))), F.count(F.when(F.col("clamped"), 1))).first()
        wanted = share * float(total or 0)
        level = max(0.0, wanted - float(held or 0)) / free if free else 0.0
        s = s.withColumn("target", F.when(F.col("clamped"), F.col("cap")).otherwise(F.col("weight") * F.lit(level)))
        over = s.where(~F.col("clamped") & (F.col("target") > F.col("cap"))).count()
        if not over:
            return s.drop("cap", "clamped")
        s = common.stored(s.withColumn("clamped", F.col("clamped") | (F.col("target") > F.col("cap"))).drop("target"))


def taken(docs: DataFrame, *keep: str, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED,
          weights: DataFrame | None = None) -> DataFrame:
    """doc_id, source, ``keep``, size, source_size, target and taken words of every row.

    ``weights`` (source, weight) may be given. ``whole`` repetitions and ``part``
    words of a last one add up to ``taken``.
    """
    d = common.stored(sizes(docs, "doc_id", "source", *keep).withColumn("_h", F.xxhash64("doc_id", F.lit(seed)))
                      .withColumn("_b", F.pmod("_h", F.lit(BUCKETS)).cast("int")))
    hist = common.stored(d.groupBy("source", "_b").agg(F.sum("size").alias("_n")))
    per = hist.groupBy("source").agg(F.sum("_n").alias("source_size"))
    w = weights if weights is not None else weights_in_turn(per)
    w = w.withColumnRenamed("source", "_s")
    per = per.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0.0, ["weight"])
    plan = water_fill(common.stored(per), share, epochs)
    plan = (plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                            .otherwise(0).cast("long"))
            .withColumn("_left", F.floor(F.col("target") + 1e-9).cast("long") - F.col("whole") * F.col("source_size")))
    plan = common.stored(plan.select(F.col("source").alias("_s"), "source_size", "target", "whole", "_left"))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = (hist.withColumn("_c", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .join(plan.select("_s", "_left"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .where((F.col("_c") <= F.col("_left")) & (F.col("_c") + F.col("_n") > F.col("_left")))
            .select(F.col("source").alias("_s"), F.col("_b").alias("_end"), F.col("_left") - F.col("_c")))
    ends = ends.toDF("_s", "_end", "_room")
    plan = common.stored(plan.withColumnRenamed("_s", "_p").join(ends, F.col("_p").eqNullSafe(F.col("_s")), "left")
                         .drop("_s").withColumnRenamed("_p", "_s"))
    d = d.join(plan, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    inside = d.where(F.col("_b") != F.coalesce("_end", F.lit(-1)))
    full = F.when((F.col("_left") > 0) & (F.col("_end").isNull() | (F.col("_b") < F.col("_end"))), F.col("size"))
    inside = inside.withColumn("part", F.coalesce(full, F.lit(0)))
    run = Window.partitionBy("source").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = d.where(F.col("_b") == F.col("_end")).withColumn("_c", F.coalesce(F.sum("size").over(run), F.lit(0)))
    edge = edge.withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("_room") - F.col("_c")))).drop("_c")
    return inside.unionByName(edge).select("doc_id", "source", *keep, "size", "source_size", "target", "whole", "part",
                                           (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def _first_words(batches):
    for batch in batches:
        for rows, raw, at in text.pieces([batch]):
            part = rows.column("_part").to_numpy(zero_copy_only=False)
            _, ends, doc = text.words(raw, at)
            first = np.searchsorted(doc, np.arange(rows.num_rows))
            out = []
            for i, n in enumerate(part):
                a = at[i]
                z = at[i + 1] if n < 0 else (ends[first[i] + n - 1] if n else a)
                out.append(raw[a:z].tobytes().decode())
            names = [n for n in rows.schema.names if n != "_part"]
            cols = [pa.array(out, pa.string()) if n == "text" else rows.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: whole copies of every document, then fractional ones cut after their taken words.

    What is taken of a row follows from its source's plan, so texts stay where they
    are; only those of the buckets that hold a source's end are moved and ranked.
    """
    d = common.own_names(docs, "doc_id", "source", "text")
    names = d.columns
    plan = taken(d, *[c for c in names if c not in ("doc_id", "source")], **options)
    last = F.col("part").cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), F.col("whole").cast("int")),
                      F.when(last > 0, F.array(last)).otherwise(F.array().cast("array<int>")))
    rows = plan.select(*names, F.explode(copies).alias("_part"))
    return rows.mapInArrow(_first_words, rows.drop("_part").schema).toDF(*docs.columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")
