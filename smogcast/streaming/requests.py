"""OP-82: scoring a stream of requested dates.

The request endpoint of the reference is naturally a stream of keys. Here a
file source of request records feeds ``foreachBatch``: each micro-batch is
scored by :func:`smogcast.plans.scoring.score_requests` against context tables
(stream-static joins) and appended to a parquet sink.

* Repeated requests are scored once: ``dropDuplicatesWithinWatermark`` keeps the
  ids of the last ``remember`` of arrival time in the state store (checkpointed, so a
  restart remembers them). Arrival is the batch's own clock, hence no request is
  ever late, and a replayed batch has the clock of its first run. Requests without
  an id are told apart by series and date.
* The context is computed once from ``obs``, or comes in published versions:
  every micro-batch looks for the newest complete one and reloads on change.
* The checkpoint location records source offsets, so a restarted query resumes
  where it stopped; each batch id owns a partition of the sink and rewrites it when
  replayed. ``rebalance`` lets the adaptive plan write few files of even size, and
  :func:`compact_sink` merges those of finished batches.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.operators.climatology import ClosedCalendar
from smogcast.plans.scoring import context_tables, score_requests

REQUEST_SCHEMA = "request_id long, series_key string, date string"


# ---- versions of the context ---------------------------------------------------
def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names below ``path``, in whatever store it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def latest_context(spark: SparkSession, path: str) -> int | None:
    """Newest version whose publication ended."""
    done = [int(n) for n in _folders(spark, path) if n.isdigit() and "meta" in _folders(spark, f"{path}/{n}")
            and "_SUCCESS" in _folders(spark, f"{path}/{n}/meta")]
    return max(done, default=None)


def publish_context(obs: DataFrame, path: str) -> int:
    """Writes the context of ``obs`` as the next version; readers see it once its ``meta``, the last part, is there."""
    spark = obs.sparkSession
    version = max([int(n) for n in _folders(spark, path) if n.isdigit()], default=0) + 1
    ctx = context_tables(obs)
    calendar = ctx.pop("calendar")
    for name, table in {**ctx, "calendar": calendar.table}.items():
        table.write.parquet(f"{path}/{version}/{name}")
    meta = {"cols": calendar.cols, "raw": list(calendar.raw), "fills": calendar.fills, "key": calendar.key, "tables": sorted(ctx)}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.json(f"{path}/{version}/meta")
    return version


def load_context(spark: SparkSession, path: str, version: int) -> dict:
    meta = json.loads(spark.read.json(f"{path}/{version}/meta").first()["meta"])
    ctx = {n: spark.read.parquet(f"{path}/{version}/{n}") for n in meta["tables"]}
    calendar = ClosedCalendar(spark.read.parquet(f"{path}/{version}/calendar"), meta["cols"], tuple(meta["raw"]), meta["fills"], meta["key"])
    return {**ctx, "calendar": calendar}


# ---- the query --------------------------------------------------------------------
def start_request_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                         obs: DataFrame | None, model, fmt: str = "json", available_now: bool = True,
                         max_files_per_trigger: int | None = None, remember: str = "1 day",
                         context_dir: str | None = None):
    """Starts the query over ``obs``, or over the versions published in ``context_dir``."""
    held: dict = {"version": None, "ctx": None}
    if context_dir is None:
        held["ctx"] = context_tables(obs)
    reader = spark.readStream.schema(REQUEST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    same = F.coalesce(F.col("request_id").cast("string"), F.concat_ws(":", F.lit("none"), "series_key", "date"))
    stream = (stream.withColumns({"__arrived": F.current_timestamp(), "__same": same}).withWatermark("__arrived", remember)
              .dropDuplicatesWithinWatermark(["__same"]).drop("__same", "__arrived"))

    def context(session: SparkSession) -> dict:
        if context_dir is not None:
            version = latest_context(session, context_dir)
            if version is None:
                raise ValueError(f"no published context in {context_dir}")
            if version != held["version"]:
                held.update(version=version, ctx=load_context(session, context_dir, version))
        return held["ctx"]

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        out = score_requests(batch, None, model, context(batch.sparkSession)).withColumn("batch_id", F.lit(batch_id))
        # Overwrite this batch's own partition: a replayed batch id rewrites
        # the same output instead of appending duplicates.
        (out.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(sink_dir))

    w = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# ---- the sink -----------------------------------------------------------------------
def _compacted(spark: SparkSession, sink_dir: str) -> int | None:
    """Last batch that the newest finished compaction holds."""
    done = [int(n) for n in _folders(spark, f"{sink_dir}/_compact") if n.isdigit()
            and "_SUCCESS" in _folders(spark, f"{sink_dir}/_compact/{n}")]
    return max(done, default=None)


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Every response once: the newest compaction and the batches after it."""
    upto, parts = _compacted(spark, sink_dir), []
    if upto is not None:
        parts.append(spark.read.parquet(f"{sink_dir}/_compact/{upto}"))
    if any(n.startswith("batch_id=") for n in _folders(spark, sink_dir)):
        own = spark.read.parquet(sink_dir)
        parts.append(own if upto is None else own.where(F.col("batch_id") > upto))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact_sink(spark: SparkSession, sink_dir: str, remove: bool = False) -> int:
    """Merges all batches so far into few files in order of request; readers by :func:`read_sink` see either form, never both.

    Run it while no batch is being written. ``remove`` deletes the merged
    batches' own partitions, after the compaction is complete.
    """
    table = read_sink(spark, sink_dir)
    upto = int(table.agg(F.max("batch_id")).first()[0])
    if _compacted(spark, sink_dir) != upto:
        table.hint("rebalance").sortWithinPartitions("request_id").write.mode("overwrite").parquet(f"{sink_dir}/_compact/{upto}")
    if remove:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(sink_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for name in _folders(spark, sink_dir):
            if name.startswith("batch_id=") and int(name[9:]) <= upto:
                fs.delete(hadoop(f"{sink_dir}/{name}"), True)
    return upto
