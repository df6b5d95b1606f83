"""Streaming roll-ups of the attempt log.

Sources are directories of attempt files read as file streams. Sinks go through
``foreachBatch`` into Parquet tables so that nothing is collected on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import backoff_reason
from .arrivals import first_arrivals, rocksdb, setting


def attempt_stream(spark: SparkSession, source_dir: str, schema, files_per_trigger: int = 1):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(source_dir))


def _versions(path: str, keep: int = 2):
    """Each batch writes a version of its own; all but the last ``keep`` are then deleted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        spark = batch.sparkSession
        for no in _complete(spark, path)[:-keep]:
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={no}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return write


def _complete(spark: SparkSession, path: str) -> list[int]:
    """Versions whose write was committed, oldest first."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def read_state_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version: a reader never meets a table that is being replaced."""
    versions = _complete(spark, path)
    return spark.read.parquet(f"{path}/version={versions[-1]}") if versions else spark.createDataFrame([], "state string, rows long")


def _append_batches(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return write


def start_state_counts(stream: DataFrame, out: str, checkpoint: str):
    """Running count per state; complete output mode, a new version of the table per batch (``read_state_counts``)."""
    counts = stream.groupBy("state").agg(F.count(F.lit(1)).alias("rows"))
    return (counts.writeStream.outputMode("complete").foreachBatch(_versions(out))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_daily_status(stream: DataFrame, out: str, checkpoint: str,
                       watermark: str = "1 day", hour: int = C.DAILY_STATUS_HOUR_UTC):
    """I4: per-state counts per UTC day ending at ``hour``:00; rows later than the watermark
    are dropped. Update mode: every batch writes the windows it changed."""
    ev = stream.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark(
        "event_time", watermark)
    day = F.window("event_time", "1 day", "1 day", f"{hour} hours")
    per_day = ev.groupBy(day.alias("w"), "state").agg(F.count(F.lit(1)).alias("rows"))
    return (per_day.select(F.col("w.end").alias("day_end"), "state", "rows")
            .writeStream.outputMode("update").foreachBatch(_append_batches(out))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_daily_status(spark: SparkSession, out: str) -> DataFrame:
    """Latest count per (day, state) from the sink, then the running total per state (streams
    allow no row-based window, so it is taken here on the small result)."""
    t = spark.read.parquet(out)
    latest = t.groupBy("day_end", "state").agg(F.max_by("rows", "batch_id").alias("rows"))
    run = Window.partitionBy("state").orderBy("day_end").rowsBetween(Window.unboundedPreceding, 0)
    return latest.select(F.col("day_end").cast("timestamp_ntz").alias("day_end"), "state", "rows",
                         F.sum("rows").over(run).alias("cumulative_rows"))


def start_dedupe(stream: DataFrame, key: str, out: str, checkpoint: str,
                 watermark: str | None = None, bitmap: bool = False):
    """I8: one output row per key however often it arrives.

    With ``bitmap`` the keys, whole numbers from 0, are kept as a bit each (``arrivals``), which a dense
    key fills to an eighth of a byte. Else the state store holds every key, for ever, or with a
    ``watermark`` for that delay, within which keys are then deduplicated.
    """
    spark = stream.sparkSession
    if bitmap:
        dedup = first_arrivals(stream, key)
    elif watermark:
        ev = stream.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark(
            "event_time", watermark)
        dedup = ev.dropDuplicatesWithinWatermark([key]).drop("event_time")
    else:
        dedup = stream.dropDuplicates([key])
    with rocksdb(spark):
        return (dedup.writeStream.outputMode("append").foreachBatch(_append_batches(out))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_backoff_spans(stream: DataFrame, out: str, checkpoint: str, backoff_seconds: int = C.THROTTLE_BACKOFF_SECONDS,
                        watermark: str = "10 minutes"):
    """I7 as a stream: gate-closed spans ``(span_start, span_end, hits)``, each written once when the watermark
    (over all attempts, not only those that close the gate) has passed its end.

    The state holds the spans that are still open; a hit that comes later than the watermark is dropped. There is
    one gate, so one key: tasks merge the hits of a span before they send it, which leaves a row per task and span.
    """
    spark = stream.sparkSession
    ev = stream.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", watermark)
    # other attempts have a gap of nought, which belongs to no session: a filter would be pushed below the watermark
    hit = (F.col("state") == C.FAILED) & backoff_reason(F.col("message")).isNotNull()
    span = F.session_window("event_time", F.when(hit, f"{backoff_seconds} seconds").otherwise("0 seconds"))
    closed = ev.groupBy(span.alias("w"), F.lit(C.FAILED) == F.col("state")).agg(F.count(F.lit(1)).alias("hits"))
    to_ts = lambda c: F.col(c).cast("timestamp_ntz")
    with setting(spark, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"):
        return (closed.select(to_ts("w.start").alias("span_start"), to_ts("w.end").alias("span_end"), "hits")
                .writeStream.outputMode("append").foreachBatch(_append_batches(out))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
