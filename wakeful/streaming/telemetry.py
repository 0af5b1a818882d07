"""Structured Streaming versions of the grid and of request scoring.

T1: tumbling per-user means with a watermark; windows are emitted in append mode
once the watermark (max event time - delay) passes their end, so state is bounded
by the delay. Readings within the delay are never lost; readings older than the
watermark may still be counted (Spark guarantees only the first direction). The
batch original has no late data, so this rule is ours.
T2: each request carries its own history, so scoring needs no state: every
micro-batch goes through the batch function in ``foreachBatch`` and is appended
to a Parquet sink (idempotent per batch id through the checkpoint).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.session import scratch_path
from wakeful.settings import FeatureSettings
from wakeful.sources.feeds import HR_TYPES


def table_stream(spark: SparkSession, folder: str, schema, name: str | None = None, max_files: int | None = None) -> DataFrame:
    """Stream of the Parquet files of a folder (optionally only ``<name>.parquet``)."""
    r = spark.readStream.schema(schema)
    if name:
        r = r.option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def hr_stream(spark: SparkSession, folder: str, schema, name: str | None = "events") -> DataFrame:
    """Readings stream from a Parquet folder of events."""
    ev = table_stream(spark, folder, schema, name)
    return ev.where(F.col("event_type").isin(*HR_TYPES)).select(
        "user_id", F.col("ts").alias("HRTIME"), F.col("value").alias("HR")
    )


def minute_grid_stream(hr: DataFrame, s: FeatureSettings, window: str = "1 minute", delay: str = "15 minutes") -> DataFrame:
    """(user_id, window start) -> mean HR and reading count.

    A watermark needs a TIMESTAMP event time, so the naive time is cast (the
    session zone is UTC, so the instant equals the wall clock)."""
    lo, hi = s.hr_limits
    x = hr.where((F.col("HR") > lo) & (F.col("HR") < hi)).withColumn("event_time", F.col("HRTIME").cast("timestamp"))
    x = x.withWatermark("event_time", delay)
    # Two aggregations in a row: readings with the same time count as their mean, as in
    # the batch grid. State is a sum and a count for each time the watermark hasn't
    # passed, then for each open window, however many readings share a time.
    per_time = x.groupBy("user_id", "event_time").agg(F.avg("HR").alias("HR"), F.count(F.lit(1)).alias("n"))
    g = per_time.groupBy("user_id", F.window("event_time", window).alias("w")).agg(F.avg("HR").alias("HR"), F.sum("n").alias("n_readings"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("HRTIME"), "HR", "n_readings")


def run_to_table(
    stream: DataFrame, name: str, mode: str = "append", foreach: Callable | None = None, out: str | None = None, checkpoint: str | None = None
) -> str:
    """Run a stream until the available input is consumed (``availableNow``) into a
    Parquet folder; returns the folder. With ``out`` and ``checkpoint`` of an earlier
    run it goes on where that run ended; without, both are new folders under the
    shared checkpoint folder."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach is None:
        q = w.outputMode(mode).format("parquet").option("path", out).start()
    else:
        q = w.foreachBatch(lambda batch, batch_id: foreach(batch, batch_id, out)).start()
    q.awaitTermination()
    return out


def score_stream(
    requests: DataFrame,
    score_batch: Callable[[DataFrame], DataFrame],
    name: str = "requests",
    out: str | None = None,
    checkpoint: str | None = None,
) -> str:
    """Apply the batch scorer to every micro-batch of requests; restarts as
    :func:`run_to_table`."""

    def sink(batch: DataFrame, batch_id: int, out: str) -> None:
        # one folder per batch id: a replayed batch overwrites its own output
        score_batch(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return run_to_table(requests, name, foreach=sink, out=out, checkpoint=checkpoint)
