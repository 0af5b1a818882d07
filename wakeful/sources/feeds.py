"""Driver tables and the telemetry feeds derived from them.

The test data carries no heart-rate/sleep/reaction-time files, so the feeds are
views over ``events`` (FIXTURES.md §2). The same definitions exist as SQL in the
oracle, so Spark and DuckDB start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeful.functions.scalar import ts_us, us_to_ts

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

HR_TYPES = ("click", "purchase", "signup")  # fixed mapping of event types to feeds
SLEEP_TYPE = "view"
PVT_TYPE = "error"
SLEEP_US_PER_VALUE = 720_000_000  # value / 5 hours, in µs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hr_feed(events: DataFrame) -> DataFrame:
    """user_id, HRTIME, HR."""
    return events.where(F.col("event_type").isin(*HR_TYPES)).select(
        "user_id", F.col("ts").alias("HRTIME"), F.col("value").alias("HR")
    )


def sleep_feed(events: DataFrame) -> DataFrame:
    """user_id, START, END (END = event time, START = END - value/5 hours)."""
    span = F.round(F.col("value") * SLEEP_US_PER_VALUE).cast("long")
    return events.where(F.col("event_type") == SLEEP_TYPE).select(
        "user_id", us_to_ts(ts_us("ts") - span).alias("START"), F.col("ts").alias("END")
    )


def pvt_feed(events: DataFrame) -> DataFrame:
    """user_id, TESTSTART, TESTID, TAPTIME (value * 6 ms)."""
    return events.where(F.col("event_type") == PVT_TYPE).select(
        "user_id",
        F.col("ts").alias("TESTSTART"),
        F.col("event_id").alias("TESTID"),
        (F.col("value") * 6).alias("TAPTIME"),
    )


def scored_feed(lineitem: DataFrame) -> DataFrame:
    """A scored table for the metric operators: y_true = l_discount*10,
    y_pred = (l_quantity - 1)/49. (l_orderkey, l_linenumber) is not unique."""
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_discount") * 10).alias("y_true"),
        ((F.col("l_quantity") - 1) / 49).alias("y_pred"),
    )


def kb_feed(embeddings: DataFrame, size: int = 5) -> DataFrame:
    """Knowledge base: the ``size`` lowest vec_id rows (a top-k that is the feature;
    its size is a fixed parameter, so it may be broadcast)."""
    return embeddings.orderBy("vec_id").limit(size).select("vec_id", "embedding")


def events_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = table(spark, sf_dir, "events")
    return {"hr": hr_feed(ev), "sleep": sleep_feed(ev), "pvt": pvt_feed(ev)}
