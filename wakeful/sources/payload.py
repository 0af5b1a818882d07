"""Request payloads (S8): JSON documents with an HR history and a sleep history.

A request is ``{"hr_history": [{"HRTIME": str, "HR": float}, ...],
"sleep_history": [{"START": str, "END": str}, ...]}``; a table (or stream) of
them is parsed with ``from_json`` and exploded into feed rows keyed by request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

HR_POINT = StructType([StructField("HRTIME", StringType()), StructField("HR", DoubleType())])
SLEEP_POINT = StructType([StructField("START", StringType()), StructField("END", StringType())])
REQUEST = StructType(
    [StructField("hr_history", ArrayType(HR_POINT)), StructField("sleep_history", ArrayType(SLEEP_POINT))]
)


def parse_payload(requests: DataFrame, json_col: str = "payload", key: str = "request_id") -> DataFrame:
    """Parse the JSON column once; returns key + ``req`` struct."""
    return requests.select(key, F.from_json(json_col, REQUEST).alias("req"))


def payload_hr(parsed: DataFrame, key: str = "request_id") -> DataFrame:
    """HR rows of every request (position kept as ``pos`` for 'last in input')."""
    return parsed.select(key, F.posexplode("req.hr_history").alias("pos", "p")).select(
        key, "pos", F.col("p.HRTIME").alias("HRTIME"), F.col("p.HR").alias("HR")
    )


def payload_sleep(parsed: DataFrame, key: str = "request_id") -> DataFrame:
    return parsed.select(key, F.explode("req.sleep_history").alias("p")).select(
        key, F.col("p.START").alias("START"), F.col("p.END").alias("END")
    )


def request_rows(hr: DataFrame, sleep: DataFrame, day_us: int, lookback_days: int = 3) -> tuple[DataFrame, DataFrame]:
    """Feed rows keyed by request (user, day): the day's readings and the sleeps that
    ended in the day or the ``lookback_days - 1`` days before."""
    day = F.floor(F.unix_micros(F.col("HRTIME").cast("timestamp")) / day_us).cast("long")
    h = hr.withColumn("day", day).withColumn("request_id", F.concat_ws("-", F.col("user_id").cast("string"), F.col("day").cast("string")))
    sday = F.floor(F.unix_micros(F.col("END").cast("timestamp")) / day_us).cast("long")
    s = sleep.withColumn("_d", sday).withColumn("day", F.explode(F.sequence(F.col("_d"), F.col("_d") + lookback_days - 1)))
    s = s.drop("_d").withColumn("request_id", F.concat_ws("-", F.col("user_id").cast("string"), F.col("day").cast("string")))
    s = s.join(h.select("request_id").distinct(), "request_id", "left_semi")
    return h, s


def build_requests(hr: DataFrame, sleep: DataFrame, day_us: int, lookback_days: int = 3) -> DataFrame:
    """Requests from feed tables: one per (user, day) with that day's HR readings and
    the sleeps that ended in the day or the ``lookback_days - 1`` days before.
    Each request is bounded by one day of readings, never a whole user history."""
    day = F.floor(F.unix_micros(F.col("HRTIME").cast("timestamp")) / day_us).cast("long")
    h = hr.withColumn("day", day)
    hr_req = h.groupBy("user_id", "day").agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("HRTIME").cast("string").alias("HRTIME"), F.col("HR").alias("HR")))
        ).alias("hr_history")
    )
    sday = F.floor(F.unix_micros(F.col("END").cast("timestamp")) / day_us).cast("long")
    s = sleep.withColumn("_d", sday).withColumn("day", F.explode(F.sequence(F.col("_d"), F.col("_d") + lookback_days - 1)))
    sl_req = s.groupBy("user_id", "day").agg(
        F.sort_array(
            F.collect_list(
                F.struct(F.col("START").cast("string").alias("START"), F.col("END").cast("string").alias("END"))
            )
        ).alias("sleep_history")
    )
    req = hr_req.join(sl_req, ["user_id", "day"], "left")
    return req.select(
        F.concat_ws("-", "user_id", "day").alias("request_id"),
        "user_id",
        "day",
        F.to_json(
            F.struct(
                "hr_history",
                F.coalesce("sleep_history", F.array().cast(ArrayType(SLEEP_POINT))).alias("sleep_history"),
            )
        ).alias("payload"),
    )
