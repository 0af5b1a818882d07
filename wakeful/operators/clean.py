"""Cleaning, projection and filter operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from wakeful.functions.scalar import fatigue_score, hours_between, nan_to_null, parse_time, ts_us
from wakeful.settings import MODEL_FEATURES, FeatureSettings


def normalize_headers(df: DataFrame, keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """Upper-case every column name (``keep`` names stay as they are)."""
    return df.toDF(*[c if c in keep else c.upper() for c in df.columns])


def resolve_alias(df: DataFrame, candidates: Sequence[str], target: str, required: bool = True) -> DataFrame:
    """Rename the first present candidate column to ``target``."""
    for c in candidates:
        if c in df.columns:
            return df.withColumnRenamed(c, target) if c != target else df
    if required:
        raise KeyError(f"none of {list(candidates)} found in {df.columns}")
    return df


def _as_timestamp(df: DataFrame, c: str) -> DataFrame:
    if isinstance(df.schema[c].dataType, StringType):
        return df.withColumn(c, parse_time(c))
    return df.withColumn(c, F.col(c).cast("timestamp_ntz"))


def clean_hr(raw: DataFrame, s: FeatureSettings, by: str = "user_id", bucketed: bool = False) -> DataFrame:
    """P3 + A1: parse time, drop null HR, keep HR strictly inside the bounds, average
    duplicate timestamps. Returns (by, HRTIME, HR, t) with t in µs.

    ``bucketed``: also return the time bucket ``b`` and leave the rows hash-partitioned
    by (by, b), the layout the series windows need, so the de-duplication and the
    windows share one shuffle."""
    df = _as_timestamp(raw, "HRTIME").withColumn("HR", F.col("HR").cast("double"))
    lo, hi = s.hr_limits
    # NaN sorts above every number in Spark, so the bounds also drop NaN; plain
    # comparisons on the raw column are pushed into the Parquet scan
    df = df.where(F.col("HRTIME").isNotNull() & (F.col("HR") > lo) & (F.col("HR") < hi))
    if bucketed:
        df = df.withColumn("b", F.floor(ts_us("HRTIME") / F.lit(s.bucket_us)).cast("long")).repartition(by, "b")
        out = df.groupBy(by, "b", "HRTIME").agg(F.avg("HR").alias("HR"))
        return out.withColumn("t", ts_us("HRTIME"))
    out = df.groupBy(by, "HRTIME").agg(F.avg("HR").alias("HR"))
    return out.withColumn("t", ts_us("HRTIME"))


def reading_buckets(raw: DataFrame, s: FeatureSettings, by: str = "user_id") -> DataFrame:
    """(by, ``_b``): the time buckets that hold readings within the bounds. A scan of
    three columns with partial aggregation; a row per user and bucket leaves it."""
    lo, hi = s.hr_limits
    df = _as_timestamp(raw.select(by, "HRTIME", "HR"), "HRTIME").withColumn("HR", F.col("HR").cast("double"))
    df = df.where(F.col("HRTIME").isNotNull() & (F.col("HR") > lo) & (F.col("HR") < hi))
    return df.select(by, F.floor(ts_us("HRTIME") / F.lit(s.bucket_us)).cast("long").alias("_b")).distinct()


def clean_sleep(raw: DataFrame, s: FeatureSettings, by: str = "user_id", dedupe: bool = True) -> DataFrame:
    """P4 + U4: parse, drop null START/END, drop duplicate (START, END) per user,
    duration in hours, keep durations strictly inside the bounds. The request path
    does not de-duplicate (``dedupe=False``)."""
    df = _as_timestamp(_as_timestamp(raw, "START"), "END")
    df = df.where(F.col("START").isNotNull() & F.col("END").isNotNull())
    df = df.select(by, "START", "END")
    if dedupe:
        df = df.dropDuplicates([by, "START", "END"])
    df = df.withColumn("duration", hours_between("END", "START"))
    lo, hi = s.sleep_limits
    return df.where((F.col("duration") > lo) & (F.col("duration") < hi))


def clean_pvt(raw: DataFrame, s: FeatureSettings, by: str = "user_id", min_year: int | None = None) -> DataFrame:
    """P1 + P2 + P5 + A2 + F1: header variants, artifact filter, mean reaction time
    per test, fatigue score, year filter (training copy only: ``min_year``).

    Returns (by, TESTSTART, [TESTID], pvt_mean_rt, fatigue_score)."""
    df = normalize_headers(raw, keep=(by,))
    df = resolve_alias(df, ["TESTSTART", "TIMESTAMP"], "TESTSTART")
    df = _as_timestamp(df, "TESTSTART")
    keys = [by, "TESTSTART"] + (["TESTID"] if "TESTID" in df.columns else [])
    if "TAPTIME" in df.columns:
        tap = nan_to_null(F.col("TAPTIME").cast("double"))
        df = df.where(tap > s.pvt_artifact_ms)
        df = df.groupBy(*keys).agg(F.avg(tap).alias("pvt_mean_rt"))
    else:
        df = resolve_alias(df, ["RT_MEAN", "MEAN_RT", "PVT_MEAN_RT"], "pvt_mean_rt")
        df = df.select(*keys, nan_to_null(F.col("pvt_mean_rt").cast("double")).alias("pvt_mean_rt"))
    df = df.withColumn(s.target_col, fatigue_score("pvt_mean_rt", s.fatigue_low_ms, s.fatigue_high_ms))
    if min_year is not None:
        df = df.where(F.year("TESTSTART") > min_year)
    return df


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any required column."""
    cond = F.lit(True)
    for c in cols:
        col = F.col(c)
        if isinstance(df.schema[c].dataType, NumericType):
            cond = cond & col.isNotNull() & ~F.isnan(col)
        else:
            cond = cond & col.isNotNull()
    return df.where(cond)


TRAIN_LEAKAGE = (
    "fatigue_score", "HR", "TESTSTART", "timestamp", "pvt_mean_rt", "MATCH_TIME",
    "HRTIME", "last_sleep_end", "TESTID", "START", "duration", "hr_diff",
)  # fixed list: columns never fed to the model (training)
INFERENCE_LEAKAGE = (
    "TESTSTART", "timestamp", "pvt_mean_rt", "MATCH_TIME", "last_sleep_end",
    "TESTID", "START", "duration", "hr_diff", "HR", "fatigue_score",
)  # fixed list: columns never fed to the model (inference)


def drop_leakage_columns(df: DataFrame, names: Sequence[str] = TRAIN_LEAKAGE) -> DataFrame:
    """Drop forbidden columns; absent names are ignored."""
    return df.drop(*names)


def feature_vector(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """The model's feature columns in order, missing -> 0, cast to double."""
    cols = [F.col(k) for k in keep]
    for f in features:
        src = F.col(f) if f in df.columns else F.lit(None)
        cols.append(F.coalesce(src.cast("double"), F.lit(0.0)).alias(f))
    return df.select(*cols)


FALLBACK = {"hours_awake": 16.0, "cum_sleep_debt": 2.0, "sleep_inertia_idx": 0.1}  # fixed values
FALLBACK_HR = 75.0  # fixed value: mean HR when a request has no usable HR


def fallback_vector(users: DataFrame, features: DataFrame, hr_mean: DataFrame, by: str = "request_id") -> DataFrame:
    """Requests without a feature row get the default vector (mean HR of the
    request or 75, awake 16 h, debt 2, inertia 0.1, the rest 0)."""
    joined = users.join(features.withColumn("_has", F.lit(True)), by, "left").join(hr_mean, by, "left")
    has = F.col("_has").isNotNull()
    cols = [by]
    for f in MODEL_FEATURES:
        if f in ("mean_hr_5min", "hr_mean_total"):
            fb = F.coalesce(F.col("_hr_mean"), F.lit(FALLBACK_HR))
        else:
            fb = F.lit(FALLBACK.get(f, 0.0))
        cols.append(F.when(has, F.col(f)).otherwise(fb).cast("double").alias(f))
    cols.append(has.alias("has_features"))
    return joined.select(*cols)


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-numeric -> NULL (``try_cast``), then keep complete rows only."""
    out = df.select(*[F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) for c in cols])
    return require_columns(out, cols)


def select_monitor_columns(
    reference: DataFrame,
    current: DataFrame,
    wanted: Sequence[str] | None,
    ignored: Sequence[str] = ("user_id", "timestamp", "event_id", "HRTIME"),
) -> list[str]:
    """P12 (schema-time): wanted columns present in both tables, else every numeric
    column of the reference that is not ignored."""
    if wanted:
        return [c for c in wanted if c in reference.columns and c in current.columns]
    return [
        f.name
        for f in reference.schema.fields
        if f.name not in ignored and isinstance(f.dataType, NumericType)
    ]
