"""Request scoring (M10, S8, P8, P9, W10, L1, L2) as a batch over a table of
requests; the streaming twin (T2) calls the same function per micro-batch.

Each request carries its own bounded history (one day of readings here), so the
per-request windows are keyed by (request_id, time bucket) like the batch ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.functions.scalar import ts_us
from wakeful.operators.advise import advice_text, select_course
from wakeful.operators.asof import asof_backward
from wakeful.operators.clean import clean_hr, clean_sleep, fallback_vector, feature_vector
from wakeful.operators.forest import FittedForest
from wakeful.operators.windows import add_time_features, hours_awake, hr_series_features, impute_awake, latest_row, sleep_features
from wakeful.session import cut_lineage
from wakeful.settings import MODEL_FEATURES, FeatureSettings
from wakeful.sources.payload import parse_payload, payload_hr, payload_sleep

KEY = "request_id"
API_THRESHOLD = 0.3  # fixed value: the request path flags score > 0.3


def request_features(requests: DataFrame, s: FeatureSettings) -> DataFrame:
    """Feature vector of the latest moment of every request (or the fallback)."""
    s = s.with_(max_gap_us=None)
    parsed = parse_payload(requests, "payload", KEY)
    # stage boundary: both feeds are used several times, the payloads parsed once for each
    hr = cut_lineage(clean_hr(payload_hr(parsed, KEY), s, KEY, bucketed=True), "request-hr")
    sleep = cut_lineage(clean_sleep(payload_sleep(parsed, KEY), s, KEY, dedupe=False), "request-sleep")
    feats = hr_series_features(hr, s, KEY, passthrough=("HRTIME",))
    sl = sleep_features(sleep, s, KEY, nth="_nth").withColumn("_end_us", ts_us("END")).withColumn("_start_us", ts_us("START"))
    buckets = hr.select(KEY, F.col("b").alias("_b")).distinct()  # the windows aren't computed a second time for them
    j = asof_backward(
        feats, sl, [KEY], "t", "_end_us", ["END", "cum_sleep_debt"], s.bucket_us, right_order=["_start_us", "_nth"], bucket_col="b", left_buckets=buckets
    )
    j = j.withColumn("hours_awake", hours_awake("t", "_end_us")).drop("b")
    j = add_time_features(impute_awake(j, s, "constant", KEY), "HRTIME")
    last = latest_row(j.select(KEY, "t", *[c for c in MODEL_FEATURES if c in j.columns]), KEY, "t")
    vec = feature_vector(last, MODEL_FEATURES, keep=[KEY])
    hr_mean = hr.groupBy(KEY).agg(F.avg("HR").alias("_hr_mean"))
    return fallback_vector(requests.select(KEY), vec, hr_mean, KEY)


def score_requests(requests: DataFrame, s: FeatureSettings, ff: FittedForest, fallback_rank: int) -> DataFrame:
    """Features -> forest -> flag (> 0.3) -> course -> advice text; ``timestamp``
    is the HRTIME text of the last reading in the payload (as the response echoes it)."""
    feats = request_features(requests, s)
    last_ts = payload_hr(parse_payload(requests, "payload", KEY), KEY).groupBy(KEY).agg(
        F.max_by("HRTIME", "pos").alias("timestamp")
    )
    feats = feats.join(last_ts, KEY, "left")
    scored = ff.transform(feats, "fatigue_probability")
    scored = scored.withColumn("is_fatigued", F.col("fatigue_probability") > API_THRESHOLD)
    with_course = select_course(scored, fallback_rank)
    return advice_text(with_course, "fatigue_probability", API_THRESHOLD).select(
        KEY, "fatigue_probability", "is_fatigued", "timestamp", "course_id", "advice", "has_features"
    )
