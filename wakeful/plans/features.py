"""Feature tables composed from the operators (the batch ETL of the original).

Training: clean HR -> series windows -> as-of last sleep -> impute -> time
features -> grid -> nearest grid point per test and offset -> required columns.
Inference: the same up to the grid, without the gap mask, every non-empty bin.

Shuffles on the heart-rate rows: one per window phase and one for the as-of join,
all keyed by (user, time bucket); the grid is a hash aggregate on (user, bin).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.functions.scalar import ts_us, us_to_ts
from wakeful.operators.asof import asof_backward, nearest_grid_match, offset_augment
from wakeful.operators.clean import (
    INFERENCE_LEAKAGE,
    clean_hr,
    clean_pvt,
    clean_sleep,
    drop_leakage_columns,
    reading_buckets,
    require_columns,
)
from wakeful.operators.windows import (
    add_time_features,
    grid_extent,
    hr_series_features,
    hours_awake,
    impute_awake,
    resample_grid,
    sleep_features,
)
from wakeful.session import cut_lineage
from wakeful.settings import FeatureSettings
from wakeful.sources.files import users_with_all_feeds

SLEEP_COLS = ["START", "END", "duration", "cum_sleep_debt"]


def continuous_features(
    hr_raw: DataFrame,
    sleep_raw: DataFrame,
    s: FeatureSettings,
    impute: str = "user_median",
    dedupe_sleep: bool = True,
    materialize: bool = True,
    by: str = "user_id",
) -> DataFrame:
    """Per-reading feature rows (before the grid): HR windows, last sleep, hours
    awake (imputed), inertia and circadian terms."""
    hr = clean_hr(hr_raw, s, by, bucketed=True)
    feats = hr_series_features(hr, s, by, passthrough=("HRTIME",))
    sl = sleep_features(clean_sleep(sleep_raw, s, by, dedupe=dedupe_sleep), s, by)
    sl = sl.withColumn("_end_us", ts_us("END")).withColumn("_start_us", ts_us("START"))
    j = asof_backward(
        feats, sl, [by], "t", "_end_us", SLEEP_COLS, s.bucket_us, right_order=["_start_us"], bucket_col="b", left_buckets=reading_buckets(hr_raw, s, by)
    )
    j = j.withColumnRenamed("END", "last_sleep_end").withColumn("hours_awake", hours_awake("t", "_end_us"))
    if materialize:
        # stage boundary: the median imputation scans this table several times
        j = cut_lineage(j, "continuous")
    j = impute_awake(j, s, "user_median" if impute == "user_median" else "constant", by, bucket="b").drop("b")
    return add_time_features(j, "HRTIME")


def feature_grid(cont: DataFrame, s: FeatureSettings, by: str = "user_id") -> DataFrame:
    """A3 on the continuous rows (sparse bins)."""
    return resample_grid(cont, s, by, "t")


def labelled_features(
    hr_raw: DataFrame, sleep_raw: DataFrame, pvt_raw: DataFrame, s: FeatureSettings, by: str = "user_id"
) -> DataFrame:
    """Training samples: one row per (user, test, offset) matched to the nearest
    grid bin within the tolerance. Key: (user_id, TESTSTART, TESTID, offset_us)."""
    # users are independent of each other, so the rule that a user needs all feeds is
    # applied to the tests, the smallest feed, and readings are not joined by user
    pvt_raw = pvt_raw.join(users_with_all_feeds([hr_raw, sleep_raw, pvt_raw], by), by, "left_semi")
    cont = continuous_features(hr_raw, sleep_raw, s, by=by)
    bins = feature_grid(cont, s, by)
    extent = grid_extent(bins, by)
    pvt = clean_pvt(pvt_raw, s, by, min_year=s.pvt_min_year).withColumn("_test_us", ts_us("TESTSTART"))
    aug = offset_augment(pvt, s.offsets_us, "_test_us", "match_us")
    m = nearest_grid_match(aug, bins, extent, "match_us", s.grid_us, s.tolerance_us, by)
    m = m.withColumn("MATCH_TIME", us_to_ts("match_us")).drop("_test_us", "match_us")
    return require_columns(m, ["mean_hr_5min", "hours_awake", s.target_col])


def inference_features(hr_raw: DataFrame, sleep_raw: DataFrame, s: FeatureSettings, by: str = "user_id") -> DataFrame:
    """Scoring rows: every non-empty grid bin of users with HR and sleep feeds,
    keyed by (user_id, HRTIME). The jumpiness diff is not gap-masked here."""
    s = s.with_(max_gap_us=None)
    cont = continuous_features(hr_raw, sleep_raw, s, by=by)
    bins = require_columns(feature_grid(cont, s, by), ["mean_hr_5min", "hours_awake"])
    bins = bins.join(sleep_raw.select(by).distinct(), by, "left_semi")  # the grid, not the readings
    return drop_leakage_columns(bins.drop("grid_us"), INFERENCE_LEAKAGE)


ROUND_NUDGE = 2.5e-8  # fixed value, shared with the oracle SQL


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column for comparison with the oracle.

    Averages of 2-decimal data often sit exactly on a 6-decimal tie; a nudge far
    above float noise and far below the last digit makes both engines round
    such ties the same way."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name).cast("double") + ROUND_NUDGE, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
