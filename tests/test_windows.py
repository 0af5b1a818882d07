"""Bucketed windows against a direct pandas computation of the same semantics."""

import numpy as np
import pandas as pd
import pytest

from wakeful.operators.windows import hr_series_features, sleep_features
from wakeful.settings import DEFAULTS, MICROS_PER_MINUTE, MICROS_PER_SECOND


def series(seed: int, users: int = 2, n: int = 900) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frames = []
    for u in range(users):
        steps = rng.choice([1, 1, 1, 2, 5, 6, 9], size=n) * MICROS_PER_SECOND
        steps[rng.integers(0, n, 3)] = 7 * MICROS_PER_MINUTE  # gaps longer than the window
        t = 1_700_000_000 * MICROS_PER_SECOND + np.cumsum(steps)
        hr = np.round(rng.uniform(50, 120, size=n), 2)
        frames.append(pd.DataFrame({"user_id": u, "t": t, "HR": hr}))
    return pd.concat(frames, ignore_index=True)


def pandas_reference(pdf: pd.DataFrame, s) -> pd.DataFrame:
    out = []
    win = pd.Timedelta(microseconds=s.window_us)
    for u, g in pdf.groupby("user_id"):
        g = g.sort_values("t").copy()
        g.index = pd.to_datetime(g["t"], unit="us")
        hr = g["HR"]
        g["mean_hr_5min"] = hr.rolling(win, min_periods=s.min_periods).mean()
        g["hr_volatility_5min"] = hr.rolling(win, min_periods=s.min_periods).std()
        g["hr_mean_total"] = hr.expanding(min_periods=s.min_periods).mean()
        g["hr_std_total"] = hr.expanding(min_periods=s.min_periods).std().fillna(1)
        gap = g.index.to_series().diff().dt.total_seconds()
        d = hr.diff().abs()
        if s.max_gap_us is not None:
            d[gap > s.max_gap_us / 1e6] = np.nan
        g["hr_diff"] = d
        g["hr_jumpiness_5min"] = np.sqrt((d**2).rolling(win, min_periods=s.jumpiness_min_periods).mean())
        g["stress_cv"] = g["hr_volatility_5min"] / (g["mean_hr_5min"] + 0.1)
        g["hr_zscore"] = (hr - g["hr_mean_total"]) / (g["hr_std_total"] + 0.1)
        out.append(g.dropna(subset=["mean_hr_5min"]).reset_index(drop=True))
    return pd.concat(out, ignore_index=True)


COLS = ["mean_hr_5min", "hr_volatility_5min", "hr_mean_total", "hr_std_total", "hr_diff", "hr_jumpiness_5min", "stress_cv", "hr_zscore"]


@pytest.mark.parametrize("max_gap", [5 * MICROS_PER_SECOND, None])
def test_bucketed_windows_match_pandas(spark, max_gap):
    s = DEFAULTS.with_(bucket_us=6 * MICROS_PER_MINUTE, max_gap_us=max_gap)  # many buckets, halos
    pdf = series(7)
    got = hr_series_features(spark.createDataFrame(pdf), s).toPandas().sort_values(["user_id", "t"]).reset_index(drop=True)
    want = pandas_reference(pdf, s).sort_values(["user_id", "t"]).reset_index(drop=True)
    assert len(got) == len(want) > 0
    for c in COLS:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_bucket_size_does_not_change_results(spark):
    pdf = series(3, users=1, n=600)
    df = spark.createDataFrame(pdf)
    a = hr_series_features(df, DEFAULTS.with_(bucket_us=5 * MICROS_PER_MINUTE)).toPandas().sort_values("t")
    b = hr_series_features(df, DEFAULTS.with_(bucket_us=10**12)).toPandas().sort_values("t")
    for c in COLS:
        np.testing.assert_allclose(a[c].to_numpy(float), b[c].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_rolling_sleep_debt_across_buckets(spark):
    from wakeful.operators.windows import sleep_features

    rng = np.random.default_rng(4)
    ends = np.sort(rng.choice(np.arange(0, 60 * 24 * 40), 60, replace=False)) * MICROS_PER_MINUTE + 1_700_000_000_000_000
    dur = np.round(rng.uniform(1, 10, 60), 3)
    pdf = pd.DataFrame({"user_id": 1, "END": pd.to_datetime(ends, unit="us"), "duration": dur})
    pdf["START"] = pdf["END"] - pd.to_timedelta(np.round(dur * 3600e6).astype("int64"), unit="us")
    want = (8.0 - pdf["duration"]).rolling(3, min_periods=1).sum().to_numpy()
    df = spark.createDataFrame(pdf).selectExpr("user_id", "CAST(START AS timestamp_ntz) START", "CAST(END AS timestamp_ntz) `END`", "duration")
    for bucket in (86_400_000_000, 3 * 86_400_000_000, 10**13):
        got = sleep_features(df, DEFAULTS.with_(bucket_us=bucket)).orderBy("END").toPandas()["cum_sleep_debt"].to_numpy()
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_flat_stretches_have_no_spread(spark):
    """Constant fractional heart rate, also after noise, at the default settings."""
    rng = np.random.default_rng(3)
    n = 20_000
    t = 1_700_000_000 * MICROS_PER_SECOND + np.arange(n) * MICROS_PER_SECOND
    noisy = np.where(np.arange(n) < n // 2, np.round(rng.uniform(45, 150, n), 2), 72.3)
    pdf = pd.DataFrame({"user_id": np.repeat([0, 1], n), "t": np.tile(t, 2), "HR": np.concatenate((np.full(n, 72.3), noisy))})
    got = hr_series_features(spark.createDataFrame(pdf), DEFAULTS).toPandas().sort_values(["user_id", "t"])
    flat = got[(got.user_id == 0) | (got.t > t[n // 2] + DEFAULTS.window_us)]
    assert flat["hr_volatility_5min"].max() < 1e-6 and flat["stress_cv"].max() < 1e-6
    assert got[got.user_id == 0]["hr_std_total"].max() < 1e-6
    want = pandas_reference(pdf, DEFAULTS).sort_values(["user_id", "t"])
    want = want[want["mean_hr_5min"].notna()]
    rising = (want.user_id == 1).to_numpy()
    for c in ("hr_std_total", "hr_mean_total", "mean_hr_5min"):
        assert np.allclose(got[c].to_numpy()[rising], want[c].to_numpy()[rising], rtol=1e-9)


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_rolling_sleep_debt_of_any_length(spark, rows):
    rng = np.random.default_rng(rows)
    end = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(rng.integers(2, 60, 60)), unit="h")
    pdf = pd.DataFrame({"user_id": 1, "START": end - pd.Timedelta(hours=1), "END": end, "duration": rng.uniform(3, 10, 60)})
    got = sleep_features(spark.createDataFrame(pdf), DEFAULTS.with_(debt_rows=rows)).toPandas().sort_values("END")
    want = (DEFAULTS.sleep_need_hours - pdf["duration"]).rolling(rows, min_periods=1).sum()
    assert np.allclose(got["cum_sleep_debt"].to_numpy(), want.to_numpy())
