import numpy as np
import pandas as pd
import pytest

from wakeful.operators.asof import asof_backward, asof_nearest, nearest_grid_key
from wakeful.settings import MICROS_PER_MINUTE


def _frames(seed):
    rng = np.random.default_rng(seed)
    left = pd.DataFrame({"user_id": rng.integers(0, 3, 400), "t": rng.integers(0, 10_000, 400) * MICROS_PER_MINUTE})
    left = left.drop_duplicates(["user_id", "t"])
    right = pd.DataFrame({"user_id": rng.integers(0, 3, 60), "rt": rng.integers(0, 10_000, 60) * MICROS_PER_MINUTE})
    right = right.drop_duplicates(["user_id", "rt"]).reset_index(drop=True)
    right["v"] = np.arange(len(right), dtype=float)
    return left, right


@pytest.mark.parametrize("bounded", [False, True])
def test_backward_matches_merge_asof(spark, bounded):
    left, right = _frames(1)
    b = 500 * MICROS_PER_MINUTE
    buckets = spark.createDataFrame(left).selectExpr("user_id", f"cast(floor(t / {b}) as long) AS _b").distinct() if bounded else None
    got = asof_backward(spark.createDataFrame(left), spark.createDataFrame(right), ["user_id"], "t", "rt", ["v"], b, left_buckets=buckets).toPandas()
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("rt"), left_on="t", right_on="rt", by="user_id", direction="backward")
    m = got.merge(want, on=["user_id", "t"], suffixes=("", "_w"))
    assert len(m) == len(left)
    assert ((m["v"] == m["v_w"]) | (m["v"].isna() & m["v_w"].isna())).all()


def test_nearest_with_tolerance_matches_merge_asof(spark):
    left, right = _frames(2)
    tol = 90 * MICROS_PER_MINUTE
    got = asof_nearest(spark.createDataFrame(left), spark.createDataFrame(right), ["user_id"], "t", "rt", ["v"], tol, 700 * MICROS_PER_MINUTE).toPandas()
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("rt"), left_on="t", right_on="rt", by="user_id", direction="nearest", tolerance=tol)
    m = got.merge(want, on=["user_id", "t"], suffixes=("", "_w"))
    assert len(m) == len(left)
    # exact distance ties may differ in direction only; compare matched distances
    d_got = (m["t"] - m["rt"]).abs()
    d_want = (m["t"] - m["rt_w"]).abs()
    assert ((d_got == d_want) | (d_got.isna() & d_want.isna())).all()


def test_grid_key_ties_go_backward(spark):
    g = MICROS_PER_MINUTE
    df = spark.createDataFrame([(30_000_000, 0, 10 * g), (90_000_000, 0, 10 * g), (-5, 0, 10 * g), (11 * g, 0, 10 * g)], "m long, f long, l long")
    got = [r[0] for r in df.select(nearest_grid_key("m", "f", "l", g)).collect()]
    assert got == [0, g, 0, 10 * g]


def test_grid_match_tolerance_is_inclusive(spark):
    from wakeful.operators.asof import nearest_grid_match

    g = MICROS_PER_MINUTE
    tol = 15 * g
    bins = spark.createDataFrame([(1, 0, 1.0), (1, 10 * g, 2.0)], "user_id long, grid_us long, mean_hr_5min double")
    extent = spark.createDataFrame([(1, 0, 10 * g)], "user_id long, first_bin long, last_bin long")
    tests = spark.createDataFrame(
        [(1, "exact", 25 * g), (1, "over", 25 * g + 1), (1, "tie", 30_000_000), (1, "gap", 5 * g + 30_000_000), (2, "nouser", 0)],
        "user_id long, name string, match_us long",
    )
    got = {r.name: r.mean_hr_5min for r in nearest_grid_match(tests, bins, extent, "match_us", g, tol).collect()}
    assert got == {"exact": 2.0, "over": None, "tie": 1.0, "gap": None, "nouser": None}


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(
    lt=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200)), min_size=1, max_size=40, unique=True),
    rt=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200), st.integers(0, 9)), max_size=30),
    bucket=st.sampled_from([7, 50, 10_000]),
)
def test_backward_property(spark, lt, rt, bucket):
    """Last right row at or before each left row, ties on time broken by the order
    column (largest wins), for any bucket size."""
    left = spark.createDataFrame(lt, "user_id long, t long")
    right = spark.createDataFrame(rt, "user_id long, rt long, o long") if rt else spark.createDataFrame([], "user_id long, rt long, o long")
    got = {(r.user_id, r.t): r.o for r in asof_backward(left, right, ["user_id"], "t", "rt", ["o"], bucket, right_order=["o"]).collect()}
    for u, t in lt:
        cands = [(rtime, o) for uu, rtime, o in rt if uu == u and rtime <= t]
        want = max(cands)[1] if cands else None
        assert got[(u, t)] == want


def test_a_stray_time_adds_one_bucket(spark):
    """One reading in the year 9999: the carried rows stay as many as the buckets with
    readings, and the stray reading still finds the last sleep before it."""
    from wakeful.operators.clean import clean_hr, reading_buckets
    from wakeful.plans.features import continuous_features
    from wakeful.settings import DEFAULTS

    hr = spark.sql("SELECT id % 5 AS user_id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id % 50, 0) AS HRTIME, 60.0 + id % 7 AS HR FROM range(200)")
    hr = hr.unionByName(spark.sql("SELECT 0L AS user_id, timestamp_ntz'9999-12-30 00:00:00' AS HRTIME, 61.0 AS HR"))
    sleep = spark.sql("SELECT id AS user_id, timestamp_ntz'2023-12-31 22:00:00' AS START, timestamp_ntz'2024-01-01 00:10:00' AS END FROM range(5)")
    assert reading_buckets(hr, DEFAULTS).count() == 6
    rows = continuous_features(hr, sleep, DEFAULTS.with_(min_periods=1, jumpiness_min_periods=1)).select("user_id", "HRTIME", "hours_awake", "last_sleep_end").collect()
    assert len(rows) == clean_hr(hr, DEFAULTS).count()
    stray = [r for r in rows if r["HRTIME"].year == 9999]
    assert len(stray) == 1 and stray[0]["last_sleep_end"].year == 2024 and stray[0]["hours_awake"] > 6e7
