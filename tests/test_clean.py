import pytest
from pyspark.sql import functions as F

from wakeful.operators.clean import clean_hr, clean_pvt, clean_sleep, coerce_numeric, feature_vector, require_columns
from wakeful.settings import DEFAULTS, MODEL_FEATURES


def test_clean_hr_bounds_dupes_nulls(spark):
    rows = [
        (1, "2024-01-01 00:00:00", 40.0),  # bound, dropped
        (1, "2024-01-01 00:00:01", 180.0),  # bound, dropped
        (1, "2024-01-01 00:00:02", 60.0),
        (1, "2024-01-01 00:00:02", 70.0),  # duplicate timestamp -> mean 65
        (1, "2024-01-01 00:00:03", None),
        (1, "2024-01-01 00:00:04", float("nan")),
    ]
    df = spark.createDataFrame(rows, "user_id long, HRTIME string, HR double")
    out = clean_hr(df, DEFAULTS).collect()
    assert len(out) == 1 and out[0].HR == 65.0


def test_clean_sleep_dedupe_and_bounds(spark):
    rows = [
        (1, "2024-01-01 00:00:00", "2024-01-01 08:00:00"),
        (1, "2024-01-01 00:00:00", "2024-01-01 08:00:00"),  # duplicate
        (1, "2024-01-02 00:00:00", "2024-01-02 00:15:00"),  # 0.25 h exactly: dropped
        (1, "2024-01-03 00:00:00", "2024-01-04 12:00:00"),  # 36 h exactly: dropped
        (1, "2024-01-05 00:00:00", "2024-01-05 00:16:00"),
    ]
    df = spark.createDataFrame(rows, "user_id long, START string, END string")
    assert clean_sleep(df, DEFAULTS).count() == 2
    assert clean_sleep(df, DEFAULTS, dedupe=False).count() == 3


def test_clean_pvt_variants(spark):
    taps = spark.createDataFrame(
        [(1, 7, "2024-01-01 10:00:00", 100), (1, 7, "2024-01-01 10:00:00", 350), (1, 7, "2024-01-01 10:00:00", 450),
         (1, 8, "2000-06-01 10:00:00", 500)],
        "user_id long, testid long, timestamp string, taptime long",
    )
    out = clean_pvt(taps, DEFAULTS, min_year=2000).collect()
    assert len(out) == 1 and out[0].pvt_mean_rt == 400.0 and out[0].fatigue_score == 1.0
    means = spark.createDataFrame([(1, "2024-01-01 10:00:00", 330.0), (1, "2024-01-02 10:00:00", None)], "user_id long, TESTSTART string, RT_MEAN double")
    out = sorted(clean_pvt(means, DEFAULTS).collect(), key=lambda r: r.TESTSTART)
    assert abs(out[0].fatigue_score - 0.3) < 1e-12 and out[1].fatigue_score is None
    with pytest.raises(KeyError):
        clean_pvt(spark.createDataFrame([(1, 5.0)], "user_id long, X double"), DEFAULTS)


def test_vector_and_coerce(spark):
    df = spark.createDataFrame([(1, 70.0, None)], "user_id long, mean_hr_5min double, hours_awake double")
    v = feature_vector(df, MODEL_FEATURES, keep=["user_id"]).first()
    assert v.mean_hr_5min == 70.0 and v.hours_awake == 0.0 and v.circadian_cos == 0.0
    c = spark.createDataFrame([("1.5", "x"), ("2", "3")], "a string, b string")
    assert coerce_numeric(c, ["a", "b"]).collect()[0].asDict() == {"a": 2.0, "b": 3.0}
    assert require_columns(df, ["hours_awake"]).count() == 0


def test_monitored_columns(spark):
    from wakeful.operators.clean import select_monitor_columns

    ref = spark.createDataFrame([(1, 2.0, "x", 3.0)], "user_id long, a double, b string, c double")
    cur = ref.drop("c")
    assert select_monitor_columns(ref, cur, ["c", "a", "zz"]) == ["a"]
    assert select_monitor_columns(ref, cur, None) == ["a", "c"]


def test_nan_counts_as_missing(spark):
    from wakeful.operators import schemas as SCH

    df = spark.createDataFrame([(1, "a", "b", float("nan"), None), (2, "a", "b", -1.0, None), (3, "a", "b", 2.0, None)], "id long, START string, `END` string, rating double, comments string")
    bad = {r.rule: r.n_bad for r in SCH.validate(df, SCH.SLEEP_RAW).collect()}
    assert bad["null:rating"] == 1 and bad["gt:rating"] == 1 and sum(bad.values()) == 2
    assert sorted((r.rule, r.id) for r in SCH.rejects(df, SCH.SLEEP_RAW, ["id"]).collect()) == [("gt:rating", 2), ("null:rating", 1)]
    with pytest.raises(ValueError):
        SCH.check(df, SCH.SLEEP_RAW)
    assert SCH.check(df.where("id = 3"), SCH.SLEEP_RAW).count() == 1
    assert len(SCH.SCHEMAS) == 8
