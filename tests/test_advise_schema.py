from pyspark.sql import functions as F

from wakeful.operators import advise as AD
from wakeful.operators import schemas as SCH


def test_course_rules_edges(spark):
    rows = [(14.0, 0.0, 0.0), (14.1, 0.0, 0.0), (0.0, 3.0, 0.0), (0.0, 3.1, 0.0), (0.0, 0.0, 0.15), (0.0, 0.0, 0.16), (None, None, None)]
    df = spark.createDataFrame(rows, "hours_awake double, cum_sleep_debt double, stress_cv double")
    got = [r.course_id for r in AD.select_course(df, 3).collect()]
    assert got == ["circadian", "acute_recovery", "circadian", "sleep_debt", "circadian", "stress_awareness", "circadian"]
    adv = AD.advice_text(AD.select_course(df.withColumn("p", F.lit(0.3)), 3), "p", 0.3)
    assert adv.where("advice IS NOT NULL").count() == 0  # strict > 0.3


def test_safety_overrides(spark):
    hr = spark.createDataFrame(
        [("a", "2026-01-25 10:00:00", 100.0), ("a", "2026-01-25 10:05:00", 80.0), ("b", "2026-01-25 03:00:00", 95.0),
         ("c", "2026-01-25 04:00:00", 70.0)], "request_id string, HRTIME string, HR double"
    ).withColumn("HRTIME", F.col("HRTIME").cast("timestamp_ntz"))
    sl = spark.createDataFrame(
        [(r, f"2026-01-2{d} 00:00:00", f"2026-01-2{d} 0{h}:00:00") for r, h in (("a", 5), ("b", 6), ("c", 5)) for d in (3, 4, 5)],
        "request_id string, START string, END string",
    ).select("request_id", F.col("START").cast("timestamp_ntz"), F.col("END").cast("timestamp_ntz"))
    got = {r.request_id: r for r in AD.safety_overrides(hr, sl).collect()}
    assert got["a"].total_sleep_h == 15.0 and got["a"].override_probability is None  # 15 h is not < 15
    assert got["b"].override_probability == 0.8142 and got["c"].override_probability == 0.8871


def test_kb_match_ties_lowest_id(spark):
    kb = [(10, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [0.0, 1.0])]
    df = spark.createDataFrame([([2.0, 0.0],), ([0.0, 3.0],)], "embedding array<float>")
    got = [(r.kb_id, r.similarity) for r in AD.kb_match(df, kb).collect()]
    assert got == [(10, 1.0), (12, 1.0)]


def test_validate_counts(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 0.5)], "circadian_sin double, mean_hr_5min double")
    v = {r.rule: r.n_bad for r in SCH.validate(df, SCH.MODEL_INPUTS).collect()}
    assert v["ge:circadian_sin"] == 0 and v["null:circadian_sin"] == 1 and v["missing:hours_awake"] == 1
