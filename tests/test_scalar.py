import math

from pyspark.sql import functions as F

from wakeful.functions.scalar import circadian, fatigue_score, parse_time, threshold_flag


def test_fatigue_score_ramp(spark):
    df = spark.createDataFrame([(x,) for x in (100.0, 299.9, 300.0, 350.0, 400.0, 450.0)] + [(None,)], "rt double")
    got = [r[0] for r in df.select(fatigue_score("rt")).collect()]
    assert got[:6] == [0.0, 0.0, 0.0, 0.5, 1.0, 1.0]
    assert got[6] is None  # null stays null (the original scores it 1.0 by fall-through)


def test_circadian_and_threshold(spark):
    df = spark.createDataFrame([("2024-01-01 06:30:00",)], "s string").select(parse_time("s").alias("ts"))
    r = df.select(circadian("ts", "sin").alias("s"), circadian("ts", "cos").alias("c")).first()
    h = 6.5
    assert abs(r.s - math.sin(2 * math.pi * h / 24)) < 1e-12
    assert abs(r.c - math.cos(2 * math.pi * h / 24)) < 1e-12
    t = spark.createDataFrame([(0.26,), (0.25,), (None,)], "p double")
    assert [r[0] for r in t.select(threshold_flag("p", 0.26)).collect()] == [1, 0, None]
    assert [r[0] for r in t.select(threshold_flag("p", 0.26, inclusive=False)).collect()] == [0, 0, None]


def test_parse_time_drops_offset(spark):
    df = spark.createDataFrame([("2026-01-18T10:00:00+02:00",), ("2026-01-18T10:00:00Z",), ("junk",)], "s string")
    got = [r[0] for r in df.select(parse_time("s")).collect()]
    assert str(got[0]) == "2026-01-18 10:00:00" and str(got[1]) == "2026-01-18 10:00:00" and got[2] is None
