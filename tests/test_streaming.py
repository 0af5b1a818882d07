"""Watermark semantics over two micro-batches (hand-made readings)."""

import tempfile
import time
from datetime import datetime, timedelta

from wakeful.settings import DEFAULTS
from wakeful.streaming.telemetry import minute_grid_stream, run_to_table, score_stream, table_stream

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_repeated_times_count_as_their_mean(spark):
    folder = tempfile.mkdtemp(prefix="wakeful-stream-test-")
    t0 = datetime(2024, 1, 1, 10, 0, 0)
    rows = [(1, t0, 1, "click", 60.0, "{}"), (2, t0, 1, "click", 80.0, "{}"), (3, t0 + timedelta(seconds=9), 1, "click", 100.0, "{}")]
    rows.append((9, t0 + timedelta(hours=1), 1, "click", 70.0, "{}"))  # moves the watermark past the window
    _write(spark, folder, "a", rows)
    src = table_stream(spark, f"{folder}/*", SCHEMA).selectExpr("user_id", "ts AS HRTIME", "value AS HR")
    out = spark.read.parquet(run_to_table(minute_grid_stream(src, DEFAULTS), "mean-test"))
    assert [(r.HR, r.n_readings) for r in out.collect()] == [(85.0, 3)]


def test_restart_goes_on_without_double_rows(spark):
    folder, state = tempfile.mkdtemp(prefix="wakeful-stream-test-"), tempfile.mkdtemp(prefix="wakeful-stream-state-")
    rows = [(i, datetime(2024, 1, 1, 10, 0, 0), i, "click", 60.0, "{}") for i in range(4)]
    where = {"out": f"{state}/out", "checkpoint": f"{state}/ckpt"}

    def run():
        src = table_stream(spark, f"{folder}/*", SCHEMA, max_files=1)
        out = score_stream(src, lambda b: b.selectExpr("event_id", "value * 2 AS doubled"), "restart-test", **where)
        return sorted(r.event_id for r in spark.read.parquet(out).collect())

    _write(spark, folder, "a", rows[:2])
    assert run() == [0, 1]
    assert run() == [0, 1]  # nothing new
    _write(spark, folder, "b", rows[2:])
    assert run() == [0, 1, 2, 3]


def _write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_minute_grid_emits_closed_windows_only(spark):
    folder = tempfile.mkdtemp(prefix="wakeful-stream-test-")
    t0 = datetime(2024, 1, 1, 10, 0, 0)
    first = [(i, t0 + timedelta(minutes=i), 1, "click", 60.0 + i, "{}") for i in range(31)]  # 10:00 .. 10:30
    second = [
        (100, datetime(2024, 1, 1, 10, 20, 30), 1, "click", 90.0, "{}"),  # late but within the delay: kept
        (101, datetime(2024, 1, 1, 11, 0, 0), 1, "click", 70.0, "{}"),  # its window is still open
    ]
    _write(spark, folder, "a", first)
    time.sleep(1.1)  # the file source orders files by modification time
    _write(spark, folder, "b", second)
    src = table_stream(spark, f"{folder}/*", SCHEMA, max_files=1).selectExpr("user_id", "ts AS HRTIME", "value AS HR")
    out = spark.read.parquet(run_to_table(minute_grid_stream(src, DEFAULTS.with_(hr_limits=(40.0, 180.0))), "grid-test"))
    got = {r.HRTIME.strftime("%H:%M"): (r.HR, r.n_readings) for r in out.collect()}
    assert "11:00" not in got  # window end 11:01 is after the final watermark 10:45
    # every window ending at or before the watermark is emitted, the late reading
    # (within the 15-minute delay) included in its window
    assert got["10:00"] == (60.0, 1) and got["10:30"] == (90.0, 1) and got["10:20"] == ((80.0 + 90.0) / 2, 2)
    assert len(got) == 31


def test_state_does_not_grow_with_readings_of_a_time(spark):
    """Many readings share few times: the state holds a row for each time and window,
    and the result is that of the batch de-duplication and grid."""
    from pyspark.sql import functions as F

    from wakeful.operators.clean import clean_hr

    folder = tempfile.mkdtemp(prefix="wakeful-stream-test-")
    t0 = datetime(2024, 1, 1, 10, 0, 0)
    rows = [(i, t0 + timedelta(seconds=20 * (i % 12)), i % 2, "click", 60.0 + i % 29, "{}") for i in range(6000)]
    _write(spark, folder, "a", rows)
    src = table_stream(spark, f"{folder}/*", SCHEMA).selectExpr("user_id", "ts AS HRTIME", "value AS HR")
    stream = minute_grid_stream(src, DEFAULTS)
    query = stream.writeStream.format("memory").queryName("open_state").trigger(availableNow=True).option("checkpointLocation", tempfile.mkdtemp()).start()
    query.awaitTermination()
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert held and max(held) <= 12  # times (6 for each user), windows (4 for each)
    _write(spark, folder, "b", [(9999, t0 + timedelta(hours=2), 5, "click", 70.0, "{}")])
    out = spark.read.parquet(run_to_table(minute_grid_stream(src, DEFAULTS), "state-test")).collect()
    hr = clean_hr(spark.createDataFrame(rows, SCHEMA).selectExpr("user_id", "ts AS HRTIME", "value AS HR"), DEFAULTS)
    grid = hr.groupBy("user_id", F.date_trunc("minute", "HRTIME").alias("m")).agg(F.avg("HR").alias("HR")).collect()
    want = {(r["user_id"], r["m"]): r["HR"] for r in grid}
    assert len(out) == len(want) == 8
    assert all(abs(want[r["user_id"], r["HRTIME"]] - r["HR"]) < 1e-9 for r in out) and sum(r["n_readings"] for r in out) == 6000


def test_request_batches_take_a_file_for_each_core(spark, tmp_path, monkeypatch):
    """A batch took one file, so batches grew with the files and one task read each."""
    from wakeful.plans import registry as R

    t0 = datetime(2024, 1, 1, 8, 0, 0)
    kinds = ("click", "view", "error", "purchase")
    rows = [(100 * u + i, t0 + timedelta(hours=5 * i, minutes=u), u, kinds[(u + i) % 4], 40.0 + (7 * u + 11 * i) % 60, "{}") for u in range(30) for i in range(16)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    outs, score = [], R.ST.score_stream

    def kept(*args, **kw):
        outs.append(score(*args, **kw))
        return outs[-1]

    monkeypatch.setattr(R.ST, "score_stream", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a file for each of 8 partitions
    try:
        got = R.stream_request_features_q(spark, f"file://{tmp_path}").collect()
        folders = spark.read.parquet(outs[0]).select("batch").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = R.request_features_q(spark, f"file://{tmp_path}").collect()
    assert len(want) > 60 and sorted(map(str, got)) == sorted(map(str, want))
    assert folders <= -(-8 // spark.sparkContext.defaultParallelism)


def test_repeated_sleeps_of_a_request_all_count(spark):
    """Sleeps of a request aren't de-duplicated: the reading meets the last of equal ones."""
    from wakeful.plans.scoring import request_features
    from wakeful.settings import EVENTS_SCALE

    readings = ",".join('{"HRTIME": "2024-01-02 %02d:00:00", "HR": 6%d.0}' % (9 + i, i) for i in range(4))
    sleep = '{"START": "2024-01-02 01:00:00", "END": "2024-01-02 0%d:00:00"}'
    rows = [(f"r{k}", '{"hr_history": [%s], "sleep_history": [%s]}' % (readings, ",".join([sleep % 6] * k + [sleep % 3] * 2))) for k in (1, 2, 3)]
    got = request_features(spark.createDataFrame(rows, "request_id string, payload string"), EVENTS_SCALE).collect()
    # debts of 3 hours (of 5 slept) and 6 hours, over the last three sleeps
    assert {r["request_id"]: r["cum_sleep_debt"] for r in got} == {"r1": 15.0, "r2": 12.0, "r3": 9.0}
