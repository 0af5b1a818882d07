"""Raw files, one per user and feed, read back."""

import uuid

from pyspark.sql import functions as F

from wakeful.sources import files as FS

SCHEMA = "HRTIME string, HR double"
TEXTS = {
    "HR_1.csv": b'HRTIME,HR\n2024-01-01 00:00:00,60.5\n"2024-01-01, noon",61\n',
    "HR_2.csv": b"\r\n \nHRTIME,HR\r\n\r\na,1.5\r\nb,x\r\n  \t\r\nc\r\nd,4,5\r\n,\r\ne,",
    "HR_3.csv": b"HRTIME,HR\nno line end,7",
    "HR_4.csv": b"HRTIME,HR\n",
    "HR_5.csv": b"",
    "HR_6.csv": b"HRTIME,HR\r\na lone,1\rend,2\n\"open,3\n\xc3\xa9t\xc3\xa9,NaN\n",
    "HR_77.csv": b"HRTIME,HR\n" + b"".join(b"line %d,%d\n" % (i, i) for i in range(500)),
    "sleep_1.csv": b"START,END\nother,feed\n",
    "HR_1.csv.bak": b"HRTIME,HR\nother,9\n",
}


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.select("user_id", "HRTIME", "HR").collect())


def test_user_files_are_read_as_by_the_csv_scan(spark, tmp_path):
    for name, text in TEXTS.items():
        (tmp_path / name).write_bytes(text)
    folder = f"file://{tmp_path}"
    scan = FS.read_csv(spark, f"{folder}/HR_*.csv", SCHEMA).withColumn("user_id", FS.extract_id(F.col("_metadata.file_name"), "HR_*.csv").cast("long"))
    want = _rows(scan)
    assert len(want) == 2 + 6 + 1 + 4 + 500
    assert _rows(FS.read_user_feed(spark, folder, SCHEMA, "HR_*.csv")) == want
    for size in (7, 64, 1000):  # long files are cut at any byte
        lines = []
        for name in ("HR_1.csv", "HR_2.csv", "HR_3.csv", "HR_77.csv"):
            with open(tmp_path / name, "rb") as f:
                length = len(TEXTS[name])
                for start in range(0, length, size):
                    lines += FS._range_lines(f, start, min(start + size, length))
        assert lines == [x for name in ("HR_1.csv", "HR_2.csv", "HR_3.csv", "HR_77.csv") for x in TEXTS[name].splitlines()]


def test_tasks_do_not_grow_with_user_files(spark, tmp_path):
    """Each file was a listing task, and every 32 of them a task of the scan."""
    n = 600
    for i in range(n):
        (tmp_path / f"HR_{i}.csv").write_text(f"HRTIME,HR\nt,{i}\n")
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        got = FS.read_user_feed(spark, f"file://{tmp_path}", SCHEMA, "HR_*.csv").agg(F.count("*"), F.sum("user_id"), F.sum("HR")).first()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tuple(got) == (n, n * (n - 1) // 2, n * (n - 1) / 2)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert sum(s.numTasks for s in stages if s) < 100
