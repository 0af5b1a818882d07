"""

Times ``hr_series_features`` (running-frame differences) against the same rolling
mean/std/jumpiness written with moving RANGE frames, on generated 1 Hz readings
with the default 5-minute windows. usage: python scripts/bench_rolling.py [seconds]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wakeful.operators.windows import hr_series_features  # noqa: E402
from wakeful.session import build_session  # noqa: E402
from wakeful.settings import DEFAULTS  # noqa: E402


def moving_frames(df, s):
    """Rolling statistics with moving RANGE frames (re-aggregated per row)."""
    w = Window.partitionBy("user_id", F.floor(F.col("t") / s.bucket_us)).orderBy("t")
    r = w.rangeBetween(-(s.window_us - 1), 0)
    d = F.abs(F.col("HR") - F.lag("HR").over(w))
    x = df.withColumn("d", d)
    return x.select(
        "user_id", "t",
        F.when(F.count("HR").over(r) >= s.min_periods, F.avg("HR").over(r)).alias("mean"),
        F.when(F.count("HR").over(r) >= s.min_periods, F.stddev_samp("HR").over(r)).alias("std"),
        F.when(F.count("d").over(r) >= s.min_periods, F.sqrt(F.avg(F.col("d") * F.col("d")).over(r))).alias("jump"),
    )


def main() -> None:
    secs = int(sys.argv[1]) if len(sys.argv) > 1 else 500_000
    users = 4
    spark = build_session("local[8]")
    df = spark.range(users * secs).select(
        (F.col("id") % users).alias("user_id"),
        (F.lit(1_700_000_000_000_000) + (F.col("id") / users).cast("long") * 1_000_000).alias("t"),
        (60 + (F.col("id") * 7919 % 600) / 10.0).alias("HR"),
    )
    df = df.repartition(16).cache()
    df.count()
    for name, fn in (("moving RANGE frames", lambda: moving_frames(df, DEFAULTS)),
                     ("running-frame differences", lambda: hr_series_features(df, DEFAULTS))):
        fn().write.format("noop").mode("overwrite").save()  # warm
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t0:.2f} s for {users * secs:,} readings", flush=True)


if __name__ == "__main__":
    main()
