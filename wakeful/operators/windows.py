"""Time-series window operators.

Physical design. One user's series may hold a large share of all rows, so no
operator partitions by ``user_id`` alone. Each series is cut into time buckets
``b = floor(t / bucket_us)`` and every window is computed per ``(user_id, b)``:

* expanding frames (W3/W4) add the per-bucket totals of all earlier buckets
  (a per-user running sum over the small bucket table);
* the previous row (W6) comes from the same bucket or, for the first row of a
  bucket, from the last row of the previous non-empty bucket;
* time-range frames (W1/W2/W7) run in cells one window long; every row is copied
  into the next cell and the copies are dropped again after the window.

All of it is built-in window/aggregate expressions (whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeful.functions.scalar import circadian, sleep_debt, sleep_inertia, us_to_ts
from wakeful.operators.quantiles import exact_median
from wakeful.settings import MICROS_PER_HOUR, FeatureSettings

UNB = Window.unboundedPreceding


def bucket_of(t, bucket_us: int):
    return F.floor(F.col(t) / F.lit(bucket_us)).cast("long")


def hr_series_features(
    hr: DataFrame, s: FeatureSettings, by: str = "user_id", keep_all: bool = False, passthrough: tuple[str, ...] = ()
) -> DataFrame:
    """W1-W8 on a cleaned series ``(by, t, HR)`` with ``t`` in µs, one row per (by, t).

    Returns the input columns plus hr_mean_total, hr_std_total, hr_zscore, hr_diff,
    mean_hr_5min, hr_volatility_5min, hr_jumpiness_5min, stress_cv. Rows without a
    rolling mean are dropped unless ``keep_all``.
    """
    B = s.bucket_us
    mp = s.min_periods
    pt = list(passthrough)
    # rows from clean_hr(bucketed=True) already carry b and its partitioning
    bcol = F.col("b") if "b" in hr.columns else bucket_of("t", B).alias("b")
    x = hr.select(by, "t", "HR", *pt, bcol)

    # -- phase A: expanding moments and previous row, per (user, bucket) -----
    per_bucket = x.groupBy(by, "b").agg(
        F.count("HR").alias("n_b"),
        F.avg("HR").alias("m_b"),
        (F.var_pop("HR") * F.count("HR")).alias("v_b"),  # squared deviations from m_b
        F.max_by(F.struct("t", "HR"), "t").alias("last_b"),
    )
    # Sums are taken of deviations from the series' first bucket mean, so that
    # q - s * s / n loses no digits to the level of the series.
    wu = Window.partitionBy(by).orderBy("b")
    before = wu.rowsBetween(UNB, -1)
    per_bucket = per_bucket.withColumn("ref", F.first("m_b", ignorenulls=True).over(wu.rowsBetween(UNB, Window.unboundedFollowing)))
    off = F.col("m_b") - F.col("ref")
    carry = per_bucket.select(
        by,
        "b",
        "ref",
        F.coalesce(F.sum("n_b").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum(F.col("n_b") * off).over(before), F.lit(0.0)).alias("s0"),
        F.coalesce(F.sum(F.col("v_b") + F.col("n_b") * off * off).over(before), F.lit(0.0)).alias("q0"),
        F.lag("last_b").over(wu).alias("prev_bucket_row"),
    )
    wa = Window.partitionBy(by, "b").orderBy("t")
    run = wa.rowsBetween(UNB, 0)
    a = x.join(carry, [by, "b"])
    d = F.col("HR") - F.col("ref")
    n = F.col("n0") + F.count("HR").over(run)
    sm = F.col("s0") + F.sum(d).over(run)
    sq = F.col("q0") + F.sum(d * d).over(run)
    prev = F.coalesce(F.lag(F.struct("t", "HR")).over(wa), F.col("prev_bucket_row"))
    a = a.select(by, "t", "b", "HR", *pt, "ref", n.alias("_n"), sm.alias("_s"), sq.alias("_q"), prev.alias("_prev"))
    var = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    mean_total = F.when(F.col("_n") >= mp, F.col("ref") + F.col("_s") / F.col("_n"))
    std_total = F.coalesce(
        F.when((F.col("_n") >= F.lit(max(mp, 2))), F.sqrt(F.greatest(var, F.lit(0.0)))), F.lit(1.0)
    )
    gap = F.col("t") - F.col("_prev.t")
    diff = F.abs(F.col("HR") - F.col("_prev.HR"))
    if s.max_gap_us is not None:
        diff = F.when(gap <= s.max_gap_us, diff)
    a = a.select(
        by,
        "t",
        "b",
        "HR",
        *pt,
        mean_total.alias("hr_mean_total"),
        std_total.alias("hr_std_total"),
        diff.alias("hr_diff"),
    ).withColumn("hr_zscore", (F.col("HR") - F.col("hr_mean_total")) / (F.col("hr_std_total") + 0.1))

    # -- phase B: time-range frames, per cell one window long -----------------
    # Cells are counted from the bucket's start. A row is copied into the next cell and,
    # near the end of its bucket, into the first one of the next bucket, so a cell holds
    # every row that its own rows' windows reach back to. A moving RANGE frame is
    # re-aggregated row by row (O(rows x frame)); a running frame is incremental, so
    # sums over (t - w, t] are the running sum up to t minus the running sum up to
    # t - w. Running sums start with the cell and are of deviations from its mean: they
    # stay small, and their differences exact also for a flat stretch after noise.
    cell_us = max(s.window_us, s.jumpiness_window_us)
    cell = F.floor((F.col("t") - F.col("b") * B) / F.lit(cell_us)).cast("long")
    nowhere = F.array().cast("array<struct<bb:bigint,_cell:bigint,_own:boolean>>")

    def place(b, c, own):
        return F.array(F.struct(b.alias("bb"), c.alias("_cell"), F.lit(own).alias("_own")))

    places = F.concat(
        place(F.col("b"), cell, True),
        F.when((cell + 1) * cell_us < B, place(F.col("b"), cell + 1, False)).otherwise(nowhere),
        F.when(F.col("t") > (F.col("b") + 1) * B - cell_us, place(F.col("b") + 1, F.lit(0).cast("long"), False)).otherwise(nowhere),
    )
    bx = a.withColumn("_at", F.explode(places)).select("*", "_at.*").drop("_at").repartition(by, "bb")
    wb = Window.partitionBy(by, "bb", "_cell").orderBy("t")
    whole = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bx = bx.withColumn("_dev", F.col("HR") - F.avg("HR").over(whole))
    upto_now = wb.rangeBetween(Window.unboundedPreceding, 0)

    def in_window(expr, w_us):
        before = wb.rangeBetween(Window.unboundedPreceding, -w_us)
        return F.sum(expr).over(upto_now) - F.coalesce(F.sum(expr).over(before), F.lit(0))

    hr_ok = F.col("HR").isNotNull().cast("long")
    n1 = in_window(hr_ok, s.window_us)
    s1 = in_window(F.col("_dev"), s.window_us)
    q1 = in_window(F.col("_dev") * F.col("_dev"), s.window_us)
    d_ok = F.col("hr_diff").isNotNull().cast("long")
    n2 = in_window(d_ok, s.jumpiness_window_us)
    q2 = in_window(F.col("hr_diff") * F.col("hr_diff"), s.jumpiness_window_us)
    bx = bx.select(
        "*", n1.alias("_n1"), s1.alias("_s1"), q1.alias("_q1"), n2.alias("_n2"), q2.alias("_q2"), (F.col("HR") - F.col("_dev")).alias("_mid")
    ).where("_own")
    var1 = (F.col("_q1") - F.col("_s1") * F.col("_s1") / F.col("_n1")) / (F.col("_n1") - 1)
    out = bx.select(
        *[c for c in bx.columns if not c.startswith("_")],
        F.when(F.col("_n1") >= mp, F.col("_mid") + F.col("_s1") / F.col("_n1")).alias("mean_hr_5min"),
        F.when((F.col("_n1") >= mp) & (F.col("_n1") >= 2), F.sqrt(F.greatest(var1, F.lit(0.0)))).alias(
            "hr_volatility_5min"
        ),
        F.when(F.col("_n2") >= s.jumpiness_min_periods, F.sqrt(F.greatest(F.col("_q2") / F.col("_n2"), F.lit(0.0)))).alias(
            "hr_jumpiness_5min"
        ),
    )
    # keep the bucket (as ``b``): the rows stay hash-partitioned by (by, b) for the
    # next bucketed operator (the as-of join to sleep)
    out = out.withColumn("stress_cv", F.col("hr_volatility_5min") / (F.col("mean_hr_5min") + 0.1)).drop(
        "b"
    ).withColumnRenamed("bb", "b")
    if not keep_all:
        out = out.where(F.col("mean_hr_5min").isNotNull())
    return out


def sleep_features(sleep: DataFrame, s: FeatureSettings, by: str = "user_id", nth: str | None = None) -> DataFrame:
    """F4 + W9: debt = need - duration; cum_sleep_debt = sum of the debts of the last
    ``debt_rows`` sleeps (this one included) in (END, START) order.

    Computed per (user, time bucket of END): the debts that precede a bucket come from
    a per-bucket table (the last debts of every non-empty bucket, looked up with
    ``lag`` over the user's buckets), so no window runs over all of one user's rows.
    ``nth`` names a column for a sleep's place in its bucket: of sleeps with equal END and
    START, the last one's sum is that of all of them.
    """
    k = s.debt_rows - 1  # earlier sleeps that count
    x = sleep.select(by, "START", "END", "duration").withColumn("_debt", sleep_debt("duration", s.sleep_need_hours))
    x = x.withColumn("_b", bucket_of_ts("END", s.bucket_us))
    w = Window.partitionBy(by, "_b").orderBy("END", "START")
    inside = F.sum("_debt").over(w.rowsBetween(-k, 0))
    place = [F.col("_rn").alias(nth)] if nth else []
    x = x.withColumn("_rn", F.row_number().over(w)).withColumn("_inside", inside)
    if k == 0:
        return x.select(by, "START", "END", "duration", F.col("_inside").alias("cum_sleep_debt"), *place)
    # the last k debts of every bucket, newest first (at most k values), and of the
    # k buckets before it: together they hold the k debts that precede a bucket
    newest = x.withColumn("_lasts", F.collect_list("_debt").over(w.rowsBetween(-(k - 1), 0)))
    per_bucket = newest.groupBy(by, "_b").agg(F.reverse(F.max_by("_lasts", "_rn")).alias("_lasts"))
    wu = Window.partitionBy(by).orderBy("_b")
    earlier = F.flatten(F.array(*[F.coalesce(F.lag("_lasts", i).over(wu), F.array().cast("array<double>")) for i in range(1, k + 1)]))
    carry = per_bucket.select(by, "_b", earlier.alias("_earlier"))
    x = x.join(carry, [by, "_b"])
    missing = F.greatest(F.lit(k + 1) - F.col("_rn"), F.lit(0))  # of the frame, before the bucket
    before = F.aggregate(F.slice("_earlier", F.lit(1), missing), F.lit(0.0), lambda acc, d: acc + d)
    return x.select(by, "START", "END", "duration", (before + F.col("_inside")).alias("cum_sleep_debt"), *place)


def bucket_of_ts(ts: str, bucket_us: int):
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(bucket_us)).cast("long")


def add_time_features(df: DataFrame, ts: str = "HRTIME") -> DataFrame:
    """F2 + F3 on a table that already has ``hours_awake``."""
    return df.withColumns(
        {
            "sleep_inertia_idx": sleep_inertia("hours_awake"),
            "circadian_sin": circadian(ts, "sin"),
            "circadian_cos": circadian(ts, "cos"),
        }
    )


def impute_awake(df: DataFrame, s: FeatureSettings, mode: str = "user_median", by: str = "user_id", bucket: str | None = None) -> DataFrame:
    """A4: null hours_awake -> exact median of the user's hours_awake, else the default;
    null cum_sleep_debt -> 0 ("user_median"). "constant" (the request path) fills the
    default only and leaves the debt for the final feature vector.

    ``bucket``: a column that spreads a user's rows. The readings then meet the user's
    sketch and median by (user, bucket), over a small table of the buckets, so that no
    join brings all of a user's readings together."""
    if mode == "constant":
        return df.withColumn("hours_awake", F.coalesce("hours_awake", F.lit(s.default_hours_awake)))
    med, keys = exact_median(df, "hours_awake", [by], spread=bucket).withColumnRenamed("median", "_med"), [by]
    if bucket:  # only buckets with something to fill
        keys = [by, bucket]
        med = df.where(F.col("hours_awake").isNull()).select(*keys).distinct().join(med, by)
    return (
        df.join(med, keys, "left")
        .withColumn("hours_awake", F.coalesce("hours_awake", "_med", F.lit(s.default_hours_awake)))
        .withColumn("cum_sleep_debt", F.coalesce("cum_sleep_debt", F.lit(0.0)))
        .drop("_med")
    )


def hours_awake(t_col: str, end_col: str):
    """Hours since the last sleep ended."""
    return (F.col(t_col) - F.col(end_col)) / float(MICROS_PER_HOUR)


GRID_DROP = ("t", "START", "last_sleep_end", "END", "HRTIME", "_end_us", "_start_us")


def resample_grid(df: DataFrame, s: FeatureSettings, by: str = "user_id", t: str = "t") -> DataFrame:
    """A3: mean of every numeric column per grid bin (left-closed, left-labelled).

    Sparse: only bins holding rows exist. The dense grid of the original (empty bins
    as all-null rows) is never materialised; consumers that need its extent use
    :func:`grid_extent`. Grouping key is (user, bin), so a heavy user spreads over
    many reducers and the partial aggregation runs map-side.
    """
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name not in (by, t, *GRID_DROP)
        and f.dataType.typeName() in ("double", "float", "integer", "long", "short", "decimal")
    ]
    g = s.grid_us
    binned = df.withColumn("_bin", F.floor(F.col(t) / g).cast("long") * g)
    out = binned.groupBy(by, "_bin").agg(*[F.avg(c).alias(c) for c in numeric])
    return out.withColumn("HRTIME", us_to_ts("_bin")).withColumnRenamed("_bin", "grid_us")


def grid_extent(bins: DataFrame, by: str = "user_id") -> DataFrame:
    """First and last bin per user (the extent of the dense grid)."""
    return bins.groupBy(by).agg(F.min("grid_us").alias("first_bin"), F.max("grid_us").alias("last_bin"))


def latest_row(df: DataFrame, by: str = "user_id", t: str = "t") -> DataFrame:
    """The last row per user in time order (``max_by`` is a partial aggregate,
    so no user's rows are sorted in one task)."""
    cols = [c for c in df.columns if c != by]
    return df.groupBy(by).agg(F.max_by(F.struct(*cols), t).alias("_r")).select(by, "_r.*")
