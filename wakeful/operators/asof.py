"""As-of joins.

J1 is a union of both sides followed by a running ``last(..., ignorenulls)``
window. The window runs per (key, time bucket); the last right row of all
earlier buckets is carried in from a small per-bucket table, so one heavy key is
spread over as many tasks as it has buckets.

J2 on a regular grid is plain arithmetic plus an equi-join (no window at all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeful.operators.windows import bucket_of

UNB = Window.unboundedPreceding


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_t: str,
    right_t: str,
    right_cols: Sequence[str],
    bucket_us: int,
    right_order: Sequence[str] = (),
    prefix: str = "",
    bucket_col: str | None = None,
    left_buckets: DataFrame | None = None,
) -> DataFrame:
    """Left as-of join: for each left row the right row with the largest
    (right_t, *right_order) such that right_t <= left_t (exact matches allowed).

    Times are µs longs. Right columns (and ``right_t``) are appended, renamed with
    ``prefix``; unmatched left rows get NULLs (J6: left rows are never lost).
    ``bucket_col``: the left side already carries floor(left_t / bucket_us) under this
    name and is hash-partitioned by (by, bucket_col); the right side is then
    partitioned the same way, so the union keeps that partitioning and the left
    side is not shuffled again. ``left_buckets``: (by, ``_b``) of all buckets that may
    hold left rows, where the caller has them from a cheaper source; the left side is
    then evaluated once. Rows are carried into these buckets only, so a stray time far
    off adds one bucket and not all those on the way.
    """
    by = list(by)
    payload = [right_t, *[c for c in right_cols if c != right_t]]
    order_key = F.struct(F.col(right_t), *[F.col(c) for c in right_order])
    rstruct = F.struct(*[F.col(c).alias(c) for c in payload])
    if bucket_col is None:
        L = left.withColumn("_b", bucket_of(left_t, bucket_us))
    else:
        L = left.withColumnRenamed(bucket_col, "_b")
    R = right.select(*by, *set(payload) | set(right_order)).withColumn("_b", bucket_of(right_t, bucket_us))
    if bucket_col is not None:
        R = R.repartition(*by, "_b")

    # carry: last right row of every earlier bucket
    rb = R.groupBy(*by, "_b").agg(F.max_by(rstruct, order_key).alias("_last"))
    keys = L.select(*by, "_b").distinct() if left_buckets is None else left_buckets
    keys = keys.join(rb, [*by, "_b"], "full")
    wk = Window.partitionBy(*by).orderBy("_b").rowsBetween(UNB, -1)
    carry = keys.select(*by, "_b", F.last("_last", ignorenulls=True).over(wk).alias("_carry"))

    lt = L.withColumn("_side", F.lit(1)).withColumn("_t", F.col(left_t))
    rt = R.select(
        *by,
        "_b",
        F.col(right_t).alias("_t"),
        F.lit(0).alias("_side"),
        rstruct.alias("_r"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(right_order)],
    )
    u = lt.unionByName(rt, allowMissingColumns=True)
    w = Window.partitionBy(*by, "_b").orderBy("_t", "_side", *[f"_o{i}" for i in range(len(right_order))])
    u = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w.rowsBetween(UNB, 0)))
    u = u.where(F.col("_side") == 1).join(carry, [*by, "_b"], "left")
    m = F.coalesce(F.col("_m"), F.col("_carry"))
    keep = [c if c != bucket_col else "_b" for c in left.columns]
    out = u.select(*keep, *[m.getField(c).alias(prefix + c) for c in payload])
    return out.withColumnRenamed("_b", bucket_col) if bucket_col else out


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_t: str,
    right_t: str,
    right_cols: Sequence[str],
    tolerance_us: int | None,
    bucket_us: int,
    prefix: str = "",
) -> DataFrame:
    """J2 general form: nearest right row (either direction) within ``tolerance``
    (inclusive); an exact tie in distance goes to the earlier (backward) row.

    The forward search is the backward search on negated time. Right rows need a
    unique (by, right_t); duplicate times should be reduced before the join.
    """
    cols = [c for c in right_cols if c != right_t]
    back = asof_backward(left, right, by, left_t, right_t, cols, bucket_us, prefix="_bk_")
    neg_l = back.withColumn("_neg_t", -F.col(left_t))
    neg_r = right.withColumn("_neg_rt", -F.col(right_t))
    both = asof_backward(neg_l, neg_r, by, "_neg_t", "_neg_rt", [right_t, *cols], bucket_us, prefix="_fw_")
    db = F.col(left_t) - F.col(f"_bk_{right_t}")
    df_ = F.col(f"_fw_{right_t}") - F.col(left_t)
    use_fw = F.col(f"_bk_{right_t}").isNull() | (F.col(f"_fw_{right_t}").isNotNull() & (df_ < db))
    dist = F.when(use_fw, df_).otherwise(db)
    ok = dist.isNotNull()
    if tolerance_us is not None:
        ok = ok & (dist <= tolerance_us)
    picked = [
        F.when(ok, F.when(use_fw, F.col(f"_fw_{c}")).otherwise(F.col(f"_bk_{c}"))).alias(prefix + c)
        for c in [right_t, *cols]
    ]
    return both.select(*left.columns, *picked)


def nearest_grid_key(match_us, first_bin, last_bin, grid_us: int):
    """Nearest point of the dense grid first_bin, first_bin + g, ..., last_bin to
    ``match_us``: clamp, then round down on an exact tie (backward wins)."""
    m, f, l = F.col(match_us), F.col(first_bin), F.col(last_bin)
    k = F.floor((m - f) / F.lit(grid_us)).cast("long")
    lower = f + k * grid_us
    upper = lower + grid_us
    inner = F.when((m - lower) <= (upper - m), lower).otherwise(upper)
    return F.when(m <= f, f).when(m >= l, l).otherwise(inner)


def nearest_grid_match(
    left: DataFrame,
    bins: DataFrame,
    extent: DataFrame,
    match_us: str,
    grid_us: int,
    tolerance_us: int,
    by: str = "user_id",
) -> DataFrame:
    """J2 against a resampled grid (A3) without materialising the dense grid.

    The nearest dense grid point is computed arithmetically, checked against the
    tolerance, then equi-joined to the sparse bins. A point that is an empty bin
    of the dense grid matches no bin row (features stay NULL, as in the dense
    original). Left rows of users without bins keep NULL features.
    """
    x = left.join(extent, by, "left")
    key = nearest_grid_key(match_us, "first_bin", "last_bin", grid_us)
    x = x.withColumn("_key", F.when(F.abs(key - F.col(match_us)) <= tolerance_us, key)).drop("first_bin", "last_bin")
    return x.join(bins.withColumnRenamed("grid_us", "_key"), [by, "_key"], "left").drop("_key")


def offset_augment(df: DataFrame, offsets_us: Sequence[int], t: str, out: str = "match_us") -> DataFrame:
    """One copy per offset, match time shifted back by the offset.

    ``explode`` of a literal array: the offsets list is part of the plan, so no
    join (and no broadcast) is needed."""
    arr = F.array(*[F.lit(int(o)) for o in offsets_us])
    return df.withColumn("offset_us", F.explode(arr)).withColumn(out, F.col(t) - F.col("offset_us"))
