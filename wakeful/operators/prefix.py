"""Running totals over an ordered key without a single-partition window.

A window with no ``partitionBy`` puts every row into one task. Here the keys of each
group are cut into buckets of about equal numbers of rows, at approximate quantiles
(totals stay exact for any cuts, heavy tails included); bucket totals get a running
sum over the small bucket table, and rows get a running sum inside their own bucket.
Total = offset of the bucket + running sum within it. Ties on the key share a bucket
and are included (RANGE frame), so the result is the sum over all rows with key <=
current (or >= when descending).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_G = "__pg"
SIDE = 32  # buckets are found in two steps: SIDE coarse ones of SIDE each


def bucket_number(key: Column, cuts: Column) -> Column:
    """How many of the ``SIDE * SIDE - 1`` ascending cuts are smaller than the key."""
    coarse = F.transform(F.sequence(F.lit(1), F.lit(SIDE - 1)), lambda i: F.element_at(cuts, i * SIDE))
    first = F.size(F.filter(coarse, lambda c: c < key))
    fine = F.slice(cuts, first * SIDE + 1, F.lit(SIDE - 1))
    return (first * SIDE + F.size(F.filter(fine, lambda c: c < key))).cast("int")


def running_totals(
    df: DataFrame,
    order_col: str,
    value_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    descending: bool = False,
    prefix: str = "cum_",
) -> DataFrame:
    """Adds ``<prefix><col>`` (running total) and ``tot_<col>`` (group total) for every
    value column. The number of groups must be bounded (features): the table of cuts,
    1,023 numbers a group, is broadcast."""
    g = list(group_cols) or [_G]
    # global case: a data-derived key (0 for every non-null key) instead of a literal,
    # so the optimizer cannot fold the join below into a cross product
    x = df if group_cols else df.withColumn(_G, F.col(order_col).isNull().cast("int"))
    key = -F.col(order_col) if descending else F.col(order_col)
    x = x.withColumn("_key", key.cast("double"))
    n = SIDE * SIDE
    stats = x.groupBy(*g).agg(
        F.percentile_approx("_key", [k / n for k in range(1, n)], 10_000).alias("_cuts"),
        *[F.sum(v).alias(f"tot_{v}") for v in value_cols],
    )
    x = x.join(F.broadcast(stats), g)
    x = x.withColumn("_k", F.coalesce(bucket_number(F.col("_key"), F.col("_cuts")), F.lit(0))).drop("_cuts")
    totals = x.groupBy(*g, "_k").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wk = Window.partitionBy(*g).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *g, "_k", *[F.coalesce(F.sum(f"_t_{v}").over(wk), F.lit(0)).alias(f"_o_{v}") for v in value_cols]
    )
    win = Window.partitionBy(*g, "_k").orderBy("_key").rangeBetween(Window.unboundedPreceding, 0)
    x = x.join(offsets, [*g, "_k"])
    return x.select(
        *df.columns,
        *[(F.col(f"_o_{v}") + F.sum(v).over(win)).alias(f"{prefix}{v}") for v in value_cols],
        *[F.col(f"tot_{v}") for v in value_cols],
    )
