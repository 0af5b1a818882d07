"""Exact grouped quantiles (A4, A5, A17) without gathering a group in one task.

``percentile``/``median`` keep every distinct value of a group in one hash map on
one task, which breaks when a single user (or the whole table, for a global
median) holds billions of rows. Here, at every size:

1. one aggregate per group gives the count and, from a quantile sketch of fixed
   size, a value range around each wanted probability;
2. one pass counts the rows below and above the range and the distinct values
   inside it (partial aggregation; about ``2 * MARGIN`` of a group lies inside);
3. a running count over those values tells the wanted ranks exactly. The largest
   value below and the smallest above are known too, so a range may be off by one
   rank; a rank farther off raises an error instead of giving a wrong value.

Interpolation is the "linear" rule shared by pandas, numpy and DuckDB's
``quantile_cont``: ``x[lo] + (h - lo) * (x[lo+1] - x[lo])``, ``h = (n - 1) * p``.
The input is scanned twice, so pass a materialised table
(``session.cut_lineage``) when it is expensive to recompute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_G = "__g"
ACCURACY = 10_000  # of the sketch: ranks are off by at most n / ACCURACY
MARGIN = 5 / ACCURACY


def _with_group_key(df: DataFrame, group_cols: Sequence[str], value_col: str) -> tuple[DataFrame, list[str]]:
    """Global case: one group whose key is derived from the data (0 for every
    non-null value) rather than a literal, so joins on it stay equi-joins."""
    if group_cols:
        return df, list(group_cols)
    return df.withColumn(_G, F.col(value_col).isNull().cast("int")), [_G]


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    small_groups: bool | None = None,
    spread: str | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group.

    Returns group columns, ``p`` (double) and ``q`` (double). Groups with no
    non-null value are absent. ``small_groups`` marks the table of value ranges (a row
    per group) as broadcastable; only set it when the number of groups is bounded.
    """
    df, g = _with_group_key(df, group_cols, value_col)
    v = F.col(value_col).cast("double")
    s = [spread] if spread else []
    base = df.select(*g, *s, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    low = [max(0.0, float(p) - MARGIN) for p in probs]
    high = [min(1.0, float(p) + MARGIN) for p in probs]
    sketch = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", [*low, *high], ACCURACY).alias("_at"))
    ranges = F.array(
        *[
            F.struct(F.lit(float(p)).alias("p"), F.col("_at")[i].alias("_lo"), F.col("_at")[len(low) + i].alias("_hi"))
            for i, p in enumerate(probs)
        ]
    )
    sketch = sketch.select(*g, "_n", ranges.alias("_ranges"))
    if small_groups or (small_groups is None and not group_cols):
        sketch = F.broadcast(sketch)
    if spread:
        sketch = base.select(*g, *s).distinct().join(sketch, g)
    rows = base.join(sketch, [*g, *s]).select(*g, "_n", "_v", F.explode("_ranges").alias("_r")).select(*g, "_n", "_v", "_r.*")
    side = F.when(F.col("_v") < F.col("_lo"), -1).when(F.col("_v") > F.col("_hi"), 1).otherwise(0)
    counts = (
        rows.withColumn("_side", side)
        .groupBy(*g, "_n", "p", "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_inside"))
        .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    )
    w = Window.partitionBy(*g, "_n", "p").orderBy("_side", "_inside")
    counts = counts.withColumn("_upto", F.sum("_cnt").over(w)).withColumn("_before", F.col("_upto") - F.col("_cnt"))
    h = (F.col("_n") - 1) * F.col("p")
    r_lo = F.floor(h).cast("long")
    r_hi = F.least(r_lo + 1, F.col("_n") - 1)

    def value_at(rank):
        """The value of a rank that falls into this row of counts."""
        here = (F.col("_before") <= rank) & (rank < F.col("_upto"))
        value = (
            F.when(F.col("_side") == 0, F.col("_inside"))
            .when((F.col("_side") < 0) & (rank == F.col("_upto") - 1), F.col("_most"))
            .when((F.col("_side") > 0) & (rank == F.col("_before")), F.col("_least"))
            .otherwise(F.raise_error(F.lit("quantile outside of its sketched range")).cast("double"))
        )
        return F.max(F.when(here, value))

    out = counts.groupBy(*g, "_n", "p").agg(value_at(r_lo).alias("_x_lo"), value_at(r_hi).alias("_x_hi"))
    out = out.select(*g, "p", (F.col("_x_lo") + (h - r_lo) * (F.col("_x_hi") - F.col("_x_lo"))).alias("q"))
    return out if group_cols else out.drop(_G)


def exact_median(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), **kw) -> DataFrame:
    """Median per group (groups columns + ``median``)."""
    return exact_quantiles(df, value_col, [0.5], group_cols, **kw).drop("p").withColumnRenamed("q", "median")


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> DataFrame:
    """Quantiles of several columns at once: unpivot to (feature, value) and group by
    feature, so all columns share one scan per level. Returns feature, p, q."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
        ).alias("kv")
    ).select("kv.feature", "kv.value")
    return exact_quantiles(long, "value", probs, ["feature"], small_groups=True, **kw)
