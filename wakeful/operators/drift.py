"""Drift monitoring.

All statistics are computed on a long (feature, side, value) table so that every
feature is handled by one set of jobs: exact quantiles by histogram refinement,
the KS statistic by distributed running totals over distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeful.functions.scalar import nan_to_null
from wakeful.operators.clean import coerce_numeric
from wakeful.operators.metrics import attach_row
from wakeful.operators.prefix import running_totals
from wakeful.operators.quantiles import column_quantiles, exact_quantiles


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) rows, one per input row and column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(c).cast("double")).alias("value")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("kv")).select(*keep, "kv.feature", "kv.value")


def robust_params(long: DataFrame, group_cols: Sequence[str] = ("feature",)) -> DataFrame:
    """A5 fit: median and IQR (linear interpolation) per group; IQR 0 -> scale 1."""
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], list(group_cols), small_groups=True)
    # groups are (feature[, side]): bounded by the number of monitored columns
    p = q.groupBy(*group_cols).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q25"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("center"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q75"),
    )
    iqr = F.col("q75") - F.col("q25")
    return p.select(*group_cols, "center", F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def robust_scale_long(long: DataFrame, group_cols: Sequence[str] = ("feature",), fit_on_side: int | None = None) -> DataFrame:
    """A5 fit + transform on the long table: (value - median) / IQR per group.

    ``fit_on_side``: fit on one side only (e.g. 0 = reference) and apply those
    parameters to both, so pure shifts or scale changes stay visible to the KS test
    (the default, each side scaled by itself, hides them as the original does)."""
    if fit_on_side is None:
        params = robust_params(long, group_cols)
        keys = list(group_cols)
    else:
        keys = [c for c in group_cols if c != "side"]
        params = robust_params(long.where(F.col("side") == fit_on_side), keys)
    return long.join(F.broadcast(params), keys).withColumn(
        "value", (F.col("value") - F.col("center")) / F.col("scale")
    ).drop("center", "scale")


def monitoring_long(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P11 on both sides (complete cases over the monitored columns), stacked long
    with a ``side`` column (0 = reference, 1 = current)."""
    ref = unpivot(coerce_numeric(reference, columns).withColumn("side", F.lit(0)), columns, ["side"])
    cur = unpivot(coerce_numeric(current, columns).withColumn("side", F.lit(1)), columns, ["side"])
    return ref.unionByName(cur)


def kolmogorov_sf(lam) -> F.Column:
    """P(K > lam) for the Kolmogorov distribution (two-sided asymptotic KS p-value).

    Small lam uses the theta-function form of the CDF, large lam the alternating
    series; 20 terms are far past double precision in both ranges."""
    k = "k"
    alt = F.expr(
        "aggregate(sequence(1, 20), CAST(0 AS DOUBLE), "
        "(acc, k) -> acc + power(-1, k - 1) * exp(-2 * k * k * lam * lam))"
    )
    small = F.expr(
        f"aggregate(sequence(1, 20), CAST(0 AS DOUBLE), "
        f"(acc, {k}) -> acc + exp(-power(2 * {k} - 1, 2) * {math.pi ** 2} / (8 * lam * lam)))"
    )
    cdf_small = F.lit(math.sqrt(2 * math.pi)) / F.col("lam") * small
    p = F.when(F.col("lam") <= 0, F.lit(1.0)).when(F.col("lam") < 1, 1 - cdf_small).otherwise(2 * alt)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


EXACT_MOST = 10_000  # fixed value: both samples of at most so many rows get exact p-values


def ks_exact_p(n0: int, n1: int, top: int) -> float:
    """P(max |F0 - F1| >= top / (n0 n1)) for two samples of one continuous distribution.

    The pooled sample in order is a walk over lattice points (i, j): from (i, j) the next
    value is of the first sample with probability (n0 - i) / (n0 + n1 - i - j). The
    p-value is the mass that leaves the band |i n1 - j n0| < top; it is added up where it
    leaves, so small values keep their digits."""
    if top <= 0:
        return 1.0
    n, p = n0 + n1, 0.0
    i = np.arange(n0 + 1)
    mass = np.zeros(n0 + 1)
    mass[0] = 1.0
    for t in range(n):  # from t to t + 1 values
        lo, hi = max(0, t - n1), min(n0, t)
        at = slice(lo, hi + 1)
        ahead = mass[at] * ((n0 - i[at]) / (n - t))
        mass[at] -= ahead
        mass[lo + 1 : hi + 2] += ahead[: n0 - lo]
        j = t + 1 - i
        out = (np.abs(i * n1 - j * n0) >= top) & (mass > 0)
        if out.any():
            p += float(mass[out].sum())
            mass[out] = 0.0
    return min(1.0, p)


@F.pandas_udf(T.DoubleType())
def _exact_p(n0: pd.Series, n1: pd.Series, top: pd.Series) -> pd.Series:
    return pd.Series([ks_exact_p(int(a), int(b), int(k)) if max(a, b) <= EXACT_MOST else None for a, b, k in zip(n0, n1, top)], dtype="float64")


def ks_two_sample(long: DataFrame, alpha: float = 0.05, group_cols: Sequence[str] = ("feature",), method: str = "auto") -> DataFrame:
    """Per group, D = max |F_ref - F_cur| over all values, and its two-sided p-value:
    exact where both samples have at most :data:`EXACT_MOST` rows, else that of the
    Kolmogorov distribution at sqrt(n1 n2 / (n1 + n2)) * D; ``method`` "asymptotic" takes
    the latter always. Returns the group columns, statistic, p_value, drift_detected,
    n_reference, n_current. D is compared as a whole number of 1 / (n1 n2). A group with
    one side only has no statistic and counts as not drifted."""
    g = list(group_cols)
    per = long.groupBy(*g, "value").agg(F.count_if(F.col("side") == 0).alias("c0"), F.count_if(F.col("side") == 1).alias("c1"))
    cum = running_totals(per, "value", ["c0", "c1"], group_cols=g)
    cum = cum.withColumnRenamed("tot_c0", "n0").withColumnRenamed("tot_c1", "n1")
    apart = F.abs(F.col("cum_c0").cast("decimal(38,0)") * F.col("n1").cast("decimal(19,0)") - F.col("cum_c1").cast("decimal(38,0)") * F.col("n0").cast("decimal(19,0)"))
    d = cum.groupBy(*g, "n0", "n1").agg(
        F.max(F.abs(F.try_divide("cum_c0", "n0") - F.try_divide("cum_c1", "n1"))).alias("statistic"), F.max(apart).alias("top")
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    d = d.withColumn("lam", F.sqrt(F.try_divide(n0 * n1, n0 + n1)) * F.col("statistic")).withColumn("p_value", kolmogorov_sf("lam"))
    if method == "auto":
        small = F.greatest("n0", "n1") <= EXACT_MOST
        exact = _exact_p(F.col("n0").cast("long"), F.col("n1").cast("long"), F.when(small, F.col("top").cast("long")).otherwise(F.lit(0)))
        d = d.withColumn("p_value", F.when(F.col("statistic").isNull(), F.lit(None)).when(small, exact).otherwise(F.col("p_value")))
    return d.select(
        *g,
        "statistic",
        "p_value",
        F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("drift_detected"),
        F.col("n0").cast("long").alias("n_reference"),
        F.col("n1").cast("long").alias("n_current"),
    )


def drift_summary(ks: DataFrame, n_features: int, max_share: float = 0.3) -> DataFrame:
    """Drifted count, share and pass flag (share < max_share); no feature -> pass."""
    a = ks.agg(F.count_if("drift_detected").alias("n_drifted"))
    share = F.when(F.lit(n_features) > 0, F.col("n_drifted") / F.lit(float(max(n_features, 1)))).otherwise(F.lit(0.0))
    return a.select(
        F.lit(n_features).cast("long").alias("n_features"),
        F.col("n_drifted").cast("long"),
        share.alias("drift_share"),
        (share < max_share).alias("drift_passed"),
    )


DRIFT_GATE = 0.15  # fixed value: an alert when a share moves by more


def label_drift(rows: DataFrame, label: str, side: str = "side", gate: float = DRIFT_GATE) -> DataFrame:
    """Shares of each label on both sides (0 reference, 1 current) and by how much they
    moved: (label, share_reference, share_current, change, alert). One partial aggregate;
    a label that a side lacks has share 0 there, null labels count as a label."""
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count_if(F.col(side) == 0).alias("n0"), F.count_if(F.col(side) == 1).alias("n1"))
    whole = counts.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    share = {i: F.coalesce(F.try_divide(f"n{i}", f"t{i}"), F.lit(0.0)) for i in (0, 1)}
    out = attach_row(counts, whole).select("label", share[0].alias("share_reference"), share[1].alias("share_current"))
    change = F.col("share_current") - F.col("share_reference")
    return out.select("*", change.alias("change"), (F.abs(change) > gate).alias("alert"))


def zscore_drift(long: DataFrame, limit: float = 3.0, gate: float = DRIFT_GATE) -> DataFrame:
    """Current values against the reference side's mean and spread: (feature, mean, std,
    z_mean, share_outside, alert), where z_mean is the current mean's z-score and
    share_outside the share of current values more than ``limit`` spreads away; an alert
    where that share passes ``gate``. A feature without reference values has nulls and no
    alert; a spread of 0 counts as 1."""
    fit = long.where(F.col("side") == 0).groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    fit = fit.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))
    z = (F.col("value") - F.col("mean")) / F.col("std")
    # one row per monitored feature: bounded by the number of columns
    current = long.where(F.col("side") == 1).join(F.broadcast(fit), "feature", "left")
    out = current.groupBy("feature", "mean", "std").agg(F.avg(z).alias("z_mean"), F.avg((F.abs(z) > limit).cast("double")).alias("share_outside"))
    return out.withColumn("alert", F.coalesce(F.col("share_outside") > gate, F.lit(False)))


def density_histogram(long: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins over the joint [min, max] of each feature, density =
    count / (n_side * width) per side. Returns feature, side, bin, lo, hi, density."""
    ext = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    x = long.join(F.broadcast(ext), "feature")
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(
        F.lit(0)
    )
    counts = x.groupBy("feature", "side", b.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("cnt"))
    sides = long.groupBy("feature", "side").agg(F.count(F.lit(1)).alias("n"))
    w = (F.col("hi") - F.col("lo")) / bins
    safe_w = F.when(w > 0, w).otherwise(F.lit(1.0))
    return counts.join(F.broadcast(sides), ["feature", "side"]).select(
        "feature",
        "side",
        "bin",
        (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
        (F.col("cnt") / (F.col("n") * safe_w)).alias("density"),
    )


# ------------------------------------------------------------ A17 / A18
def fit_impute_scale(df: DataFrame, columns: Sequence[str], impute: str = "median", scale: str = "standard") -> DataFrame:
    """A17 + A18 fit on the training table: per feature the fill value (exact
    median, or 0 for "constant") and, after filling, mean and population std
    (std 0 -> 1) for "standard", or median/IQR for "robust". One row per feature."""
    long = unpivot(df, columns)
    if impute == "median":
        fill = column_quantiles(df, columns, [0.5]).select("feature", F.col("q").alias("fill"))
    else:
        fill = long.select("feature").distinct().withColumn("fill", F.lit(0.0))
    filled = long.join(F.broadcast(fill), "feature", "left").withColumn(
        "value", F.coalesce("value", "fill", F.lit(0.0))
    )
    if scale == "standard":
        st = filled.groupBy("feature").agg(F.avg("value").alias("center"), F.stddev_pop("value").alias("_sd"))
        st = st.select("feature", "center", F.when(F.col("_sd") == 0, F.lit(1.0)).otherwise(F.col("_sd")).alias("scale"))
    else:
        st = robust_params(filled.select("feature", "value"))
    return fill.join(st, "feature", "outer")


def apply_impute_scale(df: DataFrame, params: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Transform with fitted parameters: fill then (x - center) / scale.

    The parameter table has one row per feature (bounded by the feature count), so
    it is pivoted to one row and attached as literals. With ``prefix`` the results are
    added as ``<prefix><column>`` and the original columns are kept."""
    wide = params.groupBy().pivot("feature", list(columns)).agg(
        F.first("fill").alias("fill"), F.first("center").alias("center"), F.first("scale").alias("scale")
    )
    x = attach_row(df, wide)
    kept = [c for c in df.columns if prefix or c not in columns]
    out = x.select(
        *kept,
        *[
            ((F.coalesce(nan_to_null(F.col(c).cast("double")), F.col(f"{c}_fill"), F.lit(0.0)) - F.col(f"{c}_center")) / F.col(f"{c}_scale")).alias(prefix + c)
            for c in columns
        ],
    )
    return out
