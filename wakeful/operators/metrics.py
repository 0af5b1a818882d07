"""Evaluation metrics as aggregations.

Every metric is one aggregate (partial + final) or a per-distinct-score table
followed by distributed running totals; nothing collects rows to the driver.
Metric tables are long: (metric, value), the names of the original logs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.functions.scalar import status_label, threshold_flag
from wakeful.operators.prefix import running_totals

CLASS_NAMES = ("Awake", "Fatigued")  # fixed labels of the two classes


def _long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]))
    ).select("col.metric", "col.value")


def regression_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Mae, mse, rmse, r2. A constant target gives r2 = 1 for a perfect fit, else 0."""
    err = F.col(y_pred) - F.col(y_true)
    agg = df.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sum(err * err).alias("_ss_res"),
        (F.var_pop(y_true) * F.count(y_true)).alias("_ss_tot"),
    )
    r2 = (
        F.when(F.col("_ss_tot") > 0, 1 - F.col("_ss_res") / F.col("_ss_tot"))
        .when(F.col("_ss_res") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    agg = agg.select("mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))
    return _long(agg, ["mae", "mse", "rmse", "r2"])


def confusion_counts(df: DataFrame, y_true: str, y_pred: str, threshold: float, target_threshold: float) -> DataFrame:
    """TP, FP, FN, TN in one aggregate."""
    t = F.col(y_true) >= target_threshold
    p = F.col(y_pred) >= threshold
    return df.agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row as literals.

    The aggregate is a single row of scalars by construction; reading it is one
    small job and keeps the plan free of joins (no cross product with a 1-row side)."""
    row = one_row.first()
    fields = {f.name: f.dataType for f in one_row.schema.fields}
    vals = row.asDict() if row is not None else {k: None for k in fields}
    return df.select("*", *[F.lit(vals[k]).cast(fields[k]).alias(k) for k in fields])


def _div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def roc_auc(df: DataFrame, y_true: str = "y_true", y_score: str = "y_pred", target_threshold: float = 0.5) -> DataFrame:
    """Rank AUC (Mann-Whitney, ties count one half); single class -> 0.0.

    Scores are first reduced to distinct values with their class counts, then the
    negatives below each score come from distributed running totals."""
    pos = (F.col(y_true) >= target_threshold).cast("long")
    per = df.groupBy(F.col(y_score).alias("s")).agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))
    cum = running_totals(per, "s", ["neg"])
    part = cum.agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    )
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P") * F.col("N"))).otherwise(F.lit(0.0))
    return part.select(auc.alias("roc_auc"))


def _fmt(t: float) -> str:
    return repr(float(t))


def binary_metrics(
    df: DataFrame,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    threshold: float = 0.5,
    target_threshold: float = 0.5,
) -> DataFrame:
    """A10 + A11: recall/precision/F1 at the threshold (0/0 -> 0), accuracy, ROC AUC."""
    c = confusion_counts(df, y_true, y_pred, threshold, target_threshold)
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    sfx = _fmt(threshold)
    names = [f"recall_at_{sfx}", f"precision_at_{sfx}", f"f1_at_{sfx}", "accuracy"]
    m = c.select(
        _div(tp, tp + fn).alias(names[0]),
        _div(tp, tp + fp).alias(names[1]),
        _div(2 * tp, 2 * tp + fp + fn).alias(names[2]),
        _div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )
    # two independent one-row aggregates, stacked as metric rows (no join)
    return _long(m, names).unionByName(_long(roc_auc(df, y_true, y_pred, target_threshold), ["roc_auc"]))


def confusion_matrix(df: DataFrame, y_true: str, y_pred: str, threshold: float, target_threshold: float | None = None) -> DataFrame:
    """All four cells (zeros included): true_label, pred_label, count."""
    tt = threshold if target_threshold is None else target_threshold
    c = confusion_counts(df, y_true, y_pred, threshold, tt)
    cells = [(1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn")]
    return c.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(a).alias("true_label"), F.lit(b).alias("pred_label"), F.col(k).alias("count"))
                    for a, b, k in cells
                ]
            )
        )
    ).select("col.*")


def classification_report(df: DataFrame, y_true: str, y_pred: str, threshold: float) -> DataFrame:
    """Per class precision/recall/f1/support, accuracy, macro and weighted
    averages; both classes are always reported (0/0 -> 0)."""
    c = confusion_counts(df, y_true, y_pred, threshold, threshold)
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    cls = {
        "Fatigued": (_div(tp, tp + fp), _div(tp, tp + fn), _div(2 * tp, 2 * tp + fp + fn), tp + fn),
        "Awake": (_div(tn, tn + fn), _div(tn, tn + fp), _div(2 * tn, 2 * tn + fn + fp), tn + fp),
    }
    rows = []
    for name in CLASS_NAMES:
        p, r, f, s = cls[name]
        rows.append(F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"), s.cast("double").alias("support")))
    acc = _div(tp + tn, n)
    rows.append(F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), n.cast("double").alias("support")))
    (pa, ra, fa, sa), (pf, rf, ff, sf) = cls["Awake"], cls["Fatigued"]
    rows.append(F.struct(F.lit("macro avg").alias("label"), ((pa + pf) / 2).alias("precision"), ((ra + rf) / 2).alias("recall"), ((fa + ff) / 2).alias("f1_score"), n.cast("double").alias("support")))
    w = lambda a, b: _div(a * sa + b * sf, n)
    rows.append(F.struct(F.lit("weighted avg").alias("label"), w(pa, pf).alias("precision"), w(ra, rf).alias("recall"), w(fa, ff).alias("f1_score"), n.cast("double").alias("support")))
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pr_curve(df: DataFrame, y_true: str, y_score: str, target_threshold: float) -> DataFrame:
    """Precision and recall at every distinct score (as threshold, predict
    score >= threshold), plus the closing point (precision 1, recall 0, NULL threshold)."""
    pos = (F.col(y_true) >= target_threshold).cast("long")
    per = df.groupBy(F.col(y_score).cast("double").alias("threshold")).agg(
        F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg")
    )
    cum = running_totals(per, "threshold", ["pos", "neg"], descending=True)
    cur = cum.select(
        "threshold",
        _div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.when(F.col("tot_pos") > 0, F.col("cum_pos") / F.col("tot_pos")).otherwise(F.lit(1.0)).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return cur.unionByName(end)


def score_outputs(df: DataFrame, score: str, threshold: float, inclusive: bool = True) -> DataFrame:
    """F6 on a scored table: alert flag and status label."""
    return df.withColumn("fatigue_event_alert", threshold_flag(score, threshold, inclusive)).withColumn(
        "status", status_label("fatigue_event_alert")
    )


def inference_stats(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Totals, counts, percentages and mean score (one aggregate)."""
    flag = (F.col(score) >= threshold).cast("long")
    a = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(flag), F.lit(0)).alias("fatigue_count"),
        F.avg(score).alias("mean_probability"),
    )
    return a.select(
        F.col("total").cast("long"),
        F.col("fatigue_count").cast("long"),
        (F.col("total") - F.col("fatigue_count")).cast("long").alias("awake_count"),
        _div(F.col("fatigue_count") * 100.0, F.col("total")).alias("fatigue_pct"),
        _div((F.col("total") - F.col("fatigue_count")) * 100.0, F.col("total")).alias("awake_pct"),
        "mean_probability",
    )


def metric_thresholds(metrics: DataFrame, thresholds: dict[str, tuple[float, bool]]) -> DataFrame:
    """(metric, value) joined to (threshold, greater_is_better) -> passed."""
    spark = metrics.sparkSession
    th = spark.createDataFrame(
        [(k, float(v), bool(g)) for k, (v, g) in thresholds.items()], "metric string, threshold double, greater_is_better boolean"
    )
    ok = F.when(F.col("greater_is_better"), F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    return metrics.join(F.broadcast(th), "metric").withColumn("passed", ok)


Scorer = Callable[[DataFrame], DataFrame]


def custom_scorer(fn: Callable[..., DataFrame], **params) -> Scorer:
    """Bind a metric function ``(df, **params) -> metrics table`` as a scorer."""
    return lambda df: fn(df, **params)


def sort_by(df: DataFrame, cols: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """O1: output ordering (windows carry their own order)."""
    return df.orderBy(*cols, ascending=ascending)


def limit_rows(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """O2: the first ``n`` rows by key (TakeOrdered, deterministic)."""
    return df.orderBy(*key).limit(n)
