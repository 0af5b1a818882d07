import numpy as np
import pandas as pd
import pytest

from wakeful.operators import metrics as M
from wakeful.operators.quantiles import exact_quantiles


def _m(df):
    return {r.metric: r.value for r in df.collect()}


def test_perfect_regression(spark):
    df = spark.createDataFrame([(0.1, 0.1), (0.5, 0.5), (0.9, 0.9)], "y_true double, y_pred double")
    m = _m(M.regression_metrics(df))
    assert m["mae"] == 0 and m["rmse"] == 0 and m["r2"] == 1.0
    const = spark.createDataFrame([(0.5, 0.5), (0.5, 0.4)], "y_true double, y_pred double")
    assert _m(M.regression_metrics(const))["r2"] == 0.0


def test_classification_pair_and_threshold(spark):
    df = spark.createDataFrame([(0.0, 0.2), (1.0, 0.8)], "y_true double, y_pred double")
    m = _m(M.binary_metrics(df, threshold=0.5))
    assert m["recall_at_0.5"] == m["precision_at_0.5"] == m["accuracy"] == m["roc_auc"] == 1.0
    one = spark.createDataFrame([(1.0, 0.4)], "y_true double, y_pred double")
    assert _m(M.binary_metrics(one, threshold=0.5))["recall_at_0.5"] == 0.0
    assert _m(M.binary_metrics(one, threshold=0.3))["recall_at_0.3"] == 1.0
    assert _m(M.binary_metrics(one, threshold=0.3))["roc_auc"] == 0.0  # single class


def test_auc_and_pr_curve_with_ties(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 500).astype(float)
    s = np.round(rng.uniform(size=500), 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"y_true": y, "y_pred": s}))
    auc = M.roc_auc(df, "y_true", "y_pred", 0.5).first()[0]
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(auc - want) < 1e-12
    pr = {r.threshold: (r.precision, r.recall) for r in M.pr_curve(df, "y_true", "y_pred", 0.5).collect()}
    for t in np.unique(s):
        sel = s >= t
        assert abs(pr[t][0] - y[sel].mean()) < 1e-12 and abs(pr[t][1] - y[sel].sum() / y.sum()) < 1e-12
    assert pr[None] == (1.0, 0.0)


def test_report_and_confusion(spark):
    df = spark.createDataFrame([(0.0, 0.1), (0.0, 0.9), (1.0, 0.8), (1.0, 0.2), (1.0, 0.7)], "y_true double, y_pred double")
    cm = {(r.true_label, r.pred_label): r["count"] for r in M.confusion_matrix(df, "y_true", "y_pred", 0.5).collect()}
    assert cm == {(1, 1): 2, (0, 1): 1, (1, 0): 1, (0, 0): 1}
    rep = {r.label: r for r in M.classification_report(df, "y_true", "y_pred", 0.5).collect()}
    assert abs(rep["Fatigued"].precision - 2 / 3) < 1e-12 and abs(rep["Fatigued"].recall - 2 / 3) < 1e-12
    assert rep["Awake"].support == 2 and abs(rep["accuracy"].f1_score - 0.6) < 1e-12
    stats = M.inference_stats(df.withColumnRenamed("y_pred", "p"), "p", 0.5).first()
    assert stats.total == 5 and stats.fatigue_count == 3 and stats.awake_count == 2


@pytest.mark.parametrize("kind", ["cauchy", "ties", "tiny"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(5)
    n = 9 if kind == "tiny" else 60_000
    v = {"cauchy": rng.standard_cauchy(n), "ties": rng.integers(0, 3, n).astype(float), "tiny": rng.normal(size=n)}[kind]
    pdf = pd.DataFrame({"g": (rng.random(n) < 0.3).astype(int), "v": v})
    pdf.loc[0, "v"] = 1e9  # one value far from all others
    want = pdf.groupby("g")["v"].quantile([0.0, 0.1, 0.5, 0.9, 1.0])
    got = exact_quantiles(spark.createDataFrame(pdf), "v", [0.0, 0.1, 0.5, 0.9, 1.0], ["g"]).collect()
    assert len(got) == len(want)
    for r in got:
        assert abs(r.q - want[r.g][r.p]) <= 1e-9 * max(1.0, abs(r.q))
    alone = exact_quantiles(spark.createDataFrame(pdf), "v", [0.5]).first()
    assert abs(alone.q - pdf["v"].median()) < 1e-9



def test_running_totals_of_heavy_tails(spark):
    """One value far outside must not send all others into one bucket."""
    from pyspark.sql import functions as F

    from wakeful.operators.prefix import SIDE, bucket_number, running_totals

    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"v": np.concatenate((np.round(rng.normal(size=20_000), 3), [1e6])), "c": 1.0})
    df = spark.createDataFrame(pdf)
    got = running_totals(df, "v", ["c"]).toPandas().sort_values("v")
    assert (got["cum_c"].to_numpy() == pdf["v"].sort_values().rank(method="max").to_numpy()).all()
    down = running_totals(df, "v", ["c"], descending=True).toPandas().sort_values("v", ascending=False)
    assert (down["cum_c"].to_numpy() == (-pdf["v"]).sort_values().rank(method="max").to_numpy()).all()
    cuts = df.agg(F.percentile_approx("v", [k / SIDE**2 for k in range(1, SIDE**2)], 10_000).alias("cuts"))
    sizes = df.join(F.broadcast(cuts), F.col("v").isNotNull()).groupBy(bucket_number(F.col("v"), F.col("cuts")).alias("b")).count().toPandas()
    assert sizes["count"].max() < 0.05 * len(pdf) and sizes["b"].max() < SIDE**2


def test_scorer_ordering_and_limit(spark):
    df = spark.createDataFrame([(3, 0.0, 0.1), (1, 1.0, 0.8), (2, 1.0, 0.4)], "k long, y_true double, y_pred double")
    scorer = M.custom_scorer(M.binary_metrics, threshold=0.5, target_threshold=0.5)
    got = {r.metric: r.value for r in scorer(df).collect()}
    assert got["recall_at_0.5"] == 0.5 and got["precision_at_0.5"] == 1.0 and got["roc_auc"] == 1.0
    assert [r.k for r in M.sort_by(df, ["k"]).collect()] == [1, 2, 3]
    assert [r.k for r in M.sort_by(df, ["y_true", "k"], [False, False]).collect()] == [2, 1, 3]
    assert [r.k for r in M.limit_rows(df, 2, ["k"]).collect()] == [1, 2]
