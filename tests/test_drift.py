import numpy as np
import pandas as pd

from wakeful.operators import drift as D


def test_ks_statistic_and_pvalue(spark):
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(0, 1, 400), 2)
    b = np.round(rng.normal(0.5, 1, 300), 2)
    long = spark.createDataFrame(
        pd.DataFrame({"side": [0] * len(a) + [1] * len(b), "feature": "x", "value": np.concatenate([a, b])})
    )
    r = D.ks_two_sample(long, method="asymptotic").first()
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert abs(r.statistic - np.max(np.abs(fa - fb))) < 1e-12
    lam = np.sqrt(len(a) * len(b) / (len(a) + len(b))) * r.statistic
    k = np.arange(1, 200)
    p = 2 * np.sum((-1.0) ** (k - 1) * np.exp(-2 * k**2 * lam**2))
    assert abs(r.p_value - p) < 1e-9 and r.drift_detected


def test_kolmogorov_small_lambda_branch(spark):
    lam = spark.createDataFrame([(0.5,), (0.9,), (1.36,), (0.0,)], "lam double")
    got = [row[0] for row in lam.select(D.kolmogorov_sf("lam")).collect()]
    assert abs(got[0] - 0.9639452436648751) < 1e-9  # P(K > 0.5)
    assert abs(got[2] - 0.0494) < 5e-4 and got[3] == 1.0


def test_robust_scale_iqr_zero_and_summary(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "x double, c double")
    long = D.unpivot(df, ["x", "c"])
    p = {r.feature: (r.center, r.scale) for r in D.robust_params(long).collect()}
    assert p["x"] == (2.5, 4.75 - 1.75) and p["c"] == (5.0, 1.0)  # IQR 0 -> scale 1
    ks = spark.createDataFrame([("a", True), ("b", False), ("c", False), ("d", False)], "feature string, drift_detected boolean")
    s = D.drift_summary(ks, 4).first()
    assert s.n_drifted == 1 and s.drift_share == 0.25 and s.drift_passed


def test_fit_impute_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,)], "x double")
    p = D.fit_impute_scale(df, ["x"]).first()
    filled = np.array([1.0, 2.0, 2.0, 10.0])
    assert p.fill == 2.0 and abs(p.center - filled.mean()) < 1e-12 and abs(p.scale - filled.std()) < 1e-12
    out = [r.x for r in D.apply_impute_scale(df, D.fit_impute_scale(df, ["x"]), ["x"]).collect()]
    assert abs(np.mean(out)) < 1e-12


def _long(spark, a, b):
    return spark.createDataFrame(
        pd.DataFrame({"side": [0] * len(a) + [1] * len(b), "feature": "x", "value": np.concatenate([a, b]).astype(float)})
    )


def test_drift_pairs(spark):
    rng = np.random.default_rng(9)
    a = np.round(rng.normal(0, 1, 500), 3)
    same = D.ks_two_sample(D.robust_scale_long(_long(spark, a, a), ("feature", "side"))).first()
    assert same.statistic == 0.0 and same.p_value == 1.0 and not same.drift_detected
    shifted = _long(spark, a, a + 5.0)
    own = D.ks_two_sample(D.robust_scale_long(shifted, ("feature", "side"))).first()
    ref = D.ks_two_sample(D.robust_scale_long(shifted, ("feature", "side"), fit_on_side=0)).first()
    assert own.statistic < 0.02 and not own.drift_detected  # invisible by design when each side scales itself
    assert ref.statistic > 0.9 and ref.drift_detected
    reshaped = D.ks_two_sample(D.robust_scale_long(_long(spark, a, np.round(rng.exponential(1, 500), 3)), ("feature", "side"))).first()
    assert reshaped.drift_detected


def _paths(n0, n1, top):
    """P(max |i n1 - j n0| >= top) by counting every lattice path with whole numbers."""
    from functools import lru_cache
    from math import comb

    @lru_cache(None)
    def inside(i, j):
        if abs(i * n1 - j * n0) >= top:
            return 0
        if i == n0 and j == n1:
            return 1
        return (inside(i + 1, j) if i < n0 else 0) + (inside(i, j + 1) if j < n1 else 0)

    return 1 - inside(0, 0) / comb(n0 + n1, n0)


def test_exact_p_values():
    # tables of the two-sample statistic: n0 = n1 = 5, D = 3/5, 4/5, 1; n0 = 3, n1 = 4, D = 1
    for n0, n1, top, want in ((5, 5, 15, 0.357143), (5, 5, 20, 0.079365), (5, 5, 25, 0.007937), (3, 4, 12, 0.057143)):
        assert abs(D.ks_exact_p(n0, n1, top) - want) < 1e-6
    for n0, n1 in ((1, 1), (1, 7), (6, 6), (9, 4), (12, 13), (20, 30)):
        for top in range(0, n0 * n1 + 1, max(1, n0 * n1 // 7)):
            assert abs(D.ks_exact_p(n0, n1, top) - (_paths(n0, n1, top) if top else 1.0)) < 1e-12
    assert abs(D.ks_exact_p(40, 40, 1600) * 107507208733336176461620 - 2) < 1e-9  # both samples apart: 2 / C(80, 40)
    large, limit = D.ks_exact_p(4000, 5000, 600_000), 2 * np.exp(-2 * (0.03**2) * 4000 * 5000 / 9000)
    assert abs(large / limit - 1) < 0.1


def test_exact_p_by_group(spark):
    rows = [("a", 0, float(v)) for v in range(5)] + [("a", 1, float(v) + 2.5) for v in range(5)] + [("b", 0, 1.0), ("b", 1, 1.0), ("c", 0, 3.0)]
    long = spark.createDataFrame(rows, "feature string, side int, value double")
    got = {r.feature: r for r in D.ks_two_sample(long).collect()}
    assert abs(got["a"].p_value - _paths(5, 5, 15)) < 1e-12 and abs(got["a"].statistic - 0.6) < 1e-12
    assert got["b"].p_value == 1.0 and got["b"].statistic == 0.0 and not got["b"].drift_detected
    assert got["c"].n_current == 0


def test_label_and_zscore_drift(spark):
    rows = [("a", 0)] * 8 + [("b", 0)] * 2 + [("a", 1)] * 5 + [("b", 1)] * 3 + [("c", 1)] * 2
    got = {r.label: r for r in D.label_drift(spark.createDataFrame(rows, "l string, side int"), "l").collect()}
    assert [round(got[x].change, 6) for x in "abc"] == [-0.3, 0.1, 0.2] and [got[x].alert for x in "abc"] == [True, False, True]
    one = D.label_drift(spark.createDataFrame(rows[:10], "l string, side int"), "l").collect()
    assert sorted(r.share_current for r in one) == [0.0, 0.0]
    long = [("x", 0, float(v)) for v in (1, 2, 3, 4, 5)] + [("x", 1, v) for v in (3.0, 30.0, 3.0, 3.0)] + [("k", 0, 7.0), ("k", 1, 7.5), ("n", 1, 1.0)]
    z = {r.feature: r for r in D.zscore_drift(spark.createDataFrame(long, "feature string, side int, value double")).collect()}
    assert abs(z["x"].z_mean - 6.75 / 2**0.5) < 1e-9 and z["x"].share_outside == 0.25 and z["x"].alert
    assert z["k"].z_mean == 0.5 and not z["k"].alert and z["n"].z_mean is None and not z["n"].alert


def test_stratified_sample_is_exact(spark):
    from wakeful.operators.split import stratified_sample

    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'big' WHEN id % 50 = 1 THEN NULL WHEN id % 7 = 1 THEN 'mid' ELSE concat('s', id % 4) END AS s")
    n = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    got = stratified_sample(df, "s", ["id"], 0.13)
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {s: int(np.ceil(0.13 * c)) for s, c in n.items()}
    again = stratified_sample(df.repartition(7), "s", ["id"], 0.13)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in again.collect())
    assert stratified_sample(df, "s", ["id"], 0.0).count() == 0 and stratified_sample(df, "s", ["id"], 1.0).count() == 3000
