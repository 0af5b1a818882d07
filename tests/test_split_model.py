import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wakeful.operators.forest import ForestParams, fit_forest
from wakeful.operators.split import global_rank, group_kfold, group_split
from wakeful.operators.treeshap import explain_samples
from wakeful.settings import MODEL_FEATURES


def _samples(spark, n=400, users=23):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(rng.uniform(size=(n, len(MODEL_FEATURES))), columns=list(MODEL_FEATURES))
    pdf["user_id"] = rng.integers(0, users, n)
    pdf["k"] = np.arange(n)
    pdf["fatigue_score"] = np.clip(0.6 * pdf["hours_awake"] + 0.3 * pdf["stress_cv"] + rng.normal(0, 0.05, n), 0, 1)
    pdf.loc[::17, "hr_jumpiness_5min"] = np.nan
    return spark.createDataFrame(pdf)


def test_group_split_and_kfold(spark):
    df = _samples(spark)
    users = df.select("user_id").distinct().count()
    sp = group_split(df, "user_id", 0.2, 42)
    assert sp.where("split = 'test'").count() == math.ceil(0.2 * users)
    assert sp.groupBy("user_id").count().where("count > 1").count() == 0
    folds = group_kfold(df, 5).toPandas()
    assert folds["user_id"].is_unique and set(folds["fold"]) == set(range(5))
    sizes = df.groupBy("user_id").count().toPandas().merge(folds, on="user_id").groupby("fold")["count"].sum()
    assert sizes.max() - sizes.min() <= df.groupBy("user_id").count().toPandas()["count"].max()


def test_global_rank_is_a_permutation(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000)
    r = global_rank(df, ["k"], "rank").toPandas()
    assert sorted(r["rank"]) == list(range(1000)) and (r.sort_values("k")["rank"].to_numpy() == np.arange(1000)).all()


def test_forest_importances_and_shap_additivity(spark):
    df = _samples(spark)
    ff = fit_forest(df, "fatigue_score", ForestParams(n_estimators=8, max_depth=4))
    imp = ff.importances().toPandas()
    assert abs(imp["importance"].sum() - 1) < 1e-9 and imp.iloc[0]["feature"] in ("hours_awake", "stress_cv")
    scored = ff.transform(df)
    pred = scored.select("k", "prediction").toPandas().set_index("k")
    assert pred["prediction"].between(0, 1).all()
    # the original feature columns come back unchanged (rules read raw values)
    same = scored.join(df.select("k", F.col("hours_awake").alias("_raw")), "k")
    assert same.where(~F.col("hours_awake").eqNullSafe(F.col("_raw"))).count() == 0
    prepared = ff.prepare(df.select("k", *MODEL_FEATURES))
    raw = ff.transform(df, clip=False).select("k", "prediction").toPandas().set_index("k")["prediction"]
    named = prepared.select("k", *[F.col(i).alias(f) for i, f in zip(ff.model_inputs, MODEL_FEATURES)])
    shap = explain_samples(named, ff.trees, list(MODEL_FEATURES), ["k"]).toPandas().set_index("k")
    recon = shap["expected_value"] + shap[[f"shap_{f}" for f in MODEL_FEATURES]].astype(float).sum(axis=1)
    assert np.max(np.abs(recon - raw.loc[recon.index])) < 1e-5


def test_split_breaks_hash_ties_by_id(spark, monkeypatch):
    """Exactly k users whatever the hashes, in (hash, id) order."""
    from wakeful.operators import split

    df = spark.range(10).withColumnRenamed("id", "user_id")
    third = F.shiftleft((F.col("user_id") % 3).cast("long"), 50)
    for hash_, want in ((F.lit(7).cast("long"), [0, 1, 2]), (third, [0, 3, 6])):
        monkeypatch.setattr(split, "user_hash", lambda by, seed, h=hash_: h)
        got = split.group_split(df, "user_id", 0.25, 1).where("split = 'test'").collect()
        assert sorted(r.user_id for r in got) == want


def test_split_edges(spark):
    df = spark.range(7).withColumnRenamed("id", "user_id")
    assert group_split(df, "user_id", 0.0).where("split = 'test'").count() == 0
    assert group_split(df, "user_id", 1.0).where("split = 'train'").count() == 0
    assert group_split(df.limit(0), "user_id").count() == 0


def test_saved_forest_predicts_the_same(spark, tmp_path):
    from wakeful.operators.forest import load_forest, save_forest

    df = _samples(spark)
    for params in (ForestParams(n_estimators=4, max_depth=3), ForestParams(n_estimators=4, max_depth=3, impute="constant", scale="robust")):
        ff = fit_forest(df, "fatigue_score", params)
        back = load_forest(spark, save_forest(ff, f"file://{tmp_path}/{params.scale}"), params)
        a, b = ({r.k: r.prediction for r in m.transform(df).select("k", "prediction").collect()} for m in (ff, back))
        assert a == b and len(a) == df.count()


def _shapley(trees, root, x):
    """Shapley values of one tree by the definition, over all sets of features."""
    flat = trees.flat

    def value(at, known):
        f = flat.feature[at]
        if f < 0:
            return trees.value[at]
        left = flat.left[at]
        if f in known:
            return value(left + (x[f] > trees.threshold[at]), known)
        return sum(flat.cover[c] / flat.cover[at] * value(c, known) for c in (left, left + 1))

    p = len(x)
    game = {known: value(root, known) for r in range(p + 1) for known in map(frozenset, itertools.combinations(range(p), r))}
    out = np.zeros(p)
    for known, v in game.items():
        for i in set(range(p)) - known:
            n = len(known)
            out[i] += math.factorial(n) * math.factorial(p - n - 1) / math.factorial(p) * (game[known | {i}] - v)
    return out, game[frozenset()]


def test_attributions_equal_the_definition(spark, monkeypatch):
    """Deep trees on few features (a path splits on one repeatedly), rows in blocks."""
    from wakeful.operators import treeshap

    few = MODEL_FEATURES[:5]
    df = _samples(spark, n=150).withColumn("fatigue_score", F.abs(F.sin(F.col(few[0]) * 9) * F.col(few[1]) + F.col(few[2]) - F.col(few[3]) * F.col(few[4])))
    ff = fit_forest(df, "fatigue_score", ForestParams(n_estimators=2, max_depth=9, min_samples_leaf=1, min_samples_split=2, features=few))
    x = ff.prepare(df).select(*ff.model_inputs).toPandas().to_numpy(float)
    raw = ff.trees.value[ff.trees.leaves(x)]
    for k, leaves in enumerate(treeshap.leaves_of(ff.trees, len(few))):
        whole, expected = treeshap.tree_shap(x, leaves)
        monkeypatch.setattr(treeshap, "CELLS", 1)
        single, _ = treeshap.tree_shap(x, leaves)
        monkeypatch.undo()
        assert np.allclose(whole, single, atol=1e-12) and np.allclose(expected + whole.sum(axis=1), raw[:, k], atol=1e-9)
        for i in range(0, 150, 30):
            want, base = _shapley(ff.trees, int(ff.trees.flat.roots[k]), x[i])
            assert np.allclose(whole[i], want, atol=1e-9) and abs(base - expected) < 1e-9


def test_row_folds_without_users(spark):
    from wakeful.operators.split import row_kfold

    df = spark.range(1000).withColumnRenamed("id", "k")
    folds = row_kfold(df, 4, ["k"]).groupBy("fold").count().toPandas()
    assert sorted(folds["fold"]) == [0, 1, 2, 3] and folds["count"].min() > 180
    again = row_kfold(df.repartition(3), 4, ["k"])
    assert again.join(row_kfold(df, 4, ["k"]).withColumnRenamed("fold", "f"), "k").where("fold <> f").count() == 0


def _one_by_one(sizes, k):
    loads, out = [0] * k, {}
    for user, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        f = loads.index(min(loads))
        out[user] = f
        loads[f] += n
    return out, loads


def test_turns_equal_one_by_one():
    from wakeful.operators.split import _dealt

    rng = np.random.default_rng(0)
    for _ in range(300):
        k = int(rng.integers(1, 7))
        loads, size, count = [int(x) for x in rng.integers(0, 40, k)], int(rng.integers(1, 9)), int(rng.integers(1, 60))
        turns, after = _dealt(loads, size, count)
        want, now = [], list(loads)
        for _ in range(count):
            f = now.index(min(now))
            want.append(f)
            now[f] += size
        got = []
        for r in range(count):
            since, folds = [t for t in turns if t[0] <= r][-1]
            got.append(folds[(r - since) % len(folds)])
        assert got == want and after == now and len(turns) <= k


def test_folds_equal_the_greedy_rule(spark):
    rng = np.random.default_rng(5)
    for k, sizes in ((5, rng.integers(1, 6, 200)), (3, np.r_[[500], rng.integers(1, 4, 300)]), (4, [7, 7]), (2, [3, 3, 3, 3, 3])):
        sizes = {u: int(n) for u, n in enumerate(sizes)}
        df = spark.createDataFrame([(u,) for u, n in sizes.items() for _ in range(n)], "user_id long")
        got = {r["user_id"]: r["fold"] for r in group_kfold(df, k).collect()}
        assert got == _one_by_one(sizes, k)[0]
    assert group_kfold(spark.createDataFrame([], "user_id long"), 3).count() == 0
