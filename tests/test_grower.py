import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeful.operators import grower
from wakeful.operators.forest import ForestParams, fit_forest, forest_of, load_forest, save_forest
from wakeful.operators.grower import NODE, Forest, bin_samples, compile_nodes, cross_scores, grow, held_out_scores, nodes_of
from wakeful.plans import modeling
from wakeful.settings import MODEL_FEATURES

WHOLE = dict(max_depth=4, min_samples_split=2, min_samples_leaf=1, features=2, bootstrap=False, seed=1)


def by_place(nodes):
    return sorted((int(n["tree"]), int(n["id"]), int(n["feature"]), int(n["bin"]), float(n["n"]), float(n["s"]), round(float(n["gain"]), 3)) for n in nodes)


def test_splits_of_a_small_table_by_hand(spark):
    """30 samples: a is 1..30, b is 1 for the odd ones. y is 0 up to a = 10; beyond, 4 for
    odd a and 2 for even. The first split is a <= 10 (squared error falls by
    90 - 30 * 2^2 + 20 * 3^2 ... = 60), the second b, on the right side only."""
    rows = [(a, float(a % 2), 0.0 if a <= 10 else 4.0 if a % 2 else 2.0) for a in range(1, 31)]
    df = spark.createDataFrame(rows, "a int, b double, y double")
    binned = bin_samples(df, ["a", "b"], "y")
    assert binned.cuts[0] == [float(a) for a in range(1, 31)][: len(binned.cuts[0])]
    nodes = nodes_of(grow(binned, [Forest(trees=1, **WHOLE)]), 0)
    unit = binned.unit
    found = {int(n["id"]): (int(n["feature"]), binned.cuts[n["feature"]][n["bin"]] if n["feature"] >= 0 else None, n["n"], round(n["s"] * unit / n["n"], 6), round(n["gain"] * unit**2, 4)) for n in nodes}
    assert found == {1: (0, 10.0, 30, 2.0, 60.0), 2: (-1, None, 10, 0.0, 0.0), 3: (1, 0.0, 20, 3.0, 20.0), 6: (-1, None, 10, 2.0, 0.0), 7: (-1, None, 10, 4.0, 0.0)}
    # 20 samples are too few to split where 21 are asked for
    less = nodes_of(grow(binned, [Forest(trees=1, **{**WHOLE, "min_samples_split": 21})]), 0)
    assert sorted(less["id"].tolist()) == [1, 2, 3]
    # with 11 on each side, the first cut moves to a <= 11
    leaf = nodes_of(grow(binned, [Forest(trees=1, **{**WHOLE, "min_samples_leaf": 11, "max_depth": 1})]), 0)
    assert {int(n["id"]): n["n"] for n in leaf} == {1: 30, 2: 11, 3: 19}


def table(spark, n=600, parts=3):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({c: rng.integers(0, 9, n) / 4.0 if c == "c" else rng.normal(size=n).round(2) for c in "abcde"})
    pdf["y"] = np.clip(np.sin(2 * pdf["a"]) * pdf["b"] + pdf["c"] * 0.3 + rng.normal(0, 0.1, n), 0, 1)
    pdf["fold"] = rng.integers(0, 3, n)
    pdf.loc[::13, "d"] = np.nan
    pdf = pd.concat([pdf, pdf[:150]])  # repeated rows
    return spark.createDataFrame(pdf).repartition(parts)


def one_tree(codes, y, w, f, tree):
    """The rules of the module, node by node, in plain Python."""
    out = []

    def node(rows, id_):
        n, s = int(w[rows].sum()), int((w[rows] * y[rows]).sum())
        best = None
        if id_.bit_length() - 1 < f.max_depth and n >= f.min_samples_split:
            for k in grower.node_features(f.seed, np.array([tree]), np.array([id_]), codes.shape[1], f.features)[0]:
                for cut in range(grower.BINS - 1):
                    left = rows[codes[rows, k] <= cut]
                    ln, ls = int(w[left].sum()), int((w[left] * y[left]).sum())
                    if ln >= f.min_samples_leaf and n - ln >= f.min_samples_leaf and ln and n - ln:
                        gain = ls * ls / ln + (s - ls) ** 2 / (n - ln) - s * s / n
                        if gain > 1e-9 * max(s * s / n, 1) and (best is None or gain > best[0] * (1 + 1e-12)):
                            best = (gain, int(k), cut)
        out.append((tree, id_, *(best[1:] if best else (-1, 0)), float(n), float(s)))
        if best:
            right = codes[rows, best[1]] > best[2]
            node(rows[~right], 2 * id_)
            node(rows[right], 2 * id_ + 1)

    node(np.flatnonzero(w > 0), 1)
    return out


@pytest.fixture(scope="module")
def packed(spark):
    return bin_samples(table(spark), list("abcde"), "y", "fold")


FORESTS = [
    Forest(trees=4, max_depth=6, min_samples_split=5, min_samples_leaf=2, features=2, bootstrap=True, seed=7, fold=1, fill=(0, 0, 0, 15, 0)),
    Forest(trees=3, max_depth=9, min_samples_split=2, min_samples_leaf=1, features=5, bootstrap=False, seed=7, fold=0, fill=(0, 0, 0, 3, 0)),
    Forest(trees=2, max_depth=3, min_samples_split=40, min_samples_leaf=9, features=3, bootstrap=True, seed=9, fold=None, fill=(0, 0, 0, 9, 0)),
]


def rows_of(packed, f):
    blocks = packed.blocks.toPandas()
    blocks = blocks[blocks["fold"] != (-1 if f.fold is None else f.fold)]
    codes = np.concatenate([np.frombuffer(c, np.uint8).reshape(-1, 5) for c in blocks["codes"]])
    return grower._filled(codes, f), np.concatenate([np.frombuffer(p, grower.PART) for p in blocks["part"]])


def test_trees_equal_brute_force(packed):
    grown = grow(packed, FORESTS)
    for i, f in enumerate(FORESTS):
        codes, part = rows_of(packed, f)
        want = [n for t in range(f.trees) for n in one_tree(codes, part["y"], grower._draws(f, part, t), f, t)]
        assert [x[:6] for x in by_place(nodes_of(grown, i))] == sorted(want)


@pytest.mark.parametrize("local, pack", [(100, 60), (20, 10**6)])
def test_levels_give_the_same_trees(packed, local, pack):
    whole, parted = grow(packed, FORESTS), grow(packed, FORESTS, local=local, pack_rows=pack)
    assert any((t["id"] > 1).any() for t in parted.tops)
    for i in range(len(FORESTS)):
        assert by_place(nodes_of(whole, i)) == by_place(nodes_of(parted, i))
    a, b = (sorted(map(tuple, held_out_scores(packed, g, 0.3).collect())) for g in (whole, parted))
    assert [x[0] for x in a] == [0, 1] and np.allclose(np.array(a, float), np.array(b, float), rtol=1e-12)


def test_trees_do_not_depend_on_partitions(spark, packed):
    other = bin_samples(table(spark, parts=11), list("abcde"), "y", "fold")
    a, b = grow(packed, FORESTS[:1]), grow(other, FORESTS[:1])
    assert by_place(nodes_of(a, 0)) == by_place(nodes_of(b, 0))


def test_held_out_scores_equal_brute_force(packed):
    grown = grow(packed, FORESTS)
    for i, n_test, sse, tp, fn in held_out_scores(packed, grown, 0.3).collect():
        f = FORESTS[i]
        codes, part = rows_of(packed, Forest(**{**f.__dict__, "fold": None}))
        blocks = packed.blocks.where(F.col("fold") == f.fold).toPandas()
        codes = grower._filled(np.concatenate([np.frombuffer(c, np.uint8).reshape(-1, 5) for c in blocks["codes"]]), f)
        part = np.concatenate([np.frombuffer(p, grower.PART) for p in blocks["part"]])
        flat = compile_nodes(nodes_of(grown, i))
        p = np.clip(flat.value[flat.leaves(codes)].mean(axis=1) * packed.unit, 0, 1)
        y = part["y"] * packed.unit
        assert n_test == part["n"].sum() and np.isclose(sse, (part["n"] * (p - y) ** 2).sum())
        assert tp == part["n"][(y >= 0.3) & (p >= 0.3)].sum() and fn == part["n"][(y >= 0.3) & (p < 0.3)].sum()


@pytest.mark.parametrize("local, pack", [(10**6, 10**6), (10**6, 1), (350, 60), (20, 60)])
def test_scores_at_once_equal_those_of_the_nodes(packed, local, pack):
    """Of whole trees (in one group or many), of levels alone, of levels and packs."""
    a, b = sorted(map(tuple, held_out_scores(packed, grow(packed, FORESTS), 0.3).collect())), sorted(map(tuple, cross_scores(packed, FORESTS, 0.3, local, pack).collect()))
    assert [x[0] for x in b] == [0, 1] and np.allclose(np.array(a, float), np.array(b, float), rtol=1e-12)


def test_rows_are_sent_to_groups_not_to_trees(packed, monkeypatch):
    """Sixty times the trees: no more groups than allowed, each tree in one of them, and
    shallow trees of many rows are grown without sending any row."""
    monkeypatch.setattr(grower, "GROUPS", 3)
    many = [Forest(**{**f.__dict__, "trees": 60 * f.trees}) for f in FORESTS]
    groups = grower._groups(packed, many, [0, 1, 2], 1, 3)
    assert len(groups) == 3
    for i, f in enumerate(many):
        assert sorted(t for g in groups for s in g if s.forest == i for t in s.trees.tolist()) == list(range(f.trees))
    shallow = grow(packed, [FORESTS[0]], local=20, pack_rows=60)
    assert shallow.packs.count() == 0 and not (shallow.tops[0]["feature"] == -2).any()


def kin(bootstrap, features):
    stops = [(4, 2, 1), (9, 2, 1), (9, 12, 1), (9, 2, 3), (6, 5, 3), (9, 2, 20), (3, 60, 7), (9, 2, 400)]
    return [Forest(trees=2 + i % 3, max_depth=d, min_samples_split=n, min_samples_leaf=m, features=features, bootstrap=bootstrap, seed=5, fold=1, fill=(0, 0, 0, 15, 0)) for i, (d, n, m) in enumerate(stops)]


@pytest.mark.parametrize("at_once", [1 << 18, 200])
@pytest.mark.parametrize("bootstrap, features", [(True, 2), (False, 2), (True, 5), (False, 5)])
def test_forests_that_stop_elsewhere_share_their_trees(packed, monkeypatch, bootstrap, features, at_once):
    """Values of each forest's own trees, from less than half of the work of growing each alone."""
    monkeypatch.setattr(grower, "AT_ONCE", at_once)
    forests = kin(bootstrap, features)
    other = Forest(**{**forests[0].__dict__, "seed": 6})
    (family, alone) = grower.families([*forests, other], range(9), 5)
    assert sorted(family.forests) == list(range(8)) and alone.forests == [8]
    codes, part = rows_of(packed, forests[0])
    tried, _ = rows_of(packed, Forest(**{**forests[0].__dict__, "fold": None}))
    trees = grower.FamilyTrees(codes, part, tried, family, forests)
    trees.add(np.arange(family.lead.trees))
    pairs = 0
    for i, total in zip(family.forests, trees.total):
        f, want = forests[i], np.zeros(len(tried))
        for t in range(f.trees):
            w = grower._draws(f, part, t)
            some = np.flatnonzero(w > 0)
            nodes = grower.grow_subtrees(codes, some, np.full(len(some), t), np.ones(len(some), np.int64), part["y"][some], w[some], f)
            grower._add_values(want, compile_nodes(nodes), tried)
        assert np.allclose(total, want, rtol=1e-12)
        own = grower.FamilyTrees(codes, part, tried, grower.families(forests, [i], 5)[0], forests)
        own.add(np.arange(1 if own.alike else f.trees))
        pairs += own.pairs
    assert 2 * trees.pairs < pairs


def test_large_families_are_split_and_many_scores_stay_right(packed, monkeypatch):
    """Families of at most three forests, trees in many groups: the scores of the nodes."""
    forests = [Forest(**{**f.__dict__, "fold": k}) for b, m in ((True, 2), (False, 5)) for f in kin(b, m) for k in (0, 2)]
    assert len(grower.families(forests, range(32), 5)) == 4
    monkeypatch.setattr(grower, "FAMILY", 3)
    assert len(grower.families(forests, range(32), 5)) == 12
    a = sorted(map(tuple, held_out_scores(packed, grow(packed, forests), 0.3).collect()))
    b = sorted(map(tuple, cross_scores(packed, forests, 0.3, 10**6, 1).collect()))
    assert [x[0] for x in b] == list(range(32)) and np.allclose(np.array(a, float), np.array(b, float), rtol=1e-12)


@pytest.mark.parametrize("used", [100, 500])
@pytest.mark.parametrize("top", [3, 10**6])
def test_sums_of_cells_by_bins_and_by_sorting(top, used):
    rng = np.random.default_rng(2)
    w, y = rng.integers(1, top, 300).astype(float), rng.integers(-(1 << 24), 1 << 24, 300)
    key = rng.integers(0, used, (3, 300))
    n, s = (np.bincount(key.ravel(), np.tile(x, 3), used) for x in (w, w * y))
    for cells in (used, 10**6):
        at, a, b = grower._cells(key, cells, w, w * y, n.max())
        assert at.tolist() == np.flatnonzero(n).tolist() and (a == n[at]).all() and (b == s[at]).all()


def test_features_of_a_node_are_those_of_least_hash():
    tree, ids = np.repeat(np.arange(40), 50), np.tile(np.arange(1, 51), 40)
    for width, most in ((12, 3), (5, 2), (16, 4), (2, 1)):
        with np.errstate(over="ignore"):
            base = grower._mix(np.uint64(9) + grower._mix(tree.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)))
            base = grower._mix(base + ids.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
            h = grower._mix(base[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        want = [sorted(sorted(range(width), key=lambda k: r[k])[:most]) for r in h.tolist()]
        assert grower.node_features(9, tree, ids, width, most).tolist() == want


def test_draws_equal_inversion_by_steps():
    rng = np.random.default_rng(1)
    rid, n = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.integers(1, 90, 5000)
    u = (grower._mix(rid ^ grower._key(3, 5)) >> np.uint64(11)).astype(float) / (1 << 53)
    w = grower.poisson(rid, n, 3, 5)
    for k in np.flatnonzero(n <= 64).tolist()[:500]:
        term = upto = np.exp(-float(n[k]))
        found = 0
        while u[k] >= upto:
            found += 1
            term = term * n[k] / found
            upto += term
        assert w[k] == found


def test_bootstrap_draws():
    rid = np.random.default_rng(0).integers(0, 1 << 63, 40_000).astype(np.uint64)
    for mean in (1, 5, 60, 5000):
        w = grower.poisson(rid, np.full(len(rid), mean), 3, 5)
        assert abs(w.mean() / mean - 1) < 0.03 and abs(w.var() / mean - 1) < 0.05
    assert (grower.poisson(rid, np.ones(len(rid), int), 3, 5) != grower.poisson(rid, np.ones(len(rid), int), 3, 6)).any()


def test_empty_and_constant_samples(spark):
    schema = "a double, y double"
    none = bin_samples(spark.createDataFrame([], schema), ["a"], "y")
    f = Forest(trees=2, **{**WHOLE, "features": 1})
    assert len(nodes_of(grow(none, [f]), 0)) == 0
    same = bin_samples(spark.createDataFrame([(1.0, 0.5)] * 9 + [(2.0, None), (float("nan"), 0.5)], schema), ["a"], "y")
    assert [n[:5] for n in by_place(nodes_of(grow(same, [f]), 0))] == [(0, 1, -1, 0, 10.0), (1, 1, -1, 0, 10.0)]


def samples(spark, n=500, users=23):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(rng.uniform(size=(n, len(MODEL_FEATURES))), columns=list(MODEL_FEATURES))
    pdf["user_id"] = rng.integers(0, users, n)
    pdf["fatigue_score"] = np.clip(0.6 * pdf["hours_awake"] + 0.3 * pdf["stress_cv"] + rng.normal(0, 0.05, n), 0, 1)
    pdf.loc[::17, "hr_jumpiness_5min"] = np.nan
    return spark.createDataFrame(pdf)


def test_search_fits_every_trial(spark):
    df = samples(spark)
    rows = modeling.search_params(df, n_trials=4, n_splits=3).collect()
    drawn = modeling.sample_params(4)
    assert sorted(r["trial"] for r in rows) == [0, 1, 2, 3] and [r["rmse"] for r in rows] == sorted(r["rmse"] for r in rows)
    for r in rows[:2]:
        p = drawn[r["trial"]]
        assert (r["n_estimators"], r["max_depth"], r["min_samples_split"], r["min_samples_leaf"], r["max_features"], r["bootstrap"]) == (p.n_estimators, p.max_depth, p.min_samples_split, p.min_samples_leaf, str(p.max_features), p.bootstrap)
        own = modeling.cross_validate(df, p, 3).agg(F.avg("rmse"), F.avg("recall")).first()
        assert np.allclose(own, (r["rmse"], r["recall"]))
    assert rows[0]["rmse"] < 0.12


def test_learning_beats_the_mean_and_the_scorer_equals_the_folds(spark):
    """A model fitted on all but one fold scores that fold as the search does."""
    df = samples(spark).withColumn("fold", F.col("user_id") % 3)
    params = ForestParams(n_estimators=20)
    folds = df.select("user_id", "fold").distinct()
    scores = {r["fold"]: r for r in modeling.cross_validate(df, params, 3, folds=folds).collect()}
    ff = fit_forest(df.where("fold <> 1"), "fatigue_score", params)
    err = ff.transform(df.where("fold = 1"), "p").select(F.sqrt(F.avg(F.pow(F.col("p") - F.col("fatigue_score"), 2)))).first()[0]
    # bins come from all samples in a search, from the training rows in a fit
    assert abs(scores[1]["rmse"] - err) < 0.02 and err < 0.15


def test_saved_forest_checks_its_format(spark, tmp_path):
    ff = fit_forest(samples(spark, 100), "fatigue_score", ForestParams(n_estimators=2, max_depth=2))
    path = save_forest(ff, f"file://{tmp_path}/m")
    assert load_forest(spark, path).params == ff.params
    with pytest.raises(ValueError, match="features"):
        load_forest(spark, path, ForestParams(features=("a",)))


def test_split_size_takes_effect(spark):
    df = samples(spark)
    sizes = [len(fit_forest(df, "fatigue_score", ForestParams(n_estimators=3, max_depth=8, min_samples_split=k)).trees.flat.ids) for k in (2, 60)]
    assert sizes[0] > 2 * sizes[1]
    assert NODE.itemsize and forest_of(ForestParams()).features == 3
