import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeful.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(0, 12), st.integers(1, 5), st.integers(1, 12), st.randoms(use_true_random=False))
def test_lookups_give_inner_products(d, n, m, bits, rng):
    q = np.array([[rng.randint(-(1 << bits), (1 << bits) - 1) for _ in range(d)] for _ in range(n + m)], np.int64).reshape(n + m, d)
    planes = bits + 1
    sums = negatives.narrowed(negatives.subset_sums(q[n:]), planes)
    assert (negatives.scores(negatives.pack_planes(q[:n], planes), sums) == q[:n] @ q[n:].T).all()


def brute(rows, anchors=50, positives=5, negatives=3):
    part = []
    for i, x, y in rows:
        if i is not None and y is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            part.append((i, [math.floor(256 * float(np.float32(v))) for v in x], y))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for k, (i, q, y) in enumerate(part):
        if i % anchors:
            continue
        others = [(-score(q, r), j, z) for n, (j, r, z) in enumerate(part) if n != k]
        best = sorted((s, j) for s, j, z in others if z == y)[:positives]
        for s, j in best:
            fit = sorted((t, n) for t, n, z in others if z != y and 50 * -s <= 100 * -t <= 95 * -s)[:negatives]
            out += [(i, j, r, n, -s, -t) for r, (t, n) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **how):
    return sorted(map(tuple, negatives.mine(spark.createDataFrame(rows, SCHEMA), **how).collect()))


@pytest.mark.parametrize("block, files", [(1 << 18, 1 << 12), (100, 3)])
def test_mining_equals_brute_force(spark, monkeypatch, block, files):
    for name, n in (("ROWS_A_BLOCK", block), ("ROWS_AT_ONCE", 30), ("ANCHORS_A_FILE", files), ("ANCHORS_AT_ONCE", 2)):
        monkeypatch.setattr(negatives, name, n)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.5, 0.25, 0.5, 1.0, 3.0]) for _ in range(11)], min(3, rng.randint(0, 6))) for i in range(400)]  # one label holds a half
    rows += rows[50:52] * 2 + [(100, rows[7][1], 2), (0, rows[0][1], 3)]  # repeated rows and anchors, ties
    rows += [(450, [1.0, 2.0], 1), (451, [], 1), (452, None, 1), (453, [1.0, None], 1), (454, [math.nan] * 11, 1), (455, [math.inf] * 11, 1), (456, rows[3][1], None), (None, rows[4][1], 1)]
    assert found(spark, rows) == brute(rows)


def test_mining_of_few_and_no_rows(spark):
    assert found(spark, [(0, [1.0], 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [2.0], 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [2.0], 1), (2, [1.5], 0)]) == [(0, 1, 1, 2, 131072, 98304)]
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty).count() == 0
    odd = spark.createDataFrame([(0, [1.0], 1, 5), (1, [2.0], 1, 5), (2, [1.5], 0, 5)], SCHEMA + ", key long").selectExpr("*", "label as q", "key as id", "key as asked", "key as own", "key as score", "key as slot")
    assert negatives.mine(odd).count() == 1


def test_scores_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="don't fit"):
        found(spark, [(0, [1e12] * 8, 1), (1, [1e12] * 8, 1), (2, [1e12] * 8, 0)])
