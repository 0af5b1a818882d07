"""Scale guards on physical plans: no window over data without a partition key,
and the series windows never partition by the user alone."""

import re

import numpy as np
import pandas as pd
import pytest

from wakeful.operators import drift as D
from wakeful.operators import metrics as M
from wakeful.operators.asof import asof_backward, asof_nearest
from wakeful.operators.clean import clean_hr
from wakeful.operators.windows import hr_series_features, sleep_features
from wakeful.plans.registry import QUERIES
from wakeful.settings import EVENTS_SCALE as S
from wakeful.sources.feeds import events_feeds

SF = "/root/testdata/sf0.001"


def _windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]


def _groups(text):
    """Top-level [...] groups of a plan line."""
    out, depth, start = [], 0, None
    for i, ch in enumerate(text):
        if ch == "[":
            if depth == 0:
                start = i + 1
            depth += 1
        elif ch == "]":
            depth -= 1
            if depth == 0:
                out.append(text[start:i])
    return out


def _partition_specs(df, bounded_prefix: str = "sum(_t_"):
    """Partition keys of every Window operator over data. Spark prints
    ``Window [functions], [partition keys], [order keys]`` and drops the middle list
    when there is no partition key. Windows over the bucket-totals table of
    ``running_totals`` (at most ``buckets`` rows, functions over ``_t_*``) are bounded
    by construction and reported as "bounded"."""
    specs = []
    for line in _windows(df):
        g = _groups(line[line.index("Window [") + len("Window "):])
        spec = g[1] if len(g) >= 3 else ""
        if not spec and bounded_prefix in g[0]:
            spec = "bounded"
        specs.append(spec)
    return specs


def test_guard_detects_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert _partition_specs(df) == [""]


def test_series_windows_are_bucketed(spark):
    f = events_feeds(spark, SF)
    hr = clean_hr(f["hr"], S, bucketed=True)
    feats = hr_series_features(hr, S)
    specs = _partition_specs(feats)
    assert specs and all(s.strip() for s in specs)
    # data-sized windows are keyed by (user, bucket); the user-only ones run on the bucket table
    assert sum(("b#" in s or "bb#" in s) for s in specs) >= 2
    sl = sleep_features(f["sleep"].selectExpr("user_id", "START", "`END`", "1.0 AS duration"), S)
    assert all(s.strip() for s in _partition_specs(sl))


def test_asof_and_running_totals_have_no_global_window(spark):
    f = events_feeds(spark, SF)
    hr = clean_hr(f["hr"], S)
    j = asof_backward(hr, hr.selectExpr("user_id", "t AS rt", "HR AS v"), ["user_id"], "t", "rt", ["v"], S.bucket_us)
    assert all(s.strip() for s in _partition_specs(j))
    n = asof_nearest(hr, hr.selectExpr("user_id", "t AS rt", "HR AS v"), ["user_id"], "t", "rt", ["v"], S.tolerance_us, S.bucket_us)
    assert all(s.strip() for s in _partition_specs(n))
    rng = np.random.default_rng(0)
    sc = spark.createDataFrame(pd.DataFrame({"y_true": rng.integers(0, 2, 200).astype(float), "y_pred": rng.uniform(size=200)}))
    for df in (M.roc_auc(sc), M.pr_curve(sc, "y_true", "y_pred", 0.5)):
        assert all(s.strip() for s in _partition_specs(df))
    long = D.unpivot(sc.withColumn("side", (sc.y_true > 0).cast("int")), ["y_pred"], ["side"])
    assert all(s.strip() for s in _partition_specs(D.ks_two_sample(long)))


# windows over a table that is bounded whatever the data: one row per partition
BOUNDED_ORDER = ("_pid#",)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"search_params"}))
def test_every_registered_plan(spark, name):
    """No cartesian product or nested-loop join, no window over data without a
    partition key, in the final plan of any registered query. (``search_params``
    repeats the plans of ``cross_validate`` and takes a minute.)"""
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    for line in _windows(df):
        groups = _groups(line[line.index("Window [") + len("Window "):])
        bounded = len(groups) == 2 and any(groups[1].startswith(b) for b in BOUNDED_ORDER)
        assert len(groups) >= 3 or bounded or "sum(_t_" in groups[0], line
