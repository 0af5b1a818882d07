"""Driver contract: entry smoke, registry consistency, oracle agreement at sf0.001."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from wakeful.sources.feeds import TABLES

SF = "/root/testdata/sf0.001"
FAST = [
    "hr_features", "sleep_features", "pvt_targets", "training_features", "inference_features",
    "regression_metrics", "binary_metrics", "pr_curve", "classification_report", "ks_drift",
    "kb_match", "asof_nearest", "asof_backward", "safety_overrides", "request_features",
    "group_split", "group_kfold", "stream_minute_grid", "validate_inputs",
]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "fatigue_score" in df.columns


def test_registry_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    rel = con.sql(E.oracle_sql()[name])
    orows, ocols = rel.fetchall(), rel.columns
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)


def test_release_scratch(spark):
    import os

    from wakeful.session import cut_lineage, release_scratch, scratch_path

    t = cut_lineage(spark.range(10), "release-test")
    assert t.count() == 10
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    n = release_scratch(spark, keep=(kept,))
    assert n >= 1 and os.path.exists(kept.replace("file:", ""))
