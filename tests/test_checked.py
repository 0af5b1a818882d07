"""Rows set apart: quarantine, checked CSV files, and predictors with a signature."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeful.operators import predictors as PR
from wakeful.operators import schemas as SCH
from wakeful.plans import modeling
from wakeful.sources.files import read_csv_checked


def test_quarantine_counts_what_it_writes(spark, tmp_path):
    rows = [("1", "t", 60.0), ("x", "t", 61.0), (None, "t", -1.0), ("4", None, float("nan")), ("5", "t", None)]
    df = spark.createDataFrame(rows, "id string, HRTIME string, HR double")
    got = SCH.quarantine(df, SCH.HEART_RATE_RAW, f"file://{tmp_path}/q")
    counts = {r["rule"]: r["n_bad"] for r in got.counts.collect()}
    assert counts == {"coerce:id": 1, "null:id": 1, "coerce:HRTIME": 0, "null:HRTIME": 1, "coerce:HR": 0, "gt:HR": 1, "rows:valid": 2, "rows:rejected": 3}
    assert sorted(tuple(r) for r in got.valid.collect()) == [(1, "t", 60.0), (5, "t", None)]
    assert got.valid.schema["id"].dataType.simpleString() == "bigint"
    bad = {json.loads(r["row"]).get("id"): sorted(r["rules"]) for r in got.rejected.collect()}
    assert bad == {"x": ["coerce:id"], None: ["gt:HR", "null:id"], "4": ["null:HRTIME"]}
    for schema in SCH.SCHEMAS:  # the counts are those of the two-step validation
        one = SCH.quarantine(df, schema, f"file://{tmp_path}/{schema.name}").counts.where("rule not like 'rows:%'")
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, SCH.validate(df, schema).collect())) if schema.strict else True
    empty = SCH.quarantine(df.limit(0), SCH.HEART_RATE_RAW, f"file://{tmp_path}/e")
    assert empty.valid.count() == empty.rejected.count() == 0


def test_checked_csv(spark, tmp_path):
    files = {
        "good.csv": "a,b\n1,2.5\n2,\n",
        "Upper.csv": 'A,"B"\n3,1.0\nx,1.0\n4,1,9\n5\n',
        "other.csv": "b,a\n1,2.5\n7,8\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, bad = read_csv_checked(spark, f"file://{tmp_path}", "a long, b double")
    assert sorted((r["file"], r["a"], r["b"]) for r in good.collect()) == [("Upper.csv", 3, 1.0), ("good.csv", 1, 2.5), ("good.csv", 2, None)]
    found = sorted(map(tuple, bad.collect()))
    assert [x for x in found if x[0] == "Upper.csv"] == [("Upper.csv", "4,1,9"), ("Upper.csv", "5"), ("Upper.csv", "x,1.0")]
    assert len([x for x in found if x[0] == "other.csv"]) == 2 and len(found) == 5
    good, bad = read_csv_checked(spark, f"file://{tmp_path}/good.csv", "a long, b double", header=False)
    assert good.count() == 2 and [r["line"] for r in bad.collect()] == ["a,b"]


def test_predictors_are_saved_checked_and_applied(spark, tmp_path):
    class Halves:  # local classes travel by value
        def predict(self, rows: pd.DataFrame) -> np.ndarray:
            return rows["x"].to_numpy() / 2

    class Short:
        def predict(self, rows):
            return [0.0]

    df = spark.range(50).select("id", (F.col("id") / 25).alias("x"), F.lit("t").alias("text"))
    path = f"file://{tmp_path}/p"
    PR.save_predictor(spark, PR.Predictor(PR.LinearRule({"x": 1.0}, 0.5), ["x"], version=1), path)
    PR.save_predictor(spark, PR.Predictor(Halves(), ["x"], version=2), path)
    latest, first = PR.load_predictor(spark, path), PR.load_predictor(spark, path, 1)
    assert (latest.version, first.version) == (2, 1)
    got = {r["id"]: r for r in modeling.batch_inference(latest, df, 0.26, keys=["id"]).collect()}
    assert all(abs(got[i]["fatigue_probability"] - i / 50) < 1e-12 for i in range(50)) and got[13]["status"] == "Fatigued" and got[12]["status"] == "Awake"
    scores = {r["id"]: r["p"] for r in first.transform(df, "p").collect()}
    assert scores[0] == 0.5 and scores[49] == 1.0  # clipped
    with pytest.raises(ValueError, match="other features"):
        PR.load_predictor(spark, path, features=["y"])
    with pytest.raises(ValueError, match="no version"):
        PR.load_predictor(spark, path, 9)
    with pytest.raises(ValueError, match="numeric"):
        PR.Predictor(Halves(), ["text"]).transform(df)
    with pytest.raises(Exception, match="predictions for"):
        PR.Predictor(Short(), ["x"]).transform(df.coalesce(1), "p").collect()
