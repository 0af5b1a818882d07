"""Any predictor behind one interface, saved with its signature and version.

A predictor is an object with ``predict(rows)``: a table of its features (a pandas
DataFrame, in the signature's order) to one number a row. It is serialised whole, next to
its signature (feature names and output) and version, and applied to Arrow batches inside
tasks, so a library's own model, a formula or a rule are used alike by
:func:`wakeful.plans.modeling.batch_inference` and the request scorer. Loading runs the
serialised object's code: load predictors from trusted folders only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMAT = 1


@dataclass
class Predictor:
    model: Any
    features: list[str]
    name: str = "model"
    version: int = 1

    def check(self, df: DataFrame) -> None:
        """The signature: every feature is there and a number (or a flag)."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        bad = [f for f in self.features if not isinstance(kinds.get(f), (T.NumericType, T.BooleanType))]
        if bad:
            raise ValueError(f"{self.name} {self.version} needs numeric columns {bad}")

    def transform(self, df: DataFrame, out: str = "prediction", clip: bool = True) -> DataFrame:
        """``df`` with the prediction, clipped to [0, 1]; missing inputs reach the model as
        NaN. A model that returns another number of values than rows is an error."""
        self.check(df)
        held = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(self.model))
        features = list(self.features)

        @F.pandas_udf(T.DoubleType())
        def predict(rows: pd.DataFrame) -> pd.Series:
            model = _loaded(held.value)
            found = pd.Series(list(model.predict(rows[features])), dtype="float64")
            if len(found) != len(rows):
                raise ValueError(f"{len(found)} predictions for {len(rows)} rows")
            return found

        score = predict(F.struct(*[F.col(f).cast("double").alias(f) for f in features]))
        return df.withColumn(out, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)) if clip else score)


_LAST: dict[bytes, Any] = {}


def _loaded(body: bytes) -> Any:
    """The object, unpacked once per process (the last one is kept)."""
    if body not in _LAST:
        _LAST.clear()
        _LAST[body] = cloudpickle.loads(body)
    return _LAST[body]


def save_predictor(spark: SparkSession, p: Predictor, path: str) -> str:
    head = json.dumps({"format": FORMAT, "name": p.name, "version": p.version, "features": p.features})
    row = spark.createDataFrame([(head, bytearray(cloudpickle.dumps(p.model)))], "head string, body binary")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={p.version}")
    return path


def load_predictor(spark: SparkSession, path: str, version: int | None = None, features: Sequence[str] | None = None) -> Predictor:
    """The saved predictor of a version (the latest if none is asked for); another format,
    or other features than expected, are errors."""
    saved = spark.read.parquet(path)
    version = version if version is not None else saved.agg(F.max("version")).first()[0]
    rows = saved.where(F.col("version") == version).select("head", "body").collect()
    if len(rows) != 1:
        raise ValueError(f"no version {version} in {path}")
    head = json.loads(rows[0]["head"])
    if head["format"] != FORMAT:
        raise ValueError(f"predictor format {head['format']}, {FORMAT} is read")
    if features is not None and list(features) != head["features"]:
        raise ValueError(f"{head['name']} {head['version']} was saved for other features")
    return Predictor(cloudpickle.loads(bytes(rows[0]["body"])), head["features"], head["name"], head["version"])


@dataclass
class LinearRule:
    """A weighted sum of features and a constant; missing features count as 0."""

    weights: dict[str, float]
    constant: float = 0.0

    def predict(self, rows: pd.DataFrame) -> pd.Series:
        return sum((rows[f].fillna(0.0) * w for f, w in self.weights.items()), pd.Series(self.constant, index=rows.index))
