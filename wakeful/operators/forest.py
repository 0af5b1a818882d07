"""Random-forest regression.

Preprocessing mirrors the original pipeline: fill (exact median learned on the
training table, or 0) then scale (population mean/std, or median/IQR). The fitted
parameters are one row per feature; trees are grown from histograms by
:mod:`wakeful.operators.grower`.

A fitted forest is its nodes in flat arrays (a row per node when saved). It is held by
the driver and broadcast to the tasks that score: its size is bounded by its
parameters, ``n_estimators`` * 2^(``max_depth`` + 1) nodes, and checked against
:data:`MOST_NODES`.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.operators.drift import apply_impute_scale, fit_impute_scale
from wakeful.operators.grower import NODE, Compiled, Forest, bin_samples, compile_nodes, grow, nodes_of
from wakeful.session import cut_lineage
from wakeful.settings import MODEL_FEATURES


@dataclass(frozen=True)
class ForestParams:
    # fixed defaults of the tuned forest
    n_estimators: int = 105
    max_depth: int = 7
    min_samples_split: int = 18
    min_samples_leaf: int = 2
    max_features: str | float = "log2"
    bootstrap: bool = True
    seed: int = 42
    impute: str = "median"
    scale: str = "standard"
    max_bins: int = 32
    features: tuple[str, ...] = field(default=MODEL_FEATURES)


def subset_size(max_features, n_features: int) -> int:
    """Candidate features of a node: rounded down, one at least."""
    if max_features == "log2":
        return max(1, int(math.log2(n_features)))
    if max_features == "sqrt":
        return max(1, int(math.sqrt(n_features)))
    if isinstance(max_features, float):
        return max(1, min(n_features, int(max_features * n_features)))
    return int(max_features)


def forest_of(params: ForestParams, fold: int | None = None, fill: tuple[int, ...] = ()) -> Forest:
    return Forest(
        trees=params.n_estimators,
        max_depth=params.max_depth,
        min_samples_split=params.min_samples_split,
        min_samples_leaf=params.min_samples_leaf,
        features=subset_size(params.max_features, len(params.features)),
        bootstrap=params.bootstrap,
        seed=params.seed,
        fold=fold,
        fill=fill,
    )


PREP = "_in_"  # prefix of the prepared model inputs
MOST_NODES = 1 << 24


@dataclass
class Trees:
    """A forest's nodes with thresholds in the units of the prepared inputs."""

    flat: Compiled
    threshold: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row of inputs."""
        f = self.flat
        at = np.broadcast_to(f.roots, (len(x), len(f.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(f.depth):
            feature = f.feature[at]
            right = x[rows, np.maximum(feature, 0)] > self.threshold[at]
            at = np.where(feature >= 0, f.left[at] + right, at)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean of the trees, rows taken in blocks of bounded memory."""
        out = np.empty(len(x))
        step = max(1, (1 << 21) // max(1, len(self.flat.roots)))
        for i in range(0, len(x), step):
            out[i : i + step] = self.value[self.leaves(x[i : i + step])].mean(axis=1)
        return out


def trees_of(nodes: np.ndarray, unit: float, cuts: list[list[float]]) -> Trees:
    flat = compile_nodes(nodes)
    width = max([1, *map(len, cuts)])
    table = np.zeros((len(cuts), width))
    for k, c in enumerate(cuts):
        table[k, : len(c)] = c
    inner = flat.feature >= 0
    threshold = np.where(inner, table[np.maximum(flat.feature, 0), np.where(inner, flat.bin, 0)], 0.0)
    return Trees(flat, threshold, flat.value * unit)


@dataclass
class FittedForest:
    params: ForestParams
    prep: DataFrame  # (feature, fill, center, scale), one row per feature
    trees: Trees

    @property
    def features(self) -> list[str]:
        return list(self.params.features)

    @property
    def model_inputs(self) -> list[str]:
        return [PREP + f for f in self.features]

    def prepare(self, df: DataFrame) -> DataFrame:
        """Adds the filled and scaled model inputs as ``_in_<feature>``; the original
        feature columns stay untouched (rules downstream read raw values)."""
        return apply_impute_scale(df, self.prep, self.features, prefix=PREP)

    def transform(self, df: DataFrame, out: str = "prediction", clip: bool = True) -> DataFrame:
        """M4: score; prediction clipped to [0, 1] (targets live there)."""
        held = df.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def predict(x: pd.DataFrame) -> pd.Series:
            return pd.Series(held.value.predict(x.to_numpy(float)))

        score = predict(F.struct(*self.model_inputs))
        scored = self.prepare(df).withColumn(out, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)) if clip else score)
        return scored.drop(*self.model_inputs)

    def importances(self) -> DataFrame:
        """Impurity importances (each tree's fall of squared error by feature, as a
        share; their mean; sum 1), sorted descending. One row per feature."""
        flat, p = self.trees.flat, len(self.features)
        tree = np.searchsorted(flat.roots, np.arange(len(flat.ids)), "right") - 1
        inner = flat.feature >= 0
        fall = np.bincount(tree[inner] * p + flat.feature[inner], flat.gain[inner], len(flat.roots) * p).reshape(-1, p)
        share = fall / np.where(fall.sum(axis=1, keepdims=True) > 0, fall.sum(axis=1, keepdims=True), 1)
        share = share.sum(axis=0) / max(1, int((fall.sum(axis=1) > 0).sum()))
        df = self.prep.sparkSession.createDataFrame(list(zip(self.features, share.tolist())), "feature string, importance double")
        return df.orderBy(F.col("importance").desc(), "feature")


def fit_forest(samples: DataFrame, target: str, params: ForestParams = ForestParams()) -> FittedForest:
    """M3: fill + scale learned on ``samples``, then the forest. ``user_id`` and keys
    are never features."""
    feats = list(params.features)
    base = cut_lineage(samples.select(*feats, F.col(target).cast("double").alias("label")), "train")
    prep = cut_lineage(fit_impute_scale(base, feats, params.impute, params.scale), "prep", small=True)
    x = apply_impute_scale(base, prep, feats, prefix=PREP)
    binned = bin_samples(x, [PREP + f for f in feats], "label", bins=params.max_bins)
    grown = grow(binned, [forest_of(params)])
    nodes = nodes_of(grown, 0)
    if len(nodes) > MOST_NODES:
        raise ValueError(f"a forest of {len(nodes)} nodes; lower max_depth or n_estimators")
    return FittedForest(params, prep, trees_of(nodes, binned.unit, binned.cuts))


# -- saved forests ----------------------------------------------------------------

FORMAT = 1


def node_rows(ff: FittedForest) -> pd.DataFrame:
    """A row per node: tree, id (root 1, children 2 id and 2 id + 1), feature (-1: a
    leaf), threshold, value, cover, gain."""
    flat = ff.trees.flat
    tree = np.searchsorted(flat.roots, np.arange(len(flat.ids)), "right") - 1
    columns = {"tree": tree, "id": flat.ids, "feature": flat.feature, "threshold": ff.trees.threshold, "value": ff.trees.value, "cover": flat.cover, "gain": flat.gain}
    return pd.DataFrame(columns)


def save_forest(ff: FittedForest, path: str) -> str:
    spark = ff.prep.sparkSession
    spark.createDataFrame(node_rows(ff)).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    ff.prep.write.mode("overwrite").parquet(f"{path}/prep")
    head = json.dumps({"format": FORMAT, "params": asdict(ff.params)})
    spark.createDataFrame([(head,)], "head string").coalesce(1).write.mode("overwrite").text(f"{path}/head")
    return path


def load_forest(spark, path: str, params: ForestParams | None = None) -> FittedForest:
    """A forest as :func:`save_forest` writes it; ``params`` replaces the saved ones.
    Another format, or other features than those saved, are errors."""
    head = json.loads(spark.read.text(f"{path}/head").first()[0])
    if head["format"] != FORMAT:
        raise ValueError(f"forest format {head['format']}, {FORMAT} is read")
    saved = ForestParams(**{**head["params"], "features": tuple(head["params"]["features"])})
    if params and params.features != saved.features:
        raise ValueError("the saved forest has other features")
    rows = spark.read.parquet(f"{path}/nodes").toPandas()
    nodes = np.zeros(len(rows), NODE)
    for c in ("tree", "id", "feature", "gain"):
        nodes[c] = rows[c]
    nodes["n"], nodes["s"] = rows["cover"], rows["value"] * np.maximum(rows["cover"], 1)
    rows = rows.sort_values(["tree", "id"])
    flat = compile_nodes(nodes)
    trees = Trees(flat, rows["threshold"].to_numpy(), rows["value"].to_numpy())
    return FittedForest(replace(params or saved), spark.read.parquet(f"{path}/prep"), trees)
