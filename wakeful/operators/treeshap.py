"""Per-row feature attributions for tree ensembles (M9): path-dependent TreeSHAP.

For one tree and one leaf, the path-dependent value function is a product game: for
every feature f on the root-to-leaf path, z_f(x) = 1 if x follows the path's direction
at every split on f (else 0) and r_f = product of cover ratios cover(child) /
cover(parent) at those splits. The leaf's game is v(S) = value * prod_{f in S} z_f *
prod_{f not in S} r_f. With d features, the Shapley weights s! (d - s - 1)! / d! are
integrals of t^s (1 - t)^(d - s - 1) over [0, 1], so the value of feature i is

    value * (z_i - r_i) * integral of prod_{f != i} (r_f (1 - t) + z_f t) dt.

The integrand is one polynomial of degree d - 1 for all features, with the feature's own
factor divided out; Gauss-Legendre points, one for every two degrees, integrate it
exactly. A leaf thus costs its features times half their number. Summing over leaves and
trees gives exactly the TreeSHAP values of Lundberg et al. (2020); the ensemble value is
the tree average. A path's splits on one feature are an interval of its values, so z is
two comparisons; paths are padded with null players (z = r = 1), which leave Shapley
values unchanged.

Runs in ``mapInPandas``: rows are spread by Spark; the forest (bounded by its
parameters) is broadcast, and its leaves are laid out once per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.operators.forest import Trees

CELLS = 1 << 19  # rows x leaves x features handled at once


@dataclass
class Leaves:
    """Leaves of one tree: for each of the (padded) features of its path the owner, the
    interval (low, high] of values that follow the path, and the cover ratio."""

    owner: np.ndarray  # (leaves, slots), -1 for a null player
    low: np.ndarray
    high: np.ndarray
    ratio: np.ndarray
    value: np.ndarray
    spread: np.ndarray  # (leaves * slots, features): slot -> feature
    points: np.ndarray
    weights: np.ndarray

    @property
    def expected(self) -> float:
        return float(self.value @ self.ratio.prod(axis=1))


def leaves_of(trees: Trees, n_features: int) -> list[Leaves]:
    flat = trees.flat
    return [_lay_out(trees, int(root), n_features) for root in flat.roots]


def _lay_out(trees: Trees, root: int, p: int) -> Leaves:
    flat = trees.flat
    found: list[tuple[dict, float]] = []
    stack: list[tuple[int, dict]] = [(root, {})]
    while stack:
        at, path = stack.pop()
        f = int(flat.feature[at])
        if f < 0:
            found.append((path, float(trees.value[at])))
            continue
        left, cut = int(flat.left[at]), float(trees.threshold[at])
        low, high, ratio = path.get(f, (-np.inf, np.inf, 1.0))
        cover = flat.cover[at] or 1.0
        stack.append((left + 1, {**path, f: (max(low, cut), high, ratio * flat.cover[left + 1] / cover)}))
        stack.append((left, {**path, f: (low, min(high, cut), ratio * flat.cover[left] / cover)}))
    slots, n = max(1, max(len(path) for path, _ in found)), len(found)
    owner = np.full((n, slots), -1)
    low, high, ratio = np.full((n, slots), -np.inf), np.full((n, slots), np.inf), np.ones((n, slots))
    for i, (path, _) in enumerate(found):
        for j, (f, (a, b, r)) in enumerate(path.items()):
            owner[i, j], low[i, j], high[i, j], ratio[i, j] = f, a, b, r
    spread = np.zeros((n * slots, p))
    real = np.flatnonzero(owner.ravel() >= 0)
    spread[real, owner.ravel()[real]] = 1.0
    points, weights = np.polynomial.legendre.leggauss((slots + 1) // 2)
    return Leaves(owner, low, high, ratio, np.array([v for _, v in found]), spread, (points + 1) / 2, weights / 2)


def tree_shap(x: np.ndarray, leaves: Leaves) -> tuple[np.ndarray, float]:
    """SHAP values (rows x features) and expected value of one tree; rows are taken in
    blocks, so memory doesn't grow with the tree's size times the batch."""
    n, slots = leaves.owner.shape
    step = max(1, CELLS // (n * slots))
    parts = [_block_shap(x[i : i + step], leaves) for i in range(0, len(x), step)]
    return np.concatenate(parts or [np.zeros((0, leaves.spread.shape[1]))]), leaves.expected


def _block_shap(x: np.ndarray, leaves: Leaves) -> np.ndarray:
    values = x[:, np.maximum(leaves.owner, 0)]  # (rows, leaves, slots)
    z = ((values > leaves.low) & (values <= leaves.high)) | (leaves.owner < 0)
    total = np.zeros(z.shape)
    for t, w in zip(leaves.points, leaves.weights):
        terms = np.where(z, leaves.ratio * (1 - t) + t, leaves.ratio * (1 - t))
        total += (w * terms.prod(axis=2))[:, :, None] / terms
    total *= (z - leaves.ratio) * leaves.value[:, None]
    return total.reshape(len(x), -1) @ leaves.spread


def explain_samples(df: DataFrame, trees: Trees, features: Sequence[str], keys: Sequence[str], prefix: str = "shap_") -> DataFrame:
    """Attributions for every row of ``df`` (already prepared as the model sees it):
    keys, one ``shap_<feature>`` column per feature (float, as the original), and
    ``expected_value``."""
    features, keys = list(features), list(keys)
    p = len(features)
    held = df.sparkSession.sparkContext.broadcast(trees)
    kept = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*kept, *[f"`{prefix}{f}` float" for f in features], "expected_value double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        laid = leaves_of(held.value, p)
        for pdf in batches:
            x, back = np.unique(np.nan_to_num(pdf[features].to_numpy(dtype=float), nan=0.0), axis=0, return_inverse=True)
            total, expected = np.zeros((len(x), p)), 0.0
            for leaves in laid:
                phi, e = tree_shap(x, leaves)
                total += phi / len(laid)
                expected += e / len(laid)
            out = pdf[keys].copy()
            for j, f in enumerate(features):
                out[f"{prefix}{f}"] = total[back.ravel(), j].astype(np.float32)
            out["expected_value"] = expected
            yield out

    return df.select(*keys, *features).mapInPandas(run, schema)


def shap_additivity(explained: DataFrame, predictions: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Property check table: expected_value + sum(shap) vs prediction per row."""
    total = F.col("expected_value")
    for f in features:
        total = total + F.col(f"shap_{f}")
    return explained.join(predictions, list(keys)).select(*keys, total.alias("reconstructed"), "prediction")
