"""Training, tuning, evaluation, batch scoring and explanation.

All of it runs on the labelled feature table keyed by
(user_id, TESTSTART, TESTID, offset_us): targets and predictions are joined by key,
never zipped by position.
"""

from __future__ import annotations

import random
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.functions.scalar import nan_to_null
from wakeful.operators import metrics as M
from wakeful.operators.drift import unpivot
from wakeful.operators.forest import FittedForest, ForestParams, fit_forest, forest_of
from wakeful.operators.grower import bin_samples, cross_scores
from wakeful.operators.quantiles import exact_quantiles
from wakeful.operators.split import group_kfold, group_split
from wakeful.operators.treeshap import explain_samples
from wakeful.session import cut_lineage

SAMPLE_KEY = ("user_id", "TESTSTART", "TESTID", "offset_us")
INFERENCE_KEY = ("user_id", "HRTIME")


def split_samples(samples: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Labelled samples with their group split (train/test)."""
    return samples.join(group_split(samples, "user_id", test_size, seed), "user_id")


def train(samples: DataFrame, params: ForestParams = ForestParams(), target: str = "fatigue_score") -> FittedForest:
    return fit_forest(samples, target, params)


def batch_inference(
    ff: FittedForest, features: DataFrame, threshold: float = 0.26, limit: int | None = None, keys: Sequence[str] = INFERENCE_KEY
) -> DataFrame:
    """M5: rows -> score -> threshold -> status, keyed; with ``limit`` the first rows by
    key only."""
    x = features.orderBy(*keys).limit(limit) if limit else features
    scored = ff.transform(x, "fatigue_probability")
    return M.score_outputs(scored, "fatigue_probability", threshold).select(
        *keys, "fatigue_probability", "fatigue_event_alert", "status"
    )


def stitch(ids: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Ids with the other tables' columns, joined by key (never by position). Rows
    that a table lacks are kept with nulls."""
    out = ids
    for p in parts:
        out = out.join(p, list(keys), "left")
    return out


def evaluate(ff: FittedForest, test: DataFrame, threshold: float = 0.26, target: str = "fatigue_score") -> dict[str, DataFrame]:
    """M8: score the test set once (materialised), then regression metrics,
    the classification report, the PR curve and the score statistics."""
    scored = cut_lineage(ff.transform(test, "prediction").select(F.col(target).alias("y_true"), F.col("prediction").alias("y_pred")))
    return {
        "regression": M.regression_metrics(scored),
        "report": M.classification_report(scored, "y_true", "y_pred", threshold),
        "pr_curve": M.pr_curve(scored, "y_true", "y_pred", threshold),
        "stats": M.inference_stats(scored, "y_pred", threshold),
    }


def fold_scores(samples: DataFrame, trials: Sequence[ForestParams], folds: DataFrame, n_splits: int, threshold: float, target: str = "fatigue_score") -> DataFrame:
    """(trial, fold, n_test, rmse, recall) of every trial on every fold: all forests are
    grown from one binned table, each without its fold. Missing values take the median of
    the fold's training rows; scaling can't change a split and is left out."""
    features = list(trials[0].features)
    data = cut_lineage(samples.select("user_id", target, *features).join(folds, "user_id").drop("user_id"), "folds")
    others = F.explode(F.array_except(F.array(*[F.lit(k) for k in range(n_splits)]), F.array("fold")))
    lacking = data.agg(*[F.count_if(nan_to_null(F.col(f).cast("double")).isNull()).alias(f) for f in features]).first()
    lacking = [f for f in features if lacking[f]]
    fills: dict[tuple[int, str], float] = {}
    if lacking:
        long = unpivot(data.withColumn("without", others), lacking, ["without"])
        fills = {(r["without"], r["feature"]): r["q"] for r in exact_quantiles(long, "value", [0.5], ["without", "feature"], small_groups=True).collect()}
    binned = bin_samples(data, features, target, "fold", trials[0].max_bins)

    def fill(k: int) -> tuple[int, ...]:
        return tuple(bisect_left(c, fills.get((k, f), 0.0)) for f, c in zip(features, binned.cuts))

    forests = [forest_of(p, k, fill(k)) for p in trials for k in range(n_splits)]
    found = cross_scores(binned, forests, threshold)
    hits = F.col("tp") + F.col("fn")
    return found.select(
        F.floor(F.col("forest") / n_splits).cast("int").alias("trial"),
        (F.col("forest") % n_splits).cast("int").alias("fold"),
        "n_test",
        F.sqrt(F.col("sse") / F.col("n_test")).alias("rmse"),
        F.when(hits > 0, F.col("tp") / hits).otherwise(F.lit(0.0)).alias("recall"),
    )


def cross_validate(
    samples: DataFrame,
    params: ForestParams,
    n_splits: int = 5,
    threshold: float = 0.26,
    target: str = "fatigue_score",
    folds: DataFrame | None = None,
) -> DataFrame:
    """M6: group k-fold; per fold RMSE and recall at the threshold of a model fitted
    on the other folds; one row per fold (fold, n_test, rmse, recall)."""
    if folds is None:
        folds = group_kfold(samples, n_splits)
    return fold_scores(samples, [params], folds, n_splits, threshold, target).drop("trial")


SEARCH_SPACE = {  # fixed ranges of the original search
    "n_estimators": (50, 300),
    "max_depth": (5, 25),
    "min_samples_split": (2, 20),
    "min_samples_leaf": (1, 10),
    "max_features": ("sqrt", "log2", 1.0),
    "bootstrap": (True, False),
}


def sample_params(n_trials: int, seed: int = 42, base: ForestParams = ForestParams()) -> list[ForestParams]:
    """Seeded random draws from the search space (the TPE sampler is not rebuilt)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        out.append(
            replace(
                base,
                n_estimators=rng.randint(*SEARCH_SPACE["n_estimators"]),
                max_depth=rng.randint(*SEARCH_SPACE["max_depth"]),
                min_samples_split=rng.randint(*SEARCH_SPACE["min_samples_split"]),
                min_samples_leaf=rng.randint(*SEARCH_SPACE["min_samples_leaf"]),
                max_features=rng.choice(SEARCH_SPACE["max_features"]),
                bootstrap=rng.choice(SEARCH_SPACE["bootstrap"]),
            )
        )
    return out


def search_params(samples: DataFrame, n_trials: int = 50, n_splits: int = 5, threshold: float = 0.26, seed: int = 42) -> DataFrame:
    """M7: all trials are cross-validated on the same folds at once; result table (trial,
    params, rmse, recall: means over the folds) ordered by RMSE (best first)."""
    trials = sample_params(n_trials, seed)
    scores = fold_scores(samples, trials, cut_lineage(group_kfold(samples, n_splits)), n_splits, threshold)
    names = ["n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "bootstrap"]
    rows = [(i, *[str(getattr(p, c)) if c == "max_features" else getattr(p, c) for c in names]) for i, p in enumerate(trials)]
    drawn = samples.sparkSession.createDataFrame(
        rows, "trial int, n_estimators int, max_depth int, min_samples_split int, min_samples_leaf int, max_features string, bootstrap boolean"
    )
    means = scores.groupBy("trial").agg(F.avg("rmse").alias("rmse"), F.avg("recall").alias("recall"))
    return drawn.join(F.broadcast(means), "trial").orderBy("rmse", "trial")  # a row per trial


ROWS_PER_TASK = 1024  # attributions cost leaves x depth steps a row, so rows are spread thin


def explain(ff: FittedForest, rows: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """M9: SHAP values of every row, spread over many tasks; with ``limit`` of the
    first rows by key only."""
    x = rows.orderBy(*keys).limit(limit) if limit else rows
    x = cut_lineage(x.select(*keys, *ff.features), "explained")
    # equal inputs meet in one task, which explains them once
    x = x.repartition(max(1, min(100_000, -(-x.count() // ROWS_PER_TASK))), *ff.features)
    prepared = ff.prepare(x)
    # explain on the values the trees see, named after the features
    prepared = prepared.select(*keys, *[F.col(i).alias(f) for i, f in zip(ff.model_inputs, ff.features)])
    return explain_samples(prepared, ff.trees, list(ff.features), keys)
