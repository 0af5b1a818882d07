"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models. The model of
a category sees the document's tokens and the probabilities of the categories before
it. In training these probabilities are out-of-fold: each labelled document gets them
from models that were trained without it, so a later model learns from inputs as
uncertain as those it will meet. Tokens are whole words, their first four and five
letters (inflected and compounded forms share them) and runs of marks; a document has
a token or not, so a few words count the same in a long text as in a short one.

Training uses a bounded sample of the labelled rows: its statistics are a grouped
aggregate, and every (category, fold) is a model fitted by a task of its own. Scoring
reads all documents; the models, bounded by the vocabulary, are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.llm.chunks import ChunkTable, cut, portions
from wakeful.llm.common import cut_lineage, text_of

SAMPLE_ROWS = 20_000  # labelled rows that models are fitted on, at most about
VOCABULARY = 1 << 14
LEAST_DOCS = 3
LEAST_SCORE = 10.0  # of the likelihood-ratio statistic's half: rarer tokens tell a document, not a category
FOLDS = 3
PENALTY = 0.3
STEPS = 150
PART = re.compile(r"[^\W\d_]+|[^\w\s]+")


def tokens(word: str) -> list[str]:
    """Tokens of a piece of text without white space."""
    found: list[str] = []
    for part in PART.findall(word.lower()):
        found.append(part)
        if part[0].isalpha():
            found += [part[:n] + "*" for n in (4, 5) if len(part) > n]
    return found


class Tokens:
    """Distinct vocabulary entries of texts, over a table of distinct words."""

    def __init__(self, vocabulary: dict[str, int]):
        at = vocabulary.get
        self.table = ChunkTable(lambda words: [[i for i in map(at, tokens(w)) if i is not None] for w in words])

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for part in portions(texts):
            for ids in cut(*self.table.join(pc.utf8_split_whitespace(part))):
                yield np.unique(ids)


# -- vocabulary -------------------------------------------------------------------


def vocabulary(sample: DataFrame, categories: list[str]) -> dict[str, int]:
    """The tokens that tell most about some category (largest likelihood-ratio
    statistic of a token's presence against the label), an equal share for each."""
    n = len(categories)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            labels = list(zip(*[batch.column(1 + i).to_pylist() for i in range(n)]))
            for text, marks in zip(batch.column(0).to_pylist(), labels):
                for token in {t for w in set(text.split()) for t in tokens(w)}:
                    row = found.setdefault(token, [0] * (n + 1))
                    row[n] += 1
                    for i, y in enumerate(marks):
                        row[i] += y
            columns = [pa.array([r[i] for r in found.values()], pa.int64()) for i in range(n + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *columns], ["token", *[f"n{i}" for i in range(n + 1)]])

    counts = sample.select("text", *categories).mapInArrow(count, "token string, " + ", ".join(f"n{i} long" for i in range(n + 1)))
    counts = cut_lineage(
        counts.groupBy("token").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(n + 1)]).where(F.col(f"n{n}") >= LEAST_DOCS), "vocabulary"
    )
    size = sample.agg(F.count("*"), *[F.sum(c) for c in categories]).first()
    chosen: dict[str, int] = {}
    for i in range(n):
        total, positive = size[0], size[1 + i] or 0
        if not total or not 0 < positive < total:
            continue

        def term(seen, expected):
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

        with_, a = F.col(f"n{n}"), F.col(f"n{i}")
        b, c = with_ - a, F.lit(positive) - a
        d = F.lit(total - positive) - b
        rate = positive / total
        score = (
            term(a, with_ * rate)
            + term(b, with_ * (1 - rate))
            + term(c, (F.lit(total) - with_) * rate)
            + term(d, (F.lit(total) - with_) * (1 - rate))
        )
        top = counts.select("token", score.alias("score")).where(F.col("score") >= LEAST_SCORE).orderBy(F.desc("score"), "token").limit(VOCABULARY // n).collect()
        for r in top:
            chosen.setdefault(r["token"], len(chosen))
    return chosen


# -- one linear model -------------------------------------------------------------


def fit_logistic(indptr: np.ndarray, ids: np.ndarray, extra: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Weights (tokens, extra inputs, constant) of a penalised logistic regression on
    token presence, by accelerated gradient steps with a per-weight scale."""
    n, k = len(y), extra.shape[1]
    rows = np.repeat(np.arange(n), np.diff(indptr))
    w = np.zeros(width + k + 1)
    v, scale = w.copy(), np.concatenate((np.bincount(ids, minlength=width) * 0.25, (extra**2).sum(axis=0) * 0.25, [0.25 * n])) + PENALTY
    # rows hold many tokens whose steps add up: bound the curvature by the rows' sizes
    load = np.bincount(ids, weights=np.diff(indptr)[rows].astype(float), minlength=width) * 0.25
    scale[:width] = np.maximum(scale[:width], np.minimum(load, scale[:width] * 50)) + PENALTY
    scale[width:] *= 50
    seen = 1.0
    for _ in range(STEPS):
        margin = np.bincount(rows, weights=v[ids], minlength=n) + extra @ v[width : width + k] + v[-1]
        off = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        slope = np.concatenate((np.bincount(ids, weights=off[rows], minlength=width), extra.T @ off, [off.sum()]))
        slope[:-1] += PENALTY * v[:-1]
        new = v - slope / scale
        ahead = (1 + np.sqrt(1 + 4 * seen**2)) / 2
        v = new + (seen - 1) / ahead * (new - w)
        w, seen = new, ahead
    return w


def probability(w: np.ndarray, ids: np.ndarray, extra: list[float], width: int) -> float:
    margin = w[ids].sum() + float(np.dot(w[width : width + len(extra)], extra)) + w[-1]
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


# -- the chain --------------------------------------------------------------------


@dataclass
class Chain:
    categories: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]  # one model per category, in order
    held_out: DataFrame  # doc_id, labels and out-of-fold probabilities of the sample


def train_chain(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on at most about :data:`SAMPLE_ROWS` labelled documents, taken by
    a hash of their id. Rows with a null id or a label other than 0 and 1 are left
    out. A category without both labels gets a constant model; no labelled rows at
    all give probability 0."""
    usable = labels.where(" and ".join(f"`{c}` in (0, 1)" for c in categories)).where("doc_id is not null")
    known = usable.groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in categories])
    share = max(1, -(-known.count() // SAMPLE_ROWS))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)  # before the join: only the sample's texts move
    sample = cut_lineage(texts.join(known, "doc_id").select("doc_id", "text", *categories), "toxic-sample")
    words = vocabulary(sample, categories)
    width = max(1, len(words))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tokens(words)
        for batch in batches:
            ids = pa.array([x.tolist() for x in own.of(batch.column(1))], pa.list_(pa.int32()))
            fold = pa.array([(hash_of(d)) % FOLDS for d in batch.column(0).to_pylist()], pa.int32())
            keep = [batch.column(0), *[batch.column(2 + i) for i in range(len(categories))]]
            yield pa.RecordBatch.from_arrays([*keep, ids, fold], ["doc_id", *categories, "ids", "fold"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    marks = ", ".join(f"`{c}` int" for c in categories)
    rows = cut_lineage(sample.mapInArrow(index, f"doc_id {kind}, {marks}, ids array<int>, fold int"), "toxic-rows")
    weights: list[np.ndarray] = []
    for i, category in enumerate(categories):
        before = [f"p_{c}" for c in categories[:i]]
        folds = _fit(rows, category, before, width)
        weights.append(folds.pop(-1, np.concatenate((np.zeros(width + i), [-30.0]))))
        rows = cut_lineage(_out_of_fold(rows, category, before, folds, width), "toxic-rows")
    return Chain(categories, words, weights, rows.drop("ids"))


def hash_of(name) -> int:
    import zlib

    return zlib.crc32(str(name).encode())


def _fit(rows: DataFrame, category: str, before: list[str], width: int) -> dict[int, np.ndarray]:
    """fold -> weights fitted without the fold; -1: on all rows."""
    uses = F.array_except(F.array(*[F.lit(f) for f in range(-1, FOLDS)]), F.array("fold"))
    spread = rows.select(F.explode(uses).alias("model"), F.col(category).alias("y"), "ids", *before)

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["ids"].map(len).to_numpy()
        indptr = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.concatenate([np.asarray(x, np.int64) for x in group["ids"]])
        y = group["y"].to_numpy(float)
        extra = group[before].to_numpy(float).reshape(len(group), len(before))
        return pd.DataFrame({"model": [key[0]], "w": [fit_logistic(indptr, ids, extra, y, width)]})

    found = spread.groupBy("model").applyInPandas(fit, "model int, w array<double>").collect()
    return {r["model"]: np.array(r["w"]) for r in found}


def _out_of_fold(rows: DataFrame, category: str, before: list[str], folds: dict[int, np.ndarray], width: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(folds)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.to_pydict()
            p = [
                probability(shared.value[fold], np.array(ids, np.int64), [part[c][i] for c in before], width)
                for i, (fold, ids) in enumerate(zip(part["fold"], part["ids"]))
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(p, pa.float64())], [*names, f"p_{category}"])

    kept = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"{kept}, `p_{category}` double")


def classify(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``p_<category>`` ...): a row per row of ``docs``, whole texts read.

    Null and empty texts have no tokens and get the models' constant verdict; very
    long ones count like others. Rows with a null id and repeated rows are each
    returned, empty tables give no rows, other columns are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast((chain.vocabulary, chain.weights))
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value
        own, width = Tokens(words), max(1, len(words))
        for batch in batches:
            found: list[list[float]] = []
            for ids in own.of(batch.column(1)):
                p: list[float] = []
                for w in weights:
                    p.append(probability(w, ids, p, width))
                found.append(p)
            columns = [pa.array([p[i] for p in found], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"`{n}` double" for n in names)
    )
