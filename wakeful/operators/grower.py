"""Regression forests grown from histograms, many forests at once (M3, M6, M7).

Samples are binned once: a feature's cuts are quantiles, a value's code is the
number of cuts below it. Equal samples become one row with a count, and rows are packed
into blocks. All forests of a search, over all folds, are grown from the same blocks:

* **Whole trees**: where a forest has at most :data:`LOCAL_ROWS` rows, its trees are dealt to
  groups of about equal work, of many forests and folds together, and the blocks are sent
  once to each group, not once to each tree. There are some :data:`GROUPS` groups however
  many trees there are, so what is shuffled grows with the rows alone.
* **Families**: in a search the trees of forests that draw the same rows and look at the same
  features (:class:`Family`) differ only by where they stop and by the least size of a side. They
  are grown together: a node that several of them have is split once, and from the first split
  in which they differ each goes on alone. Every tree's every node is found.
* **Level by level**, where a forest has more rows: every task adds up (count, sum of the
  target) by (forest, tree, node, feature, bin) over its blocks, Spark sums these, and the
  best split of each node is taken from its histogram. Only the chosen splits reach the
  driver. Trees of at most :data:`SHALLOW` levels are grown so to their ends, and no row is
  sent anywhere; of deeper ones the nodes of more than :data:`LOCAL_ROWS` rows are.
* **Subtrees** of the deeper ones: the rows of smaller nodes are packed together by node
  and each pack's subtrees are grown to their ends by one task, by the same histograms.

A task's memory is bounded by :data:`LOCAL_ROWS` whatever the table's size, and the
driver holds nodes of more than that many rows alone. Everything is a function of the
rows' content and the seed: targets are added as whole numbers (units of 2^-24 of the
largest target), a bootstrap draws each row Poisson-many times by a hash of its content,
and a node's features are chosen by a hash of its place. So the same samples give the
same trees however they are partitioned.

Rules: a node of ``min_samples_split`` or more samples (bootstrap draws count each) and
less than ``max_depth`` deep is split where the squared error falls most, among
``max_features`` features, if both sides keep ``min_samples_leaf``; ties go to the
first feature and the lowest cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.functions.scalar import nan_to_null
from wakeful.session import cut_lineage

BINS = 32
MISSING = 255  # code of a missing value; a forest's fill code takes its place
BLOCK_ROWS = 1 << 16
LOCAL_ROWS = 1 << 18  # rows whose subtrees one task grows
PACK_ROWS = 1 << 14  # of which smaller nodes are put together
SHALLOW = 8  # depth up to which the trees of a large forest are grown by levels alone
GROUPS = 64  # tasks that grow whole trees, or four for each core if that is more
HELD_BYTES = 1 << 25  # of histograms in a task before they are handed on
FAMILY = 32  # forests of a family at most: a share of it holds so many sums for each row tried
AT_ONCE = 1 << 18  # (row, feature) pairs of a family's nodes that are split at once
UNIT_BITS = 24
NODE = np.dtype([("tree", "<i4"), ("id", "<i8"), ("feature", "<i2"), ("bin", "<i2"), ("n", "<f8"), ("s", "<f8"), ("gain", "<f8")])
PART = np.dtype([("y", "<i8"), ("n", "<i8"), ("rid", "<u8")])


@dataclass(frozen=True)
class Forest:
    """What one forest is grown with; ``fold`` is left out of its samples."""

    trees: int
    max_depth: int
    min_samples_split: int
    min_samples_leaf: int
    features: int  # candidates of a node
    bootstrap: bool
    seed: int
    fold: int | None = None
    fill: tuple[int, ...] = ()  # codes that stand for missing values


# -- binning ----------------------------------------------------------------------


@dataclass
class Binned:
    blocks: DataFrame  # (block, fold, rows, codes, part): packed rows
    columns: list[str]
    cuts: list[list[float]]
    unit: float
    rows: dict[int, int]  # rows by fold


def bin_samples(samples: DataFrame, columns: Sequence[str], target: str, fold: str | None = None, bins: int = BINS) -> Binned:
    """Pack the samples; rows without a target are left out. Cuts of a feature are its
    distinct quantiles k / bins, from a sketch of fixed size (exact up to its accuracy of
    10,000 rows)."""
    columns, p = list(columns), [k / bins for k in range(1, bins)]
    y = nan_to_null(F.col(target).cast("double"))
    known = samples.where(y.isNotNull()).select(
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"), y.alias("y"), *[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    seen = known.agg(F.max(F.abs("y")).alias("top"), *[F.percentile_approx(f"c{i}", p, 10_000).alias(f"c{i}") for i in range(len(columns))]).first()
    cuts = [sorted(set(seen[f"c{i}"] or [])) for i in range(len(columns))]
    unit = (seen["top"] or 1.0) / (1 << UNIT_BITS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A value's code: the number of cuts below it."""
        for batch in batches:
            codes = np.empty((len(batch), len(cuts)), np.uint8)
            for i, c in enumerate(cuts):
                x = batch.column(2 + i).to_numpy(zero_copy_only=False)  # nulls as NaN
                codes[:, i] = np.where(np.isnan(x), MISSING, np.searchsorted(np.array(c, float), x))
            whole = np.floor(batch.column(1).to_numpy() / unit + 0.5).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(whole)], ["fold", "codes", "y"])

    rows = known.mapInArrow(encode, "fold int, codes binary, y long")
    rows = rows.groupBy("fold", "codes", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("rid", F.xxhash64("codes", "y", "fold"))
    width = len(columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(k: int) -> pa.RecordBatch:
            codes, part = (b"".join(x) for x in zip(*held.pop(k)))
            return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(codes) // width], pa.int64()), pa.array([codes]), pa.array([part])], ["fold", "rows", "codes", "part"])

        for batch in batches:
            folds = batch.column(0).to_numpy()
            for k in np.unique(folds).tolist():
                some = batch.filter(pa.array(folds == k))
                part = np.empty(len(some), PART)
                part["y"], part["n"] = some.column(2).to_numpy(), some.column(3).to_numpy()
                part["rid"] = some.column(4).to_numpy().view(np.uint64)
                held.setdefault(k, []).append((b"".join(some.column(1).to_pylist()), part.tobytes()))
                if sum(len(p) for _, p in held[k]) >= BLOCK_ROWS * PART.itemsize:
                    yield block(k)
        for k in list(held):
            yield block(k)

    blocks = cut_lineage(rows.mapInArrow(pack, "fold int, rows long, codes binary, part binary"), "binned")
    blocks = blocks.withColumn("block", F.xxhash64("part", "codes"))
    sizes = {r["fold"]: r["n"] for r in blocks.groupBy("fold").agg(F.sum("rows").alias("n")).collect()}
    return Binned(blocks, columns, cuts, unit, sizes)


# -- draws by hash ----------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = np.atleast_1d(np.asarray(x, np.uint64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _key(seed: int, *parts: int) -> np.uint64:
    x = np.uint64(seed & (1 << 64) - 1)
    for p in parts:
        x = _mix(x + np.uint64(0x9E3779B97F4A7C15) * np.uint64(p + 1))[0]
    return x


@lru_cache(maxsize=None)
def _poisson_table(mean: int) -> np.ndarray:
    """Shares of draws of at most 0, 1, 2, ... up to the last that a double tells apart."""
    term = upto = float(np.exp(np.array([-float(mean)]))[0])
    out = [upto]
    for k in range(1, 400):
        term = term * mean / k
        upto = upto + term
        if k > mean and upto == out[-1]:
            break
        out.append(upto)
    return np.array(out)


def poisson(rid: np.ndarray, n: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a bootstrap draws each row that stands for ``n`` samples: Poisson of
    mean ``n`` by inversion (beyond 64 by a rounded normal), from a hash of the row."""
    with np.errstate(over="ignore"):
        h = _mix(rid ^ _key(seed, tree))
    u = (h >> np.uint64(11)).astype(float) / (1 << 53)
    out = np.zeros(len(rid), np.int64)
    large = n > 64
    small = n[~large] if large.any() else n
    for mean in np.flatnonzero(np.bincount(small)).tolist():  # at most 65
        some = n == mean
        if some.all():
            return np.searchsorted(_poisson_table(mean), u, "right")
        out[some] = np.searchsorted(_poisson_table(mean), u[some], "right")
    if large.any():
        with np.errstate(over="ignore"):
            v = (_mix(h[large] + np.uint64(1)) >> np.uint64(11)).astype(float) / (1 << 53)
        mean = n[large].astype(float)
        normal = np.sqrt(-2 * np.log(1 - u[large])) * np.cos(2 * math.pi * v)
        out[large] = np.maximum(0, np.rint(mean + np.sqrt(mean) * normal)).astype(np.int64)
    return out


def node_features(seed: int, tree: np.ndarray, ids: np.ndarray, width: int, most: int) -> np.ndarray:
    """(nodes, most): the features that each node looks at, ascending: those of least hash."""
    if most >= width:
        return np.broadcast_to(np.arange(width), (len(ids), width))
    with np.errstate(over="ignore"):
        base = _mix(np.uint64(seed & (1 << 64) - 1) + _mix(tree.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)))
        base = _mix(base + ids.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        if most <= 4 and width <= 16:  # the least most + 1, with the feature in the low bits
            least: list[np.ndarray] = []
            for k in range(width):
                x = _mix(base + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(15) | np.uint64(k)
                for j, y in enumerate(least):
                    least[j], x = np.minimum(x, y), np.maximum(x, y)
                least += [x] * (len(least) <= most)
            if not any((a >> np.uint64(4) == b >> np.uint64(4)).any() for a, b in zip(least, least[1:])):
                return np.sort(np.stack([x & np.uint64(15) for x in least[:most]]).astype(np.int64), axis=0).T
        h = _mix(base[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argsort(h, axis=1, kind="stable")[:, :most], axis=1)


# -- splits -----------------------------------------------------------------------


def _splittable(ids: np.ndarray, n: np.ndarray, f: Forest) -> np.ndarray:
    depth = np.frexp(ids.astype(float))[1] - 1
    return (depth < f.max_depth) & (n >= f.min_samples_split) & (n >= 2 * f.min_samples_leaf)


def best_cut(hn: np.ndarray, hs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(gain, bin) of the best cut of each histogram (rows): the fall of the squared
    error if the bins up to ``bin`` go left."""
    ln, ls = np.cumsum(hn, axis=1)[:, :-1], np.cumsum(hs, axis=1)[:, :-1]
    n, s = hn.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
    rn, rs = n - ln, s - ls
    ok = (ln >= max(1, least)) & (rn >= max(1, least))
    whole = s * s / np.maximum(n, 1)
    gain = ls * ls / np.maximum(ln, 1) + rs * rs / np.maximum(rn, 1) - whole
    gain = np.where(ok & (gain > 1e-9 * np.maximum(whole, 1)), gain, -1.0)
    at = gain.argmax(axis=1)
    return gain[np.arange(len(gain)), at], at


def best_cuts(node: np.ndarray, code: np.ndarray, w: np.ndarray, wy: np.ndarray, n: np.ndarray, s: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`best_cut` for the rows of ``len(n)`` nodes, of which ``n`` and ``s`` are the
    sums. Only bins that hold rows are looked at: most nodes have fewer rows than bins."""
    k = len(n)
    key = node * BINS + code
    hn, hs = np.bincount(key, w, k * BINS), np.bincount(key, wy, k * BINS)
    at = np.flatnonzero(hn)
    own = at // BINS
    first = np.searchsorted(own, np.arange(k))
    ln, ls = np.cumsum(hn[at]), np.cumsum(hs[at])
    before = np.concatenate(([0.0], ln))[first], np.concatenate(([0.0], ls))[first]
    ln, ls = ln - before[0][own], ls - before[1][own]
    whole = (s * s / np.maximum(n, 1))[own]
    rn, rs = n[own] - ln, s[own] - ls
    ok = (ln >= max(1, least)) & (rn >= max(1, least))
    gain = ls * ls / np.maximum(ln, 1) + rs * rs / np.maximum(rn, 1) - whole
    gain = np.where(ok & (gain > 1e-9 * np.maximum(whole, 1)), gain, -1.0)
    best = np.maximum.reduceat(gain, first)
    top = np.flatnonzero(gain == best[own])[::-1]
    cut = np.zeros(k, np.int64)
    cut[own[top]] = at[top] % BINS  # the lowest comes last
    return best, cut


def _filled(codes: np.ndarray, f: Forest) -> np.ndarray:
    """Codes with the forest's fill codes (without any: the highest) for missing values."""
    return np.where(codes == MISSING, np.array(f.fill or (BINS - 1,), np.uint8), codes)


def grow_subtrees(codes: np.ndarray, row: np.ndarray, tree: np.ndarray, start: np.ndarray, y: np.ndarray, w: np.ndarray, f: Forest) -> np.ndarray:
    """Nodes of the subtrees below the nodes (``tree``, ``start``) of the row instances:
    ``row`` indexes ``codes``, ``y`` and ``w`` are targets and draws of the instances."""
    if len(row) and (tree == tree[0]).all() and (start == start[0]).all():
        trees, ids, at = tree[:1].astype(np.int64), start[:1].copy(), np.zeros(len(row), np.int64)
    else:
        roots, at = np.unique(np.stack((tree.astype(np.int64), start), axis=1), axis=0, return_inverse=True)
        trees, ids, at = roots[:, 0], roots[:, 1], at.ravel()
    wy, w = (w * y).astype(float), w.astype(float)
    width, out, columns = codes.shape[1], [], np.ascontiguousarray(codes.T).ravel()
    while len(ids):
        k = len(ids)
        nodes = np.zeros(k, NODE)
        nodes["tree"], nodes["id"], nodes["feature"] = trees, ids, -1
        nodes["n"], nodes["s"] = np.bincount(at, w, k), np.bincount(at, wy, k)
        out.append(nodes)
        can = _splittable(ids, nodes["n"], f)
        some = np.zeros(k, y.dtype)
        some[at] = y
        can &= np.bincount(at[y != some[at]], minlength=k) > 0  # equal targets: no cut helps
        keep = can[at]  # rows of nodes that may split
        row, at, y, w, wy = row[keep], at[keep], y[keep], w[keep], wy[keep]
        rank = np.cumsum(can) - 1
        at, which = rank[at], np.flatnonzero(can)
        k = len(which)
        if not k:
            break
        chosen = node_features(f.seed, trees[which], ids[which], width, f.features)
        gain, feature, cut = np.full(k, -1.0), np.full(k, -1), np.zeros(k, np.int64)
        for j in range(chosen.shape[1]):
            g, b = best_cuts(at, columns[chosen[at, j] * len(codes) + row], w, wy, nodes["n"][which], nodes["s"][which], f.min_samples_leaf)
            better = (g > gain) & (g > 0)
            gain, cut, feature = np.where(better, g, gain), np.where(better, b, cut), np.where(better, chosen[:, j], feature)
        split = feature >= 0
        nodes["feature"][which], nodes["bin"][which], nodes["gain"][which] = feature, cut, np.where(split, gain, 0.0)
        keep = split[at]
        row, at, y, w, wy = row[keep], at[keep], y[keep], w[keep], wy[keep]
        right = columns[feature[at] * len(codes) + row] > cut[at]
        rank = np.cumsum(split) - 1
        at = 2 * rank[at] + right
        which = which[split]
        trees = np.repeat(trees[which], 2)
        ids = (2 * ids[which][:, None] + np.arange(2)).ravel()
    return np.concatenate(out) if out else np.empty(0, NODE)


# -- families: trees that several forests share ------------------------------------


@dataclass
class Family:
    """Forests of one fold whose trees draw the same rows and look at the same features.
    ``lead`` asks for all that any of them asks for; where nothing is drawn or chosen its
    one tree stands for all, which are equal."""

    lead: Forest
    forests: list[int]
    alike: bool


def families(forests: Sequence[Forest], which: Sequence[int], width: int) -> list[Family]:
    found: dict[tuple, list[int]] = {}
    for i in which:
        f = forests[i]
        found.setdefault((f.fold, f.fill, f.seed, f.bootstrap, min(f.features, width)), []).append(i)
    out = []
    for (fold, fill, seed, bootstrap, features), own in found.items():
        own = sorted(own, key=lambda i: (forests[i].min_samples_leaf, forests[i].trees, i))
        alike = not bootstrap and features == width
        for first in range(0, len(own), FAMILY):
            some = own[first : first + FAMILY]
            fs = [forests[i] for i in some]
            lead = Forest(
                1 if alike else max(f.trees for f in fs), max(f.max_depth for f in fs), min(f.min_samples_split for f in fs),
                min(f.min_samples_leaf for f in fs), features, bootstrap, seed, fold, fill,
            )
            out.append(Family(lead, some, alike))
    return out


def _tree_work(family: Family, forests: Sequence[Forest], rows: int) -> np.ndarray:
    """Of each tree, about: levels are counted once for each least size of a side."""
    levels: dict[int, np.ndarray] = {}
    for i in family.forests:
        own = levels.setdefault(forests[i].min_samples_leaf, np.zeros(family.lead.trees))
        own[: forests[i].trees] = np.maximum(own[: forests[i].trees], forests[i].max_depth)
    return max(1, rows) * family.lead.features * sum(levels.values())


@dataclass
class Nodes:
    """Nodes of one depth, ``row`` with draws ``w`` and ``held`` (rows to be tried) lying one
    node after the other; ``who``: (nodes, forests), which forests have the node."""

    depth: int
    tree: np.ndarray
    ids: np.ndarray
    who: np.ndarray
    size: np.ndarray
    row: np.ndarray
    w: np.ndarray
    held_size: np.ndarray
    held: np.ndarray

    def part(self, a: int, b: int) -> Nodes:
        some, held = (slice(int(x[:a].sum()), int(x[:b].sum())) for x in (self.size, self.held_size))
        return Nodes(self.depth, self.tree[a:b], self.ids[a:b], self.who[a:b], self.size[a:b], self.row[some], self.w[some], self.held_size[a:b], self.held[held])


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of each range, one range after the other."""
    out = np.repeat(first - np.cumsum(size) + size, size)
    out += np.arange(len(out))
    return out


def _starts(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.concatenate((np.ones(1, bool), x[1:] != x[:-1])))


def _cells(key: np.ndarray, cells: int, w: np.ndarray, wy: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, sum of w, sum of wy) of the cells that hold rows, in order. ``key``: (features,
    rows), the cell of each; ``most``: the largest sum of w. Few rows a cell are sorted."""
    features, rows = key.shape
    if cells <= 4 * key.size:

        def summed(x: np.ndarray) -> np.ndarray:
            if cells <= rows:
                return reduce(np.add, [np.bincount(k, x, cells) for k in key])
            return np.bincount(key.ravel(), np.tile(x, features), cells)

        if most <= 1 << 13:  # both sums fit into one double: w above, wy (under 2^38) below
            both = summed(w * float(1 << 39) + wy)
            at = np.flatnonzero(both)
            both = both[at]
            n = np.rint(both / (1 << 39))
            return at, n, both - n * float(1 << 39)
        n, s = summed(w), summed(wy)
        at = np.flatnonzero(n)
        return at, n[at], s[at]
    bits = rows.bit_length()
    key = np.sort(((key << bits) | np.arange(rows)).ravel())
    row, key = key & (1 << bits) - 1, key >> bits
    first = _starts(key)
    return key[first], np.add.reduceat(w[row], first), np.add.reduceat(wy[row], first)


class FamilyTrees:
    """Grows trees of a family and adds to ``total`` (forests, rows tried) the values of
    the leaves that the rows fall to."""

    def __init__(self, codes: np.ndarray, part: np.ndarray, tried: np.ndarray, family: Family, forests: Sequence[Forest]):
        fs = [forests[i] for i in family.forests]
        self.part, self.lead = part, family.lead
        self.rows, self.tried, self.width = len(codes), len(tried), codes.shape[1]
        self.columns, self.tried_columns = (np.ascontiguousarray(x.T).ravel() for x in (codes, tried))
        self.y = part["y"].astype(float)
        self.trees, self.depth = np.array([f.trees for f in fs]), np.array([f.max_depth for f in fs])
        self.leaf = np.array([max(1, f.min_samples_leaf) for f in fs])
        self.least = np.maximum([f.min_samples_split for f in fs], 2 * self.leaf)
        self.alike, self.times = family.alike, np.where(family.alike, self.trees, 1)
        self.total = np.zeros((len(fs), self.tried))
        self.pairs = 0  # (row, feature) pairs looked at

    def add(self, trees: np.ndarray) -> None:
        step = max(1, AT_ONCE // max(1, self.rows * self.lead.features))
        for first in range(0, len(trees), step):
            own = trees[first : first + step]
            draws = [_draws(self.lead, self.part, t) for t in own.tolist()]
            rows = [np.flatnonzero(d > 0) for d in draws]
            k = [i for i, r in enumerate(rows) if len(r)]
            if not k:
                continue
            who = np.ones((len(k), len(self.trees)), bool) if self.alike else own[k, None] < self.trees
            w = np.concatenate([draws[i][rows[i]] for i in k]).astype(float)
            size = np.array([len(rows[i]) for i in k])
            held = np.tile(np.arange(self.tried), len(k))
            open_ = [Nodes(0, own[k].astype(np.int64), np.ones(len(k), np.int64), who, size, np.concatenate([rows[i] for i in k]), w, np.full(len(k), self.tried), held)]
            while open_:  # the last first, so few wait
                nodes = open_.pop()
                upto = np.cumsum(nodes.size)
                if len(upto) > 1 and upto[-1] * self.lead.features > 2 * AT_ONCE:
                    cuts = [*_starts((upto - 1) * self.lead.features // AT_ONCE).tolist(), len(upto)]
                    if len(cuts) == 2:
                        cuts[1:1] = [len(upto) // 2]
                    open_ += [nodes.part(a, b) for a, b in zip(cuts, cuts[1:])]
                elif (more := self._split(nodes)) is not None:
                    open_.append(more)

    def _split(self, nodes: Nodes) -> Nodes | None:
        """The children of the nodes; nodes that end for a forest add their value."""
        first, held_first = (np.cumsum(x) - x for x in (nodes.size, nodes.held_size))
        y = self.y[nodes.row]
        wy = nodes.w * y
        n, s = np.add.reduceat(nodes.w, first), np.add.reduceat(wy, first)
        mixed = np.maximum.reduceat(y, first) > np.minimum.reduceat(y, first)  # equal targets: no cut helps
        todo = nodes.who & (nodes.depth < self.depth) & mixed[:, None] & (n[:, None] >= self.least)
        ends = nodes.who & ~todo
        found = self._cuts(nodes, todo, ends, first, wy, n, s) if todo.any() else None
        node, f = np.nonzero(ends & (nodes.held_size > 0)[:, None])
        if len(node):
            size = nodes.held_size[node]
            at = np.repeat(f * self.tried, size) + nodes.held[_ranges(held_first[node], size)]
            np.add.at(self.total.reshape(-1), at, np.repeat((s / n)[node] * self.times[f], size))
        if found is None:
            return None
        node, feature, cut, who = found
        sides = []
        for columns, rows, start, size in ((self.columns, nodes.row, first, nodes.size), (self.tried_columns, nodes.held, held_first, nodes.held_size)):
            size = size[node]
            place = _ranges(start[node], size)
            right = columns[np.repeat(feature * (len(columns) // self.width), size) + rows[place]] > np.repeat(cut, size)
            upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(right)))
            ends_at = np.cumsum(size)
            many = upto[ends_at] - upto[ends_at - size]
            sides.append((place[np.concatenate((np.flatnonzero(~right), np.flatnonzero(right)))], np.concatenate((size - many, many))))
        (place, size), (held, held_size) = sides
        ids = np.concatenate((2 * nodes.ids[node], 2 * nodes.ids[node] + 1))
        return Nodes(nodes.depth + 1, np.tile(nodes.tree[node], 2), ids, np.tile(who, (2, 1)), size, nodes.row[place], nodes.w[place], held_size, nodes.held[held])

    def _cuts(self, nodes: Nodes, todo: np.ndarray, ends: np.ndarray, first: np.ndarray, wy: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple | None:
        """(node, feature, cut, who): the best cuts of the nodes, as :func:`best_cuts` finds
        them, and the forests that take each. Where none is found, ``ends`` is set."""
        which, most = np.flatnonzero(todo.any(axis=1)), self.lead.features
        todo, n, s, size, k = todo[which], n[which], s[which], nodes.size[which], len(which)
        row, w = nodes.row, nodes.w
        if k < len(first):
            place = _ranges(first[which], size)
            row, w, wy = row[place], w[place], wy[place]
        self.pairs += len(row) * most
        chosen = node_features(self.lead.seed, nodes.tree[which], nodes.ids[which], self.width, most)
        key, base = np.empty((most, len(row)), np.int64), np.repeat(np.arange(k) * (most * BINS), size)
        for j in range(most):
            np.add(base, self.columns[np.repeat(chosen[:, j] * self.rows, size) + row], out=key[j])
            key[j] += j * BINS
        cell, ln, ls = _cells(key, k * most * BINS, w, wy, n.max())
        if n.sum() * most >= 1 << 28:  # sums beyond what a double holds
            ln, ls = ln.astype(np.int64), ls.astype(np.int64)
        runs = _starts(cell // BINS)  # of a node and feature: each holds rows
        length = np.diff(runs, append=len(cell))
        before = ln[runs], ls[runs]
        ln, ls = np.cumsum(ln), np.cumsum(ls)
        ln, ls = (x - np.repeat(x[runs] - b, length) for x, b in zip((ln, ls), before))
        ln, ls, length = ln.astype(float), ls.astype(float), length.reshape(k, most).sum(axis=1)
        whole = s * s / n
        rn, rs = np.repeat(n, length) - ln, np.repeat(s, length) - ls
        side = np.minimum(ln, rn)
        gain = ls * ls / ln + rs * rs / np.maximum(rn, 1) - np.repeat(whole, length)
        enough, own, out = 1e-9 * np.maximum(whole, 1), np.arange(k), []
        while len(own):  # the least side first: its best cut is that of all forests that allow it
            least = np.where(todo[own], self.leaf, np.iinfo(np.int64).max).min(axis=1)
            start = np.cumsum(length) - length
            allowed = np.where(side >= np.repeat(least, length), gain, -1.0)
            best = np.maximum.reduceat(allowed, start)
            top = np.flatnonzero(allowed == np.repeat(best, length))[::-1]
            at = np.empty(len(own), np.int64)
            at[np.repeat(np.arange(len(own)), length)[top]] = top  # the first comes last
            split = best > enough[own]
            takes = todo[own] & (self.leaf <= np.where(split, side[at], np.inf)[:, None])
            ends[which[own[~split]]] |= takes[~split]
            won = cell[at[split]]
            out.append((which[own[split]], chosen[own[split], won // BINS % most], won % BINS, takes[split]))
            todo[own] &= ~takes
            left = np.flatnonzero(todo[own].any(axis=1))
            some = _ranges(start[left], length[left])
            gain, side, cell, length, own = gain[some], side[some], cell[some], length[left], own[left]
        found = tuple(np.concatenate(x) for x in zip(*out))
        return found if len(found[0]) else None


# -- trees as arrays --------------------------------------------------------------


@dataclass
class Compiled:
    """Nodes of several trees in flat arrays; children of a node lie side by side."""

    roots: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    ids: np.ndarray
    depth: int

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """(rows, trees): place of the leaf that each row falls to."""
        at = np.broadcast_to(self.roots, (len(codes), len(self.roots))).copy()
        rows = np.arange(len(codes))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            inner = f >= 0
            right = codes[rows, np.maximum(f, 0)] > self.bin[at]
            at = np.where(inner, self.left[at] + right, at)
        return at


def _fall(flat: Compiled, root: int, codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Place of the leaf of one tree that each of ``rows`` falls to."""
    at, first, flat_codes = np.full(len(rows), root), rows * codes.shape[1], codes.ravel()
    for _ in range(flat.depth):
        f = flat.feature[at]
        inner = f >= 0
        if not inner.any():
            break
        right = flat_codes[first + np.maximum(f, 0)] > flat.bin[at]
        at = np.where(inner, flat.left[at] + right, at)
    return at


def compile_nodes(nodes: np.ndarray) -> Compiled:
    nodes = nodes[np.lexsort((nodes["id"], nodes["tree"]))]
    tree, ids = nodes["tree"].astype(np.int64), nodes["id"]
    inner = nodes["feature"] >= 0
    top = int(ids.max(initial=1)) * 2 + 2
    if len(nodes) and (int(tree.max()) + 1) * top < 1 << 62:
        place = np.searchsorted(tree * top + ids, tree * top + 2 * ids)
    else:  # very deep: one tree after the other
        place = np.concatenate([np.searchsorted(ids[tree == t], 2 * ids[tree == t]) + np.searchsorted(tree, t) for t in np.unique(tree)] or [np.empty(0, np.int64)])
    value = nodes["s"] / np.maximum(nodes["n"], 1)
    depth = int(np.frexp(float(ids.max(initial=1)))[1])
    return Compiled(np.flatnonzero(ids == 1), np.where(inner, nodes["feature"], -1).astype(np.int64), nodes["bin"].astype(np.int64), np.where(inner, place, 0), value, nodes["n"].copy(), nodes["gain"].copy(), ids.copy(), depth)


# -- growing on Spark -------------------------------------------------------------


@dataclass
class Grown:
    """Trees as packs of nodes: ``packs`` (forest, fold, pack, nodes) holds subtrees,
    ``tops`` the nodes above them, by forest."""

    packs: DataFrame
    tops: list[np.ndarray]
    forests: list[Forest]
    unit: float
    cuts: list[list[float]] = field(default_factory=list)


def _block(batch: pa.RecordBatch, i: int, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint8).reshape(-1, width)
    return batch.column("fold")[i].as_py(), codes, np.frombuffer(batch.column("part")[i].as_buffer(), PART)


def _draws(f: Forest, part: np.ndarray, tree: int) -> np.ndarray:
    return poisson(part["rid"], part["n"], f.seed, tree) if f.bootstrap else part["n"]


def _open(nodes: np.ndarray, local: int) -> np.ndarray:
    """Which nodes are grown by levels: not yet looked at and of many rows."""
    return (nodes["feature"] == -2) & (nodes["gain"] > local)


def _levels(binned: Binned, forests: list[Forest], tops: list[np.ndarray], limits: list[int]) -> list[np.ndarray]:
    """Split open nodes (of more rows than the forest's limit) level by level. In ``tops``,
    feature -2 marks a node that has not been split, with its rows (draws not counted) as
    ``gain``."""
    width = len(binned.columns)
    while any(_open(t, limit).any() for t, limit in zip(tops, limits)):

        def count(batches: Iterator[pa.RecordBatch], tops=tops) -> Iterator[pa.RecordBatch]:
            asked: dict[int, list] = {}  # tree -> forests with open nodes in it
            for i, (f, t, limit) in enumerate(zip(forests, tops, limits)):
                if not _open(t, limit).any():
                    continue
                flat, t = compile_nodes(t), t[np.lexsort((t["id"], t["tree"]))]
                ends = [*flat.roots[1:].tolist(), len(t)]
                for root, end in zip(flat.roots.tolist(), ends):
                    wanted = root + np.flatnonzero(_open(t[root:end], limit))
                    if len(wanted):
                        slot = np.full(end - root, -1)
                        slot[wanted - root] = np.arange(len(wanted))
                        chosen = node_features(f.seed, t["tree"][wanted], t["id"][wanted], width, f.features)
                        asked.setdefault(int(t["tree"][root]), []).append((i, f, flat, root, slot, t["id"][wanted], chosen))
            held: dict[tuple[int, int], tuple] = {}
            size = 0

            def hand_on() -> pa.RecordBatch:
                parts = []
                for (i, tree), (ids, chosen, *sums) in held.items():
                    node, j, b = np.nonzero(sums[0])
                    parts.append((np.full(len(node), i), np.full(len(node), tree), ids[node], chosen[node, j], b, *(x[node, j, b] for x in sums)))
                held.clear()
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], names)

            for batch in batches:
                for k in range(len(batch)):
                    fold, codes, part = _block(batch, k, width)
                    filled: dict[tuple[int, ...], np.ndarray] = {}
                    for tree, those in asked.items():
                        drawn: dict[tuple[bool, int], tuple] = {}  # forests of one seed draw alike
                        for i, f, flat, root, slot, ids, chosen in those:
                            if fold == f.fold:
                                continue
                            if f.fill not in filled:
                                filled[f.fill] = _filled(codes, f)
                            x = filled[f.fill]
                            if (f.bootstrap, f.seed) not in drawn:
                                w = _draws(f, part, tree)
                                some = np.flatnonzero(w > 0)
                                w = w[some].astype(float)
                                drawn[f.bootstrap, f.seed] = some, w, w * part["y"][some]
                            some, w, wy = drawn[f.bootstrap, f.seed]
                            node = slot[_fall(flat, root, x, some) - root]
                            if (node < 0).any():
                                keep = node >= 0
                                some, w, wy, node = some[keep], w[keep], wy[keep], node[keep]
                            if (i, tree) not in held:
                                shape = (*chosen.shape, BINS)
                                held[i, tree] = (ids, chosen, *(np.zeros(shape) for _ in range(3)))
                                size += 24 * chosen.size * BINS
                            sums, flat_x, first = held[i, tree][2:], x.ravel(), some * width
                            for j in range(chosen.shape[1]):
                                key = node * BINS + flat_x[first + chosen[node, j]]
                                for total, weight in zip(sums, (None, w, wy)):
                                    total[:, j] += np.bincount(key, weight, len(ids) * BINS).reshape(-1, BINS)
                            if size > HELD_BYTES:
                                yield hand_on()
                                size = 0
            if held:
                yield hand_on()

        names = ["forest", "tree", "id", "feature", "bin", "rows", "n", "s"]
        counts = binned.blocks.mapInArrow(count, ", ".join(f"{c} long" for c in names))
        counts = counts.groupBy(*names[:5]).agg(*[F.sum(c).alias(c) for c in names[5:]])

        def choose(key: tuple, table: pa.Table) -> pa.Table:
            i, tree, id_ = (k.as_py() for k in key)
            f = forests[i]
            feature, b = table["feature"].to_numpy(), table["bin"].to_numpy()
            kinds, at = np.unique(feature, return_inverse=True)
            h = {c: np.bincount(at * BINS + b, table[c].to_numpy().astype(float), len(kinds) * BINS).reshape(-1, BINS) for c in ("rows", "n", "s")}
            g, cut = best_cut(h["n"], h["s"], f.min_samples_leaf)
            j = int(g.argmax())
            split = bool(g[j] > 0) and bool(_splittable(np.array([id_]), h["n"][j : j + 1].sum(axis=1), f)[0])
            left = {c: x[j, : cut[j] + 1].sum() for c, x in h.items()}
            row = {"forest": i, "tree": tree, "id": id_, "feature": int(kinds[j]) if split else -1, "bin": int(cut[j]) if split else 0, "gain": float(g[j]) if split else 0.0}
            row |= {f"l_{c}": float(v) for c, v in left.items()} | {f"r_{c}": float(x[j].sum() - left[c]) for c, x in h.items()}
            return pa.Table.from_pylist([row])

        sides = [f"{side}_{c}" for side in "lr" for c in ("rows", "n", "s")]
        schema = "forest long, tree long, id long, feature long, bin long, gain double, " + ", ".join(f"{c} double" for c in sides)
        done = counts.groupBy("forest", "tree", "id").applyInArrow(choose, schema).collect()
        new = [t.copy() for t in tops]
        more: list[list[tuple]] = [[] for _ in tops]
        place = {(i, int(t["tree"][at]), int(t["id"][at])): at for i, (t, limit) in enumerate(zip(tops, limits)) for at in np.flatnonzero(_open(t, limit)).tolist()}
        for r in done:
            f, t = forests[r["forest"]], new[r["forest"]]
            at = place.pop((r["forest"], r["tree"], r["id"]))
            t["feature"][at], t["bin"][at], t["gain"][at] = r["feature"], r["bin"], r["gain"]
            t["n"][at], t["s"][at] = r["l_n"] + r["r_n"], r["l_s"] + r["r_s"]
            if r["feature"] >= 0:
                for side, id_ in (("l", 2 * r["id"]), ("r", 2 * r["id"] + 1)):
                    n = r[f"{side}_n"]
                    if _splittable(np.array([id_]), np.array([n]), f)[0]:
                        more[r["forest"]].append((r["tree"], id_, -2, 0, n, r[f"{side}_s"], r[f"{side}_rows"]))
                    else:  # a leaf, whatever its rows are
                        more[r["forest"]].append((r["tree"], id_, -1, 0, n, r[f"{side}_s"], 0.0))
        for (i, _, _), at in place.items():  # no row was drawn
            new[i]["feature"][at], new[i]["gain"][at] = -1, 0.0
        tops = [np.concatenate((t, np.array(m, NODE))) if m else t for t, m in zip(new, more)]
    return tops


def _begun(binned: Binned, forests: list[Forest], local: int) -> tuple[list[np.ndarray], list[int]]:
    """The forests with what is grown by levels, and those whose trees are grown whole."""
    tops, limits = [], []
    for f in forests:
        t = np.zeros(f.trees, NODE)
        t["tree"], t["id"], t["feature"] = np.arange(f.trees), 1, -2
        rows = sum(n for k, n in binned.rows.items() if k != f.fold)
        t["gain"] = rows
        tops.append(t)
        limits.append(0 if rows > local and f.max_depth <= SHALLOW else local)
    whole = [i for i, (t, limit) in enumerate(zip(tops, limits)) if not _open(t, limit).any()]
    return _levels(binned, forests, tops, limits), whole


@dataclass
class Share:
    """Trees of a forest that a group grows: all of them, or some."""

    forest: int
    trees: np.ndarray
    all: bool


def _groups(binned: Binned, forests: list[Forest], whole: list[int], pack_rows: int, most: int, work: list[np.ndarray] | None = None) -> list[list[Share]]:
    """Deal whole trees to groups of about equal work (``work``: by forest, of each tree):
    consecutive trees, so that most forests lie in one group where there are many."""
    rows = {i: sum(n for k, n in binned.rows.items() if k != forests[i].fold) for i in whole}
    work = np.concatenate(work or [np.full(forests[i].trees, float(max(1, rows[i]) * forests[i].max_depth * forests[i].features)) for i in whole])
    some = sum(max(1, rows[i]) * forests[i].trees for i in whole) / max(pack_rows, 4 * max(rows.values()))
    count = max(1, min(most, math.ceil(some)))
    group = np.minimum(count - 1, (np.cumsum(work) - work / 2) / work.sum() * count).astype(int)
    out: list[list[Share]] = [[] for _ in range(count)]
    first = 0
    for i in whole:
        own = group[first : first + forests[i].trees]
        first += forests[i].trees
        for g in np.unique(own).tolist():
            trees = np.flatnonzero(own == g)
            out[g].append(Share(i, trees, len(trees) == forests[i].trees))
    return [g for g in out if g]


def _by_group(binned: Binned, forests: list[Forest], groups: list[list[Share]], finish, schema: str) -> DataFrame:
    """``finish(share, blocks, grown)`` for every share: ``blocks`` are (fold, block, codes,
    part) of all folds, ``grown`` yields the nodes of the share's trees, some trees at once."""
    width = len(binned.columns)

    def grown(share: Share, blocks: list[tuple]) -> Iterator[np.ndarray]:
        f = forests[share.forest]
        own = [b for b in blocks if b[0] != f.fold]
        if not own:
            return
        codes, part = _filled(np.concatenate([b[2] for b in own]), f), np.concatenate([b[3] for b in own])
        step = max(1, BLOCK_ROWS // max(1, len(part)))
        for first in range(0, len(share.trees), step):
            row, tree, w = [], [], []
            for t in share.trees[first : first + step].tolist():
                draws = _draws(f, part, t)
                some = np.flatnonzero(draws > 0)
                row.append(some)
                tree.append(np.full(len(some), t))
                w.append(draws[some])
            row, tree, w = (np.concatenate(x) for x in (row, tree, w))
            yield grow_subtrees(codes, row, tree, np.ones(len(row), np.int64), part["y"][row], w, f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []

        def done() -> Iterator[pa.RecordBatch]:
            for share in groups[now]:
                yield from finish(share, blocks, grown(share, blocks))

        for batch in batches:
            for k, g in enumerate(batch.column("group").to_pylist()):
                if g != now and blocks:
                    yield from done()
                    blocks = []
                now = g
                fold, codes, part = _block(batch, k, width)
                blocks.append((fold, batch.column("block")[k].as_py(), codes.copy(), part.copy()))
        if blocks:
            yield from done()

    sent = binned.blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))))
    sent = sent.repartition(4 * len(groups), "group").sortWithinPartitions("group", "block")
    return sent.mapInArrow(run, schema)


def _most_groups(binned: Binned) -> int:
    return max(GROUPS, 4 * binned.blocks.sparkSession.sparkContext.defaultParallelism)


def grow(binned: Binned, forests: Sequence[Forest], local: int | None = None, pack_rows: int | None = None) -> Grown:
    """Grow all the forests. Where a forest's samples are few, its trees are grown whole
    by groups; else they, or their tops, are grown by levels first."""
    forests, width = list(forests), len(binned.columns)
    local, pack_rows = local or LOCAL_ROWS, pack_rows or PACK_ROWS
    tops, whole = _begun(binned, forests, local)
    schema = "forest long, fold int, pack long, nodes binary"
    packs = []
    if whole:

        def pack(share: Share, blocks: list[tuple], grown: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for nodes in grown:
                i, first = share.forest, int(share.trees[0])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([forests[i].fold], pa.int32()), pa.array([first], pa.int64()), pa.array([nodes.tobytes()], pa.binary())], ["forest", "fold", "pack", "nodes"])

        packs.append(_by_group(binned, forests, _groups(binned, forests, whole, pack_rows, _most_groups(binned)), pack, schema))
    # nodes still open are put into packs of about pack_rows rows
    packed: list[np.ndarray] = []
    for i, t in enumerate(tops):
        mark = np.full(len(t), -1)
        at = np.flatnonzero(t["feature"] == -2) if i not in whole else np.empty(0, int)
        mark[at] = np.floor((np.cumsum(t["gain"][at]) - t["gain"][at]) / pack_rows).astype(np.int64)
        packed.append(mark)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flats = {}
        for i, t in enumerate(tops):
            if (packed[i] >= 0).any():
                order = np.lexsort((t["id"], t["tree"]))
                flats[i] = compile_nodes(t), t["tree"][order], t["id"][order], packed[i][order]
        for batch in batches:
            for k in range(len(batch)):
                fold, codes, part = _block(batch, k, width)
                for i, (flat, tree, id_, mark) in flats.items():
                    f = forests[i]
                    if fold == f.fold:
                        continue
                    x = _filled(codes, f)
                    for root in flat.roots.tolist():
                        drawn = np.flatnonzero(_draws(f, part, int(tree[root])) > 0)
                        leaf = _fall(flat, root, x, drawn)
                        for node in np.unique(leaf).tolist():
                            if mark[node] >= 0:
                                some = drawn[leaf == node]
                                yield _row(i, int(mark[node]), tree[[node]], id_[[node]], codes[some], part[some])

    def grow_pack(key: tuple, table: pa.Table) -> pa.Table:
        i, p = (k.as_py() for k in key)
        f = forests[i]
        codes, row, tree, start, y, w = [], [], [], [], [], []
        base = 0
        for r in table.to_pylist():
            part = np.frombuffer(r["part"], PART)
            codes.append(np.frombuffer(r["codes"], np.uint8).reshape(-1, width))
            for t, node in zip(r["trees"], r["ids"]):
                draws = _draws(f, part, t)
                some = np.flatnonzero(draws > 0)
                row.append(base + some)
                tree.append(np.full(len(some), t))
                start.append(np.full(len(some), node))
                y.append(part["y"][some])
                w.append(draws[some])
            base += len(part)
        nodes = grow_subtrees(_filled(np.concatenate(codes), f), *(np.concatenate(x) for x in (row, tree, start, y, w)), f)
        return pa.table({"forest": [i], "fold": pa.array([f.fold], pa.int32()), "pack": [p], "nodes": [nodes.tobytes()]})

    if any((m >= 0).any() for m in packed):
        dealt = binned.blocks.mapInArrow(deal, "forest long, pack long, trees array<int>, ids array<long>, codes binary, part binary")
        packs.append(dealt.groupBy("forest", "pack").applyInArrow(grow_pack, schema))
    spark = binned.blocks.sparkSession
    packs = cut_lineage(reduce(DataFrame.unionByName, packs), "trees") if packs else spark.createDataFrame([], schema)
    return Grown(packs, tops, forests, binned.unit, binned.cuts)


def _row(i: int, p: int, trees: np.ndarray, ids: np.ndarray, codes: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    columns = [
        pa.array([i], pa.int64()), pa.array([p], pa.int64()), pa.array([trees.tolist()], pa.list_(pa.int32())), pa.array([ids.tolist()], pa.list_(pa.int64())),
        pa.array([np.ascontiguousarray(codes).tobytes()], pa.binary()), pa.array([np.ascontiguousarray(part).tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["forest", "pack", "trees", "ids", "codes", "part"])


def nodes_of(grown: Grown, i: int) -> np.ndarray:
    """All nodes of one forest, on the driver: at most two for each sample of a tree,
    and 2^(max_depth + 1) for each tree."""
    found = grown.packs.where(F.col("forest") == i).select("nodes").collect()
    top = grown.tops[i]
    below = [np.frombuffer(r["nodes"], NODE) for r in found]
    return np.concatenate([top[top["feature"] != -2], *below])


HELD = np.dtype([("y", "<i8"), ("n", "<i8")])
SUMS = "n_test long, sse double, tp long, fn long"
SHARES = "forest long, block long, total binary, held binary, " + SUMS


def _held(part: np.ndarray) -> np.ndarray:
    out = np.empty(len(part), HELD)
    out["y"], out["n"] = part["y"], part["n"]
    return out


def _sums(total: np.ndarray, held: np.ndarray, f: Forest, unit: float, threshold: float) -> tuple[int, float, int, int]:
    """(n_test, sse, tp, fn) of rows with the sums of their trees' values."""
    found, y, n = np.clip(total * (unit / f.trees), 0.0, 1.0), held["y"] * unit, held["n"]
    hit, flagged = y >= threshold - unit / 2, found >= threshold
    return int(n.sum()), float((n * (found - y) ** 2).sum()), int(n[hit & flagged].sum()), int(n[hit & ~flagged].sum())


def _add_values(total: np.ndarray, flat: Compiled, codes: np.ndarray) -> None:
    """Add the values of all trees to each row's total."""
    if len(codes) * len(flat.roots) <= BLOCK_ROWS:
        total += flat.value[flat.leaves(codes)].sum(axis=1)
        return
    rows = np.arange(len(codes))
    for root in flat.roots.tolist():
        total += flat.value[_fall(flat, root, codes, rows)]


def _share_rows(i: int, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of :data:`SHARES`: (block, total, held) or the sums."""
    names = [c.split()[0] for c in SHARES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[(i, *r) for r in rows]), kinds)], names)


def _add_up(shares: DataFrame, forests: list[Forest], unit: float, threshold: float) -> DataFrame:
    """(forest, n_test, sse, tp, fn) from shares: the totals of a block's rows are summed
    over the trees' groups or packs before they are compared."""

    def total(key: tuple, table: pa.Table) -> pa.Table:
        i = key[0].as_py()
        found = sum(np.frombuffer(t.as_buffer(), float) for t in table["total"])
        held = next(h for h in table["held"] if h.is_valid)  # not every share has it
        sums = _sums(found, np.frombuffer(held.as_buffer(), HELD), forests[i], unit, threshold)
        return pa.table({"forest": [i], **{c: [x] for c, x in zip(("n_test", "sse", "tp", "fn"), sums)}})

    shares = cut_lineage(shares, "shares")
    parted = shares.where("total IS NOT NULL").select("forest", "block", "total", "held")
    found = parted.groupBy("forest", "block").applyInArrow(total, "forest long, " + SUMS)
    found = found.unionByName(shares.where("total IS NULL").select("forest", "n_test", "sse", "tp", "fn"))
    return found.groupBy("forest").agg(*[F.sum(c).alias(c) for c in ("n_test", "sse", "tp", "fn")])


def cross_scores(binned: Binned, forests: Sequence[Forest], threshold: float, local: int | None = None, pack_rows: int | None = None) -> DataFrame:
    """(forest, n_test, sse, tp, fn) of every forest, grown without its fold and tried on
    it. Groups that grow whole trees, family by family, try them at once, and no node leaves
    them."""
    forests, local, unit = list(forests), local or LOCAL_ROWS, binned.unit
    rows = [sum(n for k, n in binned.rows.items() if k != f.fold) for f in forests]
    whole, large = ([i for i, n in enumerate(rows) if (n <= local) == kind] for kind in (True, False))
    parts = []
    if whole:
        kin = families(forests, whole, len(binned.columns))

        def score(share: Share, blocks: list[tuple], _: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            family = kin[share.forest]
            own, held = ([b for b in blocks if (b[0] == family.lead.fold) == kind] for kind in (False, True))
            if not held or not own:
                return
            codes, tried = (_filled(np.concatenate([b[2] for b in x]), family.lead) for x in (own, held))
            trees = FamilyTrees(codes, np.concatenate([b[3] for b in own]), tried, family, forests)
            trees.add(share.trees)
            part = _held(np.concatenate([b[3] for b in held]))
            for i, total in zip(family.forests, trees.total):
                if family.alike or forests[i].trees <= share.trees[-1] + 1 and not share.trees[0]:  # all its trees
                    yield _share_rows(i, [(None, None, None, *_sums(total, part, forests[i], unit, threshold))])
                elif share.trees[0] < forests[i].trees:
                    at = 0
                    for _, block, x, _ in held:
                        some = slice(at, at + len(x))
                        yield _share_rows(i, [(block, total[some].tobytes(), None if share.trees[0] else part[some].tobytes(), None, None, None, None)])
                        at += len(x)

        leads, work = [k.lead for k in kin], [_tree_work(k, forests, rows[k.forests[0]]) for k in kin]
        groups = _groups(binned, leads, list(range(len(kin))), pack_rows or PACK_ROWS, _most_groups(binned), work)
        parts.append(_add_up(_by_group(binned, leads, groups, score, SHARES), forests, unit, threshold))
    if large:
        found = held_out_scores(binned, grow(binned, [forests[i] for i in large], local, pack_rows), threshold)
        parts.append(found.withColumn("forest", F.get(F.array(*[F.lit(i).cast("long") for i in large]), F.col("forest").cast("int"))))
    return reduce(DataFrame.unionByName, parts)


def held_out_scores(binned: Binned, grown: Grown, threshold: float) -> DataFrame:
    """(forest, n_test, sse, tp, fn): of every forest on the fold it was grown without.
    Forests grown by levels alone are tried where the blocks are. Blocks meet the packs of
    the other forests that leave out their fold; a pack adds its share of the predictions,
    and the shares of a block are summed."""
    width, tops, forests, unit = len(binned.columns), grown.tops, grown.forests, grown.unit
    ended = [i for i, t in enumerate(tops) if len(t) and not (t["feature"] == -2).any()]

    def try_ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flats = {i: compile_nodes(tops[i]) for i in ended}
        for batch in batches:
            for k in range(len(batch)):
                fold, codes, part = _block(batch, k, width)
                for i, flat in flats.items():
                    if fold == forests[i].fold:
                        total = np.zeros(len(part))
                        _add_values(total, flat, _filled(codes, forests[i]))
                        yield _share_rows(i, [(None, None, None, *_sums(total, _held(part), forests[i], unit, threshold))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                _, codes, part = _block(batch, k, width)
                i, p = batch.column("forest")[k].as_py(), batch.column("pack")[k].as_py()
                f, top = forests[i], tops[i]
                own = np.frombuffer(batch.column("nodes")[k].as_buffer(), NODE)
                if (top["feature"] != -2).any():  # a row that leaves the pack's trees adds 0
                    rest = top[(top["feature"] != -2) | ~np.isin(top["tree"].astype(np.int64) << 40 ^ top["id"], own["tree"].astype(np.int64) << 40 ^ own["id"])].copy()
                    if p:  # leaves above the packs count once
                        rest["s"][rest["feature"] < 0] = 0
                    rest["s"][rest["feature"] == -2] = 0
                    rest["feature"][rest["feature"] == -2] = -1
                    own = np.concatenate((rest, own))
                total = np.zeros(len(codes))
                _add_values(total, compile_nodes(own), _filled(codes, f))
                yield _share_rows(i, [(batch.column("block")[k].as_py(), total.tobytes(), _held(part).tobytes(), None, None, None, None)])

    blocks = binned.blocks.select("fold", "block", "codes", "part")
    shares = []
    if ended:
        shares.append(blocks.mapInArrow(try_ended, SHARES))
    if len(ended) < len(tops):
        shares.append(blocks.join(grown.packs, "fold").mapInArrow(score, SHARES))
    return _add_up(reduce(DataFrame.unionByName, shares), forests, unit, threshold)
