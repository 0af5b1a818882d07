"""SimHash near-duplicates by vantage-point trees.

Fingerprints are partitioned by their Hamming distance to vantage points. At a tree
node with vantage point v and radius m, fingerprints with d(f, v) <= m go left and
those with d(f, v) > m - k go right, k being the largest distance that links. By the
triangle inequality two linked fingerprints that part at a node have distances to v
that differ by at most k, so the left one lies in the boundary (m - k, m] and visits
the right side too: every linked pair meets in at least one leaf, and only boundary
fingerprints are copied. The routing tree is fitted on a bounded sample of the
distinct fingerprints; all fingerprints are routed and each leaf (a shard) is
searched exactly by a tree of its own, built the same way down to small blocks.

A leaf gives a spanning forest of its links, at most one edge per fingerprint, not
the pairs, so dense groups stay linear in size; components are then joined across
leaves by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage, text_of, without_rows
from wakeful.llm.components import connected_components

HASH_SEED = 42
SHINGLES_AT_ONCE = 1 << 16
BLOCK = 256  # fingerprints compared directly
CELLS = 1 << 22  # distances held at once


# -- fingerprints -----------------------------------------------------------------


def simhash(text: bytes, words: int = 3) -> int:
    """64-bit fingerprint of UTF-8 text: A-Z lower-cased, shingles of ``words`` words
    (repeats count; fewer words: the whole sequence; none: 0) hashed by XXH64, a bit
    set where it is set in over half of the hashes."""
    tokens = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) >= words:
        starts, ends = starts[: len(tokens) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = zip(starts[i : i + SHINGLES_AT_ONCE].tolist(), ends[i : i + SHINGLES_AT_ONCE].tolist())
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, key: Column | None = None
) -> DataFrame:
    """(``doc_id``, ``fp``): a row per input row, null text read as empty, ``fp`` the
    fingerprint's 64 bits as a signed long. With ``key`` (a text) that as well, as
    ``key``."""
    names = ["doc_id", "fp"] if key is None else ["doc_id", "fp", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.array([simhash(t.as_py(), words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], names)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), *([] if key is None else [key.alias("key")]))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long" + ("" if key is None else ", key string"))


# -- the tree ---------------------------------------------------------------------


def _split(fps: np.ndarray, idx: np.ndarray, bits: int, rng: np.random.Generator):
    """The best of a few vantage points for ``fps[idx]``: (vantage, radius, left,
    right), or None where none parts them."""
    best = None
    for v in fps[rng.choice(idx, min(len(idx), 5), replace=False)]:
        d = np.bitwise_count(fps[idx] ^ v)
        radius = int(np.median(d))
        for m in (radius - 1, radius):
            left, right = int((d <= m).sum()), int((d > m - bits).sum())
            cost = left * left + right * right
            if left and max(left, right) < len(idx) and (best is None or cost < best[0]):
                best = (cost, v, m, d)
    if best is None or best[0] > 0.95 * len(idx) ** 2:
        return None
    _, v, m, d = best
    return v, m, idx[d <= m], idx[d > m - bits]


class VantageTree:
    """Routing tree: ``nodes`` holds (vantage, radius, left, right), children below
    zero being leaves ``-1 - leaf``. Its size is bounded by the sample it is built
    on."""

    def __init__(self, sample: np.ndarray, leaves: int, bits: int, least: int = 16):
        self.bits, self.leaves = bits, 0
        self.nodes: list[list] = []
        rng = np.random.default_rng(7)
        sample = np.unique(sample)
        share = max(least, -(-len(sample) // max(1, leaves)))
        todo = [(None, 0, np.arange(len(sample)))]
        while todo:
            parent, side, idx = todo.pop()
            parted = _split(sample, idx, bits, rng) if len(idx) > share else None
            if parted is None:
                at = -1 - self.leaves
                self.leaves += 1
            else:
                v, m, left, _ = parted
                at = len(self.nodes)
                self.nodes.append([int(v), m, 0, 0])
                # the sample is parted without overlap, so its share follows the data
                right = np.setdiff1d(idx, left, assume_unique=True)
                todo += [(at, 2, left), (at, 3, right)]
            if parent is not None:
                self.nodes[parent][side] = at

    def route(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the positions of the fingerprints that visit them."""
        todo = [(0 if self.nodes else -1, np.arange(len(fps)))]
        while todo:
            at, idx = todo.pop()
            if at < 0:
                if len(idx):
                    yield -1 - at, idx
                continue
            v, m, left, right = self.nodes[at]
            d = np.bitwise_count(fps[idx] ^ np.uint64(v))
            todo.append((left, idx[d <= m]))
            todo.append((right, idx[d > m - self.bits]))


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the components of the pairs (i, j); a label is its component's smallest
    position."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            higher = label[label]
            if np.array_equal(higher, label):
                break
            label[:] = higher


def leaf_components(fps: np.ndarray, bits: int) -> np.ndarray:
    """Component of each of the sorted distinct ``fps`` under links of at most
    ``bits`` differing bits, as the position of its smallest member. Exact: parts
    that no vantage point divides are compared directly, block by block."""
    label = np.arange(len(fps))
    rng = np.random.default_rng(11)
    todo = [np.arange(len(fps))]
    while todo:
        idx = todo.pop()
        parted = _split(fps, idx, bits, rng) if len(idx) > BLOCK else None
        if parted is not None:
            todo += [parted[2], parted[3]]
            continue
        part, step = fps[idx], max(1, min(BLOCK, CELLS // max(1, len(idx))))
        for k in range(0, len(idx), step):
            near = np.bitwise_count(part[k : k + step, None] ^ part[None, k:]) <= bits
            i, j = np.nonzero(near)
            off = i < j
            if off.any():
                _unite(label, idx[k + i[off]], idx[k + j[off]])
    return label


# -- the join ---------------------------------------------------------------------


def near_links(
    fps: DataFrame, bits: int, leaf_rows: int = 4096, max_sample: int = 1 << 17
) -> DataFrame:
    """Spanning edges (``a``, ``b``) whose components are those of all links of at
    most ``bits`` differing bits between the distinct fingerprints ``fp`` of the
    written table ``fps``. The routing tree is fitted on at most about ``max_sample``
    of them (taken by a hash) and aims at ``leaf_rows`` to a leaf; it decides where
    fingerprints meet, never which are compared."""
    n = fps.count()
    share = max(1, -(-n // max_sample))
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).toPandas()["fp"].to_numpy(np.int64)
    tree = VantageTree(sample.view(np.uint64), -(-n // leaf_rows), bits)
    shared = fps.sparkSession.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False)
            for leaf, idx in shared.value.route(found.view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(idx), leaf, np.int32)), pa.array(found[idx])], ["leaf", "fp"]
                )

    def search(group: pa.Table) -> pa.Table:
        found = np.unique(group.column("fp").to_numpy().view(np.uint64))
        label = leaf_components(found, bits)
        moved = label != np.arange(len(found))
        return pa.table({"a": found[moved].view(np.int64), "b": found[label[moved]].view(np.int64)})

    return (
        fps.select("fp")
        .mapInArrow(route, "leaf int, fp long")
        .groupBy("leaf")
        .applyInArrow(search, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``fp`` (signed long), ``component_id``
    (smallest id reachable over links of at most ``bits`` differing fingerprint bits,
    the row's own included).

    Null text counts as empty; texts without words have fingerprint 0 and are linked
    like others. Rows with a null id take part; a component with no other ids has
    component_id null. Repeated rows are each returned. An empty table gives no rows.
    Other columns of ``docs`` are not looked at, whatever their names.
    """
    return _grouped(cut_lineage(fingerprints(docs, id_col, text_col, words), "fp"), bits).select("doc_id", "fp", "component_id")


def _grouped(prints: DataFrame, bits: int) -> DataFrame:
    """The written table ``prints`` (``doc_id``, ``fp``, ...) with ``component_id`` and
    ``root``, a fingerprint that names the row's component."""
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "fps")
    roots = connected_components(near_links(classes, bits))
    # every fingerprint that shares a component or is shared by rows
    linked = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    member = classes.join(linked, classes.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"), ((F.col("n") > 1) | F.col("root").isNotNull()).alias("shared")
    ).where("shared")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    found = member.join(least, "root").select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), "component_id")
    return prints.join(found, prints.fp == F.col("_fp"), "left").select(
        *prints.columns,
        F.when(F.col("_fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("_root", "fp").alias("root"),
    )


def fingerprint_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates, that of the smallest
    id; columns as given. A null id is larger than all others. Where the smallest id
    is repeated within a component, the row of the smaller SHA-256 of its text stays;
    of rows equal in id and text one stays, which one isn't defined.

    The decision is carried by (id, hash of the text), so that rows which share their
    id but not their text are told apart."""
    key = F.sha2(text_of(F.col(f"`{text_col}`")), 256)
    rows = _grouped(cut_lineage(fingerprints(docs, id_col, text_col, words, key), "fp"), bits)
    # rows equal in id and text are one row here, before any of them meet
    rows = cut_lineage(rows.groupBy("root", "doc_id", "key").agg(F.count("*").alias("n")), "members")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    first = rows.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("several")).where("several > 1").drop("several")
    named = first.select(F.col("root").alias("_root"), F.col("first.doc_id").alias("_first_id"), F.col("first.key").alias("_first_key"))
    stays = F.col("doc_id").eqNullSafe(F.col("_first_id")) & (F.col("key") == F.col("_first_key"))
    goes = rows.join(named, rows["root"] == named["_root"]).where(~stays).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    goes = cut_lineage(goes, "dropped")
    repeated = rows.where("n > 1").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    repeated = repeated.join(goes, repeated["_id"].eqNullSafe(goes["_id"]) & (repeated["_key"] == goes["_key"]), "left_anti")
    return without_rows(docs, key, id_col, goes, repeated)
