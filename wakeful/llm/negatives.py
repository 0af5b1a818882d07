"""Hard-negative mining by Four-Russians scoring.

Components become integers, floor(256 x). The rows are indexed as bit planes: of every
eight dimensions, the bits of one plane make a byte. An anchor has, for each group of
eight dimensions, a table of its 256 subset sums, so a plane's byte looks up what eight
products would add; planes are joined by shift and add (the highest one, two's
complement sign, counts negative), which gives whole exact inner products.

Anchors are a stated query set: they are written as files of a bounded number of
anchors to the shared folder, and each task holds the rows of its part of the index in
blocks and reads the anchor files one after the other. Rows are never shuffled or
broadcast; of a block only the best few per anchor leave the task. Two passes: the
first finds each anchor's positives (it scores rows of the anchor's own label only),
the second its negatives below each positive.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage
from wakeful.llm.files import create, open_random, read_at, shared_folder

SCALE = 256
GROUP = 8  # dimensions of a lookup table
ANCHORS_A_FILE = 1 << 12
ANCHORS_AT_ONCE = 64  # tables of 512 KB for 64 dimensions
ROWS_AT_ONCE = 1 << 11
ROWS_A_BLOCK = 1 << 18  # rows that a task holds while it reads the anchors
LEAST = np.iinfo(np.int64).min


# -- the index --------------------------------------------------------------------


def pack_planes(q: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of (rows, dimensions) integers in two's complement;
    bit j of a byte is dimension 8 g + j."""
    n, d = q.shape
    wide = np.zeros((n, -(-d // GROUP) * GROUP), np.int64)
    wide[:, :d] = q
    out = np.empty((n, planes, wide.shape[1] // GROUP), np.uint8)
    for p in range(planes):
        out[:, p] = np.packbits((wide >> p & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): sums of an anchor's components over each set of a
    group's dimensions."""
    n, d = anchors.shape
    wide = np.zeros((n, -(-d // GROUP) * GROUP), np.int64)
    wide[:, :d] = anchors
    parts = wide.reshape(n, -1, GROUP).transpose(1, 2, 0)  # group, dimension, anchor
    sums = np.zeros((parts.shape[0], 1 << GROUP, n), np.int64)
    for j in range(GROUP):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + parts[:, j, None]
    return sums


def scores(packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors): exact inner products, from lookups alone."""
    n, planes, groups = packed.shape
    total = np.zeros((n, sums.shape[2]), sums.dtype)
    found, plane = np.empty_like(total), np.empty_like(total)
    for p in range(planes - 1, -1, -1):
        plane[:] = 0
        for g in range(groups):
            np.take(sums[g], packed[:, p, g], axis=0, out=found)
            plane += found
        if p == planes - 1:
            np.negative(plane, out=total)
        else:
            total += total
            total += plane
    return total


def narrowed(sums: np.ndarray, planes: int) -> np.ndarray:
    """The tables in 32 bits where no score of theirs can pass them."""
    bound = int(np.abs(sums).max(axis=1).sum(axis=0).max(initial=0)) << planes if sums.size else 0
    if bound >= 1 << 62:
        raise ValueError("scores of these vectors don't fit 64 bits")
    return sums.astype(np.int32) if bound < 1 << 31 else sums


def _quantised(rows: DataFrame, anchors_where: str, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, q, asked): rows that take part, their components as integers."""
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    part = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & whole)
    return part.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long")).alias("q"),
        F.coalesce(F.expr(anchors_where), F.lit(False)).alias("asked"),
    )


def _matrix(lists: pa.ListArray, d: int) -> np.ndarray:
    """Lists of integers as rows of ``d``; shorter ones are filled with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), d), np.int64)
    rows = np.repeat(np.arange(len(lists)), sizes)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _index(rows: DataFrame, d: int, planes: int) -> DataFrame:
    """(id, label, bits): the bit planes of every row, a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pack_planes(_matrix(batch.column(2), d), planes)
            bits = pa.array([r.tobytes() for r in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bits], ["id", "label", "bits"])

    return cut_lineage(rows.mapInArrow(run, "id long, label long, bits binary"), "planes")


# -- anchor files -----------------------------------------------------------------


def _write_anchors(anchors: DataFrame, folder: str) -> list[str]:
    """Files of at most :data:`ANCHORS_A_FILE` anchors each, as Arrow streams. Only
    their names reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ANCHORS_A_FILE):
                part, held = batch.slice(at, ANCHORS_A_FILE), io.BytesIO()
                with pa.ipc.new_stream(held, part.schema) as out:
                    out.write_batch(part)
                uri, stream = create(folder, "anchors", ".arrow")
                with stream:
                    stream.write(held.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array([uri])], ["path"])

    names = cut_lineage(anchors.mapInArrow(run, "path string"), "anchor-files")
    return sorted(r["path"] for r in names.collect())


def _read_anchors(path: str) -> pa.RecordBatch:
    with open_random(path) as file:
        with pa.ipc.open_stream(read_at(file, 0, file.size())) as found:
            return found.read_next_batch()


def _blocks(batches: Iterator[pa.RecordBatch], planes: int, groups: int):
    """(ids, labels, packed) of at most about :data:`ROWS_A_BLOCK` rows, by (label, id)."""
    held: list[pa.RecordBatch] = []

    def block():
        t = pa.Table.from_batches(held).combine_chunks()
        ids, labels = t["id"].to_numpy(), t["label"].to_numpy()
        packed = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint8).reshape(len(ids), planes, groups)
        order = np.lexsort((ids, labels))
        return ids[order], labels[order], packed[order]

    room = ROWS_A_BLOCK
    for batch in batches:
        while len(batch):
            held.append(batch.slice(0, room))
            batch = batch.slice(len(held[-1]))
            room -= len(held[-1])
            if not room:
                yield block()
                held, room = [], ROWS_A_BLOCK
    if held:
        yield block()


def _keys(found: np.ndarray, first: int) -> np.ndarray:
    """(anchors, rows): one number for each score and place; a larger one comes first.
    Rows lie by id within a label, so an earlier place wins a tie within a label."""
    places = first + np.arange(len(found))
    if len(found) and int(np.abs(found).max()) >= 1 << 40:
        raise ValueError("scores of these vectors don't fit 40 bits")
    return (found.T.astype(np.int64) << 20) - places


# -- positives --------------------------------------------------------------------


def _top_positives(index: DataFrame, paths: list[str], d: int, planes: int, most: int) -> DataFrame:
    """Of every block, each anchor's ``most`` + 1 best rows of its own label, with a
    mark on rows equal to the anchor in all that is indexed (it is one of them)."""
    groups = -(-d // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, packed in _blocks(batches, planes, groups):
            for path in paths:
                anchors = _read_anchors(path)
                key, aid, alabel = (anchors.column(i).to_numpy() for i in range(3))
                q = _matrix(anchors.column(3), d)
                bits = pack_planes(q, planes)
                out: list[tuple] = []
                for label in np.unique(alabel):
                    lo, hi = np.searchsorted(labels, [label, label + 1])
                    if lo == hi:
                        continue
                    own = np.flatnonzero(alabel == label)
                    for at in range(0, len(own), ANCHORS_AT_ONCE):
                        some = own[at : at + ANCHORS_AT_ONCE]
                        sums = narrowed(subset_sums(q[some]), planes)
                        best = np.full((len(some), most + 1), LEAST)
                        for first in range(lo, hi, ROWS_AT_ONCE):
                            last = min(hi, first + ROWS_AT_ONCE)
                            keys = np.concatenate((best, _keys(scores(packed[first:last], sums), first)), axis=1)
                            best = np.partition(keys, keys.shape[1] - most - 1, axis=1)[:, -most - 1 :]
                        kept = best > LEAST
                        place = -best & (1 << 20) - 1
                        value = best + place >> 20
                        which, slot = np.nonzero(kept)
                        rows, a = place[which, slot], some[which]
                        same = (ids[rows] == aid[a]) & (packed[rows] == bits[a]).all(axis=(1, 2))
                        out.append((key[a], value[which, slot], ids[rows], same))
                if out:
                    columns = [np.concatenate(c) for c in zip(*out)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "score", "id", "own"])

    return index.mapInArrow(run, "key long, score long, id long, own boolean")


def _positives(found: DataFrame, most: int) -> DataFrame:
    """(key, positives): the first ``most`` other rows of the anchor's label. One row
    that equals the anchor is the anchor itself and goes."""
    order = [F.col("score").desc(), F.col("id")]
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*order, F.col("own").desc())))
    best = best.where(F.col("n") <= most + 1)
    itself = F.col("own") & (F.row_number().over(Window.partitionBy("key", "own").orderBy("n")) == 1)
    best = best.withColumn("itself", itself).where(~F.col("itself"))
    best = best.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("n"))).where(F.col("n") <= most)
    return best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("positives"))


# -- negatives --------------------------------------------------------------------


def _top_negatives(index: DataFrame, paths: list[str], d: int, planes: int, most: int, low: int, high: int) -> DataFrame:
    """Of every block, the ``most`` best rows of other labels whose score lies between
    ``low`` and ``high`` percent of a positive's, for each anchor and positive."""
    groups = -(-d // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, packed in _blocks(batches, planes, groups):
            order = np.argsort(ids, kind="stable")  # ties go by id, whatever the label
            ids, labels, packed = ids[order], labels[order], packed[order]
            for path in paths:
                anchors = _read_anchors(path)
                key, aid, alabel = (anchors.column(i).to_numpy() for i in range(3))
                q = _matrix(anchors.column(3), d)
                n_pos = anchors.column(4).value_lengths().to_numpy(zero_copy_only=False)
                width = int(n_pos.max(initial=0))
                pid, value = (_matrix(anchors.column(i), width) for i in (4, 5))
                # floor and ceiling of the bounds on a negative's score
                top, bottom = value * high // 100, -(-value * low // 100)
                out: list[tuple] = []
                for at in range(0, len(key), ANCHORS_AT_ONCE):
                    some = np.arange(at, min(len(key), at + ANCHORS_AT_ONCE))
                    sums = narrowed(subset_sums(q[some]), planes)
                    limit = top[some] << 20  # place 0 has the largest key of a score
                    best = np.full((len(some), width, most), LEAST)
                    for first in range(0, len(ids), ROWS_AT_ONCE):
                        last = min(len(ids), first + ROWS_AT_ONCE)
                        keys = _keys(scores(packed[first:last], sums), first)
                        keys[labels[None, first:last] == alabel[some, None]] = LEAST
                        keys.sort(axis=1)
                        for k in range(len(some)):
                            under = np.searchsorted(keys[k], limit[k], "right")
                            for j in range(n_pos[some[k]]):
                                new = keys[k, max(0, under[j] - most) : under[j]]
                                if len(new) and new[-1] > best[k, j, 0]:
                                    best[k, j] = np.sort(np.concatenate((best[k, j], new)))[-most:]
                    place = -best & (1 << 20) - 1
                    score = best + place >> 20
                    kept = (best > LEAST) & (score >= bottom[some][:, :, None]) & (np.arange(width)[None, :, None] < n_pos[some][:, None, None])
                    a, j, s = np.nonzero(kept)
                    row = some[a]
                    out.append((key[row], aid[row], j, pid[row, j], value[row, j], score[a, j, s], ids[place[a, j, s]]))
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["key", "anchor_id", "slot", "positive_id", "positive_score", "negative_score", "negative_id"]
    return index.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def mine(
    rows: DataFrame,
    anchors_where: str = "vec_id % 50 = 0",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``): for every anchor (a row for which the SQL condition
    ``anchors_where`` holds) and each of its first ``positives`` other rows of the same
    label, the first ``negatives`` rows of other labels whose score is from ``low`` to
    ``high`` percent of the positive's. Higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component, take
    no part. Repeated rows count each for itself: a copy of an anchor is another row,
    and a repeated anchor is answered each time. Vectors of unequal length are compared
    as if the shorter one ended in zeros; an empty one scores 0. Fewer rows than asked
    for are all returned, an empty table gives none. Other columns are not looked at. A
    score beyond 40 bits is an error."""
    spark = rows.sparkSession
    part = cut_lineage(_quantised(rows, anchors_where, id_col, vector_col, label_col), "quantised")
    size = part.agg(F.max(F.size("q")).alias("d"), F.max(F.array_max("q")).alias("top"), F.min(F.array_min("q")).alias("bottom")).first()
    d = max(1, size["d"] or 0)
    planes = 1 + max((size["top"] or 0).bit_length(), (~min(0, size["bottom"] or 0)).bit_length())  # with the sign
    index = _index(part.select("id", "label", "q"), d, planes)
    anchors = cut_lineage(part.where("asked").select(F.monotonically_increasing_id().alias("key"), "id", "label", "q"), "anchors")
    folder = shared_folder(spark, "anchors")
    found = _top_positives(index, _write_anchors(anchors, folder), d, planes, positives)
    best = _positives(found, positives)
    asked = anchors.join(best, "key").select(
        "key", "id", "label", "q", F.transform("positives", lambda p: p["id"]).alias("pid"), F.transform("positives", lambda p: p["score"]).alias("pscore")
    )
    paths = _write_anchors(asked, folder)
    found = _top_negatives(index, paths, d, planes, negatives, low, high)
    rank = F.row_number().over(Window.partitionBy("key", "slot").orderBy(F.col("negative_score").desc(), "negative_id"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


# Scores in SQL: products of whole numbers in doubles, exact below 2^53.
ORACLE = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
  FROM part a JOIN part c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
