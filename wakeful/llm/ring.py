"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, DataFrame
functions only.

The ring has 65,536 cells; every shard owns 128 of them as virtual nodes, and a key
belongs to the next virtual node clockwise of its cell. No shard takes more than its
bound of rows: keys that overflow a full shard go on clockwise to the next virtual
node of a shard with room. With no slack the bounds add up to the number of rows, so
all shards are exactly full: counts differ by one at most, whatever the keys.

Only the rows per cell (a fixed number of counts) reach the driver, where the overflow
is settled for runs of keys at once; rows then find their run by their rank on the
ring. Ranks come from a range partitioning in ring order, which parts even rows of one
key: a rank is the number of rows in earlier ranges and the place within the range, so
a key, cell, shard or source of any size is spread over many tasks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage, text_of

CELL_BITS = 16
CELLS = 1 << CELL_BITS
VIRTUAL_NODES = 128


def virtual_nodes(shards: int, each: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes in ring order. A node's cell is a hash of
    shard and replica; a taken cell passes it on to the next. Shards are placed in
    order, so one more shard moves no earlier node."""
    if shards * each > CELLS:
        raise ValueError(f"{shards} shards x {each} virtual nodes exceed {CELLS} cells")
    owner: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(each):
            cell = int(hashlib.md5(f"{shard}:{replica}".encode()).hexdigest()[:8], 16) % CELLS
            while cell in owner:
                cell = (cell + 1) % CELLS
            owner[cell] = shard
    return sorted(owner.items())


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard: an equal share, or ``1 + slack`` times it."""
    if slack:
        return [int((1 + slack) * rows / shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


@dataclass(frozen=True)
class Run:
    """Keys of a cell with ranks from ``low`` up to ``high`` lie in ``shard`` from slot
    ``slot`` on."""

    cell: int
    low: int
    high: int
    shard: int
    slot: int


def settle(counts: dict[int, int], shards: int, each: int = VIRTUAL_NODES, slack: float = 0.0) -> list[Run]:
    """Place the keys of all cells. Shards first take keys of their own arcs, then
    those that overflow by one virtual node, and so on clockwise; within an arc, keys
    stay in ring order."""
    nodes = virtual_nodes(shards, each)
    free = bounds(sum(counts.values()), shards, slack)
    arcs: list[list[int]] = [[] for _ in nodes]  # cells of each arc, clockwise
    at = 0
    for cell in range(CELLS):
        if at < len(nodes) and cell > nodes[at][0]:
            at += 1
        if counts.get(cell):
            arcs[at % len(nodes)].append(cell)
    last = nodes[-1][0]
    arcs[0].sort(key=lambda c: (c <= last, c))  # cells behind the last node come first
    left = [sum(counts[c] for c in arc) for arc in arcs]
    placed: list[list[tuple[int, int]]] = [[] for _ in nodes]  # (shard, rows) by arc
    open_, hop = [j for j in range(len(nodes)) if left[j]], 0
    while open_:
        for j in open_:
            shard = nodes[(j + hop) % len(nodes)][1]
            n = min(left[j], free[shard])
            if n:
                placed[j].append((shard, n))
                left[j] -= n
                free[shard] -= n
        open_, hop = [j for j in open_ if left[j]], hop + 1
    runs: list[Run] = []
    slots = [0] * shards
    for arc, parts in zip(arcs, placed):
        cells = iter(arc)
        cell, low = next(cells, None), 0
        for shard, n in parts:
            while n:
                if low == counts[cell]:
                    cell, low = next(cells), 0
                take = min(n, counts[cell] - low)
                runs.append(Run(cell, low, low + take, shard, slots[shard]))
                slots[shard] += take
                low, n = low + take, n - take
    return runs


def position(id_col: str, text: Column) -> Column:
    """A key's place on the ring: a hash of the id (of the text where the id is
    null)."""
    return F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(id_col))


def assign_shards(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", each: int = VIRTUAL_NODES, slack: float = 0.0
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``size`` (UTF-8 bytes of the text, null
    none, plus 8), ``text_crc32``, ``shard``, ``slot`` (from 0 without gaps within the
    shard).

    The law is that of row counts. Null ids are placed by their text; rows with equal
    ids share a cell and are ranked by text and size; rows equal in all of that are
    interchangeable. Empty tables give no rows; other columns are not looked at.
    """
    text = text_of(text_col)
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            position(id_col, text).alias("h"),
            F.monotonically_increasing_id().alias("rid"),
        ).withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int")),
        "ring",
    )
    spark = rows.sparkSession
    counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # at most 65,536
    before, start = 0, {}
    for cell in sorted(counts):
        start[cell] = before
        before += counts[cell]
    runs = [(r.cell, start[r.cell] + r.low, start[r.cell] + r.high, r.shard, r.slot) for r in settle(counts, shards, each, slack)]
    table = spark.createDataFrame(runs, "cell int, low long, high long, shard int, first long")
    order = ["cell", "h", "doc_id", "text_crc32", "size", "rid"]
    ranged = cut_lineage(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ring-ranges")
    before, ranges = 0, []
    for r in sorted(ranged.groupBy("part").count().collect()):  # a row per range
        ranges.append((r["part"], before))
        before += r["count"]
    ranges = F.broadcast(spark.createDataFrame(ranges, "part int, before long"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    ranked = ranged.withColumn("place", place).join(ranges, "part").withColumn("rank", F.col("before") + F.col("place"))
    # at most a run per cell, arc and overflow: bounded by the ring, not by the rows
    found = ranked.join(
        F.broadcast(table), (ranked["cell"] == table["cell"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    )
    return found.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - F.col("low")).cast("long").alias("slot")
    )
