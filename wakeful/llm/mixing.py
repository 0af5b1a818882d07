"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern
(the set of sources); tokens flow from patterns to the sources' quotas, the k-th copy
of a pattern's tokens costing k - 1, so nothing is repeated while fresh tokens can
still reach an open quota. The network has one node per pattern and source, not per
document, and is solved on the driver (at most ``max_patterns`` patterns). What the
flow takes of a pattern is whole copies of it and a rest; the rest is filled with
documents in the order of a seeded hash, going on past those that do not fit, and
then by the one nearest in size to what is still open.
Selection is distributed: sizes are summed per hash bucket, so no source, however
large, is sorted in one task. Up to the first document that does not fit only one
bucket is looked at row by row; from there on every step takes at least half of what
is open, so there are at most log2(open) + 1 of them.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, replace
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage, text_of, word_count

SEED = 17
DRAW_BITS, BUCKET_BITS = 52, 12


# -- quotas -----------------------------------------------------------------------


def weighted_quotas(sizes: dict, weights: tuple[int, ...] = (5, 2, 1), share: Fraction = Fraction(3, 2), most: int = 2) -> dict:
    """Targets of the sources: ``share`` of all sizes split by the repeating weights
    (sources by code point, null last), none above ``most`` times its source's size;
    the excess is shared again by weight among the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_weight = share * sum(sizes.values()), sum(weight.values())
    target: dict = {}
    # a source is full at a lower level the smaller its size to weight
    for s in sorted(names, key=lambda s: Fraction(most * sizes[s], weight[s])):
        if most * sizes[s] * open_weight > weight[s] * left:
            break
        target[s] = float(most * sizes[s])
        left, open_weight = left - most * sizes[s], open_weight - weight[s]
    return {s: target[s] if s in target else float(weight[s] * left / open_weight) for s in names}


# -- the flow ---------------------------------------------------------------------


@dataclass
class Arc:
    to: int
    free: int
    back: int  # position of the reverse arc


class Network:
    """Maximum flow by shortest augmenting paths in layers."""

    def __init__(self, nodes: int):
        self.arcs: list[list[Arc]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int) -> Arc:
        arc = Arc(b, capacity, len(self.arcs[b]))
        self.arcs[b].append(Arc(a, 0, len(self.arcs[a])))
        self.arcs[a].append(arc)
        return arc

    def _layers(self, source: int, sink: int) -> list[int] | None:
        layer = [-1] * len(self.arcs)
        layer[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for arc in self.arcs[a]:
                if arc.free and layer[arc.to] < 0:
                    layer[arc.to] = layer[a] + 1
                    queue.append(arc.to)
        return layer if layer[sink] >= 0 else None

    def augment(self, source: int, sink: int) -> None:
        while (layer := self._layers(source, sink)) is not None:
            at = [0] * len(self.arcs)
            path: list[tuple[int, Arc]] = []
            node = source
            while True:
                if node == sink:
                    pushed = min(arc.free for _, arc in path)
                    for _, arc in path:
                        arc.free -= pushed
                        self.arcs[arc.to][arc.back].free += pushed
                    k = next(i for i, (_, arc) in enumerate(path) if not arc.free)
                    node, path = path[k][0], path[:k]
                elif at[node] < len(self.arcs[node]):
                    arc = self.arcs[node][at[node]]
                    if arc.free and layer[arc.to] == layer[node] + 1:
                        path.append((node, arc))
                        node = arc.to
                    else:
                        at[node] += 1
                elif path:
                    node, _ = path.pop()
                    at[node] += 1
                else:
                    break


def route(tokens: dict[str, int], members: dict[str, list], quotas: dict, copies: int = 2) -> dict[str, int]:
    """Tokens taken of each pattern by a min-cost flow into the quotas.

    Only the supply arcs cost something (k - 1 for copy k), so augmenting paths come
    in the order of the copies: opening copy 1 of every pattern, augmenting as far as
    it goes, then copy 2 and so on is the successive-shortest-path method."""
    patterns, sources = list(tokens), list(quotas)
    node = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    sink = 1 + len(patterns) + len(sources)
    net = Network(sink + 1)
    supply = [net.add(0, 1 + i, 0) for i in range(len(patterns))]
    for i, p in enumerate(patterns):
        for s in members[p]:
            if s in node:
                net.add(1 + i, node[s], copies * tokens[p])
    for s in sources:
        net.add(node[s], sink, int(quotas[s] + 0.5))
    for _ in range(copies):
        for p, arc in zip(patterns, supply):
            arc.free += tokens[p]
        net.augment(0, sink)
    return {p: copies * tokens[p] - arc.free for p, arc in zip(patterns, supply)}


# -- selection --------------------------------------------------------------------


def draw(id_col: str | Column, seed: int = SEED) -> Column:
    """52 bits of a seeded hash of the id: the order in which documents are taken."""
    named = F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, DRAW_BITS // 4), 16, 10).cast("long")


def pattern_key(sources: Column) -> Column:
    """Membership pattern as text: the sorted distinct sources."""
    return F.to_json(F.sort_array(F.array_distinct(sources)))


@dataclass
class Mix:
    rows: DataFrame  # doc_id, size, pattern, u, copies
    sizes: dict  # source -> words of its documents
    targets: dict  # source -> target
    members: dict  # pattern -> its sources


def mix(
    docs: DataFrame,
    sources: Column,
    quotas: Callable[[dict], dict] = weighted_quotas,
    id_col: str = "doc_id",
    size: Column | None = None,
    copies: int = 2,
    seed: int = SEED,
    max_patterns: int = 100_000,
) -> Mix:
    """How often each document is taken: ``copies`` per row, from 0 to ``copies``.

    ``sources`` is an array column: the sources of a row (a null source is a source
    of its own; a null or empty array belongs to none and is never taken). ``quotas``
    maps the sources' sizes to targets. ``size`` defaults to the number of words of
    ``text`` (null: 0). Of a pattern's rest, documents are taken in the order of the
    seeded hash, each that fits into what is still open, until none does; then the
    one whose size is nearest to what is still open, where taking it brings the source
    nearer to its target (ties: the smaller, then the earlier in hash order). Rows of
    equal id are taken together. Empty tables give no rows. More than ``max_patterns``
    patterns is an error, as the network is held on the driver.
    """
    key = pattern_key(F.coalesce(sources, F.array().cast("array<string>")))
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (word_count("text") if size is None else size).cast("long").alias("size"),
            key.alias("pattern"),
            draw(id_col, seed).alias("u"),
        ),
        "mix",
    )
    cells = cut_lineage(
        rows.groupBy("pattern", F.shiftright("u", DRAW_BITS - BUCKET_BITS).alias("bucket")).agg(F.sum("size").alias("size")),
        "mix-cells",
    )
    found = cells.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    tokens = {r["pattern"]: r["size"] for r in found}
    members = {p: json.loads(p) for p in tokens}
    sizes: dict = {}
    for p, n in tokens.items():
        for s in members[p]:
            sizes[s] = sizes.get(s, 0) + n
    targets = quotas(sizes)
    flow = route(tokens, members, targets, copies)
    plan = {p: (f // tokens[p], f % tokens[p]) if tokens[p] else (0, 0) for p, f in flow.items()}
    return Mix(_taken(rows, cells, plan), sizes, targets, members)


def _small(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A table of at most a row per pattern."""
    return F.broadcast(like.sparkSession.createDataFrame(rows, schema))


@dataclass
class Ending:
    """Which documents fill the rest of a pattern: all up to ``bound`` in the order of
    the hash, the picks, and of each step (limit, upto) those of a size up to limit
    and a hash up to upto."""

    bound: int
    left: int  # words still open, negative if too many are taken
    picks: tuple[int, ...] = ()
    steps: tuple[tuple[int, int], ...] = ()


def _endings(like: DataFrame, ends: dict[str, Ending], full: dict[str, int] | None = None) -> DataFrame:
    return _small(
        like,
        [(p, e.bound, e.left, list(e.picks), list(e.steps), (full or {}).get(p, 0)) for p, e in ends.items()],
        "pattern string, bound long, open long, picks array<long>, steps array<struct<limit: long, upto: long>>, full int",
    )


def _in_steps() -> Column:
    return F.exists("steps", lambda s: (F.col("size") <= s["limit"]) & (F.col("u") <= s["upto"]))


def _untaken(rows: DataFrame, ends: dict[str, Ending]) -> DataFrame:
    """Documents behind the bound that may still be taken, rows of equal id as one."""
    return cut_lineage(
        rows.join(_endings(rows, {p: e for p, e in ends.items() if e.left > 0}), "pattern")
        .where("u > bound")
        .groupBy("pattern", "u", "open")
        .agg(F.sum("size").alias("size"))
        .where("size > 0 and size < 2 * open")
        .select("pattern", "u", "size", F.shiftright("u", DRAW_BITS - BUCKET_BITS).alias("bucket")),
        "mix-untaken",
    )


def _nearest(groups: DataFrame, ends: dict[str, Ending]) -> dict[str, Ending]:
    """The untaken document whose size is nearest to what is open is taken, where that
    leaves less open or too much."""
    state = {p: e for p, e in ends.items() if e.left > 0}
    if not state:
        return ends
    best = (
        groups.join(_endings(groups, state), "pattern")
        .where("size < 2 * open and not array_contains(picks, u)")
        .where(~_in_steps())
        .groupBy("pattern")
        .agg(F.min(F.struct(F.abs(F.col("open") - F.col("size")).alias("off"), "size", "u")).alias("pick"))
        .collect()
    )
    return ends | {
        r["pattern"]: replace(
            ends[r["pattern"]], left=ends[r["pattern"]].left - r["pick"]["size"], picks=(*ends[r["pattern"]].picks, r["pick"]["u"])
        )
        for r in best
    }


def _filled(groups: DataFrame, ends: dict[str, Ending]) -> dict[str, Ending]:
    """Every document that fits, in the order of the hash, until none does.

    Documents of at most half of what is open all fit until they have taken half of
    it; the larger ones fit where their size is left. A step ends where either event
    comes first: the small documents up to it are taken and, if it is a large one,
    that. At least half of what was open is then gone, and every document passed over
    is larger than what is left."""
    ends = dict(ends)
    last = {p: e.bound for p, e in ends.items() if e.left > 0}
    while last:
        at = _small(groups, [(p, u, ends[p].left) for p, u in last.items()], "pattern string, last long, open long")
        fitting = groups.join(at, "pattern").where("u > last and size <= open")
        small = F.when(2 * F.col("size") <= F.col("open"), F.col("size")).otherwise(0)
        # sums of whole buckets (at most 2 ** BUCKET_BITS a pattern), then within each
        cells = fitting.groupBy("pattern", "bucket").agg(F.sum(small).alias("small"))
        upto = F.sum("small").over(Window.partitionBy("pattern").orderBy("bucket"))
        cells = cells.select("pattern", "bucket", (upto - F.col("small")).alias("before"))
        inside = F.sum(small).over(Window.partitionBy("pattern", "bucket").orderBy("u"))
        event = (small > 0) & (2 * F.col("taken") > F.col("open")) | (small == 0) & (F.col("taken") + F.col("size") <= F.col("open"))
        found = (
            fitting.withColumn("inside", inside)
            .join(cells, ["pattern", "bucket"])
            .withColumn("taken", F.col("before") + F.col("inside"))
            .groupBy("pattern")
            .agg(
                F.min(F.when(event, F.struct("u", "size", "taken", (small == 0).alias("large")))).alias("event"),
                F.max("taken").alias("all"),
            )
            .collect()
        )
        state = {r["pattern"]: r for r in found}
        for p in list(last):
            e, r = ends[p], state.get(p)
            if r is None:  # none fits
                del last[p]
                continue
            stop = r["event"]
            step = (e.left // 2, (1 << DRAW_BITS) - 1 if stop is None else stop["u"])
            taken, picks = (r["all"], e.picks) if stop is None else (stop["taken"], e.picks)
            if stop is not None and stop["large"]:
                taken, picks = taken + stop["size"], (*picks, stop["u"])
            ends[p] = replace(e, left=e.left - taken, picks=picks, steps=(*e.steps, step))
            if stop is None or not ends[p].left:
                del last[p]
            else:
                last[p] = stop["u"]
    return ends


def _taken(rows: DataFrame, cells: DataFrame, plan: dict[str, tuple[int, int]]) -> DataFrame:
    rests = _small(rows, [(p, rest) for p, (_, rest) in plan.items()], "pattern string, rest long")
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("bucket"))
    crossed = (
        cells.select("pattern", "bucket", upto.alias("upto"), (upto - F.col("size")).alias("before"))
        .join(rests, "pattern")
        .where("before <= rest and rest < upto")
        .select("pattern", "bucket", "before", "rest")
        .collect()
    )
    bound = {p: -1 for p in plan}
    left = {p: rest for p, (_, rest) in plan.items()}
    for r in crossed:
        bound[r["pattern"]] = (r["bucket"] << (DRAW_BITS - BUCKET_BITS)) - 1
        left[r["pattern"]] = r["rest"] - r["before"]
    inside = _small(rows, [(r["pattern"], r["bucket"], left[r["pattern"]]) for r in crossed], "pattern string, bucket long, open long")
    running = F.sum("size").over(Window.partitionBy("pattern").orderBy("u"))  # equal u: together
    ends = (
        rows.withColumn("bucket", F.shiftright("u", DRAW_BITS - BUCKET_BITS))
        .join(inside, ["pattern", "bucket"])
        .select("pattern", "u", "open", running.alias("upto"))
        .where("upto <= open")
        .groupBy("pattern")
        .agg(F.max("u").alias("u"), F.max("upto").alias("size"))
        .collect()
    )
    for r in ends:
        bound[r["pattern"]] = r["u"]
        left[r["pattern"]] -= r["size"]
    start = {p: Ending(bound[p], left[p]) for p in plan}
    groups = _untaken(rows, start)
    chosen = _nearest(groups, _filled(groups, start))
    extra = (F.col("u") <= F.col("bound")) | F.array_contains("picks", F.col("u"))
    stepped = {p: e for p, e in chosen.items() if e.steps}
    if stepped:
        filled = (
            groups.join(_endings(groups, stepped), "pattern")
            .where(_in_steps())
            .select("pattern", "u", F.lit(True).alias("filled"))
        )
        rows = rows.join(filled, ["pattern", "u"], "left")
        extra = extra | F.coalesce("filled", F.lit(False))
    state = _endings(rows, chosen, {p: full for p, (full, _) in plan.items()})
    return rows.join(state, "pattern", "left").select(
        "doc_id", "size", "pattern", "u", F.coalesce(F.col("full") + extra.cast("int"), F.lit(0)).alias("copies")
    )


def apply_mix(docs: DataFrame, taken: Mix, sources: Column, id_col: str = "doc_id") -> DataFrame:
    """``docs`` as the mix takes them: rows with no copy go, others are repeated by
    their number of copies; columns as given."""
    wanted = taken.rows.where("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("pattern").alias("_pattern"), F.sequence(F.lit(1), "copies").alias("_copies")
    )
    wanted = wanted.distinct().select("_id", "_pattern", F.explode("_copies").alias("_copy"))
    key = pattern_key(F.coalesce(sources, F.array().cast("array<string>")))
    same = docs[id_col].eqNullSafe(wanted["_id"]) & (key == wanted["_pattern"])
    return docs.join(wanted, same).select(*[docs[f"`{c}`"] for c in docs.columns])


def per_source(taken: Mix) -> DataFrame:
    """``rows`` of a mix of single-source documents with their source's size and
    target."""
    table = _small(
        taken.rows,
        [(p, taken.sizes[of[0]], taken.targets[of[0]]) for p, of in taken.members.items() if len(of) == 1],
        "_key string, source_size long, target double",
    )
    return taken.rows.join(table, F.col("pattern") == F.col("_key"), "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS s, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source
), a AS (
  SELECT *, sum(s) OVER ()::BIGINT AS total, sum(w) OVER ()::BIGINT AS weight,
    (coalesce(sum(2 * s) OVER o, 0))::BIGINT AS caps_before, (coalesce(sum(w) OVER o, 0))::BIGINT AS w_before
  FROM s WINDOW o AS (ORDER BY s * 10 // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, 4 * s * (weight - w_before) <= w * (3 * total - 2 * caps_before) AS capped FROM a
), e AS (
  SELECT *, coalesce(sum(2 * s) FILTER (WHERE capped) OVER (), 0)::BIGINT AS caps,
    coalesce(sum(w) FILTER (WHERE capped) OVER (), 0)::BIGINT AS wcap FROM c
), t AS (
  SELECT source, s AS source_size,
    CASE WHEN capped THEN (2 * s)::DOUBLE ELSE (w * (3 * total - 2 * caps))::DOUBLE / (2 * (weight - wcap))::DOUBLE END AS target
  FROM e
), q AS (
  SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t
), p AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size END AS whole,
    CASE WHEN source_size = 0 THEN 0 ELSE quota % source_size END AS rest FROM q
), r AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u) AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), r0 AS (
  SELECT *, upto <= rest AS prefix FROM r
), r1 AS (
  SELECT *, rest - coalesce(sum(size) FILTER (WHERE prefix) OVER (PARTITION BY source), 0) AS open1 FROM r0
), g AS (
  SELECT source, u, sum(size)::BIGINT AS size, any_value(open1) AS open1 FROM r1 WHERE NOT prefix AND size > 0 GROUP BY source, u
), f AS (
  SELECT DISTINCT source, (-1)::BIGINT AS u, open1 AS open FROM r1 WHERE open1 > 0
  UNION ALL
  SELECT f.source, min(g.u), f.open - arg_min(g.size, g.u)
  FROM f JOIN g ON f.source IS NOT DISTINCT FROM g.source AND g.u > f.u AND g.size <= f.open
  GROUP BY f.source, f.u, f.open
), e2 AS (
  SELECT source, min(open) AS open2 FROM f GROUP BY source
), n AS (
  SELECT g.source, min({{'off': abs(open2 - size), 'size': size, 'u': g.u}}).u AS u
  FROM g JOIN e2 ON g.source IS NOT DISTINCT FROM e2.source
  WHERE size < 2 * open2 AND NOT EXISTS (SELECT 1 FROM f WHERE f.source IS NOT DISTINCT FROM g.source AND f.u = g.u)
  GROUP BY g.source
), extra AS (
  SELECT source, u FROM f WHERE u >= 0 UNION SELECT source, u FROM n
)
SELECT r1.doc_id, r1.size, r1.source_size, r1.target,
  (r1.size * (r1.whole + CASE WHEN r1.prefix OR extra.u IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r1 LEFT JOIN extra ON r1.source IS NOT DISTINCT FROM extra.source AND r1.u = extra.u
"""
