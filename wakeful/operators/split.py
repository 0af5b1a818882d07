"""Group-aware splits (M1, M2) and a distributed global rank.

No split looks at rows one by one on the driver: users are ordered by a hash or
by size with distributed selection / ranking, and the assignment is joined back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeful.session import cut_lineage


def user_hash(by: str, seed: int):
    """Seeded pseudo-random order of users: the first 13 hex digits of
    md5('<seed>:<id>') (52 bits, exact as a double)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(by).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


HASH_BITS, BUCKET_BITS = 52, 12


def group_split(df: DataFrame, by: str = "user_id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """M1: users (not rows) to train/test; test = the ceil(test_size * users) users
    that come first by (seeded hash, id). Users are counted per hash bucket (at most
    4,096 counts reach the driver); only the bucket in which the test set ends is
    ranked, so no task sorts all users. Returns (by, split)."""
    users = cut_lineage(df.select(by).distinct().withColumn("_h", user_hash(by, seed)), "users")
    bucket = F.shiftright("_h", HASH_BITS - BUCKET_BITS)
    counts = users.groupBy(bucket.alias("b")).count().orderBy("b").collect()
    k = math.ceil(test_size * sum(r["count"] for r in counts))
    last, room = -1, 0  # buckets before ``last`` are test, ``room`` users of it are
    for r in counts:
        if k <= 0:
            break
        last, room = r["b"], min(k, r["count"])
        k -= r["count"]
    ranked = users.where(bucket == last).withColumn("_b", bucket)
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", by))
    inside = ranked.select(by, F.when(rank <= room, "test").otherwise("train").alias("split"))
    others = users.where(bucket != last).select(by, F.when(bucket < last, "test").otherwise("train").alias("split"))
    return others.unionByName(inside)


def stratified_sample(df: DataFrame, stratum: str, key: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Exactly ceil(share * n) rows of every stratum of n rows: those that come first by a
    seeded hash of their key (ties by the key). Rows are counted per (stratum, hash
    bucket); whole buckets are taken, and only the bucket in which a stratum's sample ends
    is ranked, so a stratum that holds a third of all rows is spread over its buckets.
    Null strata are a stratum. Rows equal in stratum and key are told apart by no rule, so
    pass a key that is unique."""
    name = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    h = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    x = df.withColumn("_h", h).withColumn("_b", F.shiftright("_h", HASH_BITS - BUCKET_BITS)).withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit("\0")))
    counts = x.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_s").orderBy("_b")  # at most 4,096 buckets in a stratum
    all_ = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n")).withColumn("_want", F.ceil(F.sum("_n").over(all_) * F.lit(share)))
    room = counts.select("_s", "_b", F.greatest(F.lit(0), F.least("_n", F.col("_want") - F.col("_before"))).cast("long").alias("_room"), "_n").where("_room > 0")
    x = x.join(room, ["_s", "_b"])
    whole, ends = x.where("_room = _n"), x.where("_room < _n")
    rank = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", *key))
    ends = ends.withColumn("_rank", rank).where("_rank <= _room")
    return whole.select(*df.columns).unionByName(ends.select(*df.columns))


def global_rank(df: DataFrame, order_cols: Sequence, name: str = "rank") -> DataFrame:
    """0-based position of each row in a total order, computed without a
    single-partition window: range-partitioned sort, materialised (so partition
    ids are stable), per-partition counts -> offsets (one row per partition),
    plus the row's index inside its partition."""
    sorted_ = df.orderBy(*order_cols).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")
    )
    sorted_ = cut_lineage(sorted_)
    counts = sorted_.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over this table is bounded by the partition count
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return sorted_.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + pos).cast("long").alias(name)
    )


def _dealt(loads: list[int], size: int, count: int) -> tuple[list[tuple[int, list[int]]], list[int]]:
    """``count`` groups of one ``size`` dealt one by one to the lightest fold (of equally
    light ones the first): (from which group on, the folds that take turns) and the loads
    afterwards.

    Fold f takes its j-th group at load L_f + j size, so the deal is the merge of these
    rows by (load, fold): level by level of whole sizes, in the order of the remainders.
    A fold joins in at its own level, so there are at most as many turns as folds."""
    order = sorted(range(len(loads)), key=lambda f: (loads[f] % size, f))
    level = [x // size for x in loads]
    turns, at, now = [], 0, min(level)
    loads = list(loads)
    while at < count:
        active = [f for f in order if level[f] <= now]
        later = [x for x in level if x > now]
        rounds = min(later) - now if later else None
        n = count - at if rounds is None else min(count - at, rounds * len(active))
        turns.append((at, active))
        for k, f in enumerate(active):
            loads[f] += size * (n // len(active) + (k < n % len(active)))
        at += n
        now = min(later) if later else now
    return turns, loads


def group_kfold(df: DataFrame, n_splits: int = 5, by: str = "user_id") -> DataFrame:
    """M2: no user in two folds; users ordered by size (largest first, then id) go one by
    one to the fold with the fewest rows. Returns (by, fold).

    The greedy runs over distinct sizes, not users: the driver sees (size, number of
    users), of which there are at most sqrt(2 rows), and tells for each size whose turn it
    is from which user on; users look their fold up by their rank within the size."""
    spark = df.sparkSession
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = cut_lineage(global_rank(sizes, [F.col("_cnt").desc(), F.col(by).asc()], "_r"), "ranked")
    runs = ranked.groupBy("_cnt").agg(F.count(F.lit(1)).alias("n"), F.min("_r").alias("first")).orderBy(F.desc("_cnt")).collect()
    loads, rows = [0] * n_splits, []
    for r in runs:
        turns, loads = _dealt(loads, r["_cnt"], r["n"])
        rows.append((r["_cnt"], r["first"], turns))
    table = spark.createDataFrame(rows, "_cnt long, _first long, _turns array<struct<since: long, folds: array<int>>>")
    x = ranked.join(F.broadcast(table) if len(rows) <= MOST_SIZES else table, "_cnt").withColumn("_k", F.col("_r") - F.col("_first"))
    turn = F.element_at(F.filter("_turns", lambda t: t["since"] <= F.col("_k")), -1)
    x = x.withColumn("_t", turn)
    return x.select(by, F.get(F.col("_t.folds"), ((F.col("_k") - F.col("_t.since")) % F.size("_t.folds")).cast("int")).alias("fold"))


MOST_SIZES = 10_000  # distinct group sizes whose table is broadcast


def row_kfold(df: DataFrame, n_splits: int, key: Sequence[str]) -> DataFrame:
    """Fallback without user ids: folds by a hash of the row key."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*key), F.lit(n_splits)).cast("int"))
