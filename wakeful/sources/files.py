"""Scans, sinks and dataset metadata."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import csv as pacsv
from pyarrow import fs

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wakeful.functions.scalar import extract_id
from wakeful.session import cut_lineage


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = True, limit: int | None = None
) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass), optional row limit."""
    df = spark.read.csv(path, schema=schema, sep=sep, header=header, mode="PERMISSIVE")
    return df.limit(limit) if limit else df


CORRUPT = "_corrupt"


def read_csv_checked(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with bad rows kept apart: (rows, rejects), both with their ``file``. A line with
    too few or too many cells, or with a cell that isn't of its column's type, is a reject
    (file, line), the line as it stands. With ``header``, a file's first line must name the
    schema's columns, in any letter case; where it doesn't, the columns can't be trusted
    and all lines of the file are rejects. Files are split as usual; the headers come from
    one more scan of the files' first blocks."""
    names = [f.name for f in StructType.fromDDL(schema).fields]
    read = spark.read.csv(path, schema=f"{schema}, {CORRUPT} string", sep=sep, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    rows = read.withColumn("file", F.col("_metadata.file_name"))
    good = F.col(CORRUPT).isNull()
    if header:
        first = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
        first = first.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("first"))
        fits = F.upper(F.regexp_replace("first", '["\\s]', "")) == F.lit(sep.join(names).upper())
        rows = rows.join(first.select("file", fits.alias("_fits")), "file")
        good = good & F.col("_fits")
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *[F.col(f"`{c}`").cast("string") for c in names]))
    # parsed once; both results are read from what is written
    parsed = cut_lineage(rows.select("file", *names, F.when(~good, line).alias(CORRUPT)), "csv")
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), parsed.where(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("line"))


def read_parquet(spark: SparkSession, path: str, limit: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """Parquet scan; a limit is pushed into the scan. With ``order_by`` the first
    rows are deterministic (TakeOrdered) rather than whichever arrive first."""
    df = spark.read.parquet(path)
    if limit:
        df = (df.orderBy(*order_by) if order_by else df).limit(limit)
    return df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """S3: Parquet sink. Keys travel as columns (no row positions)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def discover_users(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = "HR_*.csv") -> DataFrame:
    """S4 + U3: distinct user ids taken from file names (``HR_<digits>.csv``), or,
    with ``pattern=None``, from ``user_id=<digits>`` folders of a partitioned table.

    Reads the files' listing only: their content column is never selected, so empty
    files count and large ones cost nothing."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths if isinstance(paths, str) else list(paths)).select("path")
    if pattern is None:
        uid = F.regexp_extract("path", r"user_id=(\d+)", 1)
    else:
        uid = extract_id(F.regexp_extract("path", r"([^/]+)$", 1), pattern)
    ids = df.select(uid.alias("user_id")).where(F.col("user_id") != "")
    return ids.distinct()


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    base = re.sub(r"^file:/(?!/)", "file:///", folder)
    return fs.FileSystem.from_uri(base) if "://" in base else (fs.LocalFileSystem(), base)


def _range_lines(f, start: int, stop: int) -> list[bytes]:
    """The lines of a file that begin in [start, stop), the last one read to its end."""
    f.seek(max(start - 1, 0))
    data = f.read(stop - max(start - 1, 0))
    if start:  # what comes before the first line end belongs to the range before
        data = data[(data.find(b"\n") + 1) or len(data):]
    if data and not data.endswith(b"\n"):
        parts = [data]
        while (more := f.read(65_536)) and b"\n" not in more:
            parts.append(more)
        data = b"".join([*parts, more[: more.find(b"\n") + 1]])
    return data.splitlines()


BLANK = bytes(range(33))  # lines of these only are skipped, as in Spark's CSV scan
RANGE_BYTES = 8 * 1024 * 1024  # of a file that are read at once
FILES_PER_TASK, BYTES_PER_TASK, LINES_PER_BATCH = 2_000, 64 * 1024 * 1024, 20_000


def read_user_feed(spark: SparkSession, folder: str, schema: StructType | str, pattern: str, by: str = "user_id") -> DataFrame:
    """One read over all users' CSV files of a feed (``pattern`` with ``*`` for the
    digits), first line a header; the user comes from the file's name.

    With a file per user, a Spark scan pays for a listing task and a reader per file. Here
    one task lists the folder, files are cut into ranges of lines (so a long one is
    shared out) and dealt to tasks that open many each. Lines are parsed by Spark, as
    in :func:`read_csv`."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            store, root = _file_system(folder)
            found = [i for i in store.get_file_info(fs.FileSelector(root)) if i.is_file and fnmatch.fnmatchcase(i.base_name, pattern)]
            for k in range(0, len(found), LINES_PER_BATCH):
                some = found[k : k + LINES_PER_BATCH]
                yield pa.RecordBatch.from_arrays([pa.array([i.base_name for i in some]), pa.array([i.size for i in some], pa.int64())], ["file", "length"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        files, texts = [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(texts, pa.string())], ["file", "line"])

        for ranges in batches:
            for name, length, start in zip(*(c.to_pylist() for c in ranges.columns)):
                with store.open_input_file(f"{root}/{name}") as f:
                    found = [x for x in _range_lines(f, start, min(start + RANGE_BYTES, length)) if x.strip(BLANK)]
                found = found[0 if start else 1 :]
                files += [name] * len(found)
                texts += [x.decode("utf-8", "replace") for x in found]
                if len(texts) >= LINES_PER_BATCH:
                    yield batch()
                    files, texts = [], []
        if texts:
            yield batch()

    listed = cut_lineage(spark.range(0, 1, 1, 1).mapInArrow(names, "file string, length long"), "listing")
    n, size = listed.agg(F.count(F.lit(1)), F.sum("length")).first()
    if not n:
        raise FileNotFoundError(f"{folder}/{pattern}")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(RANGE_BYTES).cast("long"))
    tasks = max(min(n, spark.sparkContext.defaultParallelism), n // FILES_PER_TASK, size // BYTES_PER_TASK)
    ranges = listed.select("file", "length", F.explode(starts).alias("start")).repartition(tasks)
    rows = ranges.mapInArrow(lines, "file string, line string")
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    return rows.select(F.from_csv("line", ddl).alias("_r"), extract_id(F.col("file"), pattern).cast("long").alias(by)).select("_r.*", by)


def write_user_files(df: DataFrame, folder: str, prefix: str, order: Sequence[str], by: str = "user_id") -> DataFrame:
    """One CSV file ``<prefix>_<user>.csv`` per user, without the user column, rows in
    ``order``. Users are dealt to shuffle partitions and each task writes its users'
    files one after another, a batch at a time, so the number of tasks doesn't grow
    with the users nor memory with a user's rows. Returns (user, path) of the files of
    committed tasks; a repeated task overwrites its own files."""
    columns = [c for c in df.columns if c != by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        done, user, writer, out = [], None, None, None
        for batch in batches:
            users = batch.column(0).to_pylist()
            start = 0
            while start < len(users):
                stop = start + 1
                while stop < len(users) and users[stop] == users[start]:
                    stop += 1
                part = pa.Table.from_batches([batch.slice(start, stop - start).select(columns)])
                if writer is None or users[start] != user:
                    if writer is not None:
                        writer.close()
                        out.close()
                    user = users[start]
                    path = f"{root}/{prefix}_{user}.csv"
                    out = store.open_output_stream(path)
                    writer = pacsv.CSVWriter(out, part.schema)
                    done.append((user, path))
                writer.write_table(part)
                start = stop
        if writer is not None:
            writer.close()
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done]), pa.array([p for _, p in done])], [by, "path"])

    named = df.where(F.col(by).isNotNull()).select(by, *columns)
    return named.repartition(by).sortWithinPartitions(by, *order).mapInArrow(run, f"{by} long, path string")


def users_with_all_feeds(feeds: Sequence[DataFrame], by: str = "user_id") -> DataFrame:
    """Users present in every feed (distinct ids, intersected by semi-joins)."""
    ids = [f.select(by).distinct() for f in feeds]
    return reduce(lambda a, b: a.join(b, by, "left_semi"), ids)


def write_split_outputs(samples: DataFrame, base: str, feature_cols: Sequence[str], target: str, keys: Sequence[str]) -> dict:
    """One table partitioned by ``split``; inputs/targets/ids are projections of
    it (the keys are kept in all three so they can be joined back, never zipped)."""
    path = write_parquet(samples, f"{base}/samples", partition_by=["split"])
    return {"samples": path, "inputs": list(keys) + list(feature_cols), "targets": list(keys) + [target], "ids": list(keys)}


def read_split(spark: SparkSession, path: str, split: str, cols: Sequence[str]) -> DataFrame:
    """Partition-pruned read of one split's projection."""
    return spark.read.parquet(path).where(F.col("split") == split).select(*cols)


def write_inference_outputs(features: DataFrame, base: str, keys: Sequence[str] = ("user_id", "HRTIME")) -> dict:
    """Features and ids tables (ids = the key projection)."""
    fpath = write_parquet(features, f"{base}/features")
    # the keys are read back from the written features, not computed a second time
    ipath = write_parquet(features.sparkSession.read.parquet(fpath).select(*keys), f"{base}/ids")
    return {"features": fpath, "ids": ipath}


def dataset_profile(df: DataFrame, name: str, source: str = "") -> DataFrame:
    """One-row lineage record: name, source, schema, rows, columns, per-column
    null counts and an order-independent content digest (xor of row hashes)."""
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    aggs = [
        F.count(F.lit(1)).alias("num_rows"),
        F.bit_xor(row_hash).alias("digest_xor"),
        F.sum(row_hash % 1_000_003).alias("digest_sum"),
    ] + [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    prof = df.agg(*aggs)
    nulls = F.to_json(F.struct(*[F.col(f"nulls_{c}").alias(c) for c in df.columns]))
    return prof.select(
        F.lit(name).alias("name"),
        F.lit(source).alias("source"),
        F.lit(df.schema.json()).alias("schema_json"),
        F.col("num_rows").cast("long"),
        F.lit(len(df.columns)).cast("long").alias("num_columns"),
        nulls.alias("null_counts"),
        "digest_xor",
        "digest_sum",
    )
