"""Session helpers: configuration, the shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",  # naive timestamps; µs arithmetic assumes UTC
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for large inputs: ~256 MB per scan split and per shuffle partition keeps
# each task's sort/window buffers well inside executor memory (they spill beyond);
# AQE coalesces small partitions and splits skewed ones at run time; a join side is
# broadcast only when AQE measures it below the threshold.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def shuffle_partitions_for(input_bytes: int, expansion: float = 1.5, cores: int | None = None) -> int:
    """Initial shuffle partitions for an input size: enough partitions of the target
    size for the shuffled bytes (window halos and unions add ``expansion``), at least
    the number of cores. AQE coalesces them when they come out smaller."""
    n = max(1, int(input_bytes * expansion // TARGET_PARTITION_BYTES) + 1)
    return max(n, cores or 1)


def configure_for_scale(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Apply :data:`CLUSTER_CONF` and size ``spark.sql.shuffle.partitions`` for the
    input (e.g. 100 TB of readings -> ~600k initial partitions, coalesced by AQE)."""
    for k, v in CLUSTER_CONF.items():
        spark.conf.set(k, v)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes, cores=cores)))
    return configure(spark)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "wakeful") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("WAKEFUL_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only a local session
    without one gets a private temporary folder; a cluster without one is an error,
    since a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="wakeful-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table
    (recorded per application so :func:`release_scratch` can remove it)."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/wakeful-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the intermediate tables this application wrote (call at the end of a
    job: DataFrames read from them become invalid). Uses the Hadoop FileSystem of
    each path, so it works on any shared file system. Returns the count removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    removed = 0
    for p in paths:
        if p in keep:
            _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(p)
            continue
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            fs.delete(hp, True)
            removed += 1
    return removed


def cut_lineage(df: DataFrame, name: str = "stage", small: bool = False) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: the lineage is cut, the table survives executor loss, and it is
    computed once (an eager ``checkpoint()`` computes the plan twice unless cached).
    ``small`` marks tables that are tiny by construction (written by one task)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(1) if small else df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def default_sf_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
