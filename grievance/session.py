"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline is tuned for.  They are applied by ``build_session``
# (tests, bench) and are recommendations for a cluster submission.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Dimension tables below this size are broadcast by the planner; above it
    # the joins fall back to sort-merge with AQE skew splitting.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # HotSpot never compiles a method of more bytecode: leave such stages to Spark's smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Delete reliable checkpoints once their DataFrames are garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster, sized from the bytes the job reads.

    The initial shuffle width gives each reducer about ``target_partition_bytes``
    of the input.  That is an upper bound: every wide step is an aggregation,
    a keep-last or a join with a smaller side, and carries only its pruned
    columns.  The width has no cap: a reducer's share stays the same at any
    size (raise ``target_partition_bytes`` where so many map outputs cost too
    much bookkeeping).  AQE then coalesces small partitions
    toward the advisory size and splits skewed join partitions, so reducers
    neither spill heavily nor sit idle.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.parquet.compression.codec": "zstd",
    }


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "grievance", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    n = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.default.parallelism", str(n))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def keep_methods_small(spark: SparkSession) -> None:
    """Set HotSpot's limit for generated methods in a session that has Spark's default.

    The stages that spell or parse all columns of a complaint generate larger
    ones, which would run interpreted (twice as long, measured on na_tokens).
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, RECOMMENDED_CONF[key])


#: Bytes of files that one task reads where the rows of a task are sorted whole.
SCAN_BYTES = 16 * 1024 * 1024


def keep_scans_small(spark: SparkSession) -> None:
    """Set the bytes that a task reads in a session that has Spark's default of 128 MB.

    Compressed text holds a record in some 28 bytes (measured on csv_ingest),
    its row takes several hundred where it is sorted: with the default a task
    sorts millions of rows and spills.  A scan reads the setting when it runs,
    so it stays set.
    """
    key, default = "spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024)
    if spark.conf.get(key, default).lower() in (default, f"{default}b", "128m", "128mb"):
        spark.conf.set(key, str(SCAN_BYTES))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``, from the file system's own summary."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(files.getContentSummary(hadoop).getLength()) if files.exists(hadoop) else 0


def _context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions expose no SparkContext
        return None


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local-mode session without the setting gets a private temporary
    folder; a cluster session without it is a configuration error, because a
    machine-local folder is invisible to other executors.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="grievance-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def parallelism(spark: SparkSession) -> int:
    """Default task parallelism (the shuffle width when no SparkContext is exposed)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared base for one write."""
    return f"{shared_base(spark)}/grievance/{name}-{uuid.uuid4().hex}"
