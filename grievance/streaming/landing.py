"""Incremental ingestion of complaint extracts dropped into a landing folder.

The batch schedule's "wait for the file, then load it" becomes a file-source
stream run with ``availableNow``: every run picks up exactly the files that
arrived since the previous one (the checkpoint records which were taken).
Each micro-batch is normalised and written to its own
``ingest_id=<checkpoint id>/batch_id=<n>`` folder of an append-only bronze
table; the write overwrites that folder, so a micro-batch replayed after a
failure replaces its output instead of duplicating it.  The id is the one Spark
stores in the checkpoint: a new or lost checkpoint counts batches from 0
again, but in folders of its own, and history stays.  The raw table is the
last record per complaint id over all bronze rows, ordered by (file arrival,
micro-batch, file, position): a later extract wins, which is the upsert rule of
the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from grievance.operators.raw import keep_last, normalise
from grievance.schemas import CSV_TEXT_SCHEMA, RAW_COLUMNS
from grievance.session import keep_scans_small

FILE_COLUMNS = ("_file_mtime", "_file", "_block")
BRONZE_ORDER = ("_file_mtime", "batch_id", "_file", "_block", "_row")


def landing_stream(spark: SparkSession, landing_dir: str, pattern: str = "*complaints*.csv",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of CSV text rows (human headers) from new files in ``landing_dir``.

    A stream needs its schema up front: the extract's 18 headers in file
    order.  ``enforceSchema=false`` makes a file whose header differs fail
    instead of having its columns bound by position to the wrong names.
    """
    reader = (
        spark.readStream.schema(CSV_TEXT_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(landing_dir).select(
        "*",
        F.col("_metadata.file_modification_time").alias("_file_mtime"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def _writer(bronze_path: str, checkpoint_path: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ingest_id = batch.sparkSession.read.schema("id string").json(f"{checkpoint_path}/metadata").first()["id"]
        rows = batch.withColumn("_row", F.monotonically_increasing_id())
        out = normalise(rows, keep=FILE_COLUMNS + ("_row",))
        out.write.mode("overwrite").parquet(f"{bronze_path}/ingest_id={ingest_id}/batch_id={batch_id}")

    return write_batch


def ingest_available(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint_path: str,
                     pattern: str = "*complaints*.csv") -> StreamingQuery:
    """Append every not-yet-ingested landing file to bronze, then stop.

    A task writes one bronze file of what it reads, and the last records are
    sorted by file: tasks read little at a time (``keep_scans_small``).
    """
    keep_scans_small(spark)
    q = (
        landing_stream(spark, landing_dir, pattern)
        .writeStream.foreachBatch(_writer(bronze_path, checkpoint_path))
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def current_raw(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The raw complaint table: last record per id over everything ingested so far."""
    keep_scans_small(spark)
    bronze = spark.read.parquet(bronze_path)
    return keep_last(bronze, "complaint_id", BRONZE_ORDER).select(*RAW_COLUMNS)


def new_raw_since(spark: SparkSession, bronze_path: str, after_batch: int, ingest_id: str | None = None) -> DataFrame:
    """Last record per id among micro-batches after ``after_batch`` only (of one checkpoint, if ``ingest_id`` names it).

    ``batch_id`` is a partition column of bronze, so the filter prunes whole
    folders: the work grows with the newly ingested data, not the history.
    Upsert the result into the current raw table with the daily run
    (``run(spark, new_raw_since(...), output, existing_raw=<current raw>)``).
    """
    keep_scans_small(spark)
    bronze = spark.read.parquet(bronze_path).filter(F.col("batch_id") > F.lit(after_batch))
    if ingest_id is not None:
        bronze = bronze.filter(F.col("ingest_id") == F.lit(ingest_id))
    return keep_last(bronze, "complaint_id", BRONZE_ORDER).select(*RAW_COLUMNS)
