"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.session import shared_path

#: What separates words: blank and the ASCII controls from tab to carriage return.
BLANKS = "\\x20\\x09-\\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: several consumers read the result instead of computing
    it again, and a lost executor loses none of it.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._grievance = (path, None)
    return back


def bucketed(df: DataFrame, name: str, n: int, column: str, codec: str | None = None) -> DataFrame:
    """``staged``, as a table in ``n`` buckets by ``column``: joins with another such table on it move neither side."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    table = f"grievance_{name}_{path.rsplit('-', 1)[1]}"
    df.write.format("parquet").option("path", path).option("compression", codec or "snappy").bucketBy(n, column).saveAsTable(table)
    back = spark.table(table)
    back._grievance = (path, table)
    return back


def discard(*frames: DataFrame) -> None:
    """Delete what ``staged`` or ``bucketed`` wrote, once everything made of it is written itself."""
    for df in frames:
        path, table = df._grievance
        spark = df.sparkSession
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    They go once the driver's garbage is collected, which Spark itself asks
    for only every half hour; a sequence of large shuffles would pile up on the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread(*cols: Column | str) -> Column:
    """A non-negative hash of the columns, for dealing rows out evenly."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 62) - 1))


def buckets(rows: int, per_bucket: int) -> int:
    """How many buckets hold ``rows`` with about ``per_bucket`` each."""
    return max(1, -(-rows // per_bucket))
