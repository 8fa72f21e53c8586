"""What the checks of a table need, gathered while it is written, and kept by its parts.

A table that is written whole is observed in the write pass itself
(``DataFrame.observe``): the counts of the checks cost no scan.  A table in
parts keeps one row of counts for each part; a merge counts only the parts that
it writes, and the whole is their sum.  Of the ids it keeps bitmaps: equal ids
set one bit, so an id check adds up rows and bits of a bitmap for 32,768 ids
each, instead of shuffling the ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grievance.operators import quality as Q
from grievance.operators.raw import length_metrics, profile_metrics


def raw_metrics(suite: Sequence[Q.Expectation], columns: Sequence[str]) -> dict[str, Column]:
    """All counts that the checks of the raw table need, by name."""
    return {**Q.suite_metrics(suite, columns), **length_metrics(), **profile_metrics()}


class Observed:
    """Metrics of the rows that a write passes on."""

    def __init__(self, metrics: dict[str, Column]):
        self.metrics, self._observation = metrics, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, observed.  Put it last before the write: what runs twice (a sample for a range partitioning) would count twice."""
        return df.observe(self._observation, *[m.alias(name) for name, m in self.metrics.items()])

    def row(self, spark: SparkSession) -> DataFrame:
        """The metrics as one row, once the write has ended."""
        got = self._observation.get
        schema = T.StructType([T.StructField(name, T.LongType()) for name in self.metrics])
        return spark.createDataFrame([tuple(got.get(name) or 0 for name in self.metrics)], schema)


# --- by parts ----------------------------------------------------------------

def part_metrics(df: DataFrame, part: str, metrics: dict[str, Column]) -> DataFrame:
    """One row of metrics for each part of ``df``."""
    return df.groupBy(part).agg(*[m.cast("long").alias(name) for name, m in metrics.items()])


def total_metrics(by_part: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """The metrics of the whole table: greatest lengths are maxima, all else adds up."""
    whole = [F.max(name) if name.startswith("longest_") else F.sum(name) for name in metrics]
    return by_part.agg(*[F.coalesce(m, F.lit(0)).cast("long").alias(name) for m, name in zip(whole, metrics, strict=True)])


def id_bitmaps(df: DataFrame, part: str, key: str = "complaint_id") -> DataFrame:
    """``part, bucket, n_rows, bits``: for each part and run of 32,768 ids the rows with an id, and a bitmap of the ids."""
    known = df.filter(F.col(key).isNotNull())
    return known.groupBy(part, F.bitmap_bucket_number(F.col(key)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits")
    )


def bitmap_totals(bitmaps: DataFrame) -> DataFrame:
    """``bucket, n_rows, n_ids`` over all parts: a bucket with more rows than ids has repeated ids."""
    merged = bitmaps.groupBy("bucket").agg(F.sum("n_rows").alias("n_rows"), F.bitmap_or_agg("bits").alias("bits"))
    return merged.select("bucket", "n_rows", F.bitmap_count("bits").alias("n_ids"))


def unique_counts_by_bitmap(df: DataFrame, bitmaps: DataFrame, key: str = "complaint_id") -> DataFrame:
    """``quality.unique_counts`` from bitmaps; only ids of buckets with repeated ids are looked at one by one.

    Their number is not bounded, so it is a join, never a list; without
    repeated ids the table is not read at all.
    """
    totals = bitmap_totals(bitmaps)
    all_rows = totals.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("el"), F.coalesce(F.sum(F.col("n_rows") - F.col("n_ids")), F.lit(0)).alias("more"))
    found = all_rows.first()
    spark = df.sparkSession
    if not found["more"]:
        return spark.createDataFrame([(int(found["el"]), 0)], "el long, un long")
    suspect = totals.filter("n_rows > n_ids").select(F.col("bucket").alias("_bucket"))
    rows = df.filter(F.col(key).isNotNull()).join(suspect, F.bitmap_bucket_number(F.col(key)) == F.col("_bucket"), "left_semi")
    return Q.unique_counts(rows, key).select(F.lit(int(found["el"])).alias("el"), "un")


def new_ids(before: DataFrame, increment: DataFrame) -> DataFrame:
    """``n_ids, n_new``: ids of the increment, and those that no bitmap had (both sides ``id_bitmaps``)."""
    both = before.select("bucket", "bits", F.lit(0).alias("late")).unionByName(increment.select("bucket", "bits", F.lit(1).alias("late")))
    merged = both.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all_ids"),
        F.bitmap_count(F.bitmap_or_agg(F.when(F.col("late") == 0, F.col("bits")))).alias("old_ids"),
        F.bitmap_count(F.bitmap_or_agg(F.when(F.col("late") == 1, F.col("bits")))).alias("late_ids"),
    )
    return merged.agg(F.coalesce(F.sum("late_ids"), F.lit(0)).alias("n_ids"), F.coalesce(F.sum(F.col("all_ids") - F.col("old_ids")), F.lit(0)).alias("n_new"))
