"""What an increment changes: rows tagged against the stored ones, and counts kept up to date by signed rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of a row's values in which NULL differs from every value, and no two values run together."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def change_feed(existing: DataFrame, incoming: DataFrame, key: str = "complaint_id", columns: Sequence[str] | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """``key, change, old, new``: every row of ``incoming`` (one per key) against the row that it replaces.

    ``columns`` (default: the columns of both) decide whether a row changed;
    ``old`` and ``new`` hold them all, or those of ``carry``: only these are shuffled.
    ``old`` is NULL for inserted rows.  The stored side is joined by its key;
    the increment is broadcast where its size is known to be small.
    """
    values = [c for c in (columns or existing.columns) if c != key and c in incoming.columns and c in existing.columns]
    carried = [c for c in values if carry is None or c in carry]
    digest = F.unhex(row_digest(values))
    old = existing.select(F.col(key).alias("_key"), F.struct(*carried).alias("old"), digest.alias("_old"))
    new = incoming.select(F.col(key), F.struct(*carried).alias("new"), digest.alias("_new"))
    change = F.when(F.col("_key").isNull(), INSERTED).when(F.col("_old") == F.col("_new"), UNCHANGED).otherwise(UPDATED)
    return new.join(old, F.col(key) == F.col("_key"), "left").select(key, change.alias("change"), "old", "new")


def signed_rows(feed: DataFrame, key: str = "complaint_id") -> DataFrame:
    """The rows that a merge adds (``sign`` 1) and takes away (-1); unchanged ones are neither."""
    kept = feed.filter(F.col("change") != UNCHANGED)
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))
    return kept.select(key, F.inline(both)).filter("row IS NOT NULL").select(key, "row.*", "sign")


def updated_counts(counts: DataFrame, signed: DataFrame, keys: Sequence[str], count: str = "n_complaints", grain: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``counts`` (``keys`` and ``count``) after the signed rows; groups that end with no row go.

    ``grain`` makes the counted rows of the signed ones (cleaning, filters); it must keep ``sign``.
    """
    rows = grain(signed) if grain else signed
    delta = rows.groupBy(*keys).agg(F.sum("sign").cast("bigint").alias(count))
    total = counts.select(*keys, count).unionByName(delta).groupBy(*keys).agg(F.sum(count).cast("bigint").alias(count))
    return total.filter(F.col(count) != 0)
