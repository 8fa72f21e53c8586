"""Bounded samples by key, chosen by a hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grievance.llm.common import staged

_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def first_by_hash(rows: DataFrame, key: str, id_col: str, n: int) -> DataFrame:
    """``key, id_col`` of the ``n`` rows of each key with the least hash of their id (ties by id).

    A hash bound from the key's count leaves about four times ``n`` rows of a
    frequent key to rank; where fewer than ``n`` lie below it, all rows of the key
    are ranked.  So the choice is that of ranking them all, and no task gets the
    rows of a hot key.
    """
    hashed = rows.select(key, id_col, F.xxhash64(id_col).alias("_h"))
    share = F.col("_rows") / F.lit(4.0 * n)
    bound = F.when(share <= 1, F.lit(_HIGHEST)).otherwise((F.lit(float(_LOWEST)) + F.lit(2.0**64) / share).cast("long"))
    bounds = staged(hashed.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).select(key, bound.alias("_bound")), "bounds")
    below = F.count(F.when(F.col("_h") <= F.col("_bound"), 1))
    enough = hashed.join(bounds, key).groupBy(key, "_bound").agg(below.alias("_below"))
    bounds = staged(enough.select(key, F.when(F.col("_below") >= n, F.col("_bound")).otherwise(F.lit(_HIGHEST)).alias("_bound")), "bounds")
    few = hashed.join(bounds, key).filter(F.col("_h") <= F.col("_bound"))
    order = Window.partitionBy(key).orderBy("_h", id_col)
    return few.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).select(key, id_col)
