"""Raw layer: normalise scanned text, keep the last record per complaint, merge loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grievance.functions.expressions import lenient_bigint, lenient_date, null_if_na_token, zip5
from grievance.schemas import COLUMN_MAPPING, RAW_COLUMNS, RAW_DATE_COLUMNS, VARCHAR_LIMITS


def rename_and_select(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Human headers -> snake_case, drop unknown columns, add absent ones as NULL.

    Headers already in snake_case pass through.  ``keep`` lists extra columns
    (e.g. file position) to carry along.
    """
    renamed = df.withColumnsRenamed({k: v for k, v in COLUMN_MAPPING.items() if k in df.columns})
    present = set(renamed.columns)
    cols = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    return renamed.select(*cols, *keep)


def null_na_tokens(df: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Every text column: missing-value tokens (``''``, ``N/A``, ``NaN``, ...) -> NULL."""
    string_cols = {n for n, t in df.dtypes if t == "string"}
    return df.withColumns({c: null_if_na_token(c) for c in columns if c in string_cols})


def normalise(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scanned CSV text -> typed raw rows.

    rename/allow-list, missing tokens to NULL, lenient dates, 5-char ZIP,
    lenient integer id; rows without a usable id are dropped.
    """
    base = null_na_tokens(rename_and_select(df, keep))
    # The id comes out of a generator: the condition on it stays behind that, so the id's text is read once for each row
    # and not again in the scan, or below the joins, that the condition would be moved to.
    read = base.withColumn("_id", F.explode(F.array(lenient_bigint("complaint_id")))).filter(F.col("_id").isNotNull())
    return read.withColumns({**{c: lenient_date(c) for c in RAW_DATE_COLUMNS}, "zip_code": zip5("zip_code"), "complaint_id": F.col("_id")}).drop("_id")


def keep_last(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple ("last in file").

    Expressed as ``row_number() == 1``; Spark plans it with a partial
    per-partition group limit *before* the shuffle, so a hot key ships at most
    one row per input partition and never lands whole in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn", *order)
    )


def merge_upsert(existing: DataFrame, incoming: DataFrame, key: str = "complaint_id") -> DataFrame:
    """Upsert: incoming rows replace existing rows with the same key, others are added.

    ``incoming`` must already hold one row per key (see ``keep_last``).  The
    anti-join is an equi-join on the key: broadcast when the incoming batch is
    proven small by the planner, a sort-merge join otherwise.
    """
    kept = existing.join(incoming.select(key), on=key, how="left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def length_metrics(limits: dict[str, int] = VARCHAR_LIMITS) -> dict[str, Column]:
    """Per column of ``limits``: values longer than allowed (``long_``) and the greatest length (``longest_``)."""
    out = {}
    for c, n in limits.items():
        out[f"long_{c}"] = F.count(F.when(F.length(F.col(c)) > n, 1))
        out[f"longest_{c}"] = F.coalesce(F.max(F.length(F.col(c))), F.lit(0))
    return out


def varchar_overflow(raw: DataFrame, limits: dict[str, int] = VARCHAR_LIMITS, metrics: DataFrame | None = None) -> DataFrame:
    """Per declared VARCHAR(n) column: how many values are longer than n.

    One aggregate pass for all columns (none where ``metrics`` has its row),
    unpivoted to one row per column: ``column_name, max_length, violations, longest``.
    """
    one = metrics if metrics is not None else raw.agg(*[m.alias(name) for name, m in length_metrics(limits).items()])
    stack = ", ".join(f"'{c}', {n}, `long_{c}`, `longest_{c}`" for c, n in limits.items())
    return one.selectExpr(
        f"stack({len(limits)}, {stack}) AS (column_name, max_length, violations, longest)"
    ).select(
        "column_name",
        F.col("max_length").cast("int").alias("max_length"),
        F.col("violations").cast("bigint").alias("violations"),
        F.col("longest").cast("int").alias("longest"),
    )


def profile_metrics() -> dict[str, Column]:
    return {"total_rows": F.count(F.lit(1)), "valid_dates": F.count("date_received")}


def load_profile(raw: DataFrame, metrics: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Post-load profile: total rows, rows with a date, distinct products, date share (%).

    With the row of ``profile_metrics`` in ``metrics`` only the products are
    read; not even those with ``products``, one row with ``distinct_products``.
    """
    if metrics is None:
        one = raw.agg(*[m.alias(name) for name, m in profile_metrics().items()], F.count_distinct("product").alias("distinct_products"))
    else:
        found = products if products is not None else raw.agg(F.count_distinct("product").alias("distinct_products"))
        both = metrics.select("total_rows", "valid_dates").unionByName(found, allowMissingColumns=True)
        one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return one.select(
        "total_rows",
        "valid_dates",
        "distinct_products",
        F.round(F.try_divide(F.col("valid_dates") * 100.0, F.col("total_rows")), 6).alias("valid_date_pct"),
    )
