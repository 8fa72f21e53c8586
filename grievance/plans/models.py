"""Model builders from the benchmark tables, for the single-query (driver) form.

A query that reads only the fact builds it straight from the raw derivation:
nothing is written, no dimension is built, and columns and filters are pruned
down to the table scans.  A query that joins the fact with a dimension has two
consumers of staging; it writes staging once, as Parquet in the shared folder
and without the narrative text that no gold model holds, and builds both sides
from that copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from grievance.operators.gold import build_gold, fact_complaints
from grievance.operators.raw import keep_last
from grievance.operators.staging import stage_complaints
from grievance.session import shared_path
from grievance.sources.fixture import FIXTURE_ORDER, fixture_columns, fixture_key, fixture_rows


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw complaint table: fixture rows, last record per complaint id."""
    return last_complaints(fixture_rows(spark, sf_dir), fixture_key(spark, sf_dir))


def last_complaints(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last record per complaint of ``fixture_rows``, in the raw columns.

    The narrow rows are told apart by ``fixture_key``; the texts are spelled behind.
    """
    return fixture_columns(keep_last(rows, key, FIXTURE_ORDER))


def staged_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_complaints(raw_complaints(spark, sf_dir))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, for several consumers.

    Most of a staged row or a fact are hexadecimal digests, which zstd halves.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def fact_from_raw(raw: DataFrame) -> DataFrame:
    """The fact of raw rows, row by row: each key is the row's own hash."""
    return fact_complaints(stage_complaints(raw), strategy="derive")


def fact_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without its dimensions: each key is the row's own hash.

    Equal to the lookup joins while the dimensions' keys are unique, which
    ``dbt_tests`` checks and ``fact_lookup_join`` exercises.
    """
    return fact_from_raw(raw_complaints(spark, sf_dir))


def gold_models(spark: SparkSession, sf_dir: str, strategy: str = "derive") -> dict[str, DataFrame]:
    """Fact and dimensions over one stored copy of staging (lazy: an unused model costs nothing)."""
    stg = stored(staged_complaints(spark, sf_dir).drop("complaint_narrative"), "staging")
    return build_gold(spark, stg, strategy=strategy)
