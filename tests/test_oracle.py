"""Every registered query against its DuckDB reference SQL on sf0.001."""

import pytest

from grievance.plans.catalog import ORACLE, QUERIES
from oracle_compare import compare, duckdb_connection


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", ["csv_ingest", "dbt_tests", "fact_complaints", "geo_concentration", "upsert_merge"])
def test_results_do_not_depend_on_shuffle_width(spark, sf_small, con, name):
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    assert res["ok"], res


@pytest.mark.parametrize("name", ["parse_dates", "csv_scan", "fact_complaints", "dim_date", "monthly_growth"])
def test_results_do_not_depend_on_session_time_zone(spark, sf_small, con, name):
    saved = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")  # UTC+14
        res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    assert res["ok"], res


@pytest.mark.parametrize("name", ["clean_raw", "csv_ingest", "stg_complaints", "expectation_suite", "varchar_overflow"])
def test_results_do_not_depend_on_ansi_mode(spark, sf_small, con, name):
    saved = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", saved)
    assert res["ok"], res
