"""Physical-plan properties the scale design relies on (checked with explain)."""

import contextlib
import io

import pytest

from grievance.operators import gold as G
from grievance.operators import quality as Q
from grievance.operators import reports as R
from grievance.operators.raw import keep_last
from grievance.operators.staging import stage_complaints
from grievance.plans.daily import load_raw_from_tables, read_table, run


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def warehouse(spark, sf_small):
    from grievance.session import shared_path

    out = shared_path(spark, "plans")
    run(spark, load_raw_from_tables(spark, sf_small), out, length_gate="warn", suite_gate="warn", tests_gate="warn")
    return out


def test_keep_last_limits_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS complaint_id", "id AS pos")
    p = plan(keep_last(df, "complaint_id", ["pos"]))
    head, _, tail = p.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in head and "WindowGroupLimit" in tail  # final above, partial below


def test_staging_filters_reach_the_scan(spark, warehouse):
    p = plan(stage_complaints(read_table(spark, warehouse, "consumer_complaints")), "formatted")
    for c in ("complaint_id", "date_received", "product", "company"):
        assert f"IsNotNull({c})" in p


def test_fact_broadcasts_measured_dimensions(spark, warehouse):
    stg = read_table(spark, warehouse, "stg_complaints")
    dims = [read_table(spark, warehouse, n) for n in ("dim_product", "dim_company", "dim_geography")]
    p = plan(G.fact_complaints(stg, *dims))
    assert p.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in p
    assert "Exchange hashpartitioning" not in p  # the fact itself is never shuffled


def test_suite_is_one_pass_plus_one_key_count(spark, warehouse):
    p = plan(Q.run_suite(read_table(spark, warehouse, "consumer_complaints")))
    assert p.count("FileScan parquet") == 2
    assert "partial_count" in p and "Expand" not in p and "CartesianProduct" not in p


def test_reports_aggregate_before_the_join(spark, warehouse):
    fact = read_table(spark, warehouse, "fact_complaints")
    dp = read_table(spark, warehouse, "dim_product")
    for df in (R.complaints_by_product(fact, dp), R.response_time(fact, dp)):
        p = plan(df)
        join_at = p.index("BroadcastHashJoin")
        assert "partial_count" in p[join_at:]  # the fact side is pre-aggregated below the join


def test_top_companies_is_a_topk(spark, warehouse):
    p = plan(R.complaints_by_company(read_table(spark, warehouse, "fact_complaints"),
                                      read_table(spark, warehouse, "dim_company"), top=10))
    assert "TakeOrderedAndProject" in p


def test_join_elimination_has_no_join_or_shuffle(spark, warehouse):
    stg = read_table(spark, warehouse, "stg_complaints")
    p = plan(G.fact_complaints(stg, strategy="derive"))
    assert "Join" not in p and "Exchange" not in p


def test_upsert_broadcasts_a_measured_increment(spark, warehouse):
    """A small written increment is broadcast: the existing table is scanned, not shuffled."""
    from grievance.operators.raw import merge_upsert
    from grievance.session import shared_path

    existing = read_table(spark, warehouse, "consumer_complaints")
    inc_path = shared_path(spark, "increment")
    existing.limit(50).write.parquet(inc_path)
    p = plan(merge_upsert(existing, spark.read.parquet(inc_path)))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p and "SortMergeJoin" not in p
    assert "Exchange hashpartitioning" not in p
