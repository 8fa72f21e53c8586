"""Expectations and model tests: a failing input for each check type."""

import pytest
from pyspark.sql import functions as F

from grievance.operators import quality as Q

SCHEMA = "complaint_id long, date_received string, product string, company string, state string, timely_response string"


def _suite(spark, rows, suite=Q.RAW_SUITE):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.expectation_index: r for r in Q.run_suite(df, suite).collect()}


def test_suite_all_pass(spark):
    rows = [(i, "2020-01-01", "p", "c", "NY", "Yes" if i % 2 else "No") for i in range(1, 1201)]
    res = _suite(spark, rows)
    assert len(res) == 14 and all(r.success for r in res.values())
    assert res[1].observed_value == 1200


def test_suite_failures(spark):
    rows = [(i, None if i <= 20 else "2020-01-01", None if i <= 60 else "p", "c", "NY", "yes" if i <= 100 else "Yes")
            for i in range(1, 1001)]
    rows += [(5, "2020-01-01", "p", "c", "NY", "Yes")] * 20  # 21 rows with id 5
    res = _suite(spark, rows)
    nn_date = res[6]  # 20/1020 null -> 98.0% < 99%
    assert nn_date.unexpected_count == 20 and not nn_date.success
    assert not res[8].success  # product nulls 60/1020
    uniq = res[4]  # every row of the duplicated value is unexpected
    assert uniq.unexpected_count == 21 and uniq.element_count == 1020 and not uniq.success
    in_set = res[13]  # 'yes' is outside {Yes, No}
    assert in_set.unexpected_count == 100 and not in_set.success
    assert res[14].success and res[3].success and res[1].success


def test_suite_missing_column_and_empty(spark):
    df = spark.createDataFrame([], "complaint_id long, product string")
    res = {r.expectation_index: r for r in Q.run_suite(df).collect()}
    assert not res[1].success  # 0 rows < 1000
    assert not res[5].success and res[5].observed_value == 0  # date_received missing
    assert not res[6].success
    assert res[3].success and res[4].success and res[14].success  # no rows -> success


def test_in_set_all_null_passes(spark):
    res = _suite(spark, [(i, "d", "p", "c", "NY", None) for i in range(1, 1001)])
    assert res[13].success and res[13].element_count == 0


def test_model_tests_fail_and_warn(spark):
    fact = spark.createDataFrame(
        [("k1", 1, "p1", "c1", "Immediate", "Web", 2, False), ("k1", 2, "p9", None, "Bogus", "Carrier", 20, True),
         (None, 3, None, "c1", None, None, None, None)],
        "complaint_sk string, complaint_id long, product_sk string, company_sk string, "
        "response_timeliness_category string, submitted_via string, response_days int, timely_response_flag boolean",
    ).withColumn("date_received", F.lit(None).cast("date")).withColumn("date_sent_to_company", F.lit(None).cast("date"))
    dp = spark.createDataFrame([("p1", "x")], "product_sk string, product_name string")
    dc = spark.createDataFrame([("c1", "y")], "company_sk string, company_name string")
    tests = [t for t in Q.MODEL_TESTS if t.model in ("fact_complaints",)]
    tests += [t for t in Q.MODEL_TESTS if t.model in ("dim_product", "dim_company") and t.kind == "not_null"]
    res = {r.test_name: r for r in Q.run_tests({"fact_complaints": fact, "dim_product": dp, "dim_company": dc}, tests).collect()}
    assert res["unique_fact_complaints_complaint_sk"].failures == 1
    assert res["not_null_fact_complaints_complaint_sk"].status == "fail"
    assert res["relationships_fact_complaints_product_sk"].failures == 1  # p9; NULL not reported
    assert res["relationships_fact_complaints_company_sk"].failures == 0
    assert res["accepted_values_fact_complaints_response_timeliness_category"].failures == 1
    sv = res["accepted_values_fact_complaints_submitted_via"]
    assert (sv.failures, sv.status) == (1, "warn")
    ta = res["test_timely_response_accuracy"]
    assert (ta.failures, ta.status) == (2, "warn")  # 2 days not timely; 20 days timely
    assert res["test_date_logic"].status == "pass"


def test_enforce_and_gate(spark):
    ok = spark.createDataFrame([("t", "pass"), ("u", "warn")], "test_name string, status string")
    Q.enforce(ok)
    bad = spark.createDataFrame([("t", "fail")], "test_name string, status string")
    with pytest.raises(Q.QualityGateError):
        Q.enforce(bad)
    fact = spark.range(5)
    g = Q.volume_gate(fact, min_rows=10).first()
    assert (g.n_rows, g.status) == (5, "warn")


def test_store_results(spark, scratch):
    res = spark.createDataFrame([("t", "pass")], "test_name string, status string")
    Q.store_results(res, scratch, "20240101-000000-daily-validation")
    Q.store_results(res, scratch, "20240102-000000-daily-validation")
    back = spark.read.parquet(scratch)
    assert back.count() == 2 and back.select("run_name").distinct().count() == 2


def test_suite_invariant_to_partitioning(spark, sf_small):
    from grievance.plans.models import raw_complaints

    raw = raw_complaints(spark, sf_small)
    a = Q.run_suite(raw.coalesce(1))
    b = Q.run_suite(raw.repartition(13, "state"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_duplicated_keys(spark):
    a = spark.createDataFrame([("k1",), ("k1",), ("k2",), (None,), (None,)], "sk string")
    b = spark.createDataFrame([("x",), ("y",)], "sk string")
    rows = Q.duplicated_keys({"a": (a, "sk"), "b": (b, "sk")}).collect()
    assert [(r.table, r.key, r.n) for r in rows] == [("a", "k1", 2)]
