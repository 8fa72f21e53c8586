"""The orchestrated run end to end (tables and CSV inputs), gates, re-runs."""

import pytest
from pyspark.sql import functions as F

from grievance.operators.quality import QualityGateError
from grievance.plans.daily import load_raw_from_csv, load_raw_from_tables, read_table, run
from grievance.sources.csv import write_complaints_csv
from grievance.sources.fixture import fixture_complaints, fixture_text


def test_run_from_tables(spark, sf_small, scratch):
    report = run(spark, load_raw_from_tables(spark, sf_small), scratch, length_gate="warn", suite_gate="warn", tests_gate="warn",
                 results_path=f"{scratch}/results", register=True)
    assert report.raw_rows == 4599 and report.fact_rows == 4380
    assert report.volume_status == "warn"  # fewer than 100,000 rows
    failed = {r["expectation_index"] for r in report.suite_failed}
    assert 8 in failed and 13 in failed and 10 not in failed  # product not-null, timely in-set; company passes
    failed_tests = {r["test_name"] for r in report.tests_failed}
    assert "source_not_null_raw_consumer_complaints_product" in failed_tests
    assert {r["test_name"] for r in report.tests_warned} >= {"accepted_values_fact_complaints_submitted_via"}
    assert spark.table("gold.fact_complaints").count() == 4380
    assert "dbt_loaded_at" in spark.table("gold.dim_product").columns
    assert "loaded_at" in spark.table("raw.consumer_complaints").columns
    assert spark.read.parquet(f"{scratch}/results/expectations").count() == 14
    from grievance.operators.reports import quality_history

    hist = {r.family: (r.n_checks, r.n_failed, r.n_warned) for r in quality_history(spark, f"{scratch}/results").collect()}
    assert hist["expectations"] == (14, len(report.suite_failed), 0)
    assert hist["tests"] == (27, len(report.tests_failed), len(report.tests_warned))
    assert report.load_metrics["records"] == 4599 and report.load_metrics["batches"] >= 1
    assert [r["column_name"] for r in report.length_violations] == ["state"]  # ' tx ' is longer than VARCHAR(2)


def test_gates_raise(spark, sf_small, scratch):
    raw = load_raw_from_tables(spark, sf_small)
    with pytest.raises(QualityGateError, match="declared length"):
        run(spark, raw, f"{scratch}/a")
    with pytest.raises(QualityGateError, match="expectation suite"):
        run(spark, raw, f"{scratch}/b", length_gate="warn")
    with pytest.raises(QualityGateError, match="model tests"):
        run(spark, raw, f"{scratch}/c", length_gate="warn", suite_gate="warn")


def test_upsert_rerun_is_idempotent(spark, sf_small, scratch):
    raw = load_raw_from_tables(spark, sf_small)
    run(spark, raw, f"{scratch}/a", length_gate="warn", suite_gate="warn", tests_gate="warn")
    existing = read_table(spark, f"{scratch}/a", "consumer_complaints")
    run(spark, raw, f"{scratch}/b", existing_raw=existing, length_gate="warn", suite_gate="warn", tests_gate="warn")
    once = read_table(spark, f"{scratch}/a", "fact_complaints").drop("dbt_loaded_at")
    twice = read_table(spark, f"{scratch}/b", "fact_complaints").drop("dbt_loaded_at")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_csv_path_matches_table_path(spark, sf_small, scratch):
    text = fixture_text(fixture_complaints(spark, sf_small, with_order=False)).repartition(4)
    write_complaints_csv(text, f"{scratch}/landing/complaints_extract.csv")
    raw = load_raw_from_csv(spark, f"{scratch}/landing", pattern="*.csv", select="all")
    assert raw.count() == raw.select("complaint_id").distinct().count()
    assert raw.filter(F.col("product") == "").count() == 0  # blanks became NULL at scan


def test_auto_strategy_matches_join(spark, sf_small, scratch):
    raw = load_raw_from_tables(spark, sf_small)
    a = run(spark, raw, f"{scratch}/auto", length_gate="warn", suite_gate="warn", tests_gate="warn")
    j = run(spark, raw, f"{scratch}/join", length_gate="warn", suite_gate="warn", tests_gate="warn", fact_strategy="join")
    assert (a.fact_strategy, j.fact_strategy) == ("derive", "join")
    fa = read_table(spark, f"{scratch}/auto", "fact_complaints").drop("dbt_loaded_at")
    fj = read_table(spark, f"{scratch}/join", "fact_complaints").drop("dbt_loaded_at")
    assert fa.exceptAll(fj).count() == 0 and fj.exceptAll(fa).count() == 0


REALISTIC = '''Date received,Product,Sub-product,Issue,Sub-issue,Consumer complaint narrative,Company public response,Company,State,ZIP code,Tags,Consumer consent provided?,Submitted via,Date sent to company,Company response to consumer,Timely response?,Consumer disputed?,Complaint ID
2023-08-22,Credit card,General-purpose credit card or charge card,Fees or interest,Problem with fees,"I was charged a fee, twice.
Then again in ""September"".",Company has responded to the consumer,ACME BANK,NY,021XX,"Older American, Servicemember",Consent provided,Web,2023-08-24,Closed with explanation,Yes,N/A,7001
2023-08-23,Mortgage,,Trouble during payment process,,,,Other Lender N.A.,PR,00901,,N/A,Phone,2023-08-20,Closed with monetary relief,No,No,7002
2023-08-22,Credit card,General-purpose credit card or charge card,Fees or interest,Problem with fees,Updated narrative,,ACME BANK,NY,021XX,,Consent provided,Web,2023-09-10,Closed with explanation,Yes,Yes,7001
'''


def test_realistic_extract_end_to_end(spark, scratch):
    import os

    os.makedirs(f"{scratch}/landing", exist_ok=True)
    with open(f"{scratch}/landing/complaints.csv", "w", encoding="utf-8") as fh:
        fh.write(REALISTIC)
    raw = load_raw_from_csv(spark, f"{scratch}/landing")
    run(spark, raw, f"{scratch}/wh", length_gate="warn", suite_gate="warn", tests_gate="warn")
    stg = {r.complaint_id: r for r in read_table(spark, f"{scratch}/wh", "stg_complaints").collect()}
    assert set(stg) == {7001, 7002}
    a, b = stg[7001], stg[7002]
    # The later record of 7001 won; its narrative, dispute flag and dates are the updated ones.
    assert a.complaint_narrative == "Updated narrative" and a.consumer_disputed_flag is True
    assert (a.response_days, a.zip_code, a.company_name, a.tags) == (19, "021XX", "ACME BANK", "None")
    assert a.has_narrative_flag is True
    # 7002: sent before received -> guarded date NULL, negative days kept; blanks defaulted.
    assert (b.date_sent_to_company, b.response_days) == (None, -3)
    assert (b.sub_product, b.sub_issue, b.company_name, b.timely_response_flag) == (
        "Not Specified", "Not Specified", "OTHER LENDER N.A.", False)
    assert b.has_narrative_flag is False and b.consumer_disputed_flag is False
    fact = {r.complaint_id: r for r in read_table(spark, f"{scratch}/wh", "fact_complaints").collect()}
    assert fact[7001].response_timeliness_category == "Late" and fact[7002].response_timeliness_category == "Unknown"


def test_bucketed_raw_same_results_no_shuffle(spark, sf_small, scratch):
    import contextlib
    import io

    from grievance.operators import quality as Q

    raw = load_raw_from_tables(spark, sf_small)
    plain = run(spark, raw, f"{scratch}/plain", length_gate="warn", suite_gate="warn", tests_gate="warn")
    out = f"{scratch}/bucketed"
    bucketed = run(spark, raw, out, length_gate="warn", suite_gate="warn", tests_gate="warn", bucket_raw=8)
    assert (bucketed.raw_rows, bucketed.fact_rows) == (plain.raw_rows, plain.fact_rows)
    assert bucketed.suite_failed == plain.suite_failed
    assert sorted(r["test_name"] for r in bucketed.tests_failed) == sorted(r["test_name"] for r in plain.tests_failed)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        Q.unique_failures(read_table(spark, out, "consumer_complaints"), "complaint_id").explain()
    assert "Exchange hashpartitioning" not in buf.getvalue()
    # Path readers (another process) still see the same rows.
    assert spark.read.parquet(f"{out}/raw/consumer_complaints").count() == plain.raw_rows


def test_a_failed_write_leaves_the_old_table_whole(spark, scratch):
    import pytest
    from pyspark.sql import functions as F

    from grievance.plans.daily import load_step, read_table, write_table

    old = spark.createDataFrame([(1, "a"), (2, "b")], "complaint_id long, product string")
    write_table(old, scratch, "consumer_complaints")
    broken = old.withColumn("product", F.when(F.col("complaint_id") == 2, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("product")))
    with pytest.raises(Exception, match="lost"):
        write_table(broken, scratch, "consumer_complaints")
    assert read_table(spark, scratch, "consumer_complaints").count() == 2
    more = spark.createDataFrame([(2, "new"), (3, "c")], "complaint_id long, product string")
    load_step(more, scratch, existing_raw=read_table(spark, scratch, "consumer_complaints"))
    got = {r.complaint_id: r.product for r in read_table(spark, scratch, "consumer_complaints").collect()}
    assert got == {1: "a", 2: "new", 3: "c"}


def test_results_of_a_rerun_replace_the_first(spark, scratch):
    from grievance.operators.quality import store_results

    rows = spark.createDataFrame([(1,), (2,)], "n long")
    for _ in range(2):
        store_results(rows, f"{scratch}/results", "20260101-000000-daily-validation")
    assert spark.read.parquet(f"{scratch}/results").count() == 2


def test_tables_of_others_are_not_dropped(spark, scratch):
    import pytest

    from grievance.plans.daily import register_catalog

    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.sql("DROP TABLE IF EXISTS gold.dim_date")
    spark.sql("CREATE TABLE gold.dim_date USING parquet LOCATION '" + scratch + "/mine' AS SELECT 1 AS mine")
    try:
        with pytest.raises(RuntimeError, match="not made by a run"):
            register_catalog(spark, scratch)
        assert spark.table("gold.dim_date").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS gold.dim_date")
