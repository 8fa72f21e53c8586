"""Checks from the write pass and from bitmaps, failing values, restart, and the catalog's view and functions."""

import pytest
from pyspark.sql import functions as F

from grievance.operators import metrics as M
from grievance.operators import quality as Q
from grievance.operators.quality import QualityGateError
from grievance.operators.raw import load_profile, varchar_overflow
from grievance.plans import daily as D
from grievance.plans.daily import load_raw_from_tables, read_table, run, stored_table, version_of, write_table
from grievance.schemas import RAW_COLUMNS

WARN = dict(length_gate="warn", suite_gate="warn", tests_gate="warn")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_observed_metrics_equal_a_scan(spark, sf_small, scratch):
    raw = load_raw_from_tables(spark, sf_small)
    observed = M.Observed(M.raw_metrics(Q.RAW_SUITE, RAW_COLUMNS))
    # With a range partitioning and several tasks: nothing is counted twice.
    back = write_table(raw.repartition(5), scratch, "consumer_complaints", sort=("complaint_id",), observed=observed)
    row = observed.row(spark)
    assert same(Q.run_suite(back, metrics=row), Q.run_suite(back))
    assert same(varchar_overflow(back, metrics=row), varchar_overflow(back))
    assert same(load_profile(back, metrics=row), load_profile(back))


def test_observed_checks_read_ids_only(spark, sf_small, scratch):
    observed = M.Observed(M.raw_metrics(Q.RAW_SUITE, RAW_COLUMNS))
    back = write_table(load_raw_from_tables(spark, sf_small), scratch, "consumer_complaints", observed=observed)
    plan = Q.run_suite(back, metrics=observed.row(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "ReadSchema: struct<complaint_id:bigint>" in plan


def test_bitmaps_count_repeated_ids(spark):
    ids = [1, 1, 1, 2, 32768, 32769, 32769, 70000, 5_000_000_000, -3, -3, 0, None, None]
    df = spark.createDataFrame([(i, None if i is None else i // 100) for i in ids], "complaint_id long, id_range long").repartition(4)
    bitmaps = M.id_bitmaps(df, "id_range")
    assert M.unique_counts_by_bitmap(df, bitmaps).first().asDict() == {"el": 12, "un": 7} == Q.unique_counts(df, "complaint_id").first().asDict()
    once = df.distinct()
    assert M.unique_counts_by_bitmap(once, M.id_bitmaps(once, "id_range")).first().asDict() == {"el": 8, "un": 0}
    more = spark.createDataFrame([(2, 0), (3, 0), (40_000, 400), (90_000, 900)], "complaint_id long, id_range long")
    assert M.new_ids(bitmaps, M.id_bitmaps(more, "id_range")).first().asDict() == {"n_ids": 4, "n_new": 3}
    plan = M.bitmap_totals(M.id_bitmaps(df, "id_range"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(complaint_id" not in plan


def test_checks_of_a_table_in_parts(spark, sf_small, scratch, monkeypatch):
    """Metrics by part give the rows of a scan, follow a merge, and count only the parts it wrote."""
    raw = load_raw_from_tables(spark, sf_small)
    run(spark, raw.filter("complaint_id % 4 > 0"), scratch, id_width=4000, results_path=f"{scratch}/r", **WARN)
    counted = []
    original = M.part_metrics
    monkeypatch.setattr(M, "part_metrics", lambda df, *a: counted.append(len(df.inputFiles())) or original(df, *a))
    late = raw.filter("complaint_id < 3000").withColumn("timely_response", F.lit("maybe"))
    report = run(spark, late, scratch, existing_raw=read_table(spark, scratch, "consumer_complaints"), results_path=f"{scratch}/r", run_name="second", **WARN)
    table = stored_table(spark, scratch, "consumer_complaints")
    assert counted == [len(table.files()["0"])] and len(table.current().parts) == 4
    raw_t = read_table(spark, scratch, "consumer_complaints")
    suite = Q.without_upper_bounds()
    stored = spark.read.parquet(f"{scratch}/r/expectations/run_name=second")
    assert same(stored.orderBy("expectation_index"), Q.run_suite(raw_t, suite).orderBy("expectation_index"))
    expected = [r.asDict() for r in varchar_overflow(raw_t).filter("violations > 0").collect()]
    assert report.length_violations == expected
    # The values that failed are kept with the counts.
    values = spark.read.parquet(f"{scratch}/r/failing_values/run_name=second")
    assert values.filter("column_name = 'timely_response' AND value = 'maybe'").first().n == late.count()


def test_failing_values(spark):
    df = spark.createDataFrame(
        [(1, "Yes"), (1, "No"), (2, "x"), (3, "x"), (4, "y"), (-5, None), (None, "z"), (None, "y")], "complaint_id long, timely_response string"
    )
    suite = (Q.Expectation("not_null", "complaint_id"), Q.Expectation("unique", "complaint_id"), Q.Expectation("column_exists", "nothing"),
             Q.Expectation("in_set", "timely_response", value_set=("Yes", "No", None)), Q.Expectation("between", "complaint_id", min_value=1, max_value=3),
             Q.Expectation("not_null", "absent"))
    got = [tuple(r) for r in Q.failing_values(df, suite, top=2).orderBy("expectation_index", "place").collect()]
    assert got == [(1, "complaint_id", None, 2, 1), (2, "complaint_id", "1", 2, 1), (4, "timely_response", "x", 2, 1), (4, "timely_response", "y", 2, 2),
                   (5, "complaint_id", "-5", 1, 1), (5, "complaint_id", "4", 1, 2)]
    assert {r.expectation_index for r in Q.failing_values(df, suite, only=[4]).collect()} == {4}
    assert Q.failing_values(df, suite[2:3]).collect() == []


def test_a_run_begins_again_where_it_stopped(spark, sf_small, scratch, monkeypatch):
    raw = load_raw_from_tables(spark, sf_small)

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(D.G, "fact_complaints", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            run(spark, raw, scratch, **WARN)
    before = {n: version_of(spark, scratch, n) for n in D.LAYERS}
    assert before["stg_complaints"] and before["dim_product"] and not before["fact_complaints"]
    report = run(spark, raw, scratch, resume=True, **WARN)
    after = {n: version_of(spark, scratch, n) for n in D.LAYERS}
    assert {n for n in after if after[n] != before[n]} == {"fact_complaints"}
    assert set(report.timings) == {"raw_checks", "profile", "gold_fact", "tests", "volume_gate"} and report.fact_rows == 4380
    # The same input again: only checks run.  Without resume, or with other input, everything runs.
    assert "gold_fact" not in run(spark, raw, scratch, resume=True, **WARN).timings
    assert "silver" in run(spark, raw.filter("complaint_id > 40"), scratch, resume=True, **WARN).timings
    # A table written by someone else since is not taken for the step's own.
    write_table(read_table(spark, scratch, "dim_product").drop("dbt_loaded_at"), scratch, "dim_product")
    again = run(spark, raw.filter("complaint_id > 40"), scratch, resume=True, **WARN).timings
    assert "gold_dims" in again and "silver" not in again


def test_gates_still_stop(spark, sf_small, scratch):
    with pytest.raises(QualityGateError, match="declared length"):
        run(spark, load_raw_from_tables(spark, sf_small), scratch, id_width=5000)


def test_other_sessions_see_the_view_and_the_rules(spark, sf_small, scratch):
    run(spark, load_raw_from_tables(spark, sf_small), scratch, register=True, **WARN)
    other = spark.newSession()
    assert other.sql("SHOW CREATE TABLE silver.stg_complaints").first()[0].startswith("CREATE VIEW")
    view, table = other.table("silver.stg_complaints").drop("dbt_loaded_at"), read_table(spark, scratch, "stg_complaints").drop("dbt_loaded_at")
    assert view.columns == table.columns and view.dtypes == table.dtypes
    assert sorted(map(str, view.collect())) == sorted(map(str, table.collect()))
    got = other.sql("SELECT silver.calculate_region('NY') AS r, silver.classify_response_timeliness(5) AS t").first()
    assert (got.r, got.t) == ("Northeast", "Fast")


def test_known_failures_are_those_of_a_scan(spark, sf_small, scratch):
    """Counts taken over from the suite and the key check give the rows that reading the tables gives."""
    report = run(spark, load_raw_from_tables(spark, sf_small), scratch, results_path=f"{scratch}/r", run_name="a", **WARN)
    assert report.fact_strategy == "derive"
    stored = spark.read.parquet(f"{scratch}/r/tests/run_name=a")
    scanned = Q.run_tests({n: read_table(spark, scratch, n) for n in D.LAYERS if n != "stg_complaints"})
    assert same(stored.select(*scanned.columns), scanned)
    suite = Q.without_upper_bounds()
    rows = [r.asDict() for r in Q.run_suite(read_table(spark, scratch, "consumer_complaints"), suite).collect()]
    known = Q.known_failures(Q.MODEL_TESTS, suite, rows, unique_keys=[("dim_product", "product_sk")])
    assert known["source_not_null_raw_consumer_complaints_product"] > 0 and known["unique_dim_product_product_sk"] == 0 and len(known) == 6
    # A repeated id leaves the unique test to a scan: the suite counts rows, the test values.
    rows = [{**r, "unexpected_count": 4} if r["expectation_type"].endswith("unique") else r for r in rows]
    assert "source_unique_raw_consumer_complaints_complaint_id" not in Q.known_failures(Q.MODEL_TESTS, suite, rows)
