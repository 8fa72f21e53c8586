"""Keep-last, upsert merge, VARCHAR overflow, load profile."""

from pyspark.sql import functions as F

from grievance.operators.raw import keep_last, load_profile, merge_upsert, varchar_overflow


def test_keep_last_second_row_wins(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "complaint_id long, v string, pos long")
    out = {r.complaint_id: r.v for r in keep_last(df, "complaint_id", ["pos"]).collect()}
    assert out == {1: "c", 2: "b"}


def test_keep_last_hot_key(spark):
    # One id holds most rows: the last one must still win, whole.
    rows = [(7, f"v{i}", i) for i in range(5000)] + [(8, "x", 1)]
    df = spark.createDataFrame(rows, "complaint_id long, v string, pos long").repartition(8)
    out = {r.complaint_id: r.v for r in keep_last(df, "complaint_id", ["pos"]).collect()}
    assert out == {7: "v4999", 8: "x"}


def test_load_twice_equals_once(spark):
    inc = spark.createDataFrame([(1, "new"), (3, "c")], "complaint_id long, v string")
    old = spark.createDataFrame([(1, "old"), (2, "b")], "complaint_id long, v string")
    once = merge_upsert(old, inc)
    twice = merge_upsert(once, inc)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.complaint_id: r.v for r in once.collect()} == {1: "new", 2: "b", 3: "c"}


def test_varchar_overflow(spark):
    df = spark.createDataFrame([(" tx ", "12345"), ("NY", None)], "state string, zip_code string")
    rows = {r.column_name: r for r in varchar_overflow(df, {"state": 2, "zip_code": 10}).collect()}
    assert (rows["state"].violations, rows["state"].longest) == (1, 4)
    assert (rows["zip_code"].violations, rows["zip_code"].longest) == (0, 5)


def test_load_profile_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("2020-01-01", "a"), ("2020-01-02", None)], "date_received string, product string")
    r = load_profile(df).first()
    assert (r.total_rows, r.valid_dates, r.distinct_products, r.valid_date_pct) == (3, 2, 1, 66.666667)
    assert load_profile(df.filter(F.lit(False))).first().valid_date_pct is None
