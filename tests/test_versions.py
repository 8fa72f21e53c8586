"""Versioned tables, merges of the touched parts, and the change feed."""

import threading

import pytest
from pyspark.sql import functions as F

from grievance.operators import changes as C
from grievance.operators import gold as G
from grievance.operators import reports as R
from grievance.operators.raw import merge_upsert
from grievance.plans.daily import load_raw_from_tables, load_step, read_table, run, stored_table, write_table
from grievance.plans.versions import ConcurrentWrite, VersionedTable, merge_increment, with_id_range


def rows(spark, n, value, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("complaint_id"), F.lit(value).alias("product"))


def test_versions_are_read_whole_and_expire(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    assert table.current() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(rows(spark, 10, "a"))
    second = table.replace(table.read().withColumn("product", F.lit("b")))
    assert {r["product"] for r in table.read(first).collect()} == {"a"} and {r["product"] for r in table.read().collect()} == {"b"}
    third = table.replace(rows(spark, 3, "c"))
    assert [v.number for v in table.versions()] == [first.number, second.number, third.number]
    assert table.expire(keep=2) == 1 and table.expire(keep=2) == 0
    assert table.read(second).count() == 10 and table.read().count() == 3
    empty = table.replace(rows(spark, 0, "x"))
    assert table.read(empty).count() == 0 and table.read().columns == ["complaint_id", "product"]


def test_a_reader_never_sees_a_missing_or_mixed_table(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    table.replace(rows(spark, 100, "v0").repartition(4))
    stop, seen, wrong = threading.Event(), set(), []

    def reader():
        mine = VersionedTable(spark, f"{scratch}/t")
        while not stop.is_set():
            try:
                got = mine.read().groupBy("product").count().collect()
            except Exception as e:  # noqa: BLE001
                wrong.append(str(e)[:200])
                return
            seen.update(r["product"] for r in got)
            if [r["count"] for r in got] != [100]:
                wrong.append(got)

    thread = threading.Thread(target=reader)
    thread.start()
    for k in range(1, 6):
        table.replace(rows(spark, 100, f"v{k}").repartition(4))
        table.expire(keep=3)
    stop.set()
    thread.join()
    assert not wrong and len(seen) > 1


def test_failed_concurrent_and_broken_writes(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    base = table.replace(rows(spark, 5, "a"))
    broken = rows(spark, 5, "b").withColumn("product", F.when(F.col("complaint_id") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise("b"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert {r["product"] for r in table.read().collect()} == {"a"}
    table.replace(rows(spark, 5, "c"))
    with pytest.raises(ConcurrentWrite):
        table._publish(base, rows(spark, 1, "d").schema, {}, {})
    # A writer lost while it published leaves a file that is no version; its number is passed over.
    with open(f"{scratch}/t/_versions/0000000003.json", "w") as f:
        f.write('{"number": 3, "sch')
    assert {r["product"] for r in table.read().collect()} == {"c"}
    assert table.replace(rows(spark, 5, "e")).number == 4 and {r["product"] for r in table.read().collect()} == {"e"}


def test_a_merge_touches_only_its_parts(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t", "id_range")
    old = rows(spark, 1000, "old")
    table.replace(with_id_range(old, width=100), ("id_range", "complaint_id"))
    before = table.files()
    assert len(before) == 10
    new = rows(spark, 30, "new", start=590).unionByName(rows(spark, 5, "new", start=5000)).unionByName(spark.createDataFrame([(None, "new")], "complaint_id long, product string"))
    version = merge_increment(table, with_id_range(new, width=100))
    after = table.files(version)
    assert {k for k in after if after[k] != before.get(k)} == {"5", "6", "50", "__HIVE_DEFAULT_PARTITION__"}
    expected = merge_upsert(old, new.filter("complaint_id IS NOT NULL"))
    got = table.read().filter("complaint_id IS NOT NULL").drop("id_range")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    # The merge's plan lists the touched folders only, and a filter on the part column prunes the rest.
    assert len(table.read(parts=[5, 6]).inputFiles()) == len(after["5"]) + len(after["6"])
    plan = table.read().filter("id_range = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_range" in plan
    with pytest.raises(ValueError, match="other parts"):
        table.replace_parts(with_id_range(rows(spark, 200, "x"), width=100), [0])


def test_daily_upsert_by_parts_equals_the_whole_merge(spark, sf_small, scratch):
    raw = load_raw_from_tables(spark, sf_small)
    early, late = raw.filter("complaint_id % 3 > 0"), raw.filter("complaint_id > 15000").withColumn("tags", F.lit("later"))
    gates = dict(length_gate="warn", suite_gate="warn", tests_gate="warn")
    run(spark, early, f"{scratch}/parts", id_width=5000, fact_by_month=True, **gates)
    untouched = stored_table(spark, f"{scratch}/parts", "consumer_complaints").files()["0"]
    run(spark, late, f"{scratch}/parts", existing_raw=read_table(spark, f"{scratch}/parts", "consumer_complaints"), fact_by_month=True, **gates)
    assert stored_table(spark, f"{scratch}/parts", "consumer_complaints").files()["0"] == untouched
    run(spark, early, f"{scratch}/whole", **gates)
    run(spark, late, f"{scratch}/whole", existing_raw=read_table(spark, f"{scratch}/whole", "consumer_complaints"), **gates)
    for name in ("consumer_complaints", "fact_complaints"):
        a = read_table(spark, f"{scratch}/parts", name).drop("id_range", "received_month", "loaded_at", "dbt_loaded_at")
        b = read_table(spark, f"{scratch}/whole", name).drop("loaded_at", "dbt_loaded_at").select(*a.columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    with pytest.raises(ValueError, match="5000 ids"):
        load_step(late, f"{scratch}/parts", existing_raw=raw, id_width=6000)


def test_months_are_pruned(spark, sf_small, scratch):
    raw = load_raw_from_tables(spark, sf_small)
    run(spark, raw, scratch, length_gate="warn", suite_gate="warn", tests_gate="warn", fact_by_month=True, register=True)
    fact, dates = read_table(spark, scratch, "fact_complaints"), read_table(spark, scratch, "dim_date")
    days = dates.filter("year = 2013 AND quarter = 2")
    found = G.in_dates(fact, days)
    n = found.count()
    assert n == fact.filter("date_received BETWEEN '2013-04-01' AND '2013-06-30'").count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "received_month" in plan
    # Half-year growth reads twelve months of the table.
    table = stored_table(spark, scratch, "fact_complaints")
    months = R.growth_months(table.current().parts)
    assert len(months) == 12 < len(table.current().parts)
    few = table.read(parts=months)
    assert len(few.inputFiles()) < len(fact.inputFiles())
    assert R.half_year_growth(few).collect() == R.half_year_growth(fact).collect()
    # The catalog shows the parts too, and the newest version after another run.
    assert spark.table("gold.fact_complaints").filter("received_month = 201305").count() == fact.filter("received_month = 201305").count()
    write_table(dates.filter("year = 2013"), scratch, "dim_date", audit=True)
    from grievance.plans.daily import register_catalog

    register_catalog(spark, scratch)
    assert spark.table("gold.dim_date").count() == 365


def test_change_feed_and_signed_counts(spark):
    schema = "complaint_id long, product string, state string, n int"
    old = spark.createDataFrame([(1, "a", None, 1), (2, "b", "", 2), (3, "c", "x", 3), (4, None, None, None), (9, "z", "z", 9)], schema)
    new = spark.createDataFrame([(1, "a", None, 1), (2, "b", None, 2), (3, "d", "x", 3), (4, None, None, None), (5, "a", "q", 5)], schema)
    feed = C.change_feed(old, new)
    got = {r.complaint_id: (r.change, r.old and r.old["product"], r.new["product"]) for r in feed.collect()}
    assert got == {1: ("unchanged", "a", "a"), 2: ("updated", "b", "b"), 3: ("updated", "c", "d"), 4: ("unchanged", None, None), 5: ("inserted", None, "a")}
    counts = old.groupBy("product").agg(F.count(F.lit(1)).alias("n_complaints"))
    after = C.updated_counts(counts, C.signed_rows(feed), ["product"])
    expected = merge_upsert(old, new).groupBy("product").agg(F.count(F.lit(1)).alias("n_complaints"))
    assert sorted(map(str, after.collect())) == sorted(map(str, expected.collect()))
    # Values that run together as text are different rows.
    a = spark.createDataFrame([(1, "x,y", "z", 1)], schema)
    b = spark.createDataFrame([(1, "x", "y,z", 1)], schema)
    assert C.change_feed(a, b).first().change == "updated"
