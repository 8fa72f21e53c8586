"""Steps whose time, shuffle or files must not grow faster than the input."""

from __future__ import annotations

import os

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from grievance.operators import changes as C
from grievance.operators import gold as G
from grievance.operators.raw import merge_upsert, normalise
from grievance.plans import catalog
from grievance.plans.daily import load_raw_from_csv
from grievance.plans.models import fact_only, raw_complaints, staged_complaints, stored
from grievance.plans.versions import VersionedTable, merge_increment, with_id_range
from grievance.session import SCAN_BYTES, keep_methods_small, keep_scans_small
from grievance.sources.csv import read_complaints_csv, scan_complaints, write_complaints_csv
from grievance.sources.fixture import fixture_complaints, fixture_key, fixture_rows, fixture_text, write_record_files
from grievance.sources.multiline import load_with_rejects, scan_complaint_records


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _tables(folder, lines):
    """Five tables with one order, customer, supplier and part, and lineitems ``(linenumber, price)``."""
    os.makedirs(folder)
    rows = ", ".join(f"(1::BIGINT, 1::BIGINT, 1::BIGINT, {n}, 1.0, {p}::DOUBLE, 'R', 'O', TIMESTAMP '1998-01-01')" for n, p in lines)
    for name, sql in {
        "lineitem": f"SELECT * FROM (VALUES {rows}) t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate)",
        "orders": "SELECT 1::BIGINT o_orderkey, 1::BIGINT o_custkey, 'F' o_orderstatus, TIMESTAMP '1997-01-01' o_orderdate, '2-HIGH' o_orderpriority",
        "customer": "SELECT 1::BIGINT c_custkey, 1 c_nationkey",
        "supplier": "SELECT 1::BIGINT s_suppkey, 'S' s_name",
        "part": "SELECT 1::BIGINT p_partkey, 'B' p_brand, 'T' p_type",
    }.items():
        duckdb.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("build", [raw_complaints, fact_only, lambda s, d: catalog._two_loads(s, d)[1]], ids=["raw", "fact", "increment"])
def test_last_record_needs_no_further_shuffle(spark, sf_small, no_broadcast, build):
    assert "hashpartitioning(complaint_id" not in _plan(build(spark, sf_small))


def test_line_numbers_that_do_not_decide_the_id(spark, tmp_path):
    few = _tables(tmp_path / "few", [(1, 1.0), (1, 2.0), (2, 1.0)])
    assert fixture_key(spark, few) == ("l_orderkey", "complaint_id")
    for name, lines, ids in (("many", [(1, 1.0), (11, 2.0)], [11, 21]), ("none", [(1, 1.0), ("NULL::INTEGER", 2.0), ("NULL::INTEGER", 3.0)], [None, 11])):
        folder = _tables(tmp_path / name, lines)
        assert fixture_key(spark, folder) == ("complaint_id",)
        assert sorted((r[0] for r in raw_complaints(spark, folder).select("complaint_id").collect()), key=lambda x: x or 0) == ids
    assert raw_complaints(spark, few).count() == 2


def test_id_text_is_not_read_again_by_pushed_conditions(spark, sf_small):
    plan = _plan(normalise(fixture_text(fixture_complaints(spark, sf_small, with_order=False))))
    assert not [line for line in plan.splitlines() if "Filter" in line and "RLIKE" in line]


def test_records_are_parsed_once(spark, sf_small, tmp_path):
    write_record_files(fixture_text(fixture_complaints(spark, sf_small, with_order=False)), f"{tmp_path}/in")
    loaded, rejects = load_with_rejects(scan_complaint_records(spark, f"{tmp_path}/in", "*.txt"))
    kept = spark.conf.get("spark.sql.maxToStringFields", "25")
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    try:
        for df in (loaded, rejects):
            assert _plan(df.groupBy().count()).count("from_csv") == 1
    finally:
        spark.conf.set("spark.sql.maxToStringFields", kept)


def test_extract_is_written_without_a_shuffle(spark, tmp_path):
    rows = fixture_text(spark.range(1000, 1400, 1, 4).selectExpr("id AS complaint_id", "DATE '2013-01-01' AS date_received", *[
        f"CAST(NULL AS {'date' if c == 'date_sent_to_company' else 'string'}) AS {c}" for c in catalog.RAW_COLUMNS if c not in ("complaint_id", "date_received")]))
    write_record_files(rows, f"{tmp_path}/in")
    files = [f"{tmp_path}/in/{f}" for f in os.listdir(f"{tmp_path}/in") if f.endswith(".txt")]
    assert len(files) == 4  # one per task, none shared by a hash
    texts = [open(f).read().splitlines() for f in files]
    assert all(t[0].startswith("Date received,") and sum(x.startswith("Date received,") for x in t) == 1 for t in texts)
    assert sum(len(t) for t in texts) == 400 + 4


def test_csv_files_hold_bounded_records(spark, tmp_path):
    write_complaints_csv(spark.range(0, 1000, 1, 1).selectExpr("CAST(id AS string) AS id"), f"{tmp_path}/csv", records_per_file=100)
    assert len([f for f in os.listdir(f"{tmp_path}/csv") if f.endswith(".csv")]) == 10


def test_extract_has_more_files_for_more_input(spark, sf_small, monkeypatch):
    monkeypatch.setattr(catalog, "EXTRACT_BYTES", 1000)
    assert catalog._ordered_extract(spark, sf_small).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_generated_methods_stay_compilable(spark, sf_small):
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        catalog.QUERIES["na_tokens"](spark, sf_small)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "20000")
        keep_methods_small(spark)
        assert spark.conf.get(key) == "20000"  # a choice of the user's stays
    finally:
        spark.conf.set(key, old)


def test_change_feed_carries_only_what_is_asked(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "complaint_id long, product string, tags string")
    new = spark.createDataFrame([(1, "a", "z"), (2, "b", "y"), (3, "c", "y")], "complaint_id long, product string, tags string")
    feed = C.change_feed(old, new, carry=("product",))
    assert feed.schema["new"].dataType.names == ["product"]
    assert {r.complaint_id: r.change for r in feed.collect()} == {1: C.UPDATED, 2: C.UNCHANGED, 3: C.INSERTED}
    signed = C.signed_rows(feed)
    assert sorted(map(tuple, signed.collect())) == [(1, "a", -1), (1, "a", 1), (3, "c", 1)]


def test_rows_joined_are_those_of_the_lineitems(spark, sf_small):
    assert fixture_rows(spark, sf_small).count() == spark.read.parquet(f"{sf_small}/lineitem.parquet").count()


@pytest.mark.parametrize("extra_column", [True, False])
def test_extract_is_dealt_out_once(spark, sf_small, no_broadcast, extra_column):
    plan = _plan(catalog._ordered_extract(spark, sf_small, extra_column))
    assert "hashpartitioning(complaint_id" not in plan
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


SCAN_KEY, SCAN_DEFAULT = "spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024)


@pytest.fixture
def default_scans(spark):
    old = spark.conf.get(SCAN_KEY)
    spark.conf.set(SCAN_KEY, SCAN_DEFAULT)
    yield
    spark.conf.set(SCAN_KEY, old)


@pytest.mark.parametrize("name", ["csv_ingest", "landing_ingest"])
def test_ingest_reads_little_in_a_task(spark, sf_small, default_scans, name):
    catalog.QUERIES[name](spark, sf_small)
    assert spark.conf.get(SCAN_KEY) == str(SCAN_BYTES)


def test_scan_size_of_the_user_stays(spark, default_scans):
    for value, kept in (("128MB", str(SCAN_BYTES)), ("64m", "64m"), (str(256 * 1024 * 1024), str(256 * 1024 * 1024)), ("1048576", "1048576")):
        spark.conf.set(SCAN_KEY, value)
        keep_scans_small(spark)
        assert spark.conf.get(SCAN_KEY) == kept
    spark.conf.unset(SCAN_KEY)
    keep_scans_small(spark)
    assert spark.conf.get(SCAN_KEY) in (str(SCAN_BYTES), f"{SCAN_BYTES}b")


@pytest.mark.parametrize("compression, small", [("gzip", True), ("none", False)])
def test_compressed_files_are_dealt_out_finer(spark, tmp_path, default_scans, compression, small):
    write_complaints_csv(spark.range(4).selectExpr("CAST(id AS string) AS complaint_id"), f"{tmp_path}/in", compression=compression)
    assert load_raw_from_csv(spark, f"{tmp_path}/in", pattern="*.csv*").count() == 4
    assert spark.conf.get(SCAN_KEY) == (str(SCAN_BYTES) if small else SCAN_DEFAULT)


def test_position_carries_no_folder_of_one_folder(spark, tmp_path):
    def put(path, *lines):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write("complaint_id,product\n" + "\n".join(lines) + "\n")

    put(f"{tmp_path}/one/b complaints.csv", "1,b", "2,b")
    put(f"{tmp_path}/one/a complaints.csv", "1,a", "3,a")
    assert {r[0] for r in scan_complaints(spark, f"{tmp_path}/one").select("_src_file").collect()} == {"a%20complaints.csv", "b%20complaints.csv"}
    last = {r.complaint_id: r.product for r in load_raw_from_csv(spark, f"{tmp_path}/one").collect()}
    assert last == {1: "b", 2: "b", 3: "a"}
    # With several folders the whole path decides.
    put(f"{tmp_path}/two/y/a complaints.csv", "1,y")
    put(f"{tmp_path}/two/x/z complaints.csv", "1,x")
    assert [r.product for r in load_raw_from_csv(spark, f"{tmp_path}/two").collect()] == ["y"]
    paths = {r[0] for r in scan_complaints(spark, f"{tmp_path}/two").select("_src_file").collect()}
    assert paths == {r[0] for r in read_complaints_csv(spark, [f"{tmp_path}/two/x", f"{tmp_path}/two/y"]).select("_src_file").collect()}


@pytest.mark.parametrize("lines", [[(1, 1.0), (1, 2.0), (2, 1.0)], [(1, 1.0), (11, 2.0), (1, 3.0)], [(1, 1.0), ("NULL::INTEGER", 2.0)]])
def test_extract_keeps_an_id_together(spark, tmp_path, lines):
    extract = catalog._ordered_extract(spark, _tables(tmp_path / "t", lines))
    rows = extract.select("Extra column", F.spark_partition_id().alias("part")).collect()
    assert len(rows) == len(lines)
    assert len({tuple(r) for r in rows}) == len({r[0] for r in rows})


@pytest.fixture
def writes(monkeypatch):
    """The rows given to be written, and what is done to them behind the shuffle."""
    seen, written = [], VersionedTable._written

    def spy(self, df, sort=(), watch=None):
        seen.append((df, sort, watch))
        return written(self, df, sort, watch)

    monkeypatch.setattr(VersionedTable, "_written", spy)
    return seen


def test_merge_deals_old_and_new_rows_out_once(spark, scratch, no_broadcast, writes):
    schema = "complaint_id long, product string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (150, "e"), (None, "f")], schema)
    new = spark.createDataFrame([(2, "x"), (3, "y"), (4, "z"), (None, "n")], schema)
    table = VersionedTable(spark, f"{scratch}/t", "id_range")
    table.replace(with_id_range(old, width=100), ("id_range", "complaint_id"))
    merge_increment(table, with_id_range(new, width=100))
    assert sorted(map(tuple, table.read().drop("id_range").collect()), key=str) == sorted(map(tuple, merge_upsert(old, new).collect()), key=str)
    df, sort, watch = writes[-1]
    assert "Join" not in _plan(df)
    plan = _plan(watch(df.repartitionByRange(*sort).sortWithinPartitions(*sort)))
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_rows_are_narrow_where_they_are_dealt_out(spark, sf_small, writes):
    catalog.QUERIES["fact_by_month"](spark, sf_small)
    assert not [c for c in writes[-1][0].columns if c.endswith("_sk")]
    writes.clear()
    catalog.QUERIES["merge_touched"](spark, sf_small)
    assert "product" not in writes[0][0].columns


def test_fact_meets_the_geography_before_its_other_keys_are_made(spark, sf_small, no_broadcast):
    stg = staged_complaints(spark, sf_small)
    plan = G.fact_complaints(stg, G.dim_product(stg), G.dim_company(stg), G.dim_geography(stg))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert [next(k for k in ("company", "product", "geography") if f"_{k}_key" in line) for line in joins] == ["company", "product", "geography"]


def test_stored_copies_are_packed(spark):
    (path,) = stored(spark.range(100).coalesce(1), "packed").inputFiles()
    assert pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0).column(0).compression == "ZSTD"
