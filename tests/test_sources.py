"""CSV scan / discovery / write, and the calendar spine."""

import datetime as dt
import os

import pytest

from grievance.operators.raw import normalise
from grievance.schemas import COLUMN_MAPPING
from grievance.sources import date_spine, discover_complaint_files, read_complaints_csv, scan_complaints


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


HEADER = ",".join(f'"{h}"' for h in COLUMN_MAPPING)


def _line(cid, narrative='""', product="Mortgage", date="07/29/2013"):
    vals = {h: '""' for h in COLUMN_MAPPING}
    vals.update({"Complaint ID": cid, "Consumer complaint narrative": narrative, "Product": product,
                 "Date received": date, "Company": "ACME", "ZIP code": "02139-1234"})
    return ",".join(vals[h] for h in COLUMN_MAPPING)


def test_multiline_quoted_field_is_one_row(spark, scratch):
    body = _line("1", '"first line\nsecond ""quoted"" line"') + "\n" + _line("2") + "\n"
    _write(f"{scratch}/in/complaints_a.csv", HEADER + "\n" + body)
    df = normalise(read_complaints_csv(spark, f"{scratch}/in/complaints_a.csv"))
    rows = {r.complaint_id: r for r in df.collect()}
    assert set(rows) == {1, 2}
    assert rows[1].consumer_complaint_narrative == 'first line\nsecond "quoted" line'
    assert rows[1].zip_code == "02139" and rows[1].date_received == dt.date(2013, 7, 29)
    assert rows[2].consumer_complaint_narrative is None  # '' is a missing-value token


def test_discovery_recursive_all_and_missing(spark, scratch):
    _write(f"{scratch}/base/b/complaints_2.csv", HEADER + "\n" + _line("2") + "\n")
    _write(f"{scratch}/base/a/complaints_1.csv", HEADER + "\n" + _line("1") + "\n")
    _write(f"{scratch}/base/a/other.csv", HEADER + "\n" + _line("3") + "\n")
    files = discover_complaint_files(spark, f"{scratch}/base")
    assert [os.path.basename(f) for f in files] == ["complaints_1.csv", "complaints_2.csv"]
    both = normalise(scan_complaints(spark, f"{scratch}/base"))
    assert sorted(r.complaint_id for r in both.collect()) == [1, 2]
    with pytest.raises(ValueError, match="2 files match"):
        scan_complaints(spark, f"{scratch}/base", select="single")
    with pytest.raises(FileNotFoundError):
        discover_complaint_files(spark, f"{scratch}/base", "*nothing*.csv")


def test_snake_case_headers_and_missing_columns(spark, scratch):
    _write(f"{scratch}/snake/complaints.csv", "complaint_id,product,extra\n5,Card,zzz\n6.0,,x\nabc,Loan,y\n")
    df = normalise(read_complaints_csv(spark, f"{scratch}/snake/complaints.csv"))
    rows = sorted(df.collect(), key=lambda r: r.complaint_id)
    assert [r.complaint_id for r in rows] == [5, 6]  # 'abc' dropped, '6.0' truncated
    assert "extra" not in df.columns and rows[0].state is None and rows[1].product is None


def test_date_spine_end_exclusive(spark):
    s = date_spine(spark)
    r = s.agg({"date_day": "min"}).first()[0], s.agg({"date_day": "max"}).first()[0], s.count()
    assert r == (dt.date(2011, 1, 1), dt.date(2030, 12, 30), 7304)


def test_cluster_conf_sizing():
    from grievance.session import cluster_conf

    assert cluster_conf(10 * 1024**3)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(1024**4)["spark.sql.shuffle.partitions"] == "4096"
    assert cluster_conf(100 * 1024**4)["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))


def test_utf8_bom_header(spark, scratch):
    path = f"{scratch}/bom/complaints_bom.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write(HEADER + "\n" + _line("7") + "\n")
    r = normalise(read_complaints_csv(spark, path)).first()
    assert r.complaint_id == 7 and r.date_received == dt.date(2013, 7, 29)


def test_single_line_splits_keep_file_order(spark, scratch):
    from grievance.operators.raw import keep_last
    from grievance.sources.csv import FILE_ORDER

    path = f"{scratch}/big/complaints_big.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("complaint_id,product\n")
        for i in range(20000):
            fh.write(f"{i % 100},p{i}\n")
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # many splits of one file
        scanned = read_complaints_csv(spark, path, multi_line=False)
        assert scanned.rdd.getNumPartitions() > 4
        last = keep_last(normalise(scanned, keep=FILE_ORDER), "complaint_id", FILE_ORDER)
        got = {r.complaint_id: r.product for r in last.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    assert got == {k: f"p{19900 + k}" for k in range(100)}
