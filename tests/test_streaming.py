"""Incremental landing-folder ingestion: each file once, later extracts win."""

import os
import time

from grievance.schemas import COLUMN_MAPPING
from grievance.streaming import current_raw, ingest_available

HEADER = ",".join(f'"{h}"' for h in COLUMN_MAPPING)


def _file(path, rows, mtime):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [HEADER]
    for cid, product in rows:
        vals = {h: '""' for h in COLUMN_MAPPING}
        vals.update({"Complaint ID": str(cid), "Product": product, "Date received": "2020-01-0%d" % (cid % 9 + 1)})
        lines.append(",".join(vals[h] for h in COLUMN_MAPPING))
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(path, (mtime, mtime))


def test_incremental_ingest(spark, scratch):
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    now = time.time()
    _file(f"{landing}/complaints_day1.csv", [(1, "Mortgage"), (2, "Card"), (2, "Card v2")], now - 100)
    ingest_available(spark, landing, bronze, ckpt)
    raw = {r.complaint_id: r.product for r in current_raw(spark, bronze).collect()}
    assert raw == {1: "Mortgage", 2: "Card v2"}

    _file(f"{landing}/complaints_day2.csv", [(2, "Loan"), (3, "Auto")], now - 50)
    _file(f"{landing}/notes.csv", [(9, "ignored")], now - 40)
    ingest_available(spark, landing, bronze, ckpt)
    ingest_available(spark, landing, bronze, ckpt)  # nothing new: no duplicate rows
    assert spark.read.parquet(bronze).count() == 5
    raw = {r.complaint_id: r.product for r in current_raw(spark, bronze).collect()}
    assert raw == {1: "Mortgage", 2: "Loan", 3: "Auto"}


def test_a_new_checkpoint_keeps_history(spark, scratch):
    landing, bronze = f"{scratch}/landing_ck", f"{scratch}/bronze_ck"
    now = time.time()
    _file(f"{landing}/complaints_1.csv", [(1, "Mortgage"), (2, "Card")], now - 100)
    ingest_available(spark, landing, bronze, f"{scratch}/ck_a")
    os.remove(f"{landing}/complaints_1.csv")
    _file(f"{landing}/complaints_2.csv", [(2, "Loan"), (3, "Auto")], now - 50)
    ingest_available(spark, landing, bronze, f"{scratch}/ck_b")
    assert {r.complaint_id: r.product for r in current_raw(spark, bronze).collect()} == {1: "Mortgage", 2: "Loan", 3: "Auto"}


def test_misaligned_header_fails_loudly(spark, scratch):
    import pytest

    landing = f"{scratch}/landing_bad"
    os.makedirs(landing, exist_ok=True)
    headers = list(COLUMN_MAPPING)[::-1]  # same names, other order
    with open(f"{landing}/complaints_x.csv", "w", encoding="utf-8") as fh:
        fh.write(",".join(f'"{h}"' for h in headers) + "\n" + ",".join(['"x"'] * len(headers)) + "\n")
    with pytest.raises(Exception):
        ingest_available(spark, landing, f"{scratch}/bronze_bad", f"{scratch}/ckpt_bad")


def test_incremental_merge_reads_only_new_batches(spark, scratch):
    import contextlib
    import io

    from grievance.operators.raw import merge_upsert
    from grievance.streaming import new_raw_since

    landing, bronze, ckpt = f"{scratch}/landing_inc", f"{scratch}/bronze_inc", f"{scratch}/ckpt_inc"
    now = time.time()
    _file(f"{landing}/complaints_1.csv", [(1, "A"), (2, "B")], now - 100)
    ingest_available(spark, landing, bronze, ckpt)
    raw0 = current_raw(spark, bronze)
    _file(f"{landing}/complaints_2.csv", [(2, "B2"), (3, "C"), (3, "C2")], now - 50)
    ingest_available(spark, landing, bronze, ckpt)
    new = new_raw_since(spark, bronze, after_batch=0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        new.explain("formatted")
    assert "PartitionFilters: [isnotnull(batch_id" in buf.getvalue()
    merged = {r.complaint_id: r.product for r in merge_upsert(raw0, new).collect()}
    assert merged == {r.complaint_id: r.product for r in current_raw(spark, bronze).collect()}
    assert merged == {1: "A", 2: "B2", 3: "C2"}
