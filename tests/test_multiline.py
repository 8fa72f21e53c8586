"""CSV with quoted line breaks in byte-range splits: equal to reading each file whole; rejects and losses are complete."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from grievance.schemas import COLUMN_MAPPING
from grievance.sources import multiline as M

HEADERS = list(COLUMN_MAPPING)


@pytest.fixture()
def small_splits(spark):
    """Splits of a 500 bytes, so that records of several lines span them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def whole_files(spark, path, names):
    schema = ", ".join(f"`{n}` string" for n in names)
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    return sorted(map(unix, df.collect()))


def unix(row):
    """The whole-file reader turns CRLF inside quotes into LF, where that is the file's line end."""
    return str(row).replace("\\r\\n", "\\n")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode())


def field(rng):
    kind = rng.randint(0, 9)
    word = "".join(rng.choice("ab é") for _ in range(rng.randint(1, 12))).strip() or "x"
    if kind < 4:
        return word
    if kind < 5:
        return f'{word[:1]} 5" pipe'  # a quote inside an unquoted field
    if kind < 6:
        return f'{word}"'
    body = "".join(rng.choice(["a", ",", '""', "\n", "\r\n", "é", " ", "long text "]) for _ in range(rng.randint(0, 60)))
    return f'"{body}"'


@pytest.mark.parametrize("seed", range(4))
def test_splits_equal_whole_files(spark, scratch, small_splits, seed):
    rng = random.Random(seed)
    end = "\r\n" if seed == 1 else "\n"
    for k in range(3):
        rows = [f"r{k}_{i}," + ",".join(field(rng) for _ in range(3)) for i in range(60)]
        write(f"{scratch}/in/x{k}.csv", end.join(["id,a,b,c", *rows]) + (end if k else ""))
    got, files = M.scan_records(spark, f"{scratch}/in", "*.csv")
    assert got.filter("_problem IS NOT NULL OR _missing > 0").isEmpty() and files.count() == 3
    assert sorted(map(unix, got.select("id", "a", "b", "c").collect())) == whole_files(spark, f"{scratch}/in/*.csv", ["id", "a", "b", "c"])
    # Positions follow the order in the files.
    ordered = [r.id for r in got.orderBy("_src_file", "_src_block", "_src_row").select("id").collect()]
    assert ordered == [f"r{k}_{i}" for k in range(3) for i in range(60)]


def test_one_file_is_many_tasks(spark, scratch, small_splits):
    """A record longer than several splits, and more than eight tasks for one file."""
    long = '"' + "line\n" * 400 + '"'
    write(f"{scratch}/in/one.csv", "id,a\n" + "".join(f"{i},{long if i == 7 else i}\n" for i in range(200)))
    records, _ = M.read_records(spark, f"{scratch}/in", "*.csv")
    assert M._lines(spark, f"{scratch}/in", "*.csv").rdd.getNumPartitions() >= 8
    assert records.count() == 201 and records.agg(F.max(F.length("record"))).first()[0] == 2004


def test_effects_compose_like_the_lines_together():
    """The effect of a text is that of its lines one after the other, whatever state it begins in."""
    rng = random.Random(5)

    def run(line, inside):
        state = "quoted" if inside else "start"
        for ch in line:
            if state == "start":
                state = "quoted" if ch == '"' else "start" if ch == "," else "plain"
            elif state == "plain":
                state = "start" if ch == "," else "plain"
            elif state == "quoted":
                state = "closing" if ch == '"' else "quoted"
            else:  # behind a quote inside quotes
                state = "quoted" if ch == '"' else "start" if ch == "," else "plain"
        return state == "quoted"

    from_outside, from_inside = (re.compile(p.replace("\\z", "\\Z")) for p in (M.ENDS_INSIDE_FROM_OUTSIDE, M.ENDS_INSIDE_FROM_INSIDE))
    for _ in range(3000):
        lines = ["".join(rng.choice('a,"" ') for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 5))]
        codes = []
        for line in lines:
            a, b = bool(from_outside.match(line)), bool(from_inside.match(line))
            assert (a, b) == (run(line, False), run(line, True)), line
            codes.append(M.ENDS_INSIDE if a and b else M.SWAPS if a else M.KEEPS if b else M.ENDS_OUTSIDE)
        effect = M._compose(np.array(codes, dtype=np.int8))
        for inside in (False, True):
            state = inside
            for line in lines:
                state = run(line, state)
            assert state == {M.KEEPS: inside, M.SWAPS: not inside, M.ENDS_OUTSIDE: False, M.ENDS_INSIDE: True}[effect]


def row(**values):
    return ",".join(values.get(h.split()[0].lower(), "") for h in HEADERS)


def test_every_record_is_loaded_or_rejected(spark, scratch, small_splits):
    def line(i, date="01/02/2020", tail=""):
        return f'{date},"Loan, or ""lease""\nwith text",,,,,,"ACME, Inc",NY,12345,,,Web,2020-01-05,Closed,Yes,No,{i}{tail}'

    good = [line(i) for i in range(60)]
    bad = [line(100, tail=",more"), line("ID7"), line(""), line(101, date="20150105"), "01/02/2020,Loan,short", line(102, tail=",a,b,c")]
    write(f"{scratch}/in/a_complaints.csv", "﻿" + ",".join(HEADERS) + "\r\n" + "\r\n".join(good[:30] + bad + good[30:]) + "\r\n\r\n")
    # Another column order, names in snake_case, one column absent, one unknown; the last record is unfinished.
    write(f"{scratch}/in/sub/b_complaints.csv", "complaint_id,company,date_received,product,odd\n1000,A,2020-02-02,P,x\n1001,B,2020-02-03,Q,\"never closed\n1002,C")
    write(f"{scratch}/in/other.csv", "nothing of this is read\n")
    loaded, rejects = M.load_with_rejects(M.scan_complaint_records(spark, f"{scratch}/in"))
    got = {(r.reason, r.loaded): r.n for r in rejects.groupBy("reason", "loaded").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("extra_fields", False): 2, ("complaint_id", False): 3, ("date_received", True): 1, ("open_quote", False): 1}
    ids = sorted(r.complaint_id for r in loaded.collect())
    assert ids == sorted([*range(60), 101, 1000])
    records, _ = M.read_records(spark, f"{scratch}/in")
    assert records.count() - 2 == len(ids) + rejects.filter("NOT loaded").count()
    first = loaded.filter("complaint_id = 5").first()
    assert (first["product"], first.company, str(first.date_received)) == ('Loan, or "lease"\nwith text', "ACME, Inc", "2020-01-02")
    assert rejects.filter("reason = 'open_quote'").first().file.endswith("b_complaints.csv")


def test_daily_load_keeps_rejects(spark, scratch):
    from grievance.plans.daily import load_raw_from_csv

    rows = ["01/02/2020,Loan,A,1", "01/03/2020,Loan,B,1", "x,Loan,C,2", "01/03/2020,Loan,D,none"]
    write(f"{scratch}/in/complaints.csv", "\n".join(["Date received,Product,Company,Complaint ID", *rows]))
    raw = load_raw_from_csv(spark, f"{scratch}/in", rejects_path=f"{scratch}/rejects")
    assert sorted((r.complaint_id, r.company) for r in raw.collect()) == [(1, "B"), (2, "C")]
    rejects = spark.read.parquet(f"{scratch}/rejects").collect()
    assert sorted((r.reason, r.value, r.loaded) for r in rejects) == [("complaint_id", "none", False), ("date_received", "x", True)]


def test_no_file_is_an_error(spark, scratch):
    write(f"{scratch}/in/x.txt", "a")
    with pytest.raises(FileNotFoundError):
        M.scan_records(spark, f"{scratch}/in")
