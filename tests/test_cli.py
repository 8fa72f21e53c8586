"""The command line, step by step, in a separate process."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cli(*args, timeout=600):
    proc = subprocess.run([sys.executable, "-m", "grievance", *args], cwd=REPO, capture_output=True, text=True,
                          timeout=timeout)
    out = [x for x in proc.stdout.splitlines() if x.startswith("{")]
    return proc.returncode, (json.loads(out[-1]) if out else None), proc.stderr


def test_steps(sf_small, scratch):
    wh = f"{scratch}/wh"
    code, out, err = _cli("load", "--tables", sf_small, "--output", wh)
    assert code == 0, err[-2000:]
    code, out, _ = _cli("check-raw", "--output", wh)
    assert code == 1 and out["length_violations"][0]["column_name"] == "state"  # failing checks exit 1
    code, out, _ = _cli("build", "--output", wh)
    assert code == 0 and out == {"fact_strategy": "derive"}
    code, out, _ = _cli("test", "--output", wh)
    assert code == 1 and any(r["status"] == "warn" for r in out["not_passed"])
    code, out, _ = _cli("gate", "--output", wh)
    assert code == 0 and out == {"n_rows": 4380, "min_rows": 100000, "status": "warn"}


def test_loads_by_parts_with_rejects(spark, scratch):
    from grievance.plans.daily import read_table

    header = "Date received,Product,Company,State,Timely response?,Complaint ID"
    days = [f"2020-0{m}-1{d}" for m in (1, 2, 3) for d in range(5)]
    files = {
        "a": [*[f'{d},"Loan\nlong",Acme,NY,Yes,{i}' for i, d in enumerate(days, 1)], "2020-01-01,Loan,Acme,NY,Yes,none"],
        "b": ["2020-04-01,Card,Acme,NY,No,15", "2020-04-02,Card,Acme,NY,No,100,extra", "2020-04-02,Card,Acme,NY,No,101"],
    }
    for name, lines in files.items():
        os.makedirs(f"{scratch}/{name}")
        with open(f"{scratch}/{name}/complaints.csv", "w") as f:
            f.write("\n".join([header, *lines]) + "\n")
    run = ["run", "--output", f"{scratch}/wh", "--gate", "warn", "--rejects", f"{scratch}/rejects", "--id-width", "10", "--fact-by-month"]
    code, _, err = _cli(*run, "--csv", f"{scratch}/a")
    assert code == 0, err[-2000:]
    assert [r.reason for r in spark.read.parquet(f"{scratch}/rejects").collect()] == ["complaint_id"]
    code, _, err = _cli(*run, "--csv", f"{scratch}/b", "--upsert", "--resume")
    assert code == 0, err[-2000:]
    spark.catalog.refreshByPath(f"{scratch}/rejects")
    assert [r.reason for r in spark.read.parquet(f"{scratch}/rejects").collect()] == ["extra_fields"]
    raw = read_table(spark, f"{scratch}/wh", "consumer_complaints")
    assert raw.count() == 16 and raw.filter("product = 'Card'").count() == 2 and {r.id_range for r in raw.collect()} == {0, 1, 10}
    assert read_table(spark, f"{scratch}/wh", "fact_complaints").select("received_month").distinct().count() == 4
