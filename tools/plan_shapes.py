"""Print the operator counts of each daily-run stage's physical plan (README table).

    python tools/plan_shapes.py [/root/testdata/sf0.1]

Builds the warehouse once under the session's shared folder, then runs
``explain()`` (no execution) on each stage reading the written tables.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grievance.operators import gold as G  # noqa: E402
from grievance.operators import quality as Q  # noqa: E402
from grievance.operators import reports as R  # noqa: E402
from grievance.operators.staging import stage_complaints  # noqa: E402
from grievance.plans.daily import load_raw_from_csv, load_raw_from_tables, read_table, run  # noqa: E402
from grievance.session import build_session, shared_path  # noqa: E402
from grievance.sources.csv import write_complaints_csv  # noqa: E402
from grievance.sources.fixture import fixture_complaints, fixture_text  # noqa: E402

COLUMNS = (
    ("scans", lambda p: p.count("FileScan")),
    ("hash shuffles", lambda p: p.count("Exchange hashpartitioning")),
    ("single-partition shuffles", lambda p: p.count("Exchange SinglePartition")),
    ("broadcast joins", lambda p: p.count("BroadcastHashJoin")),
    ("sort-merge joins", lambda p: p.count("SortMergeJoin")),
    ("aggregate operators", lambda p: len(re.findall(r"(?<!Object)HashAggregate\(|ObjectHashAggregate\(", p))),
    ("window group limits", lambda p: p.count("WindowGroupLimit")),
)


def physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main(sf_dir: str) -> None:
    spark = build_session(8)
    out = shared_path(spark, "plan-shapes")
    run(spark, load_raw_from_tables(spark, sf_dir), out, length_gate="warn", suite_gate="warn", tests_gate="warn")
    t = lambda n: read_table(spark, out, n)
    write_complaints_csv(fixture_text(fixture_complaints(spark, sf_dir, with_order=False)).repartition(4),
                         f"{out}/landing/complaints.csv")
    dims = (t("dim_product"), t("dim_company"), t("dim_geography"))
    models = {n: t(n) for n in ("consumer_complaints", "dim_product", "dim_company", "dim_geography", "dim_date",
                                "fact_complaints")}
    stages = {
        "csv ingest (scan, normalise, keep-last)": load_raw_from_csv(spark, f"{out}/landing", "*.csv", "all"),
        "raw from tables (5 joins, keep-last)": load_raw_from_tables(spark, sf_dir),
        "expectation suite (14)": Q.run_suite(t("consumer_complaints")),
        "silver staging": stage_complaints(t("consumer_complaints")),
        "dim_product": G.dim_product(t("stg_complaints")),
        "fact, lookup-join path (3 dimension joins)": G.fact_complaints(t("stg_complaints"), *dims),
        "fact, join elimination": G.fact_complaints(t("stg_complaints"), strategy="derive"),
        "dimension key check": Q.duplicated_keys({"p": (dims[0], "product_sk"), "c": (dims[1], "company_sk"),
                                                  "g": (dims[2], "geography_sk")}).limit(1),
        "model tests (27)": Q.run_tests(models),
        "R1 complaints_by_product": R.complaints_by_product(t("fact_complaints"), dims[0]),
        "R4 geo_concentration": R.geo_concentration(t("fact_complaints"), dims[2]),
        "R6 top-10 companies": R.complaints_by_company(t("fact_complaints"), dims[1], top=10),
        "R7 response_time": R.response_time(t("fact_complaints"), dims[0]),
    }
    print("| stage | " + " | ".join(c for c, _ in COLUMNS) + " |")
    print("|---|" + "---|" * len(COLUMNS))
    for name, df in stages.items():
        p = physical_plan(df)
        print(f"| {name} | " + " | ".join(str(f(p)) for _, f in COLUMNS) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
