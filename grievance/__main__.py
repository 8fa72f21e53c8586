"""Command line: ``python -m grievance <command> ...``.

Commands
  run        the whole daily run: load, check-raw, build, test, gate (stops on an error-severity failure)
  load       scan CSV extracts (or derive them from benchmark tables) into the raw table
  check-raw  declared VARCHAR lengths and the 14 expectations on the raw table
  build      silver staging, gold dimensions and gold fact from the raw table
  test       the 27 model tests on the built tables
  gate       fact row count against the floor (warn only)
  ingest     pick up newly landed extracts into the bronze table (incremental, exactly once per file)
  report     print one business report from a built warehouse
  quality-history  checks run, failed and warned per stored run

Every step reads what the previous one wrote under ``--output``, so steps can
be scheduled as separate tasks.  Failing checks exit with status 1.
"""

from __future__ import annotations

import argparse
import json
import sys

from grievance.operators import reports as R
from grievance.plans import daily as D
from grievance.plans.daily import load_raw_from_csv, load_raw_from_tables, read_table, run

REPORTS = {
    "complaints_by_product": lambda t: R.complaints_by_product(t("fact_complaints"), t("dim_product")),
    "timely_rate": lambda t: R.timely_rate(t("fact_complaints"), t("dim_product")),
    "dispute_rate": lambda t: R.dispute_rate(t("fact_complaints"), t("dim_product")),
    "geo_concentration": lambda t: R.geo_concentration(t("fact_complaints"), t("dim_geography")),
    "complaints_by_company": lambda t: R.complaints_by_company(t("fact_complaints"), t("dim_company")),
    "complaints_by_year": lambda t: R.complaints_by_year(t("fact_complaints"), t("dim_date")),
    "complaints_by_channel": lambda t: R.complaints_by_channel(t("fact_complaints")),
    "timeliness_distribution": lambda t: R.timeliness_distribution(t("fact_complaints")),
    "response_time": lambda t: R.response_time(t("fact_complaints"), t("dim_product")),
    "monthly_growth": lambda t: R.monthly_growth(t("fact_complaints")),
    "half_year_growth": lambda t: R.half_year_growth(t("fact_complaints")),
}


def _session(input_path: str | None = None):
    """The submission's session; settings that follow from the size of the input are applied unless it set them."""
    from pyspark.sql import SparkSession

    from grievance.session import cluster_conf, input_bytes

    # On a cluster the submission supplies master and resources.
    spark = SparkSession.builder.appName("grievance").getOrCreate()
    if input_path:
        given = {k for k, _ in spark.sparkContext.getConf().getAll()}
        for key, value in cluster_conf(input_bytes(spark, input_path)).items():
            if key.startswith("spark.sql.") and key not in given:
                spark.conf.set(key, value)
    return spark


def _source_args(parser: argparse.ArgumentParser) -> None:
    src = parser.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="folder searched recursively for extracts")
    src.add_argument("--tables", help="folder of benchmark Parquet tables")
    parser.add_argument("--pattern", default="*complaints*.csv")
    parser.add_argument("--single-file", action="store_true", help="expect one matching file; several are an error (default: load all)")
    parser.add_argument("--single-line", action="store_true",
                        help="extracts have no quoted line breaks: read each file in parallel splits")
    parser.add_argument("--rejects", metavar="PATH",
                        help="read every CSV file in splits, quoted line breaks included, and write what was not loaded under PATH")
    parser.add_argument("--id-width", type=int, metavar="N", help="keep raw in parts of N ids; an upsert touches only those it has rows of")
    parser.add_argument("--upsert", action="store_true", help="merge into the existing raw table instead of replacing it")


def _incoming(spark, a):
    raw = (load_raw_from_csv(spark, a.csv, a.pattern, select="single" if a.single_file else "all",
                             multi_line=not a.single_line, rejects_path=a.rejects)
           if a.csv else load_raw_from_tables(spark, a.tables))
    existing = None
    if a.upsert:
        existing = read_table(spark, a.output, "consumer_complaints")
    return raw, existing


def _preview(df, rows: int) -> None:
    """The first rows of a result, and how many were left out."""
    df.show(rows, truncate=False)
    left_out = df.count() - rows
    if left_out > 0:
        _print({"rows_not_shown": left_out})


def _print(obj) -> None:
    print(json.dumps(obj, default=str))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="grievance")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("run", help="the whole daily run")
    _source_args(r)
    r.add_argument("--gate", choices=("raise", "warn"), default="raise")
    r.add_argument("--register", action="store_true", help="register raw/silver/gold tables in the catalog")
    r.add_argument("--resume", action="store_true", help="begin at the step that an earlier run of the same files did not end")
    r.add_argument("--fact-by-month", action="store_true", help="keep the fact in parts by received month")
    r.add_argument("--bucket-raw", type=int, metavar="N",
                   help="write raw as a catalog table in N complaint-id buckets (id checks then need no shuffle)")

    ld = sub.add_parser("load", help="load extracts into the raw table")
    _source_args(ld)
    sub.add_parser("check-raw", help="lengths and expectations on the raw table")
    b = sub.add_parser("build", help="silver and gold from the raw table")
    b.add_argument("--fact-strategy", choices=("auto", "join", "derive"), default="auto")
    b.add_argument("--fact-by-month", action="store_true", help="keep the fact in parts by received month")
    sub.add_parser("test", help="model tests")
    sub.add_parser("gate", help="fact volume gate")
    for name in ("run", "load", "check-raw", "build", "test", "gate"):
        sp = sub.choices[name]
        sp.add_argument("--output", required=True)
        if name in ("run", "check-raw", "test"):
            sp.add_argument("--results", help="folder for check results")
        if name in ("run", "check-raw"):
            sp.add_argument("--suite", help="expectation-suite JSON to use instead of the built-in suite")
            sp.add_argument("--upper-bounds", action="store_true",
                            help="hold the load to the declared largest row count and id too (default: no upper bounds)")
        if name in ("run", "test"):
            sp.add_argument("--schema", action="append",
                            help="schema.yml with column tests to use instead of the built-in ones (repeatable)")

    i = sub.add_parser("ingest", help="incremental landing-folder ingestion")
    i.add_argument("--landing", required=True)
    i.add_argument("--bronze", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--pattern", default="*complaints*.csv")

    rep = sub.add_parser("report", help="a report from a built warehouse: whole to --to, or a preview")
    rep.add_argument("name", choices=sorted(REPORTS))
    rep.add_argument("--output", required=True)
    rep.add_argument("--to", metavar="PATH", help="write the whole report as CSV under PATH")
    rep.add_argument("--rows", type=int, default=50, help="rows of the preview; the rest is counted")

    qh = sub.add_parser("quality-history", help="checks run, failed and warned per stored run")
    qh.add_argument("--results", required=True)
    qh.add_argument("--rows", type=int, default=1000, help="rows of the preview; the rest is counted")

    a = p.parse_args(argv)
    from grievance.operators import quality as Q
    from grievance.sources.checks import model_tests_from_yml, suite_from_json

    suite = suite_from_json(a.suite) if getattr(a, "suite", None) else Q.RAW_SUITE if getattr(a, "upper_bounds", False) else None
    tests = (tuple(t for f in a.schema for t in model_tests_from_yml(f))
             if getattr(a, "schema", None) else Q.MODEL_TESTS)
    spark = _session(getattr(a, "csv", None) or getattr(a, "tables", None) or getattr(a, "landing", None) or getattr(a, "output", None))
    if a.cmd == "run":
        raw, existing = _incoming(spark, a)
        rep_ = run(spark, raw, a.output, existing_raw=existing, length_gate=a.gate, suite_gate=a.gate, tests_gate=a.gate,
                   results_path=a.results, register=a.register, suite=suite, tests=tests, bucket_raw=a.bucket_raw, id_width=a.id_width, fact_by_month=a.fact_by_month, resume=a.resume)
        _print({"run_name": rep_.run_name, "timings": rep_.timings, "load": rep_.load_metrics, "profile": rep_.profile,
                "fact_rows": rep_.fact_rows, "volume": rep_.volume_status, "fact_strategy": rep_.fact_strategy,
                "length_violations": len(rep_.length_violations), "expectations_failed": len(rep_.suite_failed),
                "tests_failed": len(rep_.tests_failed), "tests_warned": len(rep_.tests_warned)})
    elif a.cmd == "load":
        raw, existing = _incoming(spark, a)
        D.load_step(raw, a.output, existing, id_width=a.id_width)
        _print({"loaded": a.output})
    elif a.cmd == "check-raw":
        lengths, rows = D.check_raw_step(spark, a.output, a.results, suite=suite)
        failed = [r for r in rows if not r["success"]]
        _print({"length_violations": lengths, "expectations_failed": failed})
        return 1 if lengths or failed else 0
    elif a.cmd == "build":
        _print({"fact_strategy": D.build_step(spark, a.output, a.fact_strategy, fact_by_month=a.fact_by_month)})
    elif a.cmd == "test":
        rows = D.test_step(spark, a.output, a.results, tests=tests)
        _print({"not_passed": rows})
        return 1 if any(r["status"] == "fail" for r in rows) else 0
    elif a.cmd == "gate":
        _print(D.volume_step(spark, a.output))
    elif a.cmd == "ingest":
        from grievance.streaming import ingest_available

        ingest_available(spark, a.landing, a.bronze, a.checkpoint, a.pattern)
    elif a.cmd == "quality-history":
        _preview(R.quality_history(spark, a.results).orderBy("run_name", "family"), a.rows)
    else:
        report = REPORTS[a.name](lambda n: read_table(spark, a.output, n))
        if a.to:
            report.write.option("header", True).csv(a.to)
            _print({"report": a.name, "written": a.to})
        else:
            _preview(report, a.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
