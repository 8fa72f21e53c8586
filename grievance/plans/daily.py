"""The daily run: load raw -> check raw -> silver -> gold -> model tests -> volume gate.

Each layer is written as Parquet and read back before the next one uses it,
so (a) lineage is cut at every layer and a lost executor only recomputes work
since the last written layer, (b) the written dimensions can be checked for
unique keys before the fact is built (then the fact needs no join at all),
and their real file sizes decide broadcast or sort-merge when it does, and
(c) the four consumers of staging read it once from storage instead of
re-deriving it.  Only check verdicts (one row per check) reach the driver.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.functions.sql_functions import register_rules, register_sql_functions, staging_sql
from grievance.operators import gold as G
from grievance.operators import metrics as M
from grievance.operators import quality as Q
from grievance.operators.raw import keep_last, load_profile, merge_upsert, normalise, varchar_overflow
from grievance.operators.staging import stage_complaints
from grievance.plans.ledger import Ledger, digest, input_fingerprint
from grievance.plans.models import raw_complaints
from grievance.plans.versions import ID_PART, NO_VALUE, WHOLE, VersionedTable, kept_width, merge_increment, with_id_range
from grievance.schemas import RAW_COLUMNS
from grievance.session import shared_path
from grievance.sources.csv import FILE_ORDER, scan_complaints
from grievance.sources.multiline import load_with_rejects, scan_complaint_records

MONTH_PART = G.MONTH_PART
RUN_NAME_FORMAT = "%Y%m%d-%H%M%S-daily-validation"

LAYERS = {
    "consumer_complaints": "raw",
    "stg_complaints": "silver",
    "dim_product": "gold",
    "dim_company": "gold",
    "dim_geography": "gold",
    "dim_date": "gold",
    "fact_complaints": "gold",
}


def table_path(output: str, name: str) -> str:
    return f"{output.rstrip('/')}/{LAYERS[name]}/{name}"


AUDIT_COLUMN = {"consumer_complaints": "loaded_at"}  # every other model: dbt_loaded_at

# Layer namespaces and their descriptions.
LAYER_COMMENTS = {
    "raw": "Bronze layer: complaint records as loaded from the source extract",
    "silver": "Silver layer: cleaned and standardised complaint records",
    "gold": "Gold layer: star schema (dimensions and complaint fact) for analytics",
}


def audit_column(name: str) -> str:
    return AUDIT_COLUMN.get(name, "dbt_loaded_at")


def write_table(df: DataFrame, output: str, name: str, audit: bool = True, part: str | None = None, sort: Sequence[str] = (),
                observed: M.Observed | None = None) -> DataFrame:
    """Full-refresh a layer table (stamped with its load time), then return a
    DataFrame that reads it back without the stamp.

    Every write is a new version (see ``plans.versions``): a failed write
    leaves the table as it was, ``df`` may read the table it replaces, and
    readers switch in one step.  The version before stays for readers that
    have begun; older ones go.  The read-back cuts lineage, so later failures
    recompute from this table only.  ``part`` lays the rows out in parts by
    that column, neighbours in the order of ``sort`` together.  ``observed``
    gathers metrics of the rows on their way.
    """
    col = audit_column(name)
    if audit and col not in df.columns:
        df = df.withColumn(col, F.current_timestamp())
    table = VersionedTable(df.sparkSession, table_path(output, name), part)
    version = table.replace(df, sort, watch=observed and observed.watch)
    table.expire()
    return table.read(version).drop(col)


def stored_table(spark: SparkSession, output: str, name: str) -> VersionedTable:
    """A written layer table, in whatever parts it is kept."""
    table = VersionedTable(spark, table_path(output, name))
    version = table.current()
    table.part = version.part if version else None
    return table


def version_of(spark: SparkSession, output: str, name: str) -> str | None:
    """What tells this state of a layer table from every other one."""
    version = stored_table(spark, output, name).current()
    return f"{version.number}:{digest(version.parts.values())}" if version else None


# Counts and id bitmaps of a raw table in parts, kept by the same parts beside it.
_METRICS, _BITMAPS = "_part_metrics", "_id_bitmaps"


def _beside(spark: SparkSession, output: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{table_path(output, 'consumer_complaints')}{name}", ID_PART)


def update_part_metrics(spark: SparkSession, output: str, suite) -> None:
    """Count the parts of raw that were written since the metrics were; the others' counts stay."""
    raw = stored_table(spark, output, "consumer_complaints")
    version = raw.current()
    wanted = M.raw_metrics(suite, RAW_COLUMNS)
    kind = digest([repr(suite)])
    for name, count in ((_METRICS, lambda df: M.part_metrics(df, ID_PART, wanted)), (_BITMAPS, lambda df: M.id_bitmaps(df, ID_PART))):
        kept = _beside(spark, output, name)
        before = kept.current()
        done = before.note["tokens"] if before and before.note.get("kind") == kind else {}
        changed = sorted(v for v, token in version.parts.items() if done.get(v) != token)
        if changed or set(done) != set(version.parts):
            fresh = count(raw.read(version, parts=[None if v == NO_VALUE else v for v in changed]))
            rest = [v for v in version.parts if v not in changed]
            all_ = kept.read(before, parts=[None if v == NO_VALUE else v for v in rest]).unionByName(fresh) if rest else fresh
            # One small row per part (a few per run of ids), so the table is written whole.
            kept.replace(all_, (ID_PART,), {"kind": kind, "tokens": version.parts})
            kept.expire()


def _kept_metrics(spark: SparkSession, output: str, suite) -> tuple[DataFrame, DataFrame] | None:
    """The kept metrics and bitmaps, if they are those of the raw table as it is now and of this suite."""
    version = stored_table(spark, output, "consumer_complaints").current()
    tables = [_beside(spark, output, name) for name in (_METRICS, _BITMAPS)]
    for table in tables:
        kept = table.current()
        if not (version and kept) or kept.note != {"kind": digest([repr(suite)]), "tokens": version.parts}:
            return None
    return tables[0].read(), tables[1].read()


def register_catalog(spark: SparkSession, output: str) -> None:
    """Expose the written layers as ``raw.*``, ``silver.*`` and ``gold.*`` tables, and the rule functions to SQL.

    Only tables that an earlier run registered are replaced; another table of the name is an error.
    """
    for name, layer in LAYERS.items():
        if spark.catalog.tableExists(f"{layer}.{name}") and OWNER_PROPERTY not in _properties(spark, f"{layer}.{name}"):
            raise RuntimeError(f"table {layer}.{name} exists and was not made by a run; it is left as it is")
    for layer, comment in LAYER_COMMENTS.items():
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {layer} COMMENT '{comment}' LOCATION '{output.rstrip('/')}/{layer}'"
        )
    for name, layer in LAYERS.items():
        if name == "consumer_complaints" and _bucketed_raw(spark, output) is not None:
            continue  # already a (bucketed) catalog table for this output
        if name != "stg_complaints":
            _switch(spark, f"{layer}.{name}", stored_table(spark, output, name), output.rstrip("/"))
    register_rules(spark, "silver")
    register_staging_view(spark, output)
    register_sql_functions(spark)


def register_staging_view(spark: SparkSession, output: str) -> None:
    """``silver.stg_complaints`` as a view over ``raw.consumer_complaints``: nothing is stored, every session sees it."""
    name = "silver.stg_complaints"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{OWNER_PROPERTY}' = '{output.rstrip('/')}') AS {staging_sql('raw.consumer_complaints')}"
    )


def _switch(spark: SparkSession, name: str, table: VersionedTable, owner: str) -> None:
    """Let the catalog table ``name`` show the newest version: one step for readers where the table is there already."""
    version = table.current()
    folders = table.folders(version)
    if table.part is None and len(folders) == 1 and spark.catalog.tableExists(name) and not _properties(spark, name).get(PARTS_PROPERTY):
        if spark.table(name).schema.names == table.read(version).schema.names:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folders[WHOLE]}'")
            spark.catalog.refreshTable(name)
            return
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.read(version).schema.fields)
    parts = f"PARTITIONED BY ({table.part})" if table.part else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet {parts} LOCATION '{folders.get(WHOLE, table.path)}' "
        f"TBLPROPERTIES ('{OWNER_PROPERTY}' = '{owner}', '{PARTS_PROPERTY}' = '{table.part or ''}')"
    )
    if table.part:
        places = " ".join(f"PARTITION ({table.part}={'NULL' if v == NO_VALUE else repr(v)}) LOCATION '{f}'" for v, f in folders.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")


OWNER_PROPERTY, PARTS_PROPERTY = "grievance.output", "grievance.parts"


def _bucketed_raw(spark: SparkSession, output: str) -> DataFrame | None:
    """The raw table as a bucketed catalog table, if this session wrote one for ``output``."""
    name = "raw.consumer_complaints"
    if not spark.catalog.tableExists(name):
        return None
    ours = _properties(spark, name).get(OWNER_PROPERTY) == output.rstrip("/")
    return spark.table(name) if ours and _bucketed(spark, name) else None


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _bucketed(spark: SparkSession, name: str) -> bool:
    return any(c.isBucket for c in spark.catalog.listColumns(name))


def write_bucketed_raw(df: DataFrame, output: str, buckets: int) -> DataFrame:
    """Write raw at its usual path as an external catalog table bucketed by complaint id.

    Keep-last has already hash-partitioned the rows by id, so the write adds
    no shuffle.  Readers through the catalog (``read_table`` in this session)
    get bucketed scans: grouping or joining on the id needs no shuffle.  Readers
    by path see plain Parquet files.
    """
    spark = df.sparkSession
    if AUDIT_COLUMN["consumer_complaints"] not in df.columns:
        df = df.withColumn(AUDIT_COLUMN["consumer_complaints"], F.current_timestamp())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw COMMENT '{LAYER_COMMENTS['raw']}' LOCATION '{output.rstrip('/')}/raw'")
    (
        df.write.mode("overwrite").format("parquet").bucketBy(buckets, "complaint_id")
        .option("path", table_path(output, "consumer_complaints")).saveAsTable("raw.consumer_complaints")
    )
    spark.sql(f"ALTER TABLE raw.consumer_complaints SET TBLPROPERTIES ('{OWNER_PROPERTY}' = '{output.rstrip('/')}')")
    return spark.table("raw.consumer_complaints").drop(AUDIT_COLUMN["consumer_complaints"])


def read_table(spark: SparkSession, output: str, name: str) -> DataFrame:
    if name == "consumer_complaints":
        bucketed = _bucketed_raw(spark, output)
        if bucketed is not None:
            return bucketed
    table = stored_table(spark, output, name)
    return table.read() if table.current() else spark.read.parquet(table.path)  # a bucketed table seen by its path


@dataclass
class RunReport:
    run_name: str
    timings: dict[str, float] = field(default_factory=dict)
    raw_rows: int | None = None
    fact_rows: int | None = None
    length_violations: list[dict] = field(default_factory=list)
    suite_failed: list[dict] = field(default_factory=list)
    tests_failed: list[dict] = field(default_factory=list)
    tests_warned: list[dict] = field(default_factory=list)
    volume_status: str | None = None
    fact_strategy: str | None = None
    raw_files: int | None = None
    profile: dict = field(default_factory=dict)

    @property
    def load_metrics(self) -> dict:
        """Records loaded, write tasks (the files of the raw table, Spark's "batches"),
        duration of the raw load and its throughput (rows/s)."""
        sec = self.timings.get("raw") or 0.0
        return {
            "records": self.raw_rows,
            "batches": self.raw_files,
            "duration_sec": sec,
            "rows_per_sec": round(self.raw_rows / sec, 1) if self.raw_rows and sec else None,
        }


class _Clock:
    def __init__(self, report: RunReport):
        self.report = report

    def __call__(self, name: str):
        clock = self

        class _T:
            def __enter__(self):
                self.t = time.perf_counter()

            def __exit__(self, *exc):
                clock.report.timings[name] = round(time.perf_counter() - self.t, 3)

        return _T()


def _stored(spark: SparkSession, results: DataFrame, path: str, run_name: str) -> DataFrame:
    """Append check results for this run, then read them back (computed once)."""
    Q.store_results(results, path, run_name)
    return spark.read.parquet(f"{path}/run_name={run_name}")


def load_raw_from_csv(spark: SparkSession, base_path: str, pattern: str = "*complaints*.csv",
                      select: str = "all", multi_line: bool = True, rejects_path: str | None = None) -> DataFrame:
    """Scan and normalise CSV extracts; keep the last record per complaint id by file position.

    With ``rejects_path`` every file is read in byte-range splits, quoted line
    breaks included, and what could not be loaded (or was loaded with a loss)
    is written there, with file, position and reason.
    """
    if rejects_path:
        if select != "all" or not multi_line:
            raise ValueError("rejects_path reads all files, with quoted line breaks")
        loaded, rejects = load_with_rejects(scan_complaint_records(spark, base_path, pattern))
        rejects.write.mode("overwrite").parquet(rejects_path)
        return keep_last(loaded, "complaint_id", FILE_ORDER)
    scanned = scan_complaints(spark, base_path, pattern, select=select, multi_line=multi_line)
    return keep_last(normalise(scanned, keep=FILE_ORDER), "complaint_id", FILE_ORDER)


def load_raw_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw complaint load derived from the benchmark tables (see ``sources.fixture``)."""
    return raw_complaints(spark, sf_dir)


# --------------------------------------------------------------------- steps
# Each step reads what the previous one wrote under ``output``, so every step
# can also run on its own (as separate scheduled tasks would).


def load_step(raw: DataFrame, output: str, existing_raw: DataFrame | None = None,
              bucket_raw: int | None = None, id_width: int | None = None, observed: M.Observed | None = None) -> DataFrame:
    """Write the raw table: full refresh, or an upsert into ``existing_raw``
    (incoming rows win; untouched rows keep their load stamp).

    For an upsert the increment is written to the shared folder first, so the
    planner knows its real size: a daily increment is then broadcast into the
    anti-join and the (large) existing table is only scanned, never shuffled.
    A large increment gets a sort-merge join instead.  ``bucket_raw`` writes
    raw as a catalog table bucketed by id (see ``write_bucketed_raw``).
    ``id_width`` keeps raw in parts of so many ids: an upsert into the table
    under ``output`` then reads and writes only the parts it has rows of.
    ``observed`` gathers metrics of all rows while they are written (not of a
    table in parts, see ``update_part_metrics``).
    """
    stamped = raw.withColumn("loaded_at", F.current_timestamp())
    table = VersionedTable(raw.sparkSession, table_path(output, "consumer_complaints"), ID_PART)
    if existing_raw is not None:
        id_width = kept_width(table, id_width)
    if id_width:
        rows, order, note = with_id_range(stamped, width=id_width), (ID_PART, "complaint_id"), {"id_width": id_width}
        if existing_raw is None:
            version = table.replace(rows, order, note)
        elif table.current() is None or table.current().part != ID_PART:
            version = table.replace(merge_upsert(with_id_range(existing_raw, width=id_width), rows), order, note)
        else:
            version = merge_increment(table, rows)
        table.expire()
        return table.read(version).drop("loaded_at")
    if existing_raw is None:
        incoming = stamped
    else:
        spark = raw.sparkSession
        inc_path = shared_path(spark, "raw-increment")
        stamped.write.parquet(inc_path)
        incoming = merge_upsert(existing_raw, spark.read.parquet(inc_path))
        if bucket_raw:  # a bucketed table is overwritten in place, so the merge is finished first
            merged = shared_path(spark, "raw-merged")
            incoming.write.parquet(merged)
            incoming = spark.read.parquet(merged)
    if bucket_raw:
        return write_bucketed_raw(observed.watch(incoming) if observed else incoming, output, bucket_raw)
    return write_table(incoming, output, "consumer_complaints", observed=observed)


def check_raw_step(spark: SparkSession, output: str, results_path: str | None = None,
                   run_name: str | None = None, suite=None, observed: M.Observed | None = None) -> tuple[list[dict], list[dict]]:
    """Declared VARCHAR lengths and the expectation suite on the raw table.

    Returns (length violations, one row per expectation).  With ``observed``
    (the load's metrics), or for a table in parts, raw is read for the
    uniqueness of its ids only - in parts, not even for that.  With
    ``results_path`` the most frequent values that failed are stored too.  The
    default suite has no upper bounds (``Q.RAW_SUITE`` has: pass it to hold a
    load to the declared largest row count and id).
    """
    suite = Q.without_upper_bounds() if suite is None else suite
    run_name = run_name or _run_name()
    raw_t = read_table(spark, output, "consumer_complaints")
    metrics = unique = None
    if stored_table(spark, output, "consumer_complaints").part == ID_PART:
        update_part_metrics(spark, output, suite)
        by_part, bitmaps = _kept_metrics(spark, output, suite)
        metrics = M.total_metrics(by_part, M.raw_metrics(suite, RAW_COLUMNS))
        unique = {"complaint_id": M.unique_counts_by_bitmap(raw_t, bitmaps)}
    elif observed:
        metrics = observed.row(spark)
    results = Q.run_suite(raw_t, suite, metrics, unique)
    if results_path:
        results = _stored(spark, results, f"{results_path}/expectations", run_name)
    with ThreadPoolExecutor(max_workers=2) as pool:
        lengths = pool.submit(lambda: [r.asDict() for r in varchar_overflow(raw_t, metrics=metrics).filter("violations > 0").collect()])
        rows = pool.submit(lambda: [r.asDict() for r in results.collect()])
        lengths, rows = lengths.result(), rows.result()
    failed = [r["expectation_index"] for r in rows if r["unexpected_count"]]
    if results_path and failed:
        Q.store_results(Q.failing_values(raw_t, suite, only=failed), f"{results_path}/failing_values", run_name)
    return lengths, rows


def build_step(spark: SparkSession, output: str, fact_strategy: str = "auto",
               timings: dict[str, float] | None = None, fact_by_month: bool = False, ledger: Ledger | None = None) -> str:
    """raw -> silver staging -> gold dimensions -> gold fact.  Returns the fact path used.

    ``fact_by_month`` lays the fact out in parts by received month, which
    time-bounded questions need not read.  With ``ledger`` the steps that are
    whole for these very inputs are left out; they have no timing then.
    """
    timings = {} if timings is None else timings
    raw_in = {"raw": version_of(spark, output, "consumer_complaints")}
    silver = {"silver": version_of(spark, output, "stg_complaints")}
    t = time.perf_counter()
    if ledger and ledger.whole("silver", raw_in, silver):
        stg = read_table(spark, output, "stg_complaints").drop("dbt_loaded_at")
    else:
        stg = write_table(stage_complaints(read_table(spark, output, "consumer_complaints")), output, "stg_complaints")
        silver = {"silver": version_of(spark, output, "stg_complaints")}
        if ledger:
            ledger.record("silver", raw_in, silver)
        timings["silver"] = round(time.perf_counter() - t, 3)

    t = time.perf_counter()
    # Independent jobs: submit them together so small dimensions share the cluster.
    builds = {"dim_product": G.dim_product(stg), "dim_company": G.dim_company(stg),
              "dim_geography": G.dim_geography(stg), "dim_date": G.dim_date(spark)}
    if ledger and ledger.whole("gold_dims", silver, {n: version_of(spark, output, n) for n in builds}):
        dp, dc, dg, _ = (read_table(spark, output, n).drop("dbt_loaded_at") for n in builds)
    else:
        with ThreadPoolExecutor(max_workers=len(builds)) as pool:
            futures = {n: pool.submit(write_table, df, output, n) for n, df in builds.items()}
            dp, dc, dg, _ = (futures[n].result() for n in builds)
        if ledger:
            ledger.record("gold_dims", silver, {n: version_of(spark, output, n) for n in builds})
        timings["gold_dims"] = round(time.perf_counter() - t, 3)

    t = time.perf_counter()
    strategy = fact_strategy
    if strategy == "auto":
        # Join elimination is exact when every dimension key is unique: the
        # dimensions were built from this staging, so each row's key is present
        # exactly once.  Verified on the written (small) dimensions in one job.
        strategy = G.choose_fact_strategy(dp, dc, dg)
    fact_in = {**silver, "strategy": strategy, "by_month": fact_by_month, **{n: version_of(spark, output, n) for n in builds}}
    if ledger and ledger.whole("gold_fact", fact_in, {"fact": version_of(spark, output, "fact_complaints")}):
        return strategy
    fact = G.fact_complaints(stg, dp, dc, dg, strategy=strategy)
    if fact_by_month:
        write_table(G.with_month(fact), output, "fact_complaints", part=MONTH_PART, sort=(MONTH_PART, "complaint_id"))
    else:
        write_table(fact, output, "fact_complaints")
    if ledger:
        ledger.record("gold_fact", fact_in, {"fact": version_of(spark, output, "fact_complaints")})
    timings["gold_fact"] = round(time.perf_counter() - t, 3)
    return strategy


def test_step(spark: SparkSession, output: str, results_path: str | None = None,
              run_name: str | None = None, tests=Q.MODEL_TESTS, known: dict[str, int] | None = None) -> list[dict]:
    """Model tests (default: the 27) over the written tables; returns the rows that did not pass.

    ``known``: failures that the same run has counted before (see ``quality.known_failures``).
    """
    used = {t.model for t in tests} | {t.to_model for t in tests if t.to_model}
    tests = Q.run_tests({n: read_table(spark, output, n) for n in used}, tests, known)
    if results_path:
        tests = _stored(spark, tests, f"{results_path}/tests", run_name or _run_name())
    return [r.asDict() for r in tests.filter(F.col("status") != "pass").collect()]


def volume_step(spark: SparkSession, output: str) -> dict:
    """Row count of the fact against the floor (warn only)."""
    return Q.volume_gate(read_table(spark, output, "fact_complaints")).first().asDict()


class _Writing:
    """A ledger that is written but not believed."""

    def __init__(self, ledger: Ledger):
        self.record = ledger.record

    def whole(self, *_) -> bool:
        return False


def _run_name() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime(RUN_NAME_FORMAT)


def run(spark: SparkSession, raw: DataFrame, output: str, *, existing_raw: DataFrame | None = None,
        suite_gate: str = "raise", tests_gate: str = "raise", length_gate: str = "raise", fact_strategy: str = "auto",
        results_path: str | None = None, run_name: str | None = None, register: bool = False,
        suite=None, tests=Q.MODEL_TESTS, bucket_raw: int | None = None, id_width: int | None = None, fact_by_month: bool = False,
        resume: bool = False) -> RunReport:
    """The whole daily run: load, check raw, build, test, volume gate.

    ``raw`` is the incoming load (one row per complaint id).  With
    ``existing_raw`` the load is an upsert (incoming rows win), otherwise a
    full refresh; ``existing_raw`` may be the raw table under ``output``
    itself, which is replaced only when the merged table is whole.  ``length_gate`` / ``suite_gate`` / ``tests_gate``:
    ``"raise"`` stops the run on a value longer than its declared VARCHAR
    length (the raw table would reject it) / a failed expectation / an
    error-severity test, as the daily schedule does; ``"warn"`` records and
    continues.  ``fact_strategy``: ``"join"`` (dimension lookups),
    ``"derive"`` (join elimination) or ``"auto"`` (derive when the written
    dimensions have unique keys, else join).  ``bucket_raw=n`` writes raw as
    a catalog table in ``n`` id buckets, so the id checks later in this run
    read co-located buckets without a shuffle.  ``id_width=n`` keeps raw in
    parts of ``n`` ids, of which an upsert touches only those it has rows of;
    ``fact_by_month`` keeps the fact in parts by received month.

    ``resume`` begins at the step that an earlier run of the same input did
    not end: raw is not loaded again if the same files made its newest version,
    and silver and gold steps are left out while their inputs are the same.
    Checks and tests always run.
    """
    run_name = run_name or _run_name()
    report = RunReport(run_name)
    clock = _Clock(report)

    ledger = Ledger(spark, output)
    observed = None
    source = {"files": input_fingerprint(raw), "mode": "upsert" if existing_raw is not None else "replace"}
    if not (resume and ledger.whole("raw", source, {"raw": version_of(spark, output, "consumer_complaints")})):
        observed = M.Observed(M.raw_metrics(Q.without_upper_bounds() if suite is None else suite, RAW_COLUMNS)) if not id_width else None
        with clock("raw"):
            # The file listing of the written table (metadata only, no data read).
            report.raw_files = len(load_step(raw, output, existing_raw, bucket_raw, id_width, observed).inputFiles())
            ledger.record("raw", source, {"raw": version_of(spark, output, "consumer_complaints")})
    if stored_table(spark, output, "consumer_complaints").part:
        observed = None  # a merge writes some of the rows only

    with clock("raw_checks"):
        report.length_violations, suite_rows = check_raw_step(spark, output, results_path, run_name, suite, observed)
        report.suite_failed = [r for r in suite_rows if not r["success"]]
        report.raw_rows = next(
            (r["observed_value"] for r in suite_rows if r["expectation_type"].endswith("row_count_to_be_between")), None
        )
    if report.length_violations and length_gate == "raise":
        raise Q.QualityGateError(f"values longer than their declared length: {report.length_violations}")
    if report.suite_failed and suite_gate == "raise":
        raise Q.QualityGateError(f"expectation suite failed: {report.suite_failed}")

    with clock("profile"):
        metrics = observed.row(spark) if observed else None
        report.profile = load_profile(read_table(spark, output, "consumer_complaints"), metrics).first().asDict()

    report.fact_strategy = build_step(spark, output, fact_strategy, report.timings, fact_by_month, ledger if resume else _Writing(ledger))

    # What the suite and the choice of the fact's path have counted on these very tables is not counted again.
    checked = fact_strategy == "auto" and report.fact_strategy == "derive"
    keys = [("dim_product", "product_sk"), ("dim_company", "company_sk"), ("dim_geography", "geography_sk")] if checked else []
    known = Q.known_failures(tests, Q.without_upper_bounds() if suite is None else suite, suite_rows, unique_keys=keys)
    with clock("tests"):
        rows = test_step(spark, output, results_path, run_name, tests, known)
        report.tests_failed = [r for r in rows if r["status"] == "fail"]
        report.tests_warned = [r for r in rows if r["status"] == "warn"]
    if report.tests_failed and tests_gate == "raise":
        raise Q.QualityGateError(f"model tests failed: {report.tests_failed}")

    with clock("volume_gate"):
        gate = volume_step(spark, output)
        report.fact_rows, report.volume_status = gate["n_rows"], gate["status"]
    if register:
        register_catalog(spark, output)
    return report
