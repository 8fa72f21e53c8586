"""Declarative data-quality checks evaluated as Spark aggregations.

Two families:

* **expectations** on the raw table, each with a ``mostly`` tolerance
  (row count range, column presence, not-null, unique, value set, range);
* **tests** on any model (not_null, unique, accepted_values, relationships
  and singular row predicates), each with a severity (``error`` fails the
  run, ``warn`` only reports).

All null-count and row-predicate checks of one table are computed in a
single aggregate pass; each uniqueness or accepted-values check is one
``groupBy`` (partially aggregated before the shuffle, so a hot key costs one
row per partition); each relationship is one left-anti equi-join.  Results
are small DataFrames, one row per check, so nothing but the verdict ever
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grievance.schemas import (
    ACCEPTED_QUARTERS,
    ACCEPTED_REGIONS,
    ACCEPTED_SUBMITTED_VIA,
    ACCEPTED_TIMELINESS,
    FACT_MIN_ROWS,
    TIMELY_THRESHOLD_DAYS,
)

# ============================================================ expectations


@dataclass(frozen=True)
class Expectation:
    kind: str  # row_count_between | column_exists | not_null | unique | in_set | between
    column: str | None = None
    mostly: float = 1.0
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = ()

    @property
    def type_name(self) -> str:
        return {
            "row_count_between": "expect_table_row_count_to_be_between",
            "column_exists": "expect_column_to_exist",
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "in_set": "expect_column_values_to_be_in_set",
            "between": "expect_column_values_to_be_between",
        }[self.kind]


# The raw-table expectation suite, in its declared order.
RAW_SUITE: tuple[Expectation, ...] = (
    Expectation("row_count_between", min_value=1000, max_value=10000000),
    Expectation("column_exists", "complaint_id"),
    Expectation("not_null", "complaint_id", mostly=1.0),
    Expectation("unique", "complaint_id", mostly=0.99),
    Expectation("column_exists", "date_received"),
    Expectation("not_null", "date_received", mostly=0.99),
    Expectation("column_exists", "product"),
    Expectation("not_null", "product", mostly=0.99),
    Expectation("column_exists", "company"),
    Expectation("not_null", "company", mostly=0.95),
    Expectation("column_exists", "state"),
    Expectation("column_exists", "timely_response"),
    Expectation("in_set", "timely_response", mostly=0.95, value_set=("Yes", "No", None)),
    Expectation("between", "complaint_id", mostly=0.99, min_value=1, max_value=99999999),
)



def without_upper_bounds(suite: Sequence[Expectation] = RAW_SUITE) -> tuple[Expectation, ...]:
    """The suite without its largest row count and largest id: a load is not wrong for being large."""
    return tuple(replace(e, max_value=None) if e.kind in ("row_count_between", "between") else e for e in suite)


SUITE_SCHEMA = T.StructType([
    T.StructField("expectation_index", T.IntegerType()),
    T.StructField("expectation_type", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("observed_value", T.LongType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("unexpected_percent", T.DoubleType()),
    T.StructField("mostly", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
])


def _mostly_ok(elements: Column, unexpected: Column, mostly: float) -> Column:
    # No rows to judge -> success.  Otherwise the share of expected values must reach ``mostly``.
    return F.when(elements == 0, F.lit(True)).otherwise(
        (elements - unexpected).cast("double") / elements.cast("double") >= F.lit(float(mostly))
    )


def _pct(unexpected: Column, elements: Column) -> Column:
    return F.round(F.try_divide(unexpected.cast("double") * 100.0, elements.cast("double")), 6)


def _row(idx: int, e: Expectation, observed=None, elements=None, unexpected=None, success=None) -> Column:
    nul = F.lit(None)
    el = elements if elements is not None else nul
    un = unexpected if unexpected is not None else nul
    pct = _pct(unexpected, elements) if (elements is not None and unexpected is not None) else nul
    return F.struct(
        F.lit(idx).cast("int").alias("expectation_index"),
        F.lit(e.type_name).alias("expectation_type"),
        F.lit(e.column).cast("string").alias("column_name"),
        (observed if observed is not None else nul).cast("bigint").alias("observed_value"),
        el.cast("bigint").alias("element_count"),
        un.cast("bigint").alias("unexpected_count"),
        pct.cast("double").alias("unexpected_percent"),
        F.lit(float(e.mostly)).alias("mostly"),
        (success if success is not None else F.lit(False)).alias("success"),
    )


def _outside(c: Column, e: Expectation) -> Column:
    below = c < F.lit(e.min_value) if e.min_value is not None else F.lit(False)
    return below if e.max_value is None else below | (c > F.lit(e.max_value))


def suite_metrics(suite: Sequence[Expectation], columns: Sequence[str]) -> dict[str, Column]:
    """The counts that decide ``suite`` (but for uniqueness), by name; counts of parts of a table add up."""
    metrics: dict[str, Column] = {"n_rows": F.count(F.lit(1))}
    for i, e in enumerate(suite, 1):
        if e.column not in columns:
            continue
        c = F.col(e.column)
        if e.kind in ("not_null", "in_set", "between"):
            metrics[f"known_{i}"] = F.count(c)
        if e.kind == "in_set":
            allowed = [v for v in e.value_set if v is not None]
            metrics[f"unexpected_{i}"] = F.count(F.when(c.isNotNull() & ~c.isin(*allowed), 1))
        elif e.kind == "between":
            metrics[f"unexpected_{i}"] = F.count(F.when(_outside(c, e), 1))
    return metrics


def run_suite(df: DataFrame, suite: Sequence[Expectation] = RAW_SUITE, metrics: DataFrame | None = None,
              unique: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate ``suite`` on ``df``: one row per expectation (``SUITE_SCHEMA``).

    ``metrics`` is the row of ``suite_metrics`` where it is known already (from
    the pass that wrote the table): then ``df`` is read for uniqueness only, and
    not even for that where ``unique`` has the column's ``unique_counts``.
    """
    cols = set(df.columns)
    one = metrics if metrics is not None else df.agg(*[m.alias(name) for name, m in suite_metrics(suite, df.columns).items()])

    n = F.col("n_rows")
    rows: list[Column] = []
    unique_parts: list[DataFrame] = []
    for i, e in enumerate(suite, 1):
        present = e.column in cols
        if e.kind == "row_count_between":
            ok = F.lit(True)
            if e.min_value is not None:
                ok = ok & (n >= F.lit(e.min_value))
            if e.max_value is not None:
                ok = ok & (n <= F.lit(e.max_value))
            rows.append(_row(i, e, observed=n, elements=None, success=ok))
        elif e.kind == "column_exists":
            rows.append(_row(i, e, observed=F.lit(1 if present else 0), success=F.lit(present)))
        elif not present:
            rows.append(_row(i, e, success=F.lit(False)))
        elif e.kind == "not_null":
            un = n - F.col(f"known_{i}")
            rows.append(_row(i, e, elements=n, unexpected=un, success=_mostly_ok(n, un, e.mostly)))
        elif e.kind in ("in_set", "between"):
            el, un = F.col(f"known_{i}"), F.col(f"unexpected_{i}")
            rows.append(_row(i, e, elements=el, unexpected=un, success=_mostly_ok(el, un, e.mostly)))
        elif e.kind == "unique":
            counts = (unique or {}).get(e.column)
            unique_parts.append(_unique_expectation(unique_counts(df, e.column) if counts is None else counts, i, e))
    out = one.select(F.inline(F.array(*rows)))
    return reduce(DataFrame.unionByName, unique_parts, out)


def unique_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: rows with a value (``el``), and rows whose value occurs more than once (``un``)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("k"))
    return counts.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("el"),
        F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("un"),
    )


def _unique_expectation(counts: DataFrame, idx: int, e: Expectation) -> DataFrame:
    """Every row whose value occurs more than once is unexpected; NULLs are ignored."""
    el, un = F.col("el"), F.col("un")
    return counts.select(F.inline(F.array(_row(idx, e, elements=el, unexpected=un, success=_mostly_ok(el, un, e.mostly)))))


# =================================================================== tests


@dataclass(frozen=True)
class ModelTest:
    model: str
    kind: str  # not_null | unique | accepted_values | relationships | singular
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None
    name: str | None = None
    predicate: Callable[[], Column] | None = field(default=None, compare=False)

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        return f"{self.kind}_{self.model}_{self.column}"


def _date_logic() -> Column:
    return F.col("date_sent_to_company") < F.col("date_received")


def _timely_accuracy() -> Column:
    d, f = F.col("response_days"), F.col("timely_response_flag")
    t = TIMELY_THRESHOLD_DAYS
    return ((d <= t) & (f == F.lit(False))) | ((d > t) & (f == F.lit(True)))


# The 27 model tests (5 on the raw source, 20 generic on gold, 2 singular).
MODEL_TESTS: tuple[ModelTest, ...] = (
    ModelTest("consumer_complaints", "unique", "complaint_id", name="source_unique_raw_consumer_complaints_complaint_id"),
    ModelTest("consumer_complaints", "not_null", "complaint_id", name="source_not_null_raw_consumer_complaints_complaint_id"),
    ModelTest("consumer_complaints", "not_null", "date_received", name="source_not_null_raw_consumer_complaints_date_received"),
    ModelTest("consumer_complaints", "not_null", "product", name="source_not_null_raw_consumer_complaints_product"),
    ModelTest("consumer_complaints", "not_null", "company", name="source_not_null_raw_consumer_complaints_company"),
    ModelTest("fact_complaints", "unique", "complaint_sk"),
    ModelTest("fact_complaints", "not_null", "complaint_sk"),
    ModelTest("fact_complaints", "not_null", "complaint_id"),
    ModelTest("fact_complaints", "relationships", "product_sk", to_model="dim_product", to_field="product_sk"),
    ModelTest("fact_complaints", "relationships", "company_sk", to_model="dim_company", to_field="company_sk"),
    ModelTest("fact_complaints", "accepted_values", "response_timeliness_category", values=ACCEPTED_TIMELINESS),
    ModelTest("fact_complaints", "accepted_values", "submitted_via", severity="warn", values=ACCEPTED_SUBMITTED_VIA),
    ModelTest("dim_product", "unique", "product_sk"),
    ModelTest("dim_product", "not_null", "product_sk"),
    ModelTest("dim_product", "not_null", "product_name"),
    ModelTest("dim_company", "unique", "company_sk"),
    ModelTest("dim_company", "not_null", "company_sk"),
    ModelTest("dim_company", "not_null", "company_name"),
    ModelTest("dim_geography", "unique", "geography_sk"),
    ModelTest("dim_geography", "not_null", "geography_sk"),
    ModelTest("dim_geography", "accepted_values", "region", values=ACCEPTED_REGIONS),
    ModelTest("dim_date", "unique", "date_sk"),
    ModelTest("dim_date", "not_null", "date_sk"),
    ModelTest("dim_date", "not_null", "date_actual"),
    ModelTest("dim_date", "accepted_values", "quarter", values=ACCEPTED_QUARTERS),
    ModelTest("fact_complaints", "singular", name="test_date_logic", predicate=_date_logic),
    ModelTest("fact_complaints", "singular", severity="warn", name="test_timely_response_accuracy",
         predicate=_timely_accuracy),
)

TEST_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("test_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _test_row(t: ModelTest, failures: Column) -> Column:
    f = failures.cast("bigint")
    status = F.when(f == 0, F.lit("pass")).otherwise(F.lit("fail" if t.severity == "error" else "warn"))
    return F.struct(
        F.lit(t.test_name).alias("test_name"),
        F.lit(t.model).alias("model"),
        F.lit(t.column).cast("string").alias("column_name"),
        F.lit(t.kind).alias("test_type"),
        F.lit(t.severity).alias("severity"),
        f.alias("failures"),
        status.alias("status"),
    )


def not_null_failures(c: str) -> Column:
    return F.count(F.when(F.col(c).isNull(), 1))


def value_tests(df: DataFrame, tests: Sequence[ModelTest], models: dict[str, DataFrame]) -> DataFrame:
    """All accepted-values and relationship tests of one model, in one scan of it.

    The tested columns are turned into (column, value) counts, combined before
    the shuffle, so a hot key is one row per partition and the join with the
    parents' keys sees each value once.  Values and keys are compared as text.
    """
    columns = list(dict.fromkeys(t.column for t in tests))
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    parents = [
        models[t.to_model].select(F.lit(t.test_name).alias("test"), F.lit(t.column).alias("field"), F.col(t.to_field).cast("string").alias("value")).distinct()
        for t in tests if t.kind == "relationships"
    ]
    found = counts.withColumn("tests", F.lit(None).cast("array<string>"))
    if parents:
        known = reduce(DataFrame.unionByName, parents).groupBy("field", "value").agg(F.collect_set("test").alias("tests"))
        found = counts.join(known, ["field", "value"], "left")
    failures = []
    for t in tests:
        mine = F.col("field") == F.lit(t.column)
        if t.kind == "accepted_values":
            failures.append(F.count(F.when(mine & ~F.col("value").isin(*[str(v) for v in t.values]), 1)))
        else:
            has = F.coalesce(F.array_contains("tests", t.test_name), F.lit(False))
            failures.append(F.coalesce(F.sum(F.when(mine & ~has, F.col("n"))), F.lit(0)).cast("bigint"))
    one = found.agg(*[f.alias(f"__f{j}") for j, f in enumerate(failures)])
    return one.select(F.inline(F.array(*[_test_row(t, F.col(f"__f{j}")) for j, t in enumerate(tests)])))


def unique_failures(df: DataFrame, c: str) -> DataFrame:
    """One row, column ``failures``: number of non-NULL values that occur more than once."""
    return (
        df.filter(F.col(c).isNotNull())
        .groupBy(c).agg(F.count(F.lit(1)).alias("k"))
        .agg(F.count(F.when(F.col("k") > 1, 1)).alias("failures"))
    )


def duplicated_keys(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, key) whose key value occurs more than once, over several tables."""
    parts = [
        df.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1).select(F.lit(name).alias("table"), "key", "n")
        for name, (df, k) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def relationship_orphans(child: DataFrame, c: str, parent: DataFrame, p: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    The orphan keys are found among the distinct keys, so a hot key is one row
    there; the rows themselves then meet only orphan keys, which are few.
    """
    keys = parent.select(F.col(p).alias("__parent_key"))
    used = child.select(F.col(c).alias("__key")).filter(F.col("__key").isNotNull()).distinct()
    orphans = used.join(keys, F.col("__key") == F.col("__parent_key"), "left_anti")
    return child.join(orphans, F.col(c) == F.col("__key"), "left_semi")


def known_failures(tests: Sequence[ModelTest], suite: Sequence[Expectation], results: Sequence[dict], model: str = "consumer_complaints",
                   unique_keys: Sequence[tuple[str, str]] = ()) -> dict[str, int]:
    """Failures that earlier checks of the same tables have counted, by test name.

    ``results`` are the suite's rows on ``model``: missing values are its not-null counts,
    and a unique expectation without unexpected rows settles the unique test.
    ``unique_keys``: (model, column) found unique otherwise.
    """
    counts = {(e.kind, e.column): r["unexpected_count"] for e, r in zip(suite, sorted(results, key=lambda r: r["expectation_index"]), strict=True)}
    known = {}
    for t in tests:
        found = counts.get((t.kind, t.column)) if t.model == model else None
        if (t.model, t.column) in unique_keys and t.kind == "unique":
            found = 0
        if found is not None and (t.kind == "not_null" or found == 0):
            known[t.test_name] = int(found)
    return known


def run_tests(models: dict[str, DataFrame], tests: Sequence[ModelTest] = MODEL_TESTS, known: dict[str, int] | None = None) -> DataFrame:
    """Evaluate ``tests`` against named models: one row per test (``TEST_SCHEMA``).

    Tests whose failures are ``known`` read nothing.
    """
    parts: list[DataFrame] = []
    if settled := [t for t in tests if t.test_name in (known or {})]:
        one = next(iter(models.values())).sparkSession.range(1)
        parts.append(one.select(F.inline(F.array(*[_test_row(t, F.lit(known[t.test_name])) for t in settled]))))
        tests = [t for t in tests if t.test_name not in known]
    by_model: dict[str, list[ModelTest]] = {}
    for t in tests:
        if t.kind in ("not_null", "singular"):
            by_model.setdefault(t.model, []).append(t)
    # One aggregate pass per model for every row-level test on it.
    for model, ts in by_model.items():
        aggs = []
        for j, t in enumerate(ts):
            if t.kind == "not_null":
                aggs.append(not_null_failures(t.column).alias(f"__f{j}"))
            else:
                aggs.append(F.count(F.when(t.predicate(), 1)).alias(f"__f{j}"))
        one = models[model].agg(*aggs)
        parts.append(one.select(F.inline(F.array(*[_test_row(t, F.col(f"__f{j}")) for j, t in enumerate(ts)]))))
    for t in tests:
        if t.kind == "unique":
            u = unique_failures(models[t.model], t.column)
            parts.append(u.select(F.inline(F.array(_test_row(t, F.col("failures"))))))
    by_value: dict[str, list[ModelTest]] = {}
    for t in tests:
        if t.kind in ("accepted_values", "relationships"):
            by_value.setdefault(t.model, []).append(t)
    parts += [value_tests(models[m], ts, models) for m, ts in by_value.items()]
    return reduce(DataFrame.unionByName, parts)


def failing_values(df: DataFrame, suite: Sequence[Expectation] = RAW_SUITE, top: int = 20, only: Iterable[int] | None = None) -> DataFrame:
    """Which values failed: the ``top`` most frequent unexpected values of each expectation on values.

    ``expectation_index, column_name, value, n, place``: a value as text (NULL
    for a missing one), how many rows have it, and its place, 1 being the most
    frequent; ties go by the value.  One pass: rows without a failure give
    nothing, equal values are counted before the shuffle, and only the counted
    values are ranked.  A uniqueness check names the values that occur more than once.
    ``only``: the indexes of the expectations to look at.
    """
    found, repeated = [], []
    for i, e in enumerate(suite, 1):
        if (only is not None and i not in set(only)) or e.column not in df.columns or e.kind not in ("not_null", "in_set", "between", "unique"):
            continue
        c = F.col(e.column)
        if e.kind == "unique":
            counts = df.filter(c.isNotNull()).groupBy(e.column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            repeated.append(counts.select(F.lit(i).alias("expectation_index"), F.lit(e.column).alias("column_name"), c.cast("string").alias("value"), "n"))
            continue
        wrong = {"not_null": c.isNull(), "in_set": c.isNotNull() & ~c.isin(*[v for v in e.value_set if v is not None]), "between": _outside(c, e)}[e.kind]
        found.append(F.when(wrong, F.struct(F.lit(i).alias("expectation_index"), F.lit(e.column).alias("column_name"), c.cast("string").alias("value"))))
    parts = list(repeated)
    if found:
        rows = df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f")).select("f.*")
        parts.append(rows.groupBy("expectation_index", "column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    if not parts:
        return df.sparkSession.createDataFrame([], "expectation_index int, column_name string, value string, n long, place int")
    order = Window.partitionBy("expectation_index").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return reduce(DataFrame.unionByName, parts).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def volume_gate(fact: DataFrame, min_rows: int = FACT_MIN_ROWS) -> DataFrame:
    """Final gate: row count of the fact against a floor; only ever warns."""
    return fact.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(min_rows).cast("bigint").alias("min_rows"),
        F.when(F.col("n_rows") >= min_rows, F.lit("pass")).otherwise(F.lit("warn")).alias("status"),
    )


class QualityGateError(RuntimeError):
    pass


def enforce(results: DataFrame, success_col: str | None = None) -> None:
    """Raise when any error-severity check failed.  Only failing check rows
    (at most one per check) are brought to the driver."""
    if success_col:
        bad = results.filter(~F.col(success_col)).collect()
    else:
        bad = results.filter(F.col("status") == "fail").collect()
    if bad:
        raise QualityGateError(f"{len(bad)} failing checks: {[r.asDict() for r in bad]}")


def store_results(results: DataFrame, path: str, run_name: str) -> None:
    """Write a run's check results to its own ``run_name`` folder; a rerun of the name replaces them."""
    results.write.mode("overwrite").parquet(f"{path}/run_name={run_name}")
