"""Property tests: column functions against plain-Python models of their rules."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grievance.functions import expressions as X
from grievance.schemas import REGIONS, SURROGATE_KEY_NULL_MARKER, TIMELINESS_BUCKETS

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(alphabet=st.sampled_from(list("ab -_xyZ09é\t")), max_size=8)
MAYBE_TEXT = st.one_of(st.none(), TEXT)


def run_rows(spark, rows, schema, *cols):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def model_key(*vals):
    return hashlib.md5("-".join(SURROGATE_KEY_NULL_MARKER if v is None else v for v in vals).encode()).hexdigest()


@SETTINGS
@given(st.lists(st.tuples(MAYBE_TEXT, MAYBE_TEXT), min_size=1, max_size=50))
def test_surrogate_key(spark, rows):
    got = run_rows(spark, rows, "a string, b string", X.surrogate_key("a", "b").alias("k"))
    assert [g[0] for g in got] == [model_key(a, b) for a, b in rows]


@SETTINGS
@given(st.lists(st.tuples(MAYBE_TEXT), min_size=1, max_size=50))
def test_blank_default_and_lpad(spark, rows):
    got = run_rows(spark, rows, "v string", X.blank_default("v", "D").alias("d"), X.zip_lpad("v").alias("z"))
    for (v,), (d, z) in zip(rows, got):
        t = None if v is None else v.strip(" ")
        assert d == (t if t else "D")
        assert z == (None if t is None else (t[:5] if len(t) >= 5 else "0" * (5 - len(t)) + t))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["yes", "YES", "Yes", "no", "No", " No", "N/A", "y", ""]))),
                min_size=1, max_size=50))
def test_yes_no(spark, rows):
    got = run_rows(spark, rows, "v string", X.yes_no_flag("v").alias("f"))
    model = {"YES": True, "NO": False}
    assert [g[0] for g in got] == [None if v is None else model.get(v.upper()) for (v,) in rows]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-50, 400))), min_size=1, max_size=50))
def test_timeliness(spark, rows):
    got = run_rows(spark, rows, "d int", X.timeliness_category("d").alias("c"))

    def model(d):
        if d is None or d < 0:
            return "Unknown"
        return next((label for label, lo, hi in TIMELINESS_BUCKETS if lo <= d <= hi), "Late")

    assert [g[0] for g in got] == [model(d) for (d,) in rows]


ALL_STATES = [s for states in REGIONS.values() for s in states]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(ALL_STATES), st.text("ABXZ", min_size=2, max_size=2))),
                min_size=1, max_size=50))
def test_region(spark, rows):
    got = run_rows(spark, rows, "s string", X.region("s").alias("r"))
    lookup = {s: name for name, states in REGIONS.items() for s in states}
    assert [g[0] for g in got] == [lookup.get(s, "Unknown") for (s,) in rows]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**12, 10**12).map(str),
                                    st.decimals(-10**6, 10**6, places=2).map(str), st.sampled_from(["abc", "", "1e3"]))),
                min_size=1, max_size=50))
def test_lenient_bigint(spark, rows):
    got = run_rows(spark, rows, "v string", X.lenient_bigint("v").alias("n"))

    def model(v):
        if v is None:
            return None
        try:
            return int(v)
        except ValueError:
            try:
                return int(float(v))
            except ValueError:
                return None

    assert [g[0] for g in got] == [model(v) for (v,) in rows]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 10**6)), min_size=1, max_size=200, unique_by=lambda r: r[1]),
       st.integers(1, 9))
def test_keep_last_any_partitioning(spark, rows, parts):
    from grievance.operators.raw import keep_last

    df = spark.createDataFrame(rows, "complaint_id long, pos long").withColumn("v", F.col("pos") * 2)
    got = {r.complaint_id: r.v for r in keep_last(df.repartition(parts), "complaint_id", ["pos"]).collect()}
    model = {}
    for cid, pos in rows:
        if cid not in model or pos > model[cid]:
            model[cid] = pos
    assert got == {cid: pos * 2 for cid, pos in model.items()}


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 40)), st.one_of(st.none(), st.sampled_from(["Yes", "No", "yes", "x"]))),
                min_size=0, max_size=120),
       st.sampled_from([0.5, 0.9, 0.99, 1.0]))
def test_suite_mostly_semantics(spark, rows, mostly):
    from collections import Counter

    from grievance.operators.quality import Expectation, run_suite

    suite = (
        Expectation("not_null", "a", mostly=mostly),
        Expectation("unique", "a", mostly=mostly),
        Expectation("in_set", "b", mostly=mostly, value_set=("Yes", "No", None)),
        Expectation("between", "a", mostly=mostly, min_value=0, max_value=30),
    )
    df = spark.createDataFrame(rows, "a int, b string")
    got = {r.expectation_index: (r.element_count, r.unexpected_count, r.success) for r in run_suite(df, suite).collect()}

    def ok(el, un):
        return True if el == 0 else (el - un) / el >= mostly

    n = len(rows)
    a = [x for x, _ in rows if x is not None]
    b = [y for _, y in rows if y is not None]
    nulls = n - len(a)
    counts = Counter(a)
    dup = sum(c for c in counts.values() if c > 1)
    bad_b = sum(1 for y in b if y not in ("Yes", "No"))
    out_a = sum(1 for x in a if not 0 <= x <= 30)
    assert got == {
        1: (n, nulls, ok(n, nulls)),
        2: (len(a), dup, ok(len(a), dup)),
        3: (len(b), bad_b, ok(len(b), bad_b)),
        4: (len(a), out_a, ok(len(a), out_a)),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from(list('ab ,"\n;é\'x')), min_size=1, max_size=30)
                .filter(lambda t: t.strip(" ") != "" and t not in ("N/A", "NA", "nan", "null", "None", "NaN")),
                min_size=1, max_size=40))
def test_csv_round_trip_keeps_text(spark, scratch, narratives):
    from grievance.schemas import COLUMN_MAPPING
    from grievance.sources.csv import read_complaints_csv, write_complaints_csv

    headers = list(COLUMN_MAPPING)
    rows = [tuple(str(i + 1) if h == "Complaint ID" else (t if h == "Consumer complaint narrative" else "x")
                  for h in headers) for i, t in enumerate(narratives)]
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers))
    path = f"{scratch}/rt-{abs(hash(tuple(narratives)))}"
    write_complaints_csv(df, path)
    back = read_complaints_csv(spark, path)
    got = {int(r["Complaint ID"]): r["Consumer complaint narrative"] for r in back.collect()}
    assert got == {i + 1: t for i, t in enumerate(narratives)}


@SETTINGS
@given(st.dictionaries(st.integers(0, 30), st.text("abc", max_size=3), max_size=25),
       st.dictionaries(st.integers(0, 30), st.text("xyz", max_size=3), max_size=25))
def test_merge_upsert_model(spark, existing, incoming):
    from grievance.operators.raw import merge_upsert

    schema = "complaint_id long, v string"
    old = spark.createDataFrame(list(existing.items()), schema)
    new = spark.createDataFrame(list(incoming.items()), schema)
    once = merge_upsert(old, new)
    got = {r.complaint_id: r.v for r in once.collect()}
    assert got == {**existing, **incoming}
    assert sorted(merge_upsert(once, new).collect()) == sorted(once.collect())  # re-applying changes nothing
