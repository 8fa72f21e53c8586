"""Star schema: joins, elimination path, date dimension."""

import datetime as dt

from pyspark.sql import functions as F

from grievance.operators import gold as G
from grievance.plans.models import staged_complaints


def test_join_equals_derive(spark, sf_small):
    stg = staged_complaints(spark, sf_small)
    a = G.fact_complaints(stg, strategy="join")
    b = G.fact_complaints(stg, strategy="derive")
    assert a.count() == b.count() == stg.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_geography_null_state_and_null_zip(spark):
    stg = spark.createDataFrame(
        [("k1", 1, None, "02139"), ("k2", 2, "NY", None)],
        "complaint_sk string, complaint_id long, state string, zip_code string",
    )
    for c, v in {"product": "p", "sub_product": "s", "issue": "i", "sub_issue": "u", "company_name": "C",
                 "company_response": "r", "submitted_via": "Web", "tags": "None"}.items():
        stg = stg.withColumn(c, F.lit(v))
    for c in ("date_received", "date_sent_to_company"):
        stg = stg.withColumn(c, F.lit(dt.date(2020, 1, 1)))
    for c in ("timely_response_flag", "consumer_disputed_flag", "has_narrative_flag"):
        stg = stg.withColumn(c, F.lit(True))
    stg = stg.withColumn("response_days", F.lit(0))
    fact = {r.complaint_id: r for r in G.fact_complaints(stg).collect()}
    assert fact[1].geography_sk is None
    assert fact[2].geography_sk is not None  # NULL zip with a state still matches


def test_collision_fans_out_on_join_path(spark):
    # ('a-b','c') and ('a','b-c') share a key: the dimension has two rows for it.
    stg = spark.createDataFrame(
        [("k1", 1, "a-b", "c"), ("k2", 2, "a", "b-c")],
        "complaint_sk string, complaint_id long, company_name string, company_response string",
    )
    for c, v in {"product": "p", "sub_product": "s", "issue": "i", "sub_issue": "u", "state": "NY", "zip_code": "1",
                 "submitted_via": "Web", "tags": "None"}.items():
        stg = stg.withColumn(c, F.lit(v))
    for c in ("date_received", "date_sent_to_company"):
        stg = stg.withColumn(c, F.lit(None).cast("date"))
    for c in ("timely_response_flag", "consumer_disputed_flag", "has_narrative_flag"):
        stg = stg.withColumn(c, F.lit(None).cast("boolean"))
    stg = stg.withColumn("response_days", F.lit(None).cast("int"))
    assert G.dim_company(stg).select("company_sk").distinct().count() == 1
    assert G.fact_complaints(stg, strategy="join").count() == 4
    assert G.fact_complaints(stg, strategy="derive").count() == 2


def test_dim_date(spark):
    d = G.dim_date(spark)
    r = {x.date_actual: x for x in d.filter(F.col("date_actual").isin(dt.date(2024, 1, 6), dt.date(2024, 1, 8))).collect()}
    sat, mon = r[dt.date(2024, 1, 6)], r[dt.date(2024, 1, 8)]
    assert sat.is_weekend and not mon.is_weekend
    assert (sat.date_sk, sat.quarter, sat.month_name) == (20240106, 1, "January  ")
    assert d.count() == 7304 and d.select("date_sk").distinct().count() == 7304


def test_join_path_without_broadcast(spark, sf_small):
    """Dimensions over the broadcast threshold: sort-merge joins give the same fact."""
    import contextlib
    import io

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        stg = staged_complaints(spark, sf_small)
        fact = G.fact_complaints(stg, strategy="join")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fact.explain()
        assert "SortMergeJoin" in buf.getvalue() and "BroadcastHashJoin" not in buf.getvalue()
        derived = G.fact_complaints(stg, strategy="derive")
        assert fact.exceptAll(derived).count() == 0 and derived.exceptAll(fact).count() == 0
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_dim_date_every_day_against_python_calendar(spark):
    for r in G.dim_date(spark).collect():
        d = r.date_actual
        assert r.date_sk == d.year * 10000 + d.month * 100 + d.day
        assert (r.year, r.quarter, r.month, r.day) == (d.year, (d.month - 1) // 3 + 1, d.month, d.day)
        assert r.month_name == d.strftime("%B").ljust(9)
        assert r.is_weekend == (d.weekday() >= 5)
