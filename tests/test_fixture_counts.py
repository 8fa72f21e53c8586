"""Counts of the complaint fixture at sf0.001 (see FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from grievance.functions.expressions import region, upper_trim
from grievance.plans.models import raw_complaints, staged_complaints
from grievance.sources.fixture import fixture_complaints


def test_counts(spark, sf_small):
    assert fixture_complaints(spark, sf_small).count() == 6000
    raw = raw_complaints(spark, sf_small)
    assert raw.count() == 4599
    assert staged_complaints(spark, sf_small).count() == 4380
    r = raw.agg(
        F.count(F.when(F.col("date_received").isNull(), 1)).alias("nd"),
        F.count(F.when(F.col("product").isNull(), 1)).alias("np"),
        F.count(F.when(F.col("product") == "", 1)).alias("bp"),
        F.count(F.when(F.col("company").isNull(), 1)).alias("nc"),
        F.count(F.when(F.col("state").isNull(), 1)).alias("ns"),
        F.count(F.when(F.col("zip_code").isNull(), 1)).alias("nz"),
        F.count(F.when(F.col("date_sent_to_company").isNull(), 1)).alias("nsent"),
        F.count(F.when(F.col("date_sent_to_company") < F.col("date_received"), 1)).alias("neg"),
    ).first()
    assert (r.nd, r.np, r.bp, r.nc, r.ns, r.nz, r.nsent, r.neg) == (50, 96, 65, 95, 165, 259, 89, 532)
    regions = {x.region: x.n for x in raw.groupBy(region(upper_trim("state")).alias("region")).agg(F.count("*").alias("n")).collect()}
    assert regions == {"Northeast": 519, "Midwest": 694, "South": 1062, "West": 999, "Territories": 787, "Unknown": 538}
    timely = {x.timely_response: x.n for x in raw.groupBy("timely_response").agg(F.count("*").alias("n")).collect()}
    assert timely == {"Yes": 2769, "yes": 465, "No": 463, " No": 450, None: 452}
