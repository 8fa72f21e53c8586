"""Hot keys (a third of all rows on one key) must give whole, exact results."""

from pyspark.sql import functions as F

from grievance.operators import gold as G
from grievance.operators import quality as Q
from grievance.operators import reports as R


def _fact(spark, n=9000):
    # Row i: product 'hot' for a third of the rows, else one of 50 others.
    rows = spark.range(n).select(
        F.col("id").alias("complaint_id"),
        F.md5(F.col("id").cast("string")).alias("complaint_sk"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string")))
        .alias("product_sk"),
        F.when(F.col("id") % 3 == 0, F.lit("c-hot")).otherwise(F.lit("c-cold")).alias("company_sk"),
        F.when(F.col("id") % 3 == 0, F.lit("g-hot")).otherwise(F.lit(None)).alias("geography_sk"),
        (F.col("id") % 25 - 3).cast("int").alias("response_days"),
        (F.col("id") % 2 == 0).alias("timely_response_flag"),
        (F.col("id") % 5 == 0).alias("consumer_disputed_flag"),
        F.lit(True).alias("has_narrative_flag"),
        F.lit("Web").alias("submitted_via"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("date_received"),
    ).withColumn("response_timeliness_category", G.timeliness_category("response_days"))
    return rows.repartition(16)


def test_reports_with_hot_product(spark):
    fact = _fact(spark)
    products = spark.createDataFrame([("hot", "HOT")] + [(f"p{i}", f"P{i % 5}") for i in range(50)],
                                     "product_sk string, product_name string")
    counts = {r.product_name: r.n_complaints for r in R.complaints_by_product(fact, products).collect()}
    assert counts["HOT"] == 3000 and sum(counts.values()) == 9000
    rt = {r.product_name: r for r in R.response_time(fact, products).collect()}
    hot = fact.filter("product_sk = 'hot' AND response_days >= 0").select("response_days").toPandas()["response_days"]
    assert rt["HOT"].n_known_days == len(hot)
    assert abs(rt["HOT"].median_days - float(hot.median())) < 1e-9
    assert abs(rt["HOT"].p90_days - float(hot.quantile(0.9))) < 1e-9
    geo = spark.createDataFrame([("g-hot", "NY", "Northeast")], "geography_sk string, state string, region string")
    levels = {(r.region, r.state, r.grouping_level): r.n_complaints for r in R.geo_concentration(fact, geo).collect()}
    assert levels[("Northeast", "NY", 0)] == 3000 and levels[(None, None, 3)] == 9000


def test_unique_checks_with_hot_duplicate(spark):
    fact = _fact(spark).withColumn(
        "complaint_sk", F.when(F.col("complaint_id") % 3 == 0, F.lit("dup")).otherwise(F.col("complaint_sk"))
    )
    assert Q.unique_failures(fact, "complaint_sk").first().failures == 1
    dupes = Q.duplicated_keys({"fact": (fact, "complaint_sk")}).collect()
    assert [(r.key, r.n) for r in dupes] == [("dup", 3000)]
