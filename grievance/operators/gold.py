"""Gold layer: conformed dimensions and the complaint fact (star schema)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.functions.expressions import date_key, region, surrogate_key, timeliness_category
from grievance.operators.quality import duplicated_keys
from grievance.sources.spine import date_spine

PRODUCT_COLS = ("product", "sub_product", "issue", "sub_issue")
COMPANY_COLS = ("company_name", "company_response")
GEOGRAPHY_COLS = ("state", "zip_code")

FACT_COLUMNS = [
    "complaint_sk", "complaint_id", "product_sk", "company_sk", "geography_sk",
    "date_received_sk", "date_sent_to_company_sk", "date_received", "date_sent_to_company",
    "response_days", "response_timeliness_category", "timely_response_flag",
    "consumer_disputed_flag", "has_narrative_flag", "submitted_via", "tags",
]


# Each dimension is a DISTINCT over staging: Spark plans a partial
# (map-side) hash aggregate before the shuffle, so only distinct tuples per
# input partition travel, however skewed the values are.

def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select(*PRODUCT_COLS).distinct().select(
        surrogate_key(*PRODUCT_COLS).alias("product_sk"),
        F.col("product").alias("product_name"),
        "sub_product", "issue", "sub_issue",
    )


def dim_company(stg: DataFrame) -> DataFrame:
    return stg.select(*COMPANY_COLS).distinct().select(
        surrogate_key(*COMPANY_COLS).alias("company_sk"),
        "company_name", "company_response",
    )


def dim_geography(stg: DataFrame) -> DataFrame:
    return (
        stg.filter(F.col("state").isNotNull())
        .select(*GEOGRAPHY_COLS).distinct()
        .select(
            surrogate_key(*GEOGRAPHY_COLS).alias("geography_sk"),
            "state",
            region("state").alias("region"),
            "zip_code",
        )
    )


def dim_date(spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
    """Calendar dimension over the spine [start, end)."""
    kw = {k: v for k, v in (("start", start), ("end", end)) if v}
    d = F.col("date_day")
    return date_spine(spark, **kw).select(
        date_key(d).alias("date_sk"),
        d.alias("date_actual"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        # Month name blank-padded to 9 characters; weekend = Sunday(1) or Saturday(7).
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def _keyed(stg: DataFrame) -> DataFrame:
    """Staging with the three dimension lookup keys computed once per row."""
    return stg.select(
        "*",
        surrogate_key(*PRODUCT_COLS).alias("_product_key"),
        surrogate_key(*COMPANY_COLS).alias("_company_key"),
        surrogate_key(*GEOGRAPHY_COLS).alias("_geography_key"),
    )


def _fact_projection(df: DataFrame) -> DataFrame:
    return df.select(
        "complaint_sk",
        "complaint_id",
        "product_sk",
        "company_sk",
        "geography_sk",
        date_key("date_received").alias("date_received_sk"),
        date_key("date_sent_to_company").alias("date_sent_to_company_sk"),
        "date_received",
        "date_sent_to_company",
        "response_days",
        timeliness_category("response_days").alias("response_timeliness_category"),
        "timely_response_flag",
        "consumer_disputed_flag",
        "has_narrative_flag",
        "submitted_via",
        "tags",
    )


def fact_complaints(stg: DataFrame, products: DataFrame | None = None, companies: DataFrame | None = None,
                    geographies: DataFrame | None = None, strategy: str = "join") -> DataFrame:
    """One row per staged complaint with foreign keys to the dimensions.

    ``strategy="join"`` looks each key up in the dimension with a left
    equi-join, exactly as the star schema defines it (a key shared by two
    dimension rows fans out).  The planner broadcasts a dimension whose size
    it can prove below ``spark.sql.autoBroadcastJoinThreshold`` (e.g. a
    materialised dimension table); otherwise it sort-merges, and AQE either
    demotes that to a broadcast at runtime or splits skewed keys.

    ``strategy="derive"`` is join elimination: when the dimensions were built
    from this same staging frame every key is present exactly once, so the
    foreign key is the row's own hash (geography only when state is known).
    Equal to the join path whenever the dimension keys are unique (which the
    ``unique`` tests verify); it needs no shuffle at all.
    """
    if strategy == "derive":
        j = _keyed(stg).select(
            "*",
            F.col("_product_key").alias("product_sk"),
            F.col("_company_key").alias("company_sk"),
            F.when(F.col("state").isNotNull(), F.col("_geography_key")).alias("geography_sk"),
        )
        return _fact_projection(j)
    if products is None or companies is None or geographies is None:
        products, companies, geographies = dim_product(stg), dim_company(stg), dim_geography(stg)
    p = products.select(F.col("product_sk"))
    c = companies.select(F.col("company_sk"))
    g = geographies.select(F.col("geography_sk"))
    # The geography, which grows with the customers, comes first, and the other keys are made behind it: where that join
    # moves the rows they carry short texts, not digests.
    j = (
        stg.withColumn("_geography_key", surrogate_key(*GEOGRAPHY_COLS)).join(g, F.col("_geography_key") == F.col("geography_sk"), "left")
        .withColumn("_product_key", surrogate_key(*PRODUCT_COLS)).join(p, F.col("_product_key") == F.col("product_sk"), "left")
        .withColumn("_company_key", surrogate_key(*COMPANY_COLS)).join(c, F.col("_company_key") == F.col("company_sk"), "left")
    )
    return _fact_projection(j)


#: The month a complaint was received in, as yyyymm: the part column of a fact kept by month.
MONTH_PART = "received_month"


def month_key(date: str) -> Column:
    return F.year(date) * 100 + F.month(date)


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH_PART, month_key("date_received"))


def in_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The complaints received on the days of ``dates`` (rows of the date dimension), with the dimension's columns.

    The join is on the day and on its month.  Where the fact is kept by month,
    the months of the chosen days prune its parts while the query runs.
    """
    days = dates.withColumn("_month", month_key("date_actual"))
    on = (F.col("date_received_sk") == F.col("date_sk")) & (F.col(MONTH_PART) == F.col("_month"))
    return fact.join(days, on).drop("_month", "date_sk")


def choose_fact_strategy(products: DataFrame, companies: DataFrame, geographies: DataFrame) -> str:
    """``"derive"`` when every dimension key is unique (join elimination is then
    exact), else ``"join"``.  One job that reads the dimensions only (never the
    fact); only a count reaches the driver."""
    dupes = duplicated_keys({"dim_product": (products, "product_sk"), "dim_company": (companies, "company_sk"),
                             "dim_geography": (geographies, "geography_sk")})
    return "join" if dupes.limit(1).count() else "derive"


def build_gold(spark: SparkSession, stg: DataFrame, strategy: str = "join") -> dict[str, DataFrame]:
    """All gold models from one staging frame.  Lazy, except that
    ``strategy="auto"`` runs the dimension key check to pick the fact's path."""
    dp, dc, dg = dim_product(stg), dim_company(stg), dim_geography(stg)
    if strategy == "auto":
        strategy = choose_fact_strategy(dp, dc, dg)
    return {
        "dim_product": dp,
        "dim_company": dc,
        "dim_geography": dg,
        "dim_date": dim_date(spark),
        "fact_complaints": fact_complaints(stg, dp, dc, dg, strategy=strategy),
    }
