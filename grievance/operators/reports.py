"""Business reports over the gold star schema.

Every report that needs a dimension attribute first aggregates the fact on
its foreign key (partial aggregation before the shuffle, so a hot key is
pre-combined per partition), then joins that small per-key aggregate to the
dimension, then rolls up to the attribute.  The join therefore never sees
fact-sized input, whatever the dimension's size.  Additive measures travel
as counts and sums; exact percentiles travel as a (value, frequency)
histogram per key, which ``percentile(value, p, frequency)`` consumes.

Shares of a total use an unpartitioned window only *after* aggregation, over
one row per group of a low-cardinality attribute (product, region/state,
channel, category, month).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grievance.schemas import TIMELINESS_BUCKETS, UNKNOWN

RATIO_DIGITS = 6


def _ratio(c: Column) -> Column:
    return F.round(c, RATIO_DIGITS)


def _share_pct(n: str = "n_complaints") -> Column:
    return _ratio(F.try_divide(F.col(n) * 100.0, F.sum(n).over(Window.partitionBy())))


def _rate(num: str, den: str) -> Column:
    return _ratio(F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))


def _by_key_then_attribute(fact: DataFrame, key: str, dim: DataFrame, attribute: str,
                           measures: dict[str, Column]) -> DataFrame:
    """Sum additive ``measures`` per fact key, attach the dimension attribute,
    then sum again per attribute (a left join keeps keys missing from the dimension)."""
    per_key = fact.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    named = per_key.join(dim.select(key, attribute), key, "left")
    return named.groupBy(attribute).agg(*[F.sum(n).cast("bigint").alias(n) for n in measures])


def complaints_by_product(fact: DataFrame, products: DataFrame) -> DataFrame:
    """R1: complaints and share of all complaints per product."""
    agg = _by_key_then_attribute(fact, "product_sk", products, "product_name",
                                 {"n_complaints": F.count(F.lit(1))})
    return agg.select("product_name", "n_complaints", _share_pct().alias("share_pct")).orderBy(
        F.col("n_complaints").desc(), F.col("product_name").asc_nulls_last()
    )


def timely_rate(fact: DataFrame, products: DataFrame) -> DataFrame:
    """R2: per product, share of timely answers and share answered within the threshold."""
    flag = F.col("timely_response_flag")
    cat = F.col("response_timeliness_category")
    fast = [label for label, _, _ in TIMELINESS_BUCKETS]
    agg = _by_key_then_attribute(fact, "product_sk", products, "product_name", {
        "n_complaints": F.count(F.lit(1)),
        "n_known_timely": F.count(flag),
        "n_timely": F.count(F.when(flag, 1)),
        "n_known_days": F.count(F.when(cat != F.lit(UNKNOWN), 1)),
        "n_within": F.count(F.when(cat.isin(*fast), 1)),
    })
    return agg.select(
        "product_name", "n_complaints", "n_known_timely",
        _rate("n_timely", "n_known_timely").alias("timely_rate"),
        "n_known_days",
        _rate("n_within", "n_known_days").alias("within_threshold_rate"),
    )


def dispute_rate(fact: DataFrame, products: DataFrame) -> DataFrame:
    """R3: per product, disputed share of complaints whose dispute flag is known."""
    flag = F.col("consumer_disputed_flag")
    agg = _by_key_then_attribute(fact, "product_sk", products, "product_name", {
        "n_complaints": F.count(F.lit(1)),
        "n_known_disputes": F.count(flag),
        "n_disputed": F.count(F.when(flag, 1)),
    })
    return agg.select(
        "product_name", "n_complaints", "n_known_disputes", "n_disputed",
        _rate("n_disputed", "n_known_disputes").alias("dispute_rate"),
    )


def geo_concentration(fact: DataFrame, geographies: DataFrame) -> DataFrame:
    """R4: complaints by region and state with region subtotals and a grand total.

    ``grouping_level`` 0 = (region, state), 1 = region subtotal, 3 = grand total.
    """
    per_key = fact.groupBy("geography_sk").agg(F.count(F.lit(1)).alias("n"))
    named = per_key.join(geographies.select("geography_sk", "region", "state"), "geography_sk", "left")
    rolled = named.rollup("region", "state").agg(
        F.sum("n").cast("bigint").alias("n_complaints"), F.grouping_id().cast("int").alias("grouping_level")
    )
    total = F.max(F.when(F.col("grouping_level") == 3, F.col("n_complaints"))).over(Window.partitionBy())
    return rolled.select(
        "region", "state", "grouping_level", "n_complaints",
        _ratio(F.try_divide(F.col("n_complaints") * 100.0, total)).alias("share_pct"),
    )


def complaints_by_company(fact: DataFrame, companies: DataFrame, top: int | None = None) -> DataFrame:
    """R6: complaints per company, most first (ties by name); with ``top`` only so many companies.

    With ``top``, ``orderBy().limit()`` plans as a per-partition top-k merged
    at the end: no partition ever sorts or ships more than ``top`` rows.
    """
    agg = _by_key_then_attribute(fact, "company_sk", companies, "company_name",
                                 {"n_complaints": F.count(F.lit(1))})
    ordered = agg.orderBy(F.col("n_complaints").desc(), F.col("company_name").asc_nulls_last())
    return ordered if top is None else ordered.limit(top)


def complaints_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """R6: complaints per calendar year of the date dimension.

    Counted per day first, so the join is of two small sides; days outside the
    dimension are counted under a NULL year.
    """
    per_day = fact.groupBy(F.col("date_received_sk").alias("date_sk")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("has_narrative_flag"), 1)).alias("n_narrative")
    )
    return per_day.join(dates.select("date_sk", "year"), "date_sk", "left").groupBy("year").agg(
        F.sum("n").cast("bigint").alias("n_complaints"), F.sum("n_narrative").cast("bigint").alias("n_with_narrative")
    )


def complaints_by_channel(fact: DataFrame) -> DataFrame:
    """R6: complaints and share per submission channel."""
    agg = fact.groupBy("submitted_via").agg(F.count(F.lit(1)).alias("n_complaints"))
    return agg.select("submitted_via", "n_complaints", _share_pct().alias("share_pct"))


def timeliness_distribution(fact: DataFrame) -> DataFrame:
    """R7: complaints per response-timeliness category."""
    agg = fact.groupBy("response_timeliness_category").agg(F.count(F.lit(1)).alias("n_complaints"))
    return agg.select("response_timeliness_category", "n_complaints", _share_pct().alias("share_pct"))


def response_time(fact: DataFrame, products: DataFrame) -> DataFrame:
    """R7: per product, mean / median / p90 of the (non-negative) forwarding lag in days.

    Exact: the fact is reduced to a histogram ``(product_sk, days) -> n``
    (day lags take few distinct values), and the percentiles are taken over
    that histogram with frequencies, so no group ever holds its raw rows.
    """
    d = F.col("response_days")
    hist = fact.groupBy("product_sk", F.when(d >= 0, d).alias("days")).agg(F.count(F.lit(1)).alias("n"))
    named = hist.join(products.select("product_sk", "product_name"), "product_sk", "left")
    known_n = F.when(F.col("days").isNotNull(), F.col("n"))
    return named.groupBy("product_name").agg(
        F.sum("n").cast("bigint").alias("n_complaints"),
        F.coalesce(F.sum(known_n), F.lit(0)).cast("bigint").alias("n_known_days"),
        _ratio(F.try_divide(F.sum(F.col("days") * F.col("n")).cast("double"), F.sum(known_n).cast("double"))).alias("avg_days"),
        _ratio(F.percentile(F.col("days"), F.lit(0.5), F.col("n"))).alias("median_days"),
        _ratio(F.percentile(F.col("days"), F.lit(0.9), F.col("n"))).alias("p90_days"),
    )


def _monthly(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("date_received").isNotNull())
        .groupBy(F.trunc("date_received", "month").alias("month_start"))
        .agg(F.count(F.lit(1)).alias("n_complaints"))
    )


def monthly_growth(fact: DataFrame) -> DataFrame:
    """R8: complaints per month with the previous calendar month and growth (%).

    One pass over the fact: the previous row of the monthly counts (one row
    per month) counts only if it is the calendar month before.
    """
    m = _monthly(fact)
    by_month = Window.partitionBy().orderBy("month_start")
    previous = F.lag("n_complaints").over(by_month)
    adjacent = F.lag("month_start").over(by_month) == F.add_months("month_start", -1)
    return m.select("month_start", "n_complaints", F.when(adjacent, previous).alias("n_prev_month")).select(
        "month_start",
        "n_complaints",
        "n_prev_month",
        _ratio(
            F.try_divide((F.col("n_complaints") - F.col("n_prev_month")) * 100.0, F.col("n_prev_month"))
        ).alias("growth_pct"),
    )


def growth_months(parts: Iterable[object], months: int = 6) -> list[int]:
    """Of the months (yyyymm) that a fact kept by month has, those that ``half_year_growth`` needs."""
    known = sorted(int(p) for p in parts if str(p).isdigit())
    if not known:
        return []
    place = lambda m: m // 100 * 12 + m % 100
    return [m for m in known if place(m) > place(known[-1]) - 2 * months]


def half_year_growth(fact: DataFrame, months: int = 6) -> DataFrame:
    """R8: the last ``months`` calendar months (anchored at the latest month with
    complaints) against the ``months`` before them.

    Of a fact kept by month, the parts that ``growth_months`` names are enough.
    """
    m = _monthly(fact)
    anchor = F.max("month_start").over(Window.partitionBy())
    flagged = m.select("n_complaints", "month_start", anchor.alias("anchor_month"))
    ms, a = F.col("month_start"), F.col("anchor_month")
    last = ms > F.add_months(a, -months)
    prior = (ms > F.add_months(a, -2 * months)) & ~last
    out = flagged.groupBy("anchor_month").agg(
        F.sum(F.when(last, F.col("n_complaints")).otherwise(0)).cast("bigint").alias("n_last_period"),
        F.sum(F.when(prior, F.col("n_complaints")).otherwise(0)).cast("bigint").alias("n_prior_period"),
    )
    return out.select(
        "anchor_month",
        "n_last_period",
        "n_prior_period",
        _ratio(
            F.try_divide((F.col("n_last_period") - F.col("n_prior_period")) * 100.0, F.col("n_prior_period"))
        ).alias("growth_pct"),
    )


def quality_history(spark, results_path: str) -> DataFrame:
    """R5 over time: per stored run, how many checks ran, failed and only warned.

    Reads the results the daily run appends under ``results_path``
    (``expectations/`` and ``tests/``, partitioned by ``run_name``).
    """
    exp = spark.read.parquet(f"{results_path}/expectations").select(
        "run_name", F.lit("expectations").alias("family"),
        F.when(F.col("success"), F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )
    tests = spark.read.parquet(f"{results_path}/tests").select("run_name", F.lit("tests").alias("family"), "status")
    return exp.unionByName(tests).groupBy("run_name", "family").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count(F.when(F.col("status") == "fail", 1)).alias("n_failed"),
        F.count(F.when(F.col("status") == "warn", 1)).alias("n_warned"),
    )
