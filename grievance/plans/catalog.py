"""Registry of named queries: Spark builder + DuckDB reference SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Every query reads the benchmark tables in ``sf_dir`` whole; none depends on
another query's output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grievance.functions import expressions as X
from grievance.functions.sql_functions import staging_sql
from grievance.operators import changes as C
from grievance.operators import gold as G
from grievance.operators import metrics as M
from grievance.operators import quality as Q
from grievance.operators import raw as RAW
from grievance.operators import reports as R
from grievance.operators.staging import REQUIRED_FIELDS, STAGING_COLUMNS, required_fields, stage_complaints
from grievance.plans import oracle as O
from grievance.plans.daily import load_raw_from_csv
from grievance.plans.models import fact_from_raw, fact_only, gold_models, last_complaints, raw_complaints, staged_complaints, stored
from grievance.plans.versions import ID_PART, VersionedTable, merge_increment, with_id_range
from grievance.schemas import ACCEPTED_SUBMITTED_VIA, NO_TAGS, NOT_SPECIFIED, RAW_COLUMNS, UNKNOWN
from grievance.session import input_bytes, keep_scans_small, parallelism, shared_path
from grievance.sources.csv import read_complaints_csv, write_complaints_csv
from grievance.sources.fixture import (
    FIXTURE_ORDER, fixture_columns, fixture_complaints, fixture_key, fixture_rows, fixture_text, multiline_narratives, write_record_files,
)
from grievance.sources.multiline import load_with_rejects, scan_complaint_records
from grievance.streaming import current_raw, ingest_available

#: Ids in one part of the fixture's raw table: a few parts at every scale.
MERGE_WIDTH = 400_000
#: Bytes of lineitems behind one file of the extract (about a quarter of a million records).
EXTRACT_BYTES = 4 * 1024 * 1024
#: Records in one file of a scan.
FILE_RECORDS = 400_000
QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------- models

@register("upsert_keep_last", O.with_raw("SELECT * FROM raw"))
def q_upsert_keep_last(spark, sf_dir):
    return raw_complaints(spark, sf_dir)


@register("stg_complaints", O.with_stg("SELECT * FROM stg"))
def q_stg_complaints(spark, sf_dir):
    return staged_complaints(spark, sf_dir).select(*STAGING_COLUMNS)


@register("stg_view", O.with_stg("SELECT * FROM stg"))
def q_stg_view(spark, sf_dir):
    """Staging as the query of its view."""
    name = f"raw_{uuid.uuid4().hex}"
    raw_complaints(spark, sf_dir).createOrReplaceTempView(name)
    return spark.sql(staging_sql(name)).select(*STAGING_COLUMNS)


@register("dim_product", O.with_gold("SELECT * FROM dim_product"))
def q_dim_product(spark, sf_dir):
    return G.dim_product(staged_complaints(spark, sf_dir))


@register("dim_company", O.with_gold("SELECT * FROM dim_company"))
def q_dim_company(spark, sf_dir):
    return G.dim_company(staged_complaints(spark, sf_dir))


@register("dim_geography", O.with_gold("SELECT * FROM dim_geography"))
def q_dim_geography(spark, sf_dir):
    return G.dim_geography(staged_complaints(spark, sf_dir))


@register("fact_complaints", O.with_gold("SELECT * FROM fact"))
def q_fact_complaints(spark, sf_dir):
    return fact_only(spark, sf_dir)


# -------------------------------------------------------------------- reports

@register(
    "complaints_by_product",
    O.with_gold(
        """
SELECT product_name, n_complaints, round(n_complaints * 100.0 / sum(n_complaints) OVER (), 6) AS share_pct
FROM (SELECT dp.product_name, count(*) AS n_complaints
      FROM fact f LEFT JOIN dim_product dp USING (product_sk) GROUP BY dp.product_name)
"""
    ),
)
def q_complaints_by_product(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return R.complaints_by_product(g["fact_complaints"], g["dim_product"])


# ------------------------------------------------------------ ingestion path

def _text(spark, sf_dir):
    """The fixture as CSV-style text (every row, duplicates included)."""
    return fixture_text(fixture_complaints(spark, sf_dir, with_order=False))


@register("rename_select", O.with_text("SELECT * FROM renamed"))
def q_rename_select(spark, sf_dir):
    return RAW.rename_and_select(_text(spark, sf_dir))


@register("na_tokens", O.with_text("SELECT * FROM nulled"))
def q_na_tokens(spark, sf_dir):
    return RAW.null_na_tokens(RAW.rename_and_select(_text(spark, sf_dir)))


@register("parse_dates", O.with_text("SELECT complaint_id, date_received, date_sent_to_company FROM clean"))
def q_parse_dates(spark, sf_dir):
    return RAW.normalise(_text(spark, sf_dir)).select("complaint_id", "date_received", "date_sent_to_company")


@register("clean_raw", O.with_text("SELECT * FROM clean"))
def q_clean_raw(spark, sf_dir):
    return RAW.normalise(_text(spark, sf_dir))


@register("csv_scan", O.with_text("SELECT * FROM clean"))
def q_csv_scan(spark, sf_dir):
    """Text written as CSV files to the shared folder, scanned back and normalised."""
    path = shared_path(spark, "csv_scan")
    write_complaints_csv(_text(spark, sf_dir), path, records_per_file=FILE_RECORDS)
    return RAW.normalise(read_complaints_csv(spark, path))


def _ordered_extract(spark, sf_dir, extra_column=True):
    """CSV text whose file order follows the fixture's record order.

    All records of an id lie in one file, sorted by the fixture order, so
    "last in file" is the fixture's last record and the load can be checked
    against SQL.  There are as many files as the input needs, so none grows
    with it, and tasks read little enough to deal out and sort in memory.
    """
    keep_scans_small(spark)
    n = max(parallelism(spark), -(-input_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet") // EXTRACT_BYTES))
    key = fixture_key(spark, sf_dir)
    rows = fixture_rows(spark, sf_dir, n) if "l_orderkey" in key else fixture_rows(spark, sf_dir).repartition(n, "complaint_id")
    # Numbered within the id: the planner then keeps an id together and in order, and moves rows again only where they do
    # not lie so.  The condition holds for all; without it the number, and the order with it, would be left out.
    numbered = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*FIXTURE_ORDER))).filter("_nth >= 1")
    return fixture_text(fixture_columns(numbered), extra_column=extra_column)


@register("csv_ingest", O.text_keep_last_sql())
def q_csv_ingest(spark, sf_dir):
    """CSV extract -> discovery -> scan -> normalise -> last record per id by file position."""
    landing = shared_path(spark, "csv_ingest")
    write_complaints_csv(_ordered_extract(spark, sf_dir), f"{landing}/complaints_extract.csv", compression="gzip")
    return load_raw_from_csv(spark, landing, pattern="*.csv.gz", select="all")


def _record_files(spark, sf_dir):
    """The extract as CSV files whose records hold line breaks, and some a field too many or too few."""
    path = shared_path(spark, "record_files")
    text = fixture_text(multiline_narratives(fixture_complaints(spark, sf_dir, with_order=False)))
    write_record_files(text, path)
    return path


@register("csv_split_scan", O.with_records(f"SELECT * EXCLUDE (cid) FROM clean WHERE NOT {O.EXTRA}"))
def q_csv_split_scan(spark, sf_dir):
    """Multi-line records read in byte-range splits: what is loaded."""
    loaded, _ = load_with_rejects(scan_complaint_records(spark, _record_files(spark, sf_dir), "*.txt"))
    return loaded.select(*RAW_COLUMNS)


@register("load_rejects", O.rejects_sql())
def q_load_rejects(spark, sf_dir):
    """Records in = records loaded + records rejected by reason; and what was lost in loaded ones."""
    scanned = scan_complaint_records(spark, _record_files(spark, sf_dir), "*.txt")
    loaded, rejects = load_with_rejects(scanned)
    n = F.count(F.lit(1)).alias("n")
    return (
        rejects.groupBy("reason", "loaded").agg(n)
        .unionByName(scanned[0].agg(n).select(F.lit("records").alias("reason"), F.lit(None).cast("boolean").alias("loaded"), "n"))
        .unionByName(loaded.agg(n).select(F.lit("loaded").alias("reason"), F.lit(True).alias("loaded"), "n"))
    )


@register("landing_ingest", O.text_keep_last_sql())
def q_landing_ingest(spark, sf_dir):
    """The same extract picked up by the incremental landing-folder stream."""
    base = shared_path(spark, "landing_ingest")
    write_complaints_csv(_ordered_extract(spark, sf_dir, extra_column=False), f"{base}/landing", compression="gzip")
    ingest_available(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", pattern="*.csv.gz")
    return current_raw(spark, f"{base}/bronze")


@register("varchar_overflow", O.varchar_overflow_sql())
def q_varchar_overflow(spark, sf_dir):
    return RAW.varchar_overflow(raw_complaints(spark, sf_dir))


@register(
    "upsert_merge",
    f"""WITH fixture AS ({O.FIXTURE_SELECT}),
old_rows AS ({O._dedup("(SELECT * FROM fixture WHERE CAST(o5 AS DATE) < DATE '1998-07-01')")}),
new_rows AS ({O._dedup("(SELECT * FROM fixture WHERE NOT (CAST(o5 AS DATE) < DATE '1998-07-01'))")})
SELECT * FROM old_rows WHERE complaint_id NOT IN (SELECT complaint_id FROM new_rows)
UNION ALL SELECT * FROM new_rows""",
)
def q_upsert_merge(spark, sf_dir):
    f, key = fixture_rows(spark, sf_dir), fixture_key(spark, sf_dir)
    early = F.col("_ord_ship").cast("date") < F.lit("1998-07-01").cast("date")
    existing = last_complaints(f.filter(early), key)
    incoming = last_complaints(f.filter(~early), key)
    return RAW.merge_upsert(existing, incoming)


def _two_load_rows(spark, sf_dir):
    """An early load and a later increment with new, changed and unchanged complaints, as the last narrow row of each."""
    f, key = fixture_rows(spark, sf_dir), fixture_key(spark, sf_dir)
    early = F.col("_ord_ship").cast("date") < F.lit("1998-07-01").cast("date")
    again = F.floor(F.col("complaint_id") / 10) % 5 == 0
    return tuple(RAW.keep_last(f.filter(load), key, FIXTURE_ORDER) for load in (early, ~early | again))


def _two_loads(spark, sf_dir):
    """``_two_load_rows`` in the raw columns."""
    return tuple(map(fixture_columns, _two_load_rows(spark, sf_dir)))


_TWO_LOADS = f"""WITH fixture AS ({O.FIXTURE_SELECT}),
old_rows AS ({O._dedup("(SELECT * FROM fixture WHERE CAST(o5 AS DATE) < DATE '1998-07-01')")}),
new_rows AS ({O._dedup("(SELECT * FROM fixture WHERE NOT (CAST(o5 AS DATE) < DATE '1998-07-01') OR complaint_id // 10 % 5 = 0)")}),
raw AS (SELECT * FROM old_rows WHERE complaint_id NOT IN (SELECT complaint_id FROM new_rows) UNION ALL SELECT * FROM new_rows)"""


@register("merge_touched", _TWO_LOADS + f" SELECT *, CAST(complaint_id // {MERGE_WIDTH} AS BIGINT) AS id_range FROM raw")
def q_merge_touched(spark, sf_dir):
    """The increment merged into the parts of a versioned table that it has rows of."""
    existing, incoming = (with_id_range(rows, width=MERGE_WIDTH) for rows in _two_load_rows(spark, sf_dir))
    table = VersionedTable(spark, shared_path(spark, "merge_touched"), ID_PART)
    # The narrow rows are dealt out by part; the texts are spelled as they are written.
    table.replace(existing, (ID_PART, "complaint_id"), watch=lambda rows: fixture_columns(rows, (ID_PART,)))
    return table.read(merge_increment(table, fixture_columns(incoming, (ID_PART,))))


_FEED = ("product", "date_sent_to_company", "company_response_to_consumer", "timely_response", "sub_issue")


@register(
    "change_feed",
    _TWO_LOADS + " SELECT n.complaint_id, CASE WHEN o.complaint_id IS NULL THEN 'inserted' WHEN "
    + " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in RAW_COLUMNS) + " THEN 'unchanged' ELSE 'updated' END AS change, "
    + ", ".join(f"o.{c} AS old_{c}, n.{c} AS new_{c}" for c in _FEED) + " FROM new_rows n LEFT JOIN old_rows o USING (complaint_id)",
)
def q_change_feed(spark, sf_dir):
    """Every row of an increment, tagged against the stored one, with old and new values."""
    feed = C.change_feed(*_two_loads(spark, sf_dir))
    return feed.select("complaint_id", "change", *[F.col(f"{v}.{c}").alias(f"{v}_{c}") for c in _FEED for v in ("old", "new")])


@register(
    "signed_counts",
    _TWO_LOADS + f", stg AS ({O.staging_select('raw')}) SELECT product, count(*) AS n_complaints FROM stg GROUP BY product",
)
def q_signed_counts(spark, sf_dir):
    """Complaints by product, kept up to date by the signed rows of the change feed instead of being counted again."""
    existing, incoming = _two_loads(spark, sf_dir)
    existing, incoming = stored(existing, "existing"), stored(incoming, "incoming")
    counts = stage_complaints(existing).groupBy("product").agg(F.count(F.lit(1)).alias("n_complaints"))
    signed = C.signed_rows(C.change_feed(existing, incoming, carry=REQUIRED_FIELDS))
    return C.updated_counts(counts, signed, ["product"], grain=lambda rows: required_fields(rows).select(X.blank_default("product", NOT_SPECIFIED).alias("product"), "sign"))


@register(
    "fact_by_month",
    O.with_gold(
        "SELECT f.complaint_id, f.product_sk, CAST(year(f.date_received) * 100 + month(f.date_received) AS INTEGER) AS received_month, "
        "d.quarter, d.is_weekend FROM fact f JOIN dim_date d ON f.date_received_sk = d.date_sk WHERE d.year = 2010 + 3 AND d.quarter IN (2, 3)",
        extra=O.DIM_DATE,
    ),
)
def q_fact_by_month(spark, sf_dir):
    """The fact kept by received month; days chosen in the date dimension prune its parts."""
    table = VersionedTable(spark, shared_path(spark, "fact_by_month"), G.MONTH_PART)
    # The raw rows are dealt out by month; their keys, digests that no codec shortens, are made as they are written.
    raw = G.with_month(required_fields(raw_complaints(spark, sf_dir)))
    fact = table.read(table.replace(raw, (G.MONTH_PART, "complaint_id"), watch=lambda rows: G.with_month(fact_from_raw(rows))))
    days = stored(G.dim_date(spark), "dim_date").filter("year = 2013 AND quarter IN (2, 3)")
    return G.in_dates(fact, days).select("complaint_id", "product_sk", G.MONTH_PART, "quarter", "is_weekend")


@register(
    "load_profile",
    O.with_raw(
        "SELECT count(*) AS total_rows, count(date_received) AS valid_dates, "
        "count(DISTINCT product) AS distinct_products, "
        "round(CAST(count(date_received) * 100.0 / count(*) AS DOUBLE), 6) AS valid_date_pct FROM raw"
    ),
)
def q_load_profile(spark, sf_dir):
    return RAW.load_profile(raw_complaints(spark, sf_dir))


@register(
    "uniq_complaint_sk",
    f"""WITH fixture AS ({O.FIXTURE_SELECT})
SELECT {O.sk('complaint_id')} AS complaint_sk, count(*) AS n_records
FROM fixture GROUP BY 1 HAVING count(*) > 1""",
)
def q_uniq_complaint_sk(spark, sf_dir):
    f = fixture_complaints(spark, sf_dir, with_order=False)
    return (
        f.select(X.surrogate_key("complaint_id").alias("complaint_sk"))
        .groupBy("complaint_sk").agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


# ----------------------------------------------------- column-level operators

@register(
    "required_fields",
    O.with_raw(
        "SELECT complaint_id, date_received, product, company FROM raw WHERE complaint_id IS NOT NULL "
        "AND date_received IS NOT NULL AND product IS NOT NULL AND company IS NOT NULL"
    ),
)
def q_required_fields(spark, sf_dir):
    return required_fields(raw_complaints(spark, sf_dir)).select("complaint_id", "date_received", "product", "company")


_BLANKS = {
    "product": ("product", NOT_SPECIFIED),
    "sub_product": ("sub_product", NOT_SPECIFIED),
    "issue": ("issue", NOT_SPECIFIED),
    "sub_issue": ("sub_issue", NOT_SPECIFIED),
    "company_response": ("company_response_to_consumer", NOT_SPECIFIED),
    "submitted_via": ("submitted_via", UNKNOWN),
    "tags": ("tags", NO_TAGS),
}


@register(
    "blank_defaults",
    O.with_raw(
        "SELECT complaint_id, "
        + ", ".join(f"COALESCE(NULLIF(TRIM({src}), ''), '{d}') AS {out}" for out, (src, d) in _BLANKS.items())
        + " FROM raw"
    ),
)
def q_blank_defaults(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select(
        "complaint_id", *[X.blank_default(src, d).alias(out) for out, (src, d) in _BLANKS.items()]
    )


@register("normalize_names", O.with_raw("SELECT complaint_id, UPPER(TRIM(company)) AS company_name, UPPER(TRIM(state)) AS state FROM raw"))
def q_normalize_names(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select(
        "complaint_id", X.upper_trim("company").alias("company_name"), X.upper_trim("state").alias("state")
    )


@register("zip_lpad", O.with_raw("SELECT complaint_id, LPAD(TRIM(zip_code), 5, '0') AS zip_code FROM raw"))
def q_zip_lpad(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select("complaint_id", X.zip_lpad("zip_code").alias("zip_code"))


@register(
    "yes_no_flags",
    O.with_raw(
        "SELECT complaint_id, "
        "CASE WHEN UPPER(timely_response) = 'YES' THEN TRUE WHEN UPPER(timely_response) = 'NO' THEN FALSE END AS timely_response_flag, "
        "CASE WHEN UPPER(consumer_disputed) = 'YES' THEN TRUE WHEN UPPER(consumer_disputed) = 'NO' THEN FALSE END AS consumer_disputed_flag "
        "FROM raw"
    ),
)
def q_yes_no_flags(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select(
        "complaint_id",
        X.yes_no_flag("timely_response").alias("timely_response_flag"),
        X.yes_no_flag("consumer_disputed").alias("consumer_disputed_flag"),
    )


@register(
    "narrative_flag",
    O.with_raw(
        "SELECT complaint_id, CASE WHEN consumer_consent_provided = 'Consent provided' "
        "AND consumer_complaint_narrative IS NOT NULL THEN TRUE ELSE FALSE END AS has_narrative_flag FROM raw"
    ),
)
def q_narrative_flag(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select(
        "complaint_id",
        X.narrative_flag("consumer_consent_provided", "consumer_complaint_narrative").alias("has_narrative_flag"),
    )


@register(
    "date_guard",
    O.with_raw(
        "SELECT complaint_id, CASE WHEN date_sent_to_company >= date_received THEN date_sent_to_company END "
        "AS date_sent_to_company FROM raw"
    ),
)
def q_date_guard(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select(
        "complaint_id", X.guarded_sent_date("date_sent_to_company", "date_received").alias("date_sent_to_company")
    )


@register(
    "response_days",
    O.with_raw(
        "SELECT complaint_id, CASE WHEN date_sent_to_company IS NOT NULL AND date_received IS NOT NULL "
        "THEN CAST(date_sent_to_company - date_received AS INTEGER) END AS response_days FROM raw"
    ),
)
def q_response_days(spark, sf_dir):
    return raw_complaints(spark, sf_dir).select(
        "complaint_id", X.response_days("date_sent_to_company", "date_received").alias("response_days")
    )


@register(
    "date_keys",
    O.with_stg(
        f"SELECT complaint_id, {O.datekey('date_received')} AS date_received_sk, "
        f"{O.datekey('date_sent_to_company')} AS date_sent_to_company_sk FROM stg"
    ),
)
def q_date_keys(spark, sf_dir):
    return staged_complaints(spark, sf_dir).select(
        "complaint_id",
        X.date_key("date_received").alias("date_received_sk"),
        X.date_key("date_sent_to_company").alias("date_sent_to_company_sk"),
    )


@register(
    "surrogate_key",
    O.with_stg(
        f"SELECT complaint_id, complaint_sk, {O.sk('product', 'sub_product', 'issue', 'sub_issue')} AS product_key, "
        f"{O.sk('company_name', 'company_response')} AS company_key, {O.sk('state', 'zip_code')} AS geography_key FROM stg"
    ),
)
def q_surrogate_key(spark, sf_dir):
    return staged_complaints(spark, sf_dir).select(
        "complaint_id",
        "complaint_sk",
        X.surrogate_key(*G.PRODUCT_COLS).alias("product_key"),
        X.surrogate_key(*G.COMPANY_COLS).alias("company_key"),
        X.surrogate_key(*G.GEOGRAPHY_COLS).alias("geography_key"),
    )


@register(
    "timeliness_category",
    O.with_stg(
        "SELECT complaint_id, response_days, "
        f"{X.timeliness_case_sql('response_days')} AS response_timeliness_category FROM stg"
    ),
)
def q_timeliness_category(spark, sf_dir):
    return staged_complaints(spark, sf_dir).select(
        "complaint_id", "response_days", X.timeliness_category("response_days").alias("response_timeliness_category")
    )


@register(
    "region",
    O.with_raw(
        f"SELECT {X.region_case_sql('UPPER(TRIM(state))')} AS region, count(*) AS n_complaints FROM raw GROUP BY 1"
    ),
)
def q_region(spark, sf_dir):
    return (
        raw_complaints(spark, sf_dir)
        .groupBy(X.region(X.upper_trim("state")).alias("region"))
        .agg(F.count(F.lit(1)).alias("n_complaints"))
    )


# ------------------------------------------------------------------ joins

def _written_gold(spark, sf_dir):
    """Staging and the three dimensions, each written before the fact looks its keys up."""
    stg = stored(staged_complaints(spark, sf_dir).drop("complaint_narrative"), "staging")
    return stg, *(stored(f(stg), "dimension") for f in (G.dim_product, G.dim_company, G.dim_geography))


@register("fact_lookup_join", O.with_gold("SELECT * FROM fact"))
def q_fact_lookup_join(spark, sf_dir):
    """The fact by its definition: three left joins with the written dimensions."""
    stg, dp, dc, dg = _written_gold(spark, sf_dir)
    return G.fact_complaints(stg, dp, dc, dg, strategy="join")


@register(
    "fact_lookup_fan_out",
    O.with_gold(
        "SELECT s.complaint_id, d.product_sk FROM stg s LEFT JOIN "
        "(SELECT product_sk FROM dim_product UNION ALL SELECT product_sk FROM dim_product WHERE sub_product = 'Not Specified') d "
        f"ON {O.sk('s.product', 's.sub_product', 's.issue', 's.sub_issue')} = d.product_sk"
    ),
)
def q_fact_lookup_fan_out(spark, sf_dir):
    """A dimension in which some keys occur twice: the lookup join repeats their complaints, and ``auto`` must choose it."""
    stg, dp, dc, dg = _written_gold(spark, sf_dir)
    doubled = stored(dp.unionByName(dp.filter(F.col("sub_product") == NOT_SPECIFIED)), "dimension")
    strategy = G.choose_fact_strategy(doubled, dc, dg)
    return G.fact_complaints(stg, doubled, dc, dg, strategy=strategy).select("complaint_id", "product_sk")

@register(
    "fact_join_product",
    O.with_gold(
        "SELECT f.complaint_id, f.product_sk, dp.product_name, dp.sub_product, dp.issue, dp.sub_issue "
        "FROM fact f LEFT JOIN dim_product dp USING (product_sk)"
    ),
)
def q_fact_join_product(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return g["fact_complaints"].select("complaint_id", "product_sk").join(g["dim_product"], "product_sk", "left")


@register(
    "fact_join_company",
    O.with_gold(
        "SELECT f.complaint_id, f.company_sk, dc.company_name, dc.company_response "
        "FROM fact f LEFT JOIN dim_company dc USING (company_sk)"
    ),
)
def q_fact_join_company(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return g["fact_complaints"].select("complaint_id", "company_sk").join(g["dim_company"], "company_sk", "left")


@register(
    "fact_join_geography",
    O.with_gold(
        "SELECT f.complaint_id, f.geography_sk, dg.state, dg.region, dg.zip_code "
        "FROM fact f LEFT JOIN dim_geography dg ON f.geography_sk = dg.geography_sk"
    ),
)
def q_fact_join_geography(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    f = g["fact_complaints"].select("complaint_id", "geography_sk")
    d = g["dim_geography"]
    return f.join(d, f["geography_sk"] == d["geography_sk"], "left").select(
        "complaint_id", f["geography_sk"], "state", "region", "zip_code"
    )


@register(
    "rel_product",
    O.with_gold(
        "SELECT f.complaint_id, f.product_sk FROM fact f WHERE f.product_sk IS NOT NULL AND f.product_sk NOT IN "
        "(SELECT product_sk FROM dim_product WHERE product_name <> 'ECONOMY')"
    ),
)
def q_rel_product(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    parent = g["dim_product"].filter(F.col("product_name") != "ECONOMY")
    return Q.relationship_orphans(g["fact_complaints"], "product_sk", parent, "product_sk").select(
        "complaint_id", "product_sk"
    )


@register(
    "rel_company",
    O.with_gold(
        "SELECT f.complaint_id, f.company_sk FROM fact f WHERE f.company_sk IS NOT NULL AND f.company_sk NOT IN "
        "(SELECT company_sk FROM dim_company WHERE company_response <> 'Closed with explanation')"
    ),
)
def q_rel_company(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    parent = g["dim_company"].filter(F.col("company_response") != "Closed with explanation")
    return Q.relationship_orphans(g["fact_complaints"], "company_sk", parent, "company_sk").select(
        "complaint_id", "company_sk"
    )


# --------------------------------------------------------------- dim_date

@register(
    "dim_date",
    O.with_gold(
        "SELECT d.*, coalesce(r.n_received, 0) AS n_received FROM dim_date d LEFT JOIN "
        "(SELECT date_received_sk, count(*) AS n_received FROM fact GROUP BY 1) r ON d.date_sk = r.date_received_sk",
        extra=O.DIM_DATE,
    ),
)
def q_dim_date(spark, sf_dir):
    per_day = fact_only(spark, sf_dir).groupBy(F.col("date_received_sk").alias("date_sk")).agg(
        F.count(F.lit(1)).alias("n_received")
    )
    return G.dim_date(spark).join(per_day, "date_sk", "left").withColumn(
        "n_received", F.coalesce(F.col("n_received"), F.lit(0).cast("bigint"))
    )


# ---------------------------------------------------------- quality checks

@register(
    "test_date_logic",
    O.with_raw(
        "SELECT complaint_id, date_received, date_sent_to_company FROM raw WHERE date_sent_to_company < date_received"
    ),
)
def q_test_date_logic(spark, sf_dir):
    raw = raw_complaints(spark, sf_dir)
    return raw.filter(Q._date_logic()).select("complaint_id", "date_received", "date_sent_to_company")


@register(
    "test_timely_accuracy",
    O.with_gold(
        "SELECT complaint_id, response_days, timely_response_flag FROM fact "
        f"WHERE (response_days <= {O.THRESHOLD} AND timely_response_flag = FALSE) "
        f"OR (response_days > {O.THRESHOLD} AND timely_response_flag = TRUE)"
    ),
)
def q_test_timely_accuracy(spark, sf_dir):
    fact = fact_only(spark, sf_dir)
    return fact.filter(Q._timely_accuracy()).select("complaint_id", "response_days", "timely_response_flag")


@register(
    "accepted_submitted_via",
    O.with_gold(
        "SELECT submitted_via AS value_field, count(*) AS n_records FROM fact "
        f"WHERE submitted_via NOT IN {O.ACCEPTED['submitted_via']} GROUP BY submitted_via"
    ),
)
def q_accepted_submitted_via(spark, sf_dir):
    fact = fact_only(spark, sf_dir)
    c = F.col("submitted_via")
    return (
        fact.filter(c.isNotNull() & ~c.isin(*ACCEPTED_SUBMITTED_VIA))
        .groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    )


@register(
    "volume_gate",
    O.with_gold(
        f"SELECT count(*) AS n_rows, CAST({O.MIN_FACT_ROWS} AS BIGINT) AS min_rows, "
        f"CASE WHEN count(*) >= {O.MIN_FACT_ROWS} THEN 'pass' ELSE 'warn' END AS status FROM fact"
    ),
)
def q_volume_gate(spark, sf_dir):
    return Q.volume_gate(fact_only(spark, sf_dir))


@register("expectation_suite", O.suite_sql(Q.RAW_SUITE))
def q_expectation_suite(spark, sf_dir):
    # Two branches (the one-pass aggregate and the key count) read raw: derive the columns they need once.
    used = [c for c in RAW_COLUMNS if c in {e.column for e in Q.RAW_SUITE}]
    return Q.run_suite(stored(raw_complaints(spark, sf_dir).select(*used), "raw"))


@register("suite_from_write", O.suite_sql(Q.RAW_SUITE))
def q_suite_from_write(spark, sf_dir):
    """The expectation suite from metrics observed while raw is written; raw is read again for its ids only."""
    observed = M.Observed(M.raw_metrics(Q.RAW_SUITE, RAW_COLUMNS))
    table = VersionedTable(spark, shared_path(spark, "suite_from_write"))
    raw = table.read(table.replace(raw_complaints(spark, sf_dir), watch=observed.watch))
    return Q.run_suite(raw, metrics=observed.row(spark))


@register(
    "id_bitmaps",
    f"WITH fixture AS ({O.FIXTURE_SELECT}) SELECT CAST(sum(n) AS BIGINT) AS el, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS un, "
    "CAST(sum(n) - count(*) AS BIGINT) AS surplus FROM (SELECT complaint_id, count(*) AS n FROM fixture GROUP BY complaint_id)",
)
def q_id_bitmaps(spark, sf_dir):
    """Rows with an id, rows whose id is repeated, and surplus rows, from bitmaps of the ids."""
    rows = stored(with_id_range(fixture_complaints(spark, sf_dir, with_order=False).select("complaint_id"), width=MERGE_WIDTH), "ids")
    bitmaps = stored(M.id_bitmaps(rows, ID_PART), "id_bitmaps")
    surplus = M.bitmap_totals(bitmaps).agg(F.sum(F.col("n_rows") - F.col("n_ids")).alias("surplus"))
    counts = M.unique_counts_by_bitmap(rows, bitmaps)
    both = counts.unionByName(surplus, allowMissingColumns=True)
    return both.agg(*[F.max(c).cast("bigint").alias(c) for c in both.columns])


@register("failing_values", O.failing_values_sql(Q.RAW_SUITE, 20))
def q_failing_values(spark, sf_dir):
    """The 20 most frequent unexpected values of each expectation, ties by the value."""
    used = [c for c in RAW_COLUMNS if c in {e.column for e in Q.RAW_SUITE}]
    return Q.failing_values(stored(raw_complaints(spark, sf_dir).select(*used), "raw"), top=20)


_SINGULAR_SQL = {
    "test_date_logic": "date_sent_to_company < date_received",
    "test_timely_response_accuracy": (
        f"(response_days <= {O.THRESHOLD} AND timely_response_flag = FALSE) "
        f"OR (response_days > {O.THRESHOLD} AND timely_response_flag = TRUE)"
    ),
}


@register("dbt_tests", O.tests_sql(Q.MODEL_TESTS, _SINGULAR_SQL))
def q_dbt_tests(spark, sf_dir):
    # 27 checks read six models: derive each model once (as the daily run
    # does with its written layers), then run every check on the copies.
    raw = stored(raw_complaints(spark, sf_dir).drop("consumer_complaint_narrative"), "raw")
    stg = stored(stage_complaints(raw.withColumn("consumer_complaint_narrative", F.lit(None).cast("string"))), "staging")
    dp, dc, dg = (stored(f(stg), "dimension") for f in (G.dim_product, G.dim_company, G.dim_geography))
    fact = stored(G.fact_complaints(stg, dp, dc, dg), "fact")
    models = {"consumer_complaints": raw, "dim_product": dp, "dim_company": dc, "dim_geography": dg,
              "dim_date": G.dim_date(spark), "fact_complaints": fact}
    return Q.run_tests(models)


# ------------------------------------------------------------- more reports

_PRODUCT_JOIN = "FROM fact f LEFT JOIN dim_product dp USING (product_sk) GROUP BY dp.product_name"


@register(
    "timely_rate",
    O.with_gold(
        "SELECT dp.product_name, count(*) AS n_complaints, count(f.timely_response_flag) AS n_known_timely, "
        "round(avg(CASE WHEN f.timely_response_flag THEN 1.0::DOUBLE WHEN NOT f.timely_response_flag THEN 0.0::DOUBLE END), 6) AS timely_rate, "
        "count(CASE WHEN f.response_timeliness_category <> 'Unknown' THEN 1 END) AS n_known_days, "
        "round(avg(CASE WHEN f.response_timeliness_category IN ('Immediate', 'Fast', 'Timely') THEN 1.0::DOUBLE "
        "WHEN f.response_timeliness_category <> 'Unknown' THEN 0.0::DOUBLE END), 6) AS within_threshold_rate "
        + _PRODUCT_JOIN
    ),
)
def q_timely_rate(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return R.timely_rate(g["fact_complaints"], g["dim_product"])


@register(
    "dispute_rate",
    O.with_gold(
        "SELECT dp.product_name, count(*) AS n_complaints, count(f.consumer_disputed_flag) AS n_known_disputes, "
        "count(CASE WHEN f.consumer_disputed_flag THEN 1 END) AS n_disputed, "
        "round(avg(CASE WHEN f.consumer_disputed_flag THEN 1.0::DOUBLE WHEN NOT f.consumer_disputed_flag THEN 0.0::DOUBLE END), 6) "
        "AS dispute_rate " + _PRODUCT_JOIN
    ),
)
def q_dispute_rate(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return R.dispute_rate(g["fact_complaints"], g["dim_product"])


@register(
    "geo_concentration",
    O.with_gold(
        "SELECT region, state, grouping_level, n_complaints, "
        "round(CAST(n_complaints AS DOUBLE) * 100.0 / max(CASE WHEN grouping_level = 3 THEN n_complaints END) OVER (), 6) AS share_pct "
        "FROM (SELECT dg.region, dg.state, CAST(GROUPING(dg.region, dg.state) AS INTEGER) AS grouping_level, count(*) AS n_complaints "
        "FROM fact f LEFT JOIN dim_geography dg ON f.geography_sk = dg.geography_sk GROUP BY ROLLUP (dg.region, dg.state))"
    ),
)
def q_geo_concentration(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return R.geo_concentration(g["fact_complaints"], g["dim_geography"])


@register(
    "complaints_by_company",
    O.with_gold(
        "SELECT dc.company_name, count(*) AS n_complaints FROM fact f LEFT JOIN dim_company dc USING (company_sk) "
        "GROUP BY dc.company_name"
    ),
)
def q_complaints_by_company(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return R.complaints_by_company(g["fact_complaints"], g["dim_company"])


@register(
    "complaints_by_year",
    O.with_gold(
        "SELECT d.year, count(*) AS n_complaints, count(CASE WHEN has_narrative_flag THEN 1 END) AS n_with_narrative "
        "FROM fact f LEFT JOIN dim_date d ON f.date_received_sk = d.date_sk GROUP BY d.year",
        extra=O.DIM_DATE,
    ),
)
def q_complaints_by_year(spark, sf_dir):
    return R.complaints_by_year(fact_only(spark, sf_dir), G.dim_date(spark))


def _share_sql(col: str) -> str:
    return (
        f"SELECT {col}, n_complaints, round(CAST(n_complaints AS DOUBLE) * 100.0 / sum(n_complaints) OVER (), 6) AS share_pct "
        f"FROM (SELECT {col}, count(*) AS n_complaints FROM fact GROUP BY {col})"
    )


@register("complaints_by_channel", O.with_gold(_share_sql("submitted_via")))
def q_complaints_by_channel(spark, sf_dir):
    return R.complaints_by_channel(fact_only(spark, sf_dir))


@register("timeliness_distribution", O.with_gold(_share_sql("response_timeliness_category")))
def q_timeliness_distribution(spark, sf_dir):
    return R.timeliness_distribution(fact_only(spark, sf_dir))


_KNOWN = "CASE WHEN f.response_days >= 0 THEN f.response_days END"


@register(
    "response_time",
    O.with_gold(
        f"SELECT dp.product_name, count(*) AS n_complaints, count({_KNOWN}) AS n_known_days, "
        f"round(avg({_KNOWN}), 6) AS avg_days, round(quantile_cont({_KNOWN}, 0.5), 6) AS median_days, "
        f"round(quantile_cont({_KNOWN}, 0.9), 6) AS p90_days " + _PRODUCT_JOIN
    ),
)
def q_response_time(spark, sf_dir):
    g = gold_models(spark, sf_dir)
    return R.response_time(g["fact_complaints"], g["dim_product"])


_MONTHLY = (
    "monthly AS (SELECT CAST(date_trunc('month', date_received) AS DATE) AS month_start, count(*) AS n_complaints "
    "FROM fact WHERE date_received IS NOT NULL GROUP BY 1)"
)


@register(
    "monthly_growth",
    O.with_gold(
        "SELECT m.month_start, m.n_complaints, p.n_complaints AS n_prev_month, "
        "round(CAST(m.n_complaints - p.n_complaints AS DOUBLE) * 100.0 / p.n_complaints, 6) AS growth_pct "
        "FROM monthly m LEFT JOIN monthly p ON p.month_start = CAST(m.month_start - INTERVAL 1 MONTH AS DATE)",
        extra=_MONTHLY,
    ),
)
def q_monthly_growth(spark, sf_dir):
    return R.monthly_growth(fact_only(spark, sf_dir))


@register(
    "half_year_growth",
    O.with_gold(
        "SELECT anchor_month, "
        "CAST(sum(CASE WHEN month_start > anchor_month - INTERVAL 6 MONTH THEN n_complaints ELSE 0 END) AS BIGINT) AS n_last_period, "
        "CAST(sum(CASE WHEN month_start > anchor_month - INTERVAL 12 MONTH AND NOT (month_start > anchor_month - INTERVAL 6 MONTH) "
        "THEN n_complaints ELSE 0 END) AS BIGINT) AS n_prior_period, "
        "round(CAST(n_last_period - n_prior_period AS DOUBLE) * 100.0 / n_prior_period, 6) AS growth_pct "
        "FROM (SELECT *, max(month_start) OVER () AS anchor_month FROM monthly) GROUP BY anchor_month",
        extra=_MONTHLY,
    ),
)
def q_half_year_growth(spark, sf_dir):
    return R.half_year_growth(fact_only(spark, sf_dir))
