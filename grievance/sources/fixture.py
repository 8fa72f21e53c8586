"""Complaint records derived from the benchmark tables.

The complaint pipeline's real input is a public CSV extract; the test and
bench data are TPC-H-style tables.  ``fixture_complaints`` maps one lineitem
row (with its order, customer, supplier and part) to one complaint record so
that every cleaning rule, key, check and report has work that grows with the
tables.  The same mapping is written in DuckDB SQL in ``grievance.plans.oracle``.

The modulo conditions below only *shape* field values (NULLs, blanks,
padding, bad tokens); no row is ever filtered out by them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.schemas import COLUMN_MAPPING, RAW_COLUMNS
from grievance.session import keep_methods_small

# Fixture shaping: state code per customer nation key 0..23 (24 -> NULL).
FIXTURE_STATES: tuple[str, ...] = (
    "NY", "CA", " tx ", "IL", "FL", "PR", "WA", "ma", "OH", "GA", "AE", "GU",
    "DC", "MN", "OR", "PA", "CO", "VI", "MI", "NC", "HI", "NJ", "", "AK",
)

# Order dates are moved by so many years, a multiple of four that keeps leap days, into the calendar dimension.
FIXTURE_YEARS = 16

# Columns that stand in for "position in file" when several rows share an id:
# the greatest tuple is the last record.
FIXTURE_ORDER: tuple[str, ...] = ("_ord_partkey", "_ord_suppkey", "_ord_price", "_ord_qty", "_ord_ship")

TABLES = ("lineitem", "orders", "customer", "supplier", "part")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(value: Column, mapping: dict, default: Column | None = None) -> Column:
    items = list(mapping.items())
    expr = F.when(value == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(value == F.lit(k), F.lit(v))
    return expr if default is None else expr.otherwise(default)


def fixture_rows(spark: SparkSession, sf_dir: str, order_parts: int | None = None) -> DataFrame:
    """Every lineitem with its order, customer, supplier and part, its ``complaint_id`` and the ``_ord_*`` columns.

    These rows are narrow; wide steps run on them, and ``fixture_columns``
    spells the complaint's columns behind.  ``order_parts`` deals the lineitems
    out by order into so many partitions for the last join.
    """
    keep_methods_small(spark)
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    s = read_table(spark, sf_dir, "supplier")
    p = read_table(spark, sf_dir, "part")

    # Plain inner equi-joins: the planner broadcasts the sides its size
    # statistics prove small and sort-merges the rest.  Customers meet the
    # orders before the lineitems do, and lineitem x orders comes last: its
    # rows lie by order, as the last record of an id needs them.
    lines = li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    if order_parts:
        lines = lines.repartition(order_parts, "l_orderkey")
    j = lines.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
    return j.withColumns(
        {
            "complaint_id": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint"),
            "_ord_partkey": F.col("l_partkey"),
            "_ord_suppkey": F.col("l_suppkey"),
            "_ord_price": F.col("l_extendedprice"),
            "_ord_qty": F.col("l_quantity"),
            "_ord_ship": F.col("l_shipdate"),
        }
    )


def fixture_key(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """The columns of ``fixture_rows`` that tell complaints apart: the id, with its order in front where the id decides it.

    With line numbers 0 to 9 an id has one order, and rows that lie by order
    need not move again.  Any other (or missing) number leaves the id alone.
    """
    line = F.col("l_linenumber")
    other = read_table(spark, sf_dir, "lineitem").filter(line.isNull() | ~line.between(0, 9))
    return ("complaint_id",) if other.limit(1).count() else ("l_orderkey", "complaint_id")


def fixture_columns(j: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``fixture_rows`` -> the 18 typed raw columns, and those of ``keep``."""
    lk, ln, pk, sk = (F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    odate = F.add_months(F.col("o_orderdate").cast("date"), 12 * FIXTURE_YEARS)
    cust = F.col("o_custkey")
    prio = F.col("o_orderpriority")

    cols = {
        "complaint_id": F.col("complaint_id"),
        "date_received": F.when(lk % 97 != 0, odate),
        "product": F.when(pk % 61 == 0, F.lit(None).cast("string"))
        .when(pk % 41 == 0, F.lit(""))
        .when(ln == 3, F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
        .otherwise(F.col("p_type")),
        "sub_product": F.when(pk % 7 != 0, F.col("p_brand")),
        "issue": F.concat(F.lit("Issue "), F.col("l_returnflag")),
        "sub_issue": F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(prio),
        "consumer_complaint_narrative": F.when(
            ln % 2 == 0, F.concat(F.lit("Narrative "), lk.cast("string"))
        ),
        "company_public_response": F.when(ln == 5, F.lit("Company chooses not to respond")),
        "company": F.when(pk % 59 != 0, F.concat(F.lit(" "), F.lower(F.col("s_name")), F.lit(" "))),
        "state": F.try_element_at(F.array(*[F.lit(x) for x in FIXTURE_STATES]), F.col("c_nationkey") + 1),
        "zip_code": F.when(cust % 19 == 0, F.lit(None).cast("string"))
        .when(cust % 23 == 0, F.concat((cust + 10000).cast("string"), F.lit("-6789")))
        .otherwise(cust.cast("string")),
        "tags": _case(ln, {1: "Older American", 2: "Servicemember", 3: ""}),
        "consumer_consent_provided": _case(F.col("l_returnflag"), {"R": "Consent provided", "A": "N/A"}),
        "submitted_via": _case(
            prio,
            {"1-URGENT": "Web", "2-HIGH": "Phone", "3-MEDIUM": "Postal mail", "5-LOW": "Carrier"},
            F.lit(""),
        ),
        "date_sent_to_company": F.when(
            pk % 53 != 0, F.date_add(odate, ((pk + sk) % 24 - 3).cast("int"))
        ),
        "company_response_to_consumer": _case(
            F.col("o_orderstatus"), {"F": "Closed with explanation", "O": ""}
        ),
        "timely_response": _case(lk % 10, {0: "No", 1: "yes", 2: " No", 3: None}, F.lit("Yes")),
        "consumer_disputed": _case(lk % 5, {0: "Yes", 1: "N/A"}, F.lit("No")),
    }
    return j.select(*[cols[name].alias(name) for name in RAW_COLUMNS], *keep)


def fixture_complaints(spark: SparkSession, sf_dir: str, with_order: bool = True) -> DataFrame:
    """18 typed raw columns (plus the ``_ord_*`` file-order stand-ins), one row per lineitem."""
    return fixture_columns(fixture_rows(spark, sf_dir), FIXTURE_ORDER if with_order else ())


# Fixture shaping for the text (CSV) path: how a NULL field is spelled.
TEXT_NULL_SPELLINGS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)
# How some dates are spelled: text before and after the ISO date (the last two: after month/day/year).
TEXT_DATE_SPELLINGS: tuple[tuple[str, str], ...] = (
    (" ", ""), ("", "  "), ("", " 10:11:12.5"), ("", "T10:11:12Z"), ("", " 10:11"), ("", "T23:59:59+02:00"), ("", " 25:00:00"),
    (" ", " 10:11 AM"), ("", " 1:02:03 PM"),
)


def fixture_text(raw: DataFrame, extra_column: bool = True) -> DataFrame:
    """Render typed raw complaints as CSV-style text under the human headers,
    in the extract's column order.

    Dates alternate between month/day/year and ISO spelling, some with blanks
    around them or a time of day behind them; some ids carry a '.0' suffix
    (float-looking) or are junk (letters, type suffixes, hexadecimal text),
    some dates are junk, and NULLs are spelled with one of the missing-value
    tokens.  With ``extra_column``
    a column that the normaliser must drop is appended.
    """
    cid = F.col("complaint_id")
    line, order = cid % 10, F.floor(cid / 10)
    null_word = F.element_at(
        F.array(*[F.lit(x) for x in TEXT_NULL_SPELLINGS]), (cid % len(TEXT_NULL_SPELLINGS) + 1).cast("int")
    )

    def text_date(c: str) -> Column:
        d = F.col(c)
        us, iso = F.date_format(d, "MM/dd/yyyy"), d.cast("string")
        plain = F.when(line % 2 == 1, us).otherwise(iso)
        spelled = F.when(order % 7 != 0, plain)
        for i, (before, after) in enumerate(TEXT_DATE_SPELLINGS):
            kind = us if after.endswith("M") else iso
            spelled = spelled.when(order % len(TEXT_DATE_SPELLINGS) == i, F.concat(F.lit(before), kind, F.lit(after)))
        return F.when(d.isNull(), null_word).when(order % 83 == 0, F.lit("unknown date")).otherwise(spelled)

    def text_id() -> Column:
        return (
            F.when(order % 89 == 0, F.concat(F.lit("ID"), cid.cast("string")))
            .when(order % 89 == 1, F.concat(cid.cast("string"), F.element_at(F.array(F.lit("d"), F.lit("F"), F.lit("L")), (line % 3 + 1).cast("int"))))
            .when(order % 89 == 2, F.concat(F.lit("0x"), cid.cast("string")))
            .when(line == 4, F.concat(cid.cast("string"), F.lit(".0")))
            .otherwise(cid.cast("string"))
        )

    out = []
    for header, name in COLUMN_MAPPING.items():
        if name == "complaint_id":
            e = text_id()
        elif name in ("date_received", "date_sent_to_company"):
            e = text_date(name)
        else:
            e = F.coalesce(F.col(name), null_word)
        out.append(e.alias(header))
    if extra_column:
        out.append(F.concat(F.lit("row-"), cid.cast("string")).alias("Extra column"))
    return raw.select(*out)


# Fixture shaping for whole records: narratives of several lines, and records with a field too many or too few.
LINES_EVERY, EXTRA_EVERY, SHORT_EVERY = 3, 79, 73


def multiline_narratives(raw: DataFrame) -> DataFrame:
    """Some narratives with quotes, commas and both kinds of line break."""
    c, text = F.col("consumer_complaint_narrative"), F.lit('\nsaid "no", twice\r\n\nend')
    return raw.withColumn("consumer_complaint_narrative", F.when(F.floor(F.col("complaint_id") / 10) % LINES_EVERY == 0, F.concat(c, text)).otherwise(c))


def write_record_files(text: DataFrame, path: str) -> None:
    """Write ``fixture_text`` as CSV records, one file per task that has rows, each file with its header.

    Some records get one field too many, some lack the last one.  Nothing is
    shuffled: a task's first row carries the header in front.
    """
    order = F.floor(F.substring("Extra column", 5, 20).cast("bigint") / 10)
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in text.columns]), options)
    short = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in text.columns[:-1]]), options)
    record = F.when(order % EXTRA_EVERY == 5, F.concat(whole, F.lit(",one more"))).when(order % SHORT_EVERY == 7, short).otherwise(whole)
    rows = text.select(record.alias("value"), F.monotonically_increasing_id().alias("row"))  # a task's part of the id starts at 0
    first = F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    head = F.lit(",".join(text.columns) + "\n")
    rows.select(F.when(first, F.concat(head, "value")).otherwise(F.col("value")).alias("value")).write.option("maxRecordsPerFile", 0).text(path, lineSep="\n")
