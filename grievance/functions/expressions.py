"""Column-level building blocks.

Every function here maps Columns to a Column built from Spark's own
expressions, so the optimizer can fold, push down and code-generate them;
none of them runs Python per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from grievance.schemas import (
    CONSENT_PROVIDED,
    NA_TOKENS,
    REGIONS,
    SURROGATE_KEY_NULL_MARKER,
    SURROGATE_KEY_SEPARATOR,
    TIMELINESS_BUCKETS,
    TIMELINESS_LATE,
    UNKNOWN,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- ingestion-side (text) parsing -----------------------------------------

def null_if_na_token(c: ColumnOrName, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """Text equal to one of the missing-value tokens becomes NULL (exact match, no trim)."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


# Time of day as text: hours and minutes, optional seconds and fraction.
_CLOCK = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.]\d+)?)?"
_ISO_TEXT = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}([T ]{_CLOCK} ?(Z|[+-]\d{{2}}:?\d{{2}})?)?$"
_US_TEXT = rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}( {_CLOCK}( ?[AaPp][Mm])?)?$"
_NUMBER_TEXT = r"^[+-]?(\d+([.]\d*)?|[.]\d+)([eE][+-]?\d{1,3})?$"


def lenient_date(c: ColumnOrName) -> Column:
    """Month/day/year or ISO text to DATE; text that is no date, or has no valid time of day, gives NULL.

    Surrounding blanks do not matter.  A time may follow, with optional
    seconds and fraction, AM/PM (month/day/year) or a zone (ISO); the date is
    taken as written.  The day is cast as ISO text, which needs no formatter.
    """
    c = F.btrim(_col(c))
    day = F.regexp_extract(c, "^[0-9/-]+", 0)
    return (
        F.when(c.rlike(_ISO_TEXT), day)
        .when(c.rlike(_US_TEXT), F.regexp_replace(day, "^([0-9]+)/([0-9]+)/([0-9]+)$", "$3-$1-$2"))
        .try_cast("date")
    )


def lenient_bigint(c: ColumnOrName) -> Column:
    """Decimal number text to BIGINT: integers exactly, fractions truncated, anything else to NULL.

    Only plain decimal or exponent notation counts: type suffixes (``123d``)
    and hexadecimal text are junk, not numbers.
    """
    c = F.btrim(_col(c))
    exact = F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,10)").try_cast("bigint"))
    return F.when(c.rlike(_NUMBER_TEXT), F.coalesce(exact, c.try_cast("double").try_cast("bigint")))


def zip5(c: ColumnOrName) -> Column:
    """First five characters of a ZIP; the literal text 'nan' is a missing value."""
    head = F.substring(_col(c), 1, 5)
    return F.when(head != F.lit("nan"), head)


# --- staging expressions ----------------------------------------------------

def blank_default(c: ColumnOrName, default: str) -> Column:
    """Trim spaces; empty or NULL becomes ``default``."""
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(default))


def upper_trim(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_col(c)))


def zip_lpad(c: ColumnOrName) -> Column:
    """Left-pad with zeros to five characters (longer values are cut to five)."""
    return F.lpad(F.trim(_col(c)), 5, "0")


def yes_no_flag(c: ColumnOrName) -> Column:
    """'yes'/'no' in any case to TRUE/FALSE; anything else (untrimmed) to NULL."""
    u = F.upper(_col(c))
    return F.when(u == F.lit("YES"), F.lit(True)).when(u == F.lit("NO"), F.lit(False))


def narrative_flag(consent: ColumnOrName, narrative: ColumnOrName) -> Column:
    """TRUE only when consent was given and a narrative is present; never NULL."""
    cond = (_col(consent) == F.lit(CONSENT_PROVIDED)) & _col(narrative).isNotNull()
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def guarded_sent_date(sent: ColumnOrName, received: ColumnOrName) -> Column:
    """The forwarding date, kept only when it is not before the received date."""
    sent, received = _col(sent), _col(received)
    return F.when(sent >= received, sent)


def response_days(sent: ColumnOrName, received: ColumnOrName) -> Column:
    """Days from received to sent, from the *unguarded* dates (negatives survive)."""
    sent, received = _col(sent), _col(received)
    return F.when(sent.isNotNull() & received.isNotNull(), F.datediff(sent, received))


def date_key(d: ColumnOrName) -> Column:
    """DATE to an integer yyyymmdd key (arithmetic, no string formatting)."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 of the '-'-joined text of the columns, NULLs replaced by a marker.

    Matches the hashing of the warehouse's generated keys exactly, including
    its known ambiguity: ('a-b', 'c') and ('a', 'b-c') hash alike.
    """
    parts = [
        F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL_MARKER))
        for c in cols
    ]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


# --- business classifications (expression macros) --------------------------

def timeliness_category(days: ColumnOrName) -> Column:
    """NULL or negative -> Unknown; 0-3 Immediate; 4-7 Fast; 8-15 Timely; else Late."""
    d = _col(days)
    expr = F.when(d.isNull() | (d < 0), F.lit(UNKNOWN))
    for label, lo, hi in TIMELINESS_BUCKETS:
        expr = expr.when(d.between(lo, hi), F.lit(label))
    return expr.otherwise(F.lit(TIMELINESS_LATE))


def region(state: ColumnOrName) -> Column:
    """Region name of a two-letter state code; NULL or unlisted -> Unknown."""
    s = _col(state)
    items = list(REGIONS.items())
    first_label, first_states = items[0]
    expr = F.when(s.isin(*first_states), F.lit(first_label))
    expr = reduce(lambda acc, kv: acc.when(s.isin(*kv[1]), F.lit(kv[0])), items[1:], expr)
    return expr.otherwise(F.lit(UNKNOWN))


def timeliness_case_sql(arg: str) -> str:
    """The timeliness rule as a SQL CASE text, for a SQL temporary function."""
    arms = " ".join(
        f"WHEN {arg} BETWEEN {lo} AND {hi} THEN '{label}'" for label, lo, hi in TIMELINESS_BUCKETS
    )
    return (
        f"CASE WHEN {arg} IS NULL OR {arg} < 0 THEN '{UNKNOWN}' {arms} "
        f"ELSE '{TIMELINESS_LATE}' END"
    )


def region_case_sql(arg: str) -> str:
    """The region rule as a SQL CASE text."""
    arms = " ".join(
        "WHEN {a} IN ({v}) THEN '{r}'".format(a=arg, v=", ".join(f"'{s}'" for s in states), r=name)
        for name, states in REGIONS.items()
    )
    return f"CASE {arms} ELSE '{UNKNOWN}' END"
