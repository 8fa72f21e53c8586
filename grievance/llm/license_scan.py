"""Licence scan by canonical digest.

A text is brought to a canonical form - lower case, copyright statements dropped,
punctuation to blanks, hyphenated and British spellings to one form - and the
digest of the whole canonical text is joined with the digests of the known
licences, which go through the same expressions.  Each line of a document is
looked up as a text of its own as well, so that a notice inside a document is
found; nothing is matched in part.

Defined cases
* null text: no digest, no licence; blank text: the digest of the empty text;
* a line or text that only holds a copyright statement: the same as empty; where
  a licence opens on the same line, the statement ends there;
* a document that repeats a notice, or names several licences: each identifier once, sorted;
* two identifiers with one digest: the first in code point order;
* a long text is read whole, line by line; a null id is carried as it is;
* repeated rows give repeated results; an empty table gives no rows;
* extra columns are not carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.llm.license_texts import LICENCES, NOTICES

#: Words with which the known licences and notices open (fixed values).
OPENINGS: tuple[str, ...] = (
    "permission is hereby granted", "permission is granted", "permission to use", "redistribution and use", "this software is provided",
    "licensed under", "licenced under", "released under", "distributed under", "this work is licensed", "spdx-license-identifier",
)
#: A copyright statement at the beginning of a line, up to such words or the end of the line.
COPYRIGHT = r"^[^\p{L}\p{N}]*(?:copyright|©|\(c\) *[0-9]|all rights reserved)[\s\S]*?(" + "|".join(o.replace(" ", " +") for o in OPENINGS) + r"|\z)"
#: Spellings that count as equal (fixed values): found, written.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("recognised", "recognized"),
    ("https", "http"),
)


def canonical_line(line: Column) -> Column:
    """The canonical form of a text without line breaks."""
    low = F.regexp_replace(F.lower(line), COPYRIGHT, "$1")
    joined = F.regexp_replace(low, r"(\p{L})-(\p{L})", "$1$2")
    plain = F.btrim(F.regexp_replace(joined, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    spelled = plain
    for found, written in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{found}\b", written)
    british = plain.rlike(r"\b(" + "|".join(f for f, _ in SPELLINGS) + r")\b")
    return F.when(british, spelled).otherwise(plain)


def canonical_lines(text: Column) -> Column:
    """The canonical, non-empty lines of a text."""
    return F.filter(F.transform(F.split(text, "\n"), canonical_line), lambda x: x != "")


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_digests(spark: SparkSession, texts: Sequence[tuple[str, str]] = LICENCES + NOTICES) -> DataFrame:
    """``known_digest, license_id`` of the known texts: a table of fixed size."""
    rows = spark.createDataFrame([(k, t) for k, t in texts], "license_id string, _text string")
    return rows.select(digest(F.concat_ws(" ", canonical_lines(F.col("_text")))).alias("known_digest"), "license_id").distinct()


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, license_id`` (of the whole text) and ``line_licenses`` (of single lines, joined by blanks).

    ``known`` must be small, as the table of known texts is: its digests are
    broadcast for the join of whole texts, and are a constant of the lookup of lines.
    """
    known = known.groupBy("known_digest").agg(F.min("license_id").alias("license_id"))
    entries = known.collect()
    names = F.map_from_entries(F.array(*[F.struct(F.lit(d), F.lit(n)) for d, n in entries]))
    digests = F.array(*[F.lit(d) for d, _ in entries])
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("_lines")).select(
        "doc_id",
        F.when(F.col("_lines").isNotNull(), digest(F.concat_ws(" ", "_lines"))).alias("digest"),
        F.array_intersect(F.transform("_lines", digest), digests).alias("_hits"),
    )
    found = F.array_sort(F.array_distinct(F.transform("_hits", lambda d: names[d])))
    return rows.join(F.broadcast(known), F.col("digest") == F.col("known_digest"), "left").select(
        "doc_id", "digest", "license_id", F.when(F.size("_hits") > 0, F.concat_ws(" ", found)).alias("line_licenses")
    )


def _canonical_sql(x: str) -> str:
    """``canonical_line`` in DuckDB SQL."""
    out = f"regexp_replace(lower({x}), '{COPYRIGHT}', '\\1')"
    out = f"regexp_replace({out}, '(\\p{{L}})-(\\p{{L}})', '\\1\\2', 'g')"
    out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"
    for found, written in SPELLINGS:
        out = f"regexp_replace({out}, '\\b{found}\\b', '{written}', 'g')"
    return out


def _lines_sql(text: str) -> str:
    return f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: {_canonical_sql('x')}), lambda x: x <> '')"


def _known_sql() -> str:
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in LICENCES + NOTICES)
    return f"SELECT sha256(array_to_string({_lines_sql('t')}, ' ')) AS known, min(k) AS k FROM (VALUES {values}) AS v(k, t) GROUP BY 1"


#: DuckDB SQL for ``scan`` over ``documents``.
ORACLE_SQL = f"""
WITH known AS ({_known_sql()}), d AS (
  SELECT doc_id, {_lines_sql('text')} AS l FROM documents
), hit AS (
  SELECT doc_id, string_agg(DISTINCT k, ' ' ORDER BY k) AS line_licenses
  FROM (SELECT doc_id, sha256(unnest(l)) AS h FROM d) JOIN known ON h = known GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN l IS NOT NULL THEN sha256(array_to_string(l, ' ')) END AS digest, k AS license_id, line_licenses
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN known ON known.known = sha256(array_to_string(l, ' '))
"""
