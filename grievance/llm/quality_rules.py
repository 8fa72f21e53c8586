"""Host-level quality rules.

Every document is measured on its whole text with DataFrame functions only.
Rule failures are then summed by host (the ``source`` column), each host's
failure rate is shrunk towards the corpus by a beta prior estimated from the
hosts themselves, and hosts whose shrunk rate passes a bound are rejected; the
verdict is joined back to the documents.

Defined cases
* null, empty or blank text: no word, all measures 0, ``base_failed`` TRUE;
* null host: a host of its own;
* a corpus of one host, or of hosts with equal rates: the prior is as strong as
  it may be, and the shrunk rate is the corpus rate;
* a long text is measured whole; a null id is carried as it is;
* repeated rows are measured and counted each; an empty table gives no rows;
* extra columns are not carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import BLANKS, spread, staged

#: Fewest words, and the largest share of words in repeated windows (in %), of an acceptable document.
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
#: Further rules that count for hosts: symbols per 100 words, repeated lines per 100 lines, mean word length.
MAX_SYMBOL_PCT = 10
MAX_DUP_LINE_PCT = 30
WORD_LENGTH = (3, 10)
#: A host is rejected when the shrunk failure rate of any rule is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength, in pseudo-documents.
PRIOR_STRENGTH = (1.0, 1e6)
#: Verdicts of up to so many hosts are broadcast; more are joined with salted keys.
BROADCAST_HOSTS = 100_000
SALTS = 64

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
RULES = ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """How many words lie in a window that the text holds twice or more."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        starts = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"])),
            lambda x: x["p"],
        )))
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, x: total + x,
        ))

    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANKS}]+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))

    def less(removed: str) -> Column:
        return F.length(F.translate(text, removed, "")).cast("long")

    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), F.col(host_col).alias("host"))
        .select(
            "doc_id", "host",
            less(_SPACE).alias("word_chars"),
            (F.length(text) - less(_SYMBOLS)).alias("n_symbols"),
            let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r"))).alias("_w"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("_l"),
        )
        .select(
            "doc_id", "host", F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", F.col("_l.n").alias("n_lines"),
            F.col("_l.d").alias("n_dup_lines"), F.col("_w.r").alias("n_repeat_words"),
        )
    )


def failures() -> dict[str, Column]:
    """Each rule as a condition on the measures."""
    words = F.col("n_words")
    return {
        "few_words": words < MIN_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PCT * words,
        "repeated_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("n_lines"),
        "word_length": (F.col("word_chars") < WORD_LENGTH[0] * words) | (F.col("word_chars") > WORD_LENGTH[1] * words),
    }


def host_verdicts(measures: DataFrame) -> DataFrame:
    """``host, n_docs, host_failed`` and each rule's shrunk rate.

    The prior of a rule is a beta distribution with the hosts' mean rate and
    the variance between hosts: their document-weighted variance less what
    chance alone would make of equal hosts.  One row of sums per rule reaches the driver.
    """
    hosts = staged(
        measures.groupBy("host").agg(F.count("*").alias("n_docs"), *[F.count(F.when(c, 1)).alias(r) for r, c in failures().items()]), "hosts"
    )
    n = F.col("n_docs")
    total = hosts.agg(F.sum(n).alias("n"), F.count("*").alias("hosts"), *[F.sum(r).alias(r) for r in RULES]).first()
    docs = total["n"] or 0
    mean = {r: (total[r] / docs if docs else 0.0) for r in RULES}
    spread_ = hosts.agg(*[F.sum(n * F.pow(F.col(r) / n - F.lit(mean[r]), 2)).alias(r) for r in RULES]).first()
    rates = {}
    for r in RULES:
        m = mean[r]
        variance = (spread_[r] - m * (1 - m) * total["hosts"]) / docs if docs else 0.0
        low, high = PRIOR_STRENGTH
        strength = min(max(m * (1 - m) / variance - 1, low), high) if variance > 0 else high
        rates[r] = (F.col(r) + F.lit(m * strength)) / (n + F.lit(strength))
    failed = F.greatest(*rates.values()) > MAX_HOST_RATE
    return hosts.select("host", "n_docs", failed.alias("host_failed"), *[rates[r].alias(f"{r}_rate") for r in RULES])


def with_verdicts(measures: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Documents with ``host_failed``: a broadcast of few hosts, or a join whose keys are salted."""
    verdicts = verdicts.select(F.col("host").alias("_host"), "host_failed")
    same = F.col("host").eqNullSafe(F.col("_host"))
    if verdicts.count() <= BROADCAST_HOSTS:
        joined = measures.join(F.broadcast(verdicts), same, "left")
    else:
        salted = measures.withColumn("_salt", F.pmod(spread("doc_id", "n_words", "word_chars"), F.lit(SALTS)))
        copies = verdicts.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = salted.join(copies, same & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy")
    return joined.drop("_host")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The measures of every document, ``base_failed``, ``host_failed`` and ``kept``."""
    measures = staged(measure(docs, id_col, text_col, host_col), "measures")
    base = failures()
    return with_verdicts(measures, host_verdicts(measures)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (base["few_words"] | base["repeated_words"]).alias("base_failed"),
        (~(base["few_words"] | base["repeated_words"]) & ~F.col("host_failed")).alias("kept"),
        "host_failed", "n_lines",
    )


#: DuckDB SQL for ``judge`` over ``documents``.
ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[{BLANKS}]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{BLANKS}]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS u(i)
), twice AS (
  SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) >= 2
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM win JOIN twice USING (doc_id, g), range(0, 5) AS r(k) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, source, len(w) AS n_words, length(regexp_replace(t, '[{BLANKS}]', '', 'g')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id
), f AS (
  SELECT *, (n_words < 10)::INT AS f1, (100 * n_repeat_words > 20 * n_words)::INT AS f2, (100 * n_symbols > 10 * n_words)::INT AS f3,
         (100 * n_dup_lines > 30 * n_lines)::INT AS f4, (word_chars < 3 * n_words OR word_chars > 10 * n_words)::INT AS f5
  FROM m
), h AS (
  SELECT source, rule, count(*) AS n, sum(v) AS k
  FROM (UNPIVOT f ON f1, f2, f3, f4, f5 INTO NAME rule VALUE v) GROUP BY ALL
), p AS (
  SELECT rule, sum(k) / sum(n) AS mean, sum(n) AS docs FROM h GROUP BY rule
), q AS (
  SELECT rule, mean, CASE WHEN v > 0 THEN least(greatest(mean * (1 - mean) / v - 1, 1), 1e6) ELSE 1e6 END AS s
  FROM (SELECT rule, any_value(mean) AS mean, (sum(n * pow(k / n - mean, 2)) - any_value(mean) * (1 - any_value(mean)) * count(*)) / any_value(docs) AS v FROM h JOIN p USING (rule) GROUP BY rule)
), verdict AS (
  SELECT source, max((k + mean * s) / (n + s)) > 0.5 AS host_failed FROM h JOIN q USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 + f2 > 0) AS base_failed,
       (f1 + f2 = 0 AND NOT host_failed) AS kept, host_failed, n_lines
FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source
"""
