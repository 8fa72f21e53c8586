"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters are a set of elements (letter, how often it came before), so a
binary vector; words one inserted, deleted or replaced letter apart have
vectors of Hamming distance one or two.  The elements are dealt by a hash into
``PARTS`` parts.  Two vectors that differ in at most two elements agree in all
but two parts, so they share one of the signatures made of every choice of
``PARTS - 2`` parts.  An equi-join on the signatures therefore finds all pairs,
and each pair is verified letter by letter inside the join.

Letters alone bring together anagrams and words of like syllables, so a
signature is refined by something else that one edit leaves alone: either the
first half of the shorter word or its second half stands in both words.  Every
signature is made for both halves, at the word's own length and, to meet words
one shorter, at the length less one.  Groups that share a signature then are
little more than the pairs wanted; Spark splits hot ones in the join.

Counting words needs no Python: runs are counted with partial sums before the
shuffle, and a word that fills the corpus is one row per map task.

Defined cases: null text has no words; a null id counts as the empty string
when a run's noise is drawn; rows are counted as often as they stand there;
ties of the most frequent near word go to the smallest in code-point order;
long texts and long runs are handled whole (signatures take time in proportion
to length times its logarithm); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import staged
from grievance.llm.shingles import mix

#: Letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
#: Shortest word, least number of occurrences, and one in how many runs loses a letter.
MIN_LETTERS, MIN_COUNT, NOISE = 7, 2, 31
#: A near word is a word's form from this multiple of the word's own count.
FACTOR = 10
#: Parts of the letter vectors, and the largest Hamming distance of one edit.
PARTS, DISTANCE = 4, 2


def _lower(run: Column) -> Column:
    plain = F.octet_length(run) == F.char_length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, string.ascii_uppercase, string.ascii_lowercase))


def runs(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``doc_id, run`` for every maximal run of at least so many letters, A-Z in lower case.

    Shorter runs give no word: noise only makes runs shorter.
    """
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{min_letters},}}"), F.lit(0))).alias("run"))
    return found.select("doc_id", _lower(F.col("run")).alias("run"))


def noisy(found: DataFrame, one_in: int = NOISE) -> DataFrame:
    """``word``: the runs, of which one in ``one_in`` loses the letter that its hash points at."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = found.select("run", F.crc32(key.cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def count_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, one_in: int = NOISE) -> DataFrame:
    """``word, n``: the distinct words of ``docs`` (``doc_id, text``) and how often they occur."""
    words = noisy(runs(docs, min_letters), one_in).filter(F.char_length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def letter_signatures(words: list[str], parts: int = PARTS) -> np.ndarray:
    """One row per word: a hash of its letters in each choice of ``parts - DISTANCE`` parts."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    letter = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    order = np.lexsort((letter, word))
    letter, word = letter[order], word[order]
    new = np.concatenate([[True], (letter[1:] != letter[:-1]) | (word[1:] != word[:-1])])[: len(letter)]
    before = np.arange(len(letter)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    element = mix((letter << np.uint64(32)) + before.astype(np.uint64) + np.uint64(1))
    sums = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(sums, (word, (element % np.uint64(parts)).astype(np.int64)), mix(element))
    chosen = [sums[:, list(c)].sum(axis=1, dtype=np.uint64) + np.uint64(j + 1) for j, c in enumerate(combinations(range(parts), parts - DISTANCE))]
    return mix(np.stack(chosen, axis=1)).view(np.int64)


def _with_signatures(words: DataFrame, parts: int) -> DataFrame:
    """``word, n, sig``: one row for each signature."""

    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(letter_signatures(batch.tolist(), parts)), dtype=object)

    sigs = F.pandas_udf(sign, "array<long>")  # type: ignore[call-overload]
    return words.select("word", "n", F.explode(sigs("word")).alias("sig"))


def near_pairs(words: DataFrame, parts: int = PARTS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of distinct words of ``words`` (``word, n``) exactly one edit apart, once."""
    signed = staged(_with_signatures(words, parts), "signatures")
    length = F.char_length("word")

    def keyed(base: Column) -> DataFrame:
        """For a shorter word of ``base`` letters: keys of its first and of its second half."""
        half = F.floor(base / 2).cast("int")
        first, second = F.substring("word", F.lit(1), half), F.substring("word", length - (base - half) + 1, base - half)
        keys = F.explode(F.array(F.xxhash64("sig", base, F.lit(1), first), F.xxhash64("sig", base, F.lit(2), second)))
        return signed.select("word", "n", keys.alias("key"))

    own = keyed(length)
    longer = keyed(length - 1).filter(length > min_letters)
    left = own.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = own.unionByName(longer).select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    ordered = (F.char_length("a") < F.char_length("b")) | ((F.char_length("a") == F.char_length("b")) & (F.col("a") < F.col("b")))
    # A pair can share several signatures.
    return left.join(right, "key").filter(ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b").distinct()


def group_variants(words: DataFrame, factor: int = FACTOR, parts: int = PARTS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words`` (``word, n``; distinct words)."""
    words = staged(words.select("word", "n"), "words")
    pairs = staged(near_pairs(words, parts, min_letters), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    large = -F.col("best.less") >= factor * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"),
    )
    judged = staged(judged, "judged")
    forms = judged.filter("form IS NOT NULL").select("word", "form")
    return judged.join(_roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word of each chain of ``forms`` (``word, form``).

    A form is more frequent than its word, so chains end; each round doubles the part of a chain that is behind a word.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(roots.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return roots


#: The same rows in DuckDB: words one edit apart share what is left when a letter is deleted.
ORACLE_SQL = """
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([k FOR k IN range(8)], lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))
), long_runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents)
), counted AS (
  SELECT doc_id, run, count(*) AS k, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM long_runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, k, xor(list_reduce([ord_at FOR ord_at IN bytes], lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT run, k, [('0x' || substr(hex(b), 2 * i + 1, 2))::BIGINT FOR i IN range(octet_length(b))] AS bytes FROM counted), tab
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), less AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM less x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM less x JOIN words y ON x.rest = y.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top_n, min(other) FILTER (WHERE n = m) AS top
  FROM (SELECT *, max(n) OVER (PARTITION BY word) AS m FROM near) GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top_n >= 10 * w.n THEN b.top END AS form, CASE WHEN b.top_n >= 10 * w.n THEN b.top_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, coalesce(form, word) AS root FROM judged
  UNION SELECT c.word, j.form FROM chain c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL
), last AS (
  SELECT c.word, c.root FROM chain c JOIN judged j ON c.root = j.word WHERE j.form IS NULL
)
SELECT j.word, j.form, l.root, j.n, j.n_near, j.form_n FROM judged j JOIN last l USING (word)
"""
