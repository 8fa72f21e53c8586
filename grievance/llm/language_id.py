"""Language identification by rank-order n-gram profiles.

A language profile lists the most frequent character n-grams of its training
text in order.  A document's own list, taken over its whole text, is compared
with every profile: each of its n-grams adds how far it is out of place, and an
n-gram the profile lacks adds the profile's length.  The smallest sum wins.

Defined cases
* null, empty or letterless text: language ``und``, score 0;
* ties between languages: the first in code point order;
* equally frequent n-grams: the order of their numbers;
* no labelled text at all: every document is ``und``; a row with a null id is judged, but not learned from;
* a long text is counted whole; an empty table gives no rows;
* repeated rows: each row is judged by itself; a row count is never changed;
* extra columns are carried through unless they have a result column's name,
  in which case the result replaces them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grievance.llm.common import fresh_name, staged
from grievance.llm.sampling import first_by_hash

UNDETERMINED = "und"
#: n-gram lengths, and how many n-grams a profile lists.
LENGTHS = (1, 2, 3)
PROFILE_SIZE = 300
#: Bound of the fit: labelled documents per language, chosen by a hash of the id.
TRAIN_DOCS_PER_LANGUAGE = 2000
#: Chosen ids are broadcast up to this number, so that only chosen texts leave their task.
BROADCAST_IDS = 1_000_000

_PAD = ord("_")
_BITS = 21  # of a code point


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The padded n-grams of all words of the text, lower-cased, as numbers in rising order, and their counts.

    An n-gram is the number whose digits are its code points.  Words are
    separated by one pad; a triple around a pad would span two words and is left out.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4") if text else np.zeros(0, dtype="<u4")
    is_letter = _letters()[points]
    if not is_letter.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    marked = np.concatenate([[_PAD], np.where(is_letter, points, _PAD), [_PAD]]).astype(np.int64)
    letter = np.concatenate([[False], is_letter, [False]])
    kept = letter | np.concatenate([[True], letter[:-1]])  # one pad after each word, and one before the first
    seq, letter = marked[kept], letter[kept]
    if not letter[1]:  # the text began with another character
        seq, letter = seq[1:], letter[1:]
    two = (seq[:-1] << _BITS) | seq[1:]
    three = ((two[:-1] << _BITS) | seq[2:])[letter[1:-1]]
    return np.unique(np.concatenate([seq[letter], two, three]), return_counts=True)


def gram_text(code: int) -> str:
    """An n-gram's characters."""
    out = ""
    while code:
        out = chr(code & ((1 << _BITS) - 1)) + out
        code >>= _BITS
    return out


def gram_code(gram: str) -> int:
    code = 0
    for c in gram:
        code = (code << _BITS) | ord(c)
    return code


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, in order; ties in the order of their numbers."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


def fit_profiles(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 per_language: int = TRAIN_DOCS_PER_LANGUAGE, size: int = PROFILE_SIZE) -> dict[str, list[str]]:
    """Profiles from at most ``per_language`` labelled documents of each language.

    The ids are chosen first, so the text of other documents is not shuffled;
    n-gram counts are summed by Spark, and only ``size`` rows per language
    reach the driver.
    """
    rows = labelled.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    rows = rows.filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & F.col("_id").isNotNull())
    chosen = staged(first_by_hash(rows, "_lang", "_id", per_language).select("_id").distinct(), "chosen")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen
    sample = rows.join(chosen, "_id", "left_semi").select("_lang", "_text")

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, texts in pdf.groupby("_lang")["_text"]:
                parts = [gram_counts(t) for t in texts]
                grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                total = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(grams))
                yield pd.DataFrame({"_lang": lang, "_gram": grams, "_n": total.astype(np.int64)})

    grams = sample.mapInPandas(count, "_lang string, _gram long, _n long").groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n"))
    top = Window.partitionBy("_lang").orderBy(F.desc("_n"), "_gram")
    listed = grams.withColumn("_rank", F.row_number().over(top)).filter(F.col("_rank") <= size).select("_lang", "_rank", "_gram")
    profiles: dict[str, list[str]] = {}
    for lang, _, gram in sorted(tuple(r) for r in listed.collect()):
        profiles.setdefault(lang, []).append(gram_text(gram))
    return profiles


class ProfileModel:
    """All profiles as one table of ranks: a row per n-gram, a column per language."""

    def __init__(self, profiles: dict[str, list[str]], size: int = PROFILE_SIZE):
        self.langs = sorted(profiles)
        self.size = size
        self.grams = np.array(sorted({gram_code(g) for lang in self.langs for g in profiles[lang]}), dtype=np.int64)
        # The last row is that of n-grams no profile has.
        self.ranks = np.full((len(self.grams) + 1, max(len(self.langs), 1)), -1, dtype=np.int64)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, [gram_code(g) for g in profiles[lang]]), j] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(*gram_counts(text), self.size)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0
        row = np.searchsorted(self.grams, own)
        row[self.grams[np.minimum(row, len(self.grams) - 1)] != own] = len(self.grams)
        theirs = self.ranks[row]
        out = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(own))[:, None]))
        total = out.sum(axis=0)
        best = int(total.argmin())
        return self.langs[best], 1.0 - float(total[best]) / (self.size * len(own))


def identify(df: DataFrame, profiles: dict[str, list[str]], text_col: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (1: every n-gram in its place, 0: none known)."""
    model = ProfileModel(profiles, size)

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("lang_pred", "score")]
    judged = fresh_name(df, "_judged")
    rows = df.select(*kept, judge(F.col(text_col)).alias(judged))
    return rows.select(*kept, f"{judged}.lang_pred", f"{judged}.score")


def held_out(id_col: str = "doc_id"):
    """TRUE for the quarter of ids that is never learned from (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def predict_documents(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out, then predict all rows from their text alone."""
    marked = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    profiles = fit_profiles(marked.filter(~F.col("held_out")))
    return identify(marked.drop("lang"), profiles).select("doc_id", "held_out", "lang_pred", "score")
