"""Toxicity as a severity grade, by cumulative-link ordinal regression.

A document is the set of its words and of the words' beginnings, which words
with other endings share.  One weight per feature serves all ordered
thresholds: P(grade <= k) = sigmoid(threshold_k - sum of the weights of the
document's features).  The result is the expected grade, the most likely grade and
the probability of any toxicity.

The labels say toxic or not.  Grades of the toxic training documents follow
from how many *indicative* words they hold, words at least ``INDICATIVE_RATIO``
times as frequent in toxic as in other training documents.

Defined cases
* null or empty text: no word, the grade that the thresholds give to an empty set;
* labels of unknown documents, null ids and null labels are not learned from; a document
  labelled several times is toxic if any label says so;
* no labelled document, or all labelled alike: no word has a weight and every document has severity 0;
* ties between grades: the lowest; a long text is scored whole; a document with a null id is scored;
* repeated rows are scored each; an empty table gives no rows;
* extra columns are not carried, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import staged
from grievance.llm.sampling import first_by_hash

#: Bound of the fit: labelled documents of either label, chosen by a hash of the id.
FIT_DOCS_PER_LABEL = 3000
#: A word needs so many training documents to get a weight.
MIN_DOCS = 5
#: Lengths of the word beginnings that are features too.
BEGINNINGS = (4, 5)
INDICATIVE_RATIO = 10.0
#: Fewest indicative features of grades 2 and 3; other toxic documents have grade 1.
GRADE_WORDS = (2, 5)
GRADES = 4
STEPS = 300
RATE = 0.5
#: Weight of the sum of absolute word weights in the loss: most words get exactly none.
SPARSITY = 5e-4

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """The text's words in lower case, and the first letters of longer ones, marked by a star."""
    found = set(_WORD.findall(text.lower())) if text else set()
    return found.union(*({w[:n] + "*" for w in found if len(w) > n} for n in BEGINNINGS))


def grades(docs: list[set[str]], toxic: np.ndarray) -> np.ndarray:
    """Grade of each training document: 0, or 1 to 3 by its number of indicative features."""
    bad, good = Counter(), Counter()
    for d, t in zip(docs, toxic, strict=True):
        (bad if t else good).update(d)
    n_bad, n_good = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    marks = {w for w, n in bad.items() if n >= MIN_DOCS and n / n_bad >= INDICATIVE_RATIO * (good[w] + 1) / n_good}
    held = np.array([len(d & marks) for d in docs])
    return np.where(toxic, 1 + np.searchsorted(GRADE_WORDS, held, side="right"), 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def thresholds_of(first: float, gaps: np.ndarray) -> np.ndarray:
    return first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def fit(docs: list[set[str]], toxic: np.ndarray) -> dict:
    """``{"words": {word: weight}, "thresholds": [...]}``; no thresholds if there is nothing to tell apart.

    Proximal gradient steps with a rate per weight; the thresholds stay in
    order because their gaps are exponentials.
    """
    toxic = np.asarray(toxic, dtype=bool)
    if not toxic.any() or toxic.all():
        return {"words": {}, "thresholds": []}
    seen = Counter(w for d in docs for w in d)
    vocabulary = sorted(w for w, n in seen.items() if n >= MIN_DOCS)
    index = {w: i for i, w in enumerate(vocabulary)}
    columns = [[index[w] for w in sorted(d) if w in index] for d in docs]
    row = np.repeat(np.arange(len(docs)), [len(c) for c in columns])
    col = np.array([i for c in columns for i in c], dtype=np.int64)
    y = grades(docs, toxic)
    n, v = len(docs), len(vocabulary)

    w, first, gaps = np.zeros(v), 0.0, np.zeros(GRADES - 2)
    squares = np.full(v + 1 + len(gaps), 1e-8)
    for _ in range(STEPS):
        cut = np.concatenate([[-np.inf], thresholds_of(first, gaps), [np.inf]])
        s = np.bincount(row, weights=w[col], minlength=n)
        upper, lower = _sigmoid(cut[y + 1] - s), _sigmoid(cut[y] - s)
        p = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_cut = np.bincount(y, weights=-d_upper, minlength=GRADES)[:-1] + np.bincount(y, weights=d_lower, minlength=GRADES)[1:]
        after = np.cumsum(by_cut[::-1])[::-1]
        grad = np.concatenate([
            np.bincount(col, weights=(d_upper - d_lower)[row], minlength=v)[:v], [after[0]], after[1:] * np.exp(gaps) + 0.01 * n * gaps,
        ]) / n
        squares += grad**2
        rate = RATE / np.sqrt(squares)
        step = rate * grad
        w = w - step[:v]
        w = np.sign(w) * np.maximum(np.abs(w) - rate[:v] * SPARSITY, 0)
        first -= step[v]
        gaps = np.clip(gaps - step[v + 1 :], -5, 5)
    kept = np.flatnonzero(w)
    return {"words": {vocabulary[i]: float(w[i]) for i in kept}, "thresholds": thresholds_of(first, gaps).tolist()}


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  per_label: int = FIT_DOCS_PER_LABEL) -> dict:
    """Fit on at most ``per_label`` documents of either label, in one task; the model's words come to the driver.

    The model's size is bounded by the words of the sample.
    """
    label = labels.select(F.col(id_col).alias("_id"), (F.col(label_col) != 0).alias("_toxic")).dropna().groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    chosen = first_by_hash(label, "_toxic", "_id", per_label)
    chosen = F.broadcast(staged(chosen, "chosen"))  # 2 * per_label rows at most
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).dropna().join(chosen, "_id").select("_id", "_text", "_toxic")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_id", "_text"]).drop_duplicates("_id")
        return pd.DataFrame({"model": [json.dumps(fit([words(t) for t in pdf["_text"]], pdf["_toxic"].to_numpy(dtype=bool)))]})

    found = rows.groupBy(F.lit(0).alias("_all")).applyInPandas(one, "model string").collect()
    return json.loads(found[0]["model"]) if found else {"words": {}, "thresholds": []}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_severity, grade, p_toxic, toxic`` for every document, from its whole text."""
    weights, cut = model["words"], np.array(model["thresholds"])

    def judge(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = weights.get
        for pdf in batches:
            s = np.array([sum(x for x in map(get, sorted(words(t) & weights.keys()))) for t in pdf["_text"]], dtype=float)
            above = 1 - _sigmoid(cut[None, :] - s[:, None])  # P(grade > k)
            each = -np.diff(np.concatenate([np.ones((len(s), 1)), above, np.zeros((len(s), 1))], axis=1), axis=1)
            p = above[:, 0] if len(cut) else np.zeros(len(s))
            yield pd.DataFrame({
                "doc_id": pdf["_id"].astype("Int64"), "expected_severity": above.sum(axis=1), "grade": each.argmax(axis=1), "p_toxic": p, "toxic": p >= 0.5,
            })

    schema = "doc_id long, expected_severity double, grade int, p_toxic double, toxic boolean"
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInPandas(judge, schema)
