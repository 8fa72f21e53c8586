"""Fill-in-the-middle: texts cut at two unit borders and put together anew for infilling.

Units are lines, or code points.  The cuts are found by rank and select on
machine words: all texts of an Arrow batch are viewed as uint64, a few
additions and masks mark the bytes that end a unit, ``bitwise_count`` gives
the marks of each word, a binary search in their running sum finds the word of
the k-th mark, and a byte-wise running sum inside that word finds the byte.
No text is split into lines or decoded.

The draw is a function of the document's id and a salt alone: eight-digit
groups 1 to 4 of the hex sha256 of ``<salt>:<id>`` give the two cuts, whether
the text is transformed at all, and the order of its parts.  A text that holds
a sentinel, or is empty, stays plain; so the parts can be read back from the
output and its form without doubt (``restore``).

Defined cases: null text is the empty text; a row without an id has no draw
and stays plain; repeated rows get the same result; a long text costs time and
memory in proportion to its length (work goes on in slices of ``SLICE_BYTES``
or one text); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentinels before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of the texts that are transformed, and of these per cent with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
#: Bytes of text that are worked on at once, unless one text is longer.
SLICE_BYTES = 8 << 20

_ONES = np.uint64(0x0101_0101_0101_0101)
_LOW7 = np.uint64(0x7F7F_7F7F_7F7F_7F7F)
_HIGH = np.uint64(0x8080_8080_8080_8080)


def _words(data: np.ndarray) -> np.ndarray:
    """``data`` as little-endian uint64, with one zero word at least behind it."""
    out = np.zeros(len(data) // 8 + 2, dtype="<u8")
    out.view(np.uint8)[: len(data)] = data
    return out


def mark_newlines(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed."""
    x = words ^ (_ONES * np.uint64(0x0A))
    # Adding 0x7F to the low seven bits carries into the high bit unless they are zero; no byte disturbs the next.
    return ~(((x & _LOW7) + _LOW7) | x) & _HIGH


def mark_continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte 10xxxxxx, which is not the first of its code point."""
    return words & ~(words << np.uint64(1)) & _HIGH


class Marks:
    """Rank and select on the marked bytes of a buffer."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.until = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marks stand before each byte position."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        inside = self.marks[word] & ((np.uint64(1) << bits) - np.uint64(1))
        return np.where(word > 0, self.until[word - 1], 0) + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte position of each k-th mark (from 0)."""
        word = np.searchsorted(self.until, k, side="right")
        before = np.where(word > 0, self.until[word - 1], 0)
        # Byte j of the product counts the marks of bytes 0 to j; the mark sought is behind all bytes that count too few.
        upto = (self.marks[word] >> np.uint64(7)) * _ONES
        fewer = (upto[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8))) & np.uint64(0xFF)
        return word * 8 + (fewer.astype(np.int64) <= (k - before)[:, None]).sum(axis=1)


def _draws(ids: list, salt: str) -> np.ndarray:
    """Four numbers for each id."""
    out = np.zeros((len(ids), 4), dtype=np.int64)
    for row, i in zip(out, ids, strict=True):
        if i is not None:
            row[:] = np.frombuffer(hashlib.sha256(f"{salt}:{i}".encode()).digest()[:16], dtype=">u4")
    return out


def cut_texts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Marks]:
    """Per text: number of units, byte positions of both cuts; and the marks of bytes that begin no code point."""
    words = _words(data)
    continued = Marks(mark_continuations(words))
    start, end = offsets[:-1], offsets[1:]
    if unit == "line":
        ends = Marks(mark_newlines(words))
        filled = np.flatnonzero(end > start)
        open_end = np.zeros(len(start), dtype=np.int64)
        open_end[filled] = data[end[filled] - 1] != 0x0A
    else:
        # A code point ends where the next byte begins one: mark the beginnings, and look at the byte before.
        ends = Marks(~mark_continuations(words) & _HIGH)
        open_end = np.zeros(len(start), dtype=np.int64)
    first = ends.rank(start)
    n = ends.rank(end) - first + open_end
    cuts = []
    for units in (np.minimum(draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)), np.maximum(draws[:, 0] % (n + 1), draws[:, 1] % (n + 1))):
        at = np.where(units == 0, start, end)
        inner = np.flatnonzero((units > 0) & (units < n))
        if unit == "line":
            at[inner] = ends.select(first[inner] + units[inner] - 1) + 1
        else:
            at[inner] = ends.select(first[inner] + units[inner])
        cuts.append(at)
    return n, cuts[0], cuts[1], continued


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``SLICE_BYTES``, or one row."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, end
        at = end


def _transformer(schema: pa.Schema, salt: str, unit: str, rate: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p_mark, s_mark, m_mark = marks

    def rows(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        values = texts.buffers()[2]
        buffer = np.frombuffer(values, dtype=np.uint8)[offsets[0] : offsets[-1]] if values is not None and offsets[-1] > offsets[0] else np.zeros(0, dtype=np.uint8)
        offsets = offsets - offsets[0]
        doc_ids = ids.to_pylist()
        draws = _draws(doc_ids, salt)
        n, low, high, continued = cut_texts(buffer, offsets, draws, unit)
        start, end = offsets[:-1], offsets[1:]
        ranks = {at: continued.rank(b) for at, b in (("start", start), ("low", low), ("high", high))}
        prefix_chars = (low - start) - (ranks["low"] - ranks["start"])
        middle_chars = (high - low) - (ranks["high"] - ranks["low"])
        forms, outputs = [], []
        whole = buffer.tobytes()
        for k in range(len(doc_ids)):
            text = whole[start[k] : end[k]]
            if doc_ids[k] is None or not text or draws[k, 2] % 100 >= rate or any(m in text for m in marks):
                forms.append("plain")
                outputs.append(text)
                continue
            prefix, middle, suffix = whole[start[k] : low[k]], whole[low[k] : high[k]], whole[high[k] : end[k]]
            if draws[k, 3] % 100 < suffix_first:
                forms.append("spm")
                outputs.append(b"".join((s_mark, suffix, p_mark, prefix, m_mark, middle)))
            else:
                forms.append("psm")
                outputs.append(b"".join((p_mark, prefix, s_mark, suffix, m_mark, middle)))
        plain = np.array([f == "plain" for f in forms], dtype=bool)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n), pa.array(forms, pa.string()), pa.array(prefix_chars, mask=plain), pa.array(middle_chars, mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).cast(pa.string()).fill_null("")
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            for a, b in _slices(offsets):
                yield rows(batch.column(0)[a:b], texts[a:b])

    return run


def transform(docs: DataFrame, salt: str = "7", unit: str = "line", rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs`` (``doc_id, text``).

    ``unit`` is ``line`` (a line feed belongs to the line it ends) or ``char``.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit!r}")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([
        ("doc_id", to_arrow_type(kind)), ("n", pa.int64()), ("form", pa.string()),
        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
    ])
    return rows.mapInArrow(
        _transformer(schema, salt, unit, rate, suffix_first),
        f"doc_id {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restore(output: Column, form: Column) -> Column:
    """The text, from what ``transform`` made of it."""

    def between(a: str, b: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(b), F.lit(1)), F.lit(a), F.lit(2))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def with_digests(made: DataFrame) -> DataFrame:
    """The columns of ``transform`` with digests of the output and of the restored text instead of the output."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The same rows in DuckDB, for salt 7, lines, rate 100 and half of the texts with the suffix first.
ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents
), d AS (
  SELECT doc_id, t, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 25, 8))::BIGINT AS h4,
         length(t) - length(replace(t, chr(10), '')) + CASE WHEN t = '' OR t[-1] = chr(10) THEN 0 ELSE 1 END AS n,
         string_split(t, chr(10)) AS lines
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         t = '' OR doc_id IS NULL OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain
  FROM d
), l AS (
  SELECT *, CASE WHEN lo = 0 THEN 0 WHEN lo = n THEN length(t) ELSE length(array_to_string(lines[1:lo], chr(10))) + 1 END AS p,
         CASE WHEN hi = 0 THEN 0 WHEN hi = n THEN length(t) ELSE length(array_to_string(lines[1:hi], chr(10))) + 1 END AS q
  FROM c
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN p END AS prefix_chars, CASE WHEN NOT plain THEN q - p END AS middle_chars,
       sha256(CASE WHEN plain THEN t
                   WHEN h4 % 100 < 50 THEN '<S>' || substr(t, q + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, q - p)
                   ELSE '<P>' || substr(t, 1, p) || '<S>' || substr(t, q + 1) || '<M>' || substr(t, p + 1, q - p) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM l
"""
