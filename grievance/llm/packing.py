"""Packing token sequences: best fit, then local search by exchanging documents.

Documents are tokenised once, by Spark tasks; only lengths travel afterwards.
Pieces are dealt to groups of bounded size by a hash, each group is packed on
its own, and the documents of underfull sequences are dealt and packed again,
pass after pass, until one group holds them or a pass fills hardly any more.

Within a group the pieces are placed best fit, longest first.  The local search
then works on the underfull sequences: it moves a document, or exchanges one
for one or two for one, whenever that increases the sum of squared fills; a
sequence that runs empty disappears.  It ends when a whole round over the
underfull sequences changes nothing.

Defined cases
* null or empty text: no token but the closing one, a piece of length 1;
* a document of just the capacity is one full piece; of longer ones the first
  piece takes what does not fill a sequence;
* equal lengths: the order of (id, piece); repeated rows are separate documents;
* empty input: no rows.  Extra columns are not carried.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import buckets, spread, staged

CAPACITY = 2048
#: Pieces that one task packs at a time.  The time of the local search grows with the square of a group's underfull sequences.
GROUP = 2_000
#: Sequences filled less than this share are packed again in the next pass; a pass that leaves more than so much of the pieces to the next is the last.
FULL_SHARE = 0.999
WORTH_A_PASS = 0.8
#: Bytes of text tokenised together.
BATCH_BYTES = 8_000_000
END_ID = 0
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"

_RARE = re.compile(r"[^\x21-\x7e\xa1-ɏ\n ]")


def is_odd(text: str) -> bool:
    """Whether splitting the text into words at blanks could change its tokens."""
    return (
        not text or text[0] in " \n" or text[-1] in " \n" or _RARE.search(text) is not None
        or any(s in text for s in ("  ", " \n", "\n ", "\n\n", "<|"))
    )


def _byte_of_char() -> dict[str, int]:
    """The bytes that byte-level vocabularies write as printable characters."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Tokens:
    """Token ids of texts as little-endian 32-bit arrays.

    The vocabulary file is that of the ``tokenizers`` library.  Ordinary text
    goes through the same vocabulary as byte-pair ranks, which gives the same
    ids several times faster; text that holds a special token's string goes
    through ``tokenizers`` itself.  No token holds the end of a word and the
    blank that follows, so the ids of ``a b`` are those of ``a`` and of
    `` b``: each distinct word of a batch is encoded once.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding(
            "byte-level", mergeable_ranks=ranks, special_tokens={},
            # The splitting rule of byte-level vocabularies (fixed value).
            pat_str=r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
        )
        self.leads = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.leads[[i for b, i in ranks.items() if b[:1] == b" "]] = True

    def whole(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        odd = [is_odd(t) for t in texts]
        plain = self._by_word([t for t, o in zip(texts, odd, strict=True) if not o])
        return [self.whole(t) if o else next(plain) for t, o in zip(texts, odd, strict=True)]

    def _by_word(self, texts: list[str]) -> Iterator[np.ndarray]:
        if not texts:
            return
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_pylist()
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(words)), dtype="<u4")
        # A text's first word has no blank before it: it gets an entry of its own.
        first = [self.whole(t.partition(" ")[0]) for t in texts]
        code[at[:-1]] = len(words) + np.arange(len(texts))
        lead = np.flatnonzero(self.leads[ids])
        start = np.concatenate([lead, len(ids) + np.cumsum([0, *map(len, first)])])
        size = np.diff(start)[code]
        end = np.cumsum(size)
        ids = np.concatenate([ids, *first])[np.repeat(start[code] - (end - size), size) + np.arange(end[-1])]
        bounds = np.concatenate([[0], end])[at]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[a:b]


def cut(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the capacity."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity
    return ([(0, first)] if first else []) + [(a, capacity) for a in range(first, tokens, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer_path)
        for batch in batches:
            chars = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))])
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(chars, chars[at] + BATCH_BYTES, "right")) - 1)
                part = batch.slice(at, stop - at)
                rows: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), tokens.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    raw = ids.tobytes() + end
                    for n, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        rows.append((doc, n, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
                at = stop
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECE_TYPES, strict=True)], names=PIECE_NAMES)

    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(tokenise, PIECE_SCHEMA)


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, goes to the fullest bin with room.

    Bit ``r`` of ``has`` says whether a bin with room ``r`` is open, so the
    fullest bin with enough room is the lowest set bit from the length up.
    """
    bins: list[list[int]] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    has = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        if fit := has >> size:
            room = size + (fit & -fit).bit_length() - 1
            b = open_[room].pop()
            if not open_[room]:
                has ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > size:
            open_[room - size].append(b)
            has |= 1 << (room - size)
    return bins


def exchange(mine: list[int], theirs: list[int], room: int, lengths: list[int]) -> tuple[int, tuple[int, ...], tuple[int, ...]] | None:
    """The exchange that fills a bin most: (gain, items it gives, items it takes), or none.

    The bin ``mine`` has ``room`` left and is at least as full as ``theirs``,
    so any gain of up to ``room`` increases the sum of squared fills.
    """
    gives = [((), 0)] + [((i,), lengths[i]) for i in mine]
    one = [((j,), lengths[j]) for j in theirs]
    two = [((j, k), lengths[j] + lengths[k]) for n, j in enumerate(theirs) for k in theirs[n + 1 :]]
    pairs = [((i, k), lengths[i] + lengths[k]) for n, i in enumerate(mine) for k in mine[n + 1 :]]
    best = None
    for given, takes in ((gives, one), (gives[1:], two), (pairs, one)):
        takes = sorted(takes, key=lambda x: x[1])
        sums = [x[1] for x in takes]
        for g, size in given:
            at = bisect_right(sums, size + room) - 1
            if at >= 0 and (gain := sums[at] - size) > 0 and (best is None or gain > best[0]):
                best = (gain, g, takes[at][0])
                if gain == room:
                    return best
    return best


def local_search(bins: list[list[int]], lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Empty bins by exchanges between the emptiest bin and fuller ones.

    Ends when the free room of all underfull bins is less than one bin, so
    that no packing has fewer, or when a round over all underfull bins changes
    nothing: a bin without an exchange is tried again as long as others change.
    Bins of the same lengths have the same exchanges, so a pair of such bins
    that has none is not looked at twice.
    """
    fill = {n: sum(lengths[i] for i in b) for n, b in enumerate(bins)}
    under = {n for n in fill if fill[n] < capacity}
    kind = {n: tuple(sorted(lengths[i] for i in bins[n])) for n in under}
    none: set[tuple] = set()
    stuck: set[int] = set()
    moved = False  # since the round began
    while sum(capacity - fill[n] for n in under) >= capacity:
        if not (donors := under - stuck):
            if not moved:
                break
            stuck, moved = set(), False
            continue
        donor = min(donors, key=lambda n: (fill[n], n))
        changed = False
        for n in sorted(under - {donor}, key=lambda n: (-fill[n], n)):
            while fill[n] < capacity and fill[donor] <= fill[n] and bins[donor] and (kind[n], kind[donor]) not in none:
                if (found := exchange(bins[n], bins[donor], capacity - fill[n], lengths)) is None:
                    none.add((kind[n], kind[donor]))
                    break
                gain, given, taken = found
                bins[n] = [i for i in bins[n] if i not in given] + list(taken)
                bins[donor] = [i for i in bins[donor] if i not in taken] + list(given)
                fill[n] += gain
                fill[donor] -= gain
                kind[n], kind[donor] = (tuple(sorted(lengths[i] for i in bins[k])) for k in (n, donor))
                changed = moved = True
            if fill[n] == capacity:
                under.discard(n)
            if not bins[donor]:
                under.discard(donor)
                break
        if not changed:
            stuck.add(donor)
    return [b for b in bins if b]


def place(pdf: pd.DataFrame, base: int, capacity: int = CAPACITY) -> pd.DataFrame:
    """A group's pieces with ``sequence_id``, ``offset`` and the fill of their sequence."""
    pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
    lengths = pdf["length"].tolist()
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    order = [i for b in bins for i in b]
    of = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    out = pdf.iloc[order].reset_index(drop=True)
    size = out["length"].to_numpy()
    before = np.cumsum(size) - size
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    return out.assign(sequence_id=base + of, offset=before - before[first][of], _fill=np.bincount(of, weights=size).astype("int64")[of])


def pack(pieces_: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.

    First pass: groups dealt by a hash, in which a row's number parts equal
    rows.  Further passes: the pieces of sequences that are not full, dealt
    anew, so that the leftovers of all groups meet.
    """
    def placed(rows: DataFrame, n: int, pass_: int) -> DataFrame:
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            base = (pass_ << 56) + (int(pdf["_group"].iloc[0]) << 20)  # a group has fewer sequences than pieces
            return place(pdf, base, capacity).drop(columns="_group")

        dealt = rows.withColumn("_group", F.pmod(spread("doc_id", "piece", "ids_crc32", F.lit(pass_), F.monotonically_increasing_id()), F.lit(n)))
        return dealt.groupBy("_group").applyInPandas(one, PLACED_SCHEMA + ", _fill long")

    pieces_ = staged(pieces_.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    full = F.col("_fill") >= int(FULL_SHARE * capacity)
    done, left, pass_ = [], pieces_.count(), 0
    while True:
        groups = buckets(left, group)
        packed = staged(placed(pieces_, groups, pass_), "packed")
        before, pass_ = left, pass_ + 1
        pieces_ = packed.filter(~full).drop("sequence_id", "offset", "_fill")
        left = pieces_.count()
        if groups == 1 or left > WORTH_A_PASS * before:
            return reduce(DataFrame.unionByName, done, packed).drop("_fill")
        done.append(packed.filter(full))
