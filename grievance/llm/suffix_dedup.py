"""Exact repeated strings across documents, by a distributed difference cover.

A byte goes when it lies in a string of ``SPAN`` bytes that also starts in a
document with a smaller id.  Strings are compared as bytes, within documents,
on the input as it is.

The steps, each a Spark job over blocks of a few megabytes of text:

1. *Phrases.* Content-defined cuts split every document; a phrase is the text
   from a cut up to ``SPAN - 1`` bytes after the next.  A phrase that a smaller
   document has too goes whole, and only one copy of each is looked at further.
2. *Anchors.* The least hash of the ``ANCHOR``-byte strings of a window is the
   same wherever the window occurs.  Windows whose anchor no other document
   has cannot repeat; the rest are cut out as segments.
3. *Difference cover* of the segments.  Positions count in steps of six bytes
   modulo three; of any two positions one shift by no, one or two steps brings
   both into the sample of residues 1 and 2.  The triples of sampled steps (18
   bytes) are sorted and named, triples of names are sorted and named again,
   which covers the span, with names for its last 44 and 38 bytes as well.
4. *Merging.* Sampled windows meet by their names; a remaining window meets those
   of residue 1 by its first step and the name after it, those of residue 2 by
   two steps and the name after them.  Neighbours with an equal prefix are one
   group, and its smallest id decides.

What travels between blocks are sorted arrays of keys, each distinct key of a
block once, so a string that a third of all documents hold is one key per block.
Answers return in the order of the keys.  Text and segments never travel again:
they are tables in buckets by groups of blocks, and the answers are dealt into
the same buckets, together with a note of every row's place among the keys, so
that no step sorts again what an earlier one has sorted.

Defined cases
* null or empty text: no bytes, nothing removed; texts shorter than the span: nothing removed;
* repeated rows with one id do not remove each other, being no smaller; a null id compares with nothing;
* an empty table gives no rows; extra columns are not carried, whatever their names;
* a document is never split, so the longest one bounds a block from below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import bucketed, buckets, discard, release, staged
from grievance.llm.shingles import mix

SPAN = 50
#: Mean length of the stretch between two cuts, a power of two, and the bytes that decide a cut.
CUT_EVERY = 64
CUT_BYTES = 16
ANCHOR = 40
STEP = 6
#: Bytes of text in a block; bytes of text per bucket of keys.
BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 16_000_000
#: Neighbouring blocks of a part; bytes of text per bucket of parts, and how many of these there are at most.
PART_BLOCKS = 8
PART_BYTES = 32_000_000
MAX_PART_BUCKETS = 100_000

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


# --- arrays ----------------------------------------------------------------

_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64))


def window_hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """For each size a hash of every window of so many bytes, put together from windows of powers of two."""
    base = 0x9E37_79B9_7F4A_7C15
    part, length = _BYTE_HASH[data], 1
    out: list[tuple[np.ndarray | None, int]] = [(None, 0)] * len(sizes)
    while length <= max(sizes):
        for i, size in enumerate(sizes):
            if size & length:
                whole, have = out[i]
                if whole is None:
                    out[i] = (part, length)
                else:
                    n = max(len(data) - have - length + 1, 0)
                    out[i] = (whole[:n] * np.uint64(pow(base, length, 1 << 64)) + part[have : have + n], have + length)
        if 2 * length <= max(sizes):
            n = max(len(data) - 2 * length + 1, 0)
            part = part[:n] * np.uint64(pow(base, length, 1 << 64)) + part[length : length + n]
        length *= 2
    return [mix(whole) for whole, _ in out]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        n = max(len(out) - step, 0)
        out = np.minimum(out[:n], out[step : step + n])
        have += step
    return out


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the positions in any of the spans."""
    change = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:n]) > 0


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, compressed: all first bytes, then all second bytes, and so on, so that like stands by like."""
    raw = np.stack([np.ascontiguousarray(c, dtype="<u8").view(np.uint8).reshape(-1, 8).T for c in columns])
    return zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def unpacked(blob: bytes, columns: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(raw.transpose(0, 2, 1)).reshape(columns, -1).view("<u8").reshape(columns, -1)


def groups_of(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows stand together, and where a new group starts in it.

    Rows are sorted by the first two columns and a hash of the others.
    """
    if len(columns) == 1:
        order = np.argsort(columns[0])
    else:
        rest = [mixed(columns[2:])] if len(columns) > 3 else columns[2:]
        order = np.lexsort([*rest, columns[1], columns[0]])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row."""
    h = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9E37_79B9_7F4A_7C15) + c)
    return h


def bucket_of(columns: list[np.ndarray], n_buckets: int) -> np.ndarray:
    return mixed(columns) % np.uint64(n_buckets)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers below 2**32, compressed by planes of bytes."""
    planes = [np.ascontiguousarray(a, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(a) for a in arrays], dtype="<u8").tobytes() + b"".join(planes))


def unpack_arrays(blob: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    out, at = [], 8 * n
    for size in raw[:at].view("<u8").tolist():
        out.append(np.ascontiguousarray(raw[at : at + 4 * size].reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64))
        at += 4 * size
    return out


#: The bucket under which a block's note to itself stands.
NOTE = -1


class Places:
    """Each row's place among the distinct keys of a block, and the buckets in which these stand: what is needed of the keys to read the answers."""

    def __init__(self, place: np.ndarray, buckets_: np.ndarray, counts: np.ndarray):
        self.place, self.buckets, self.counts = place, buckets_, counts

    def note(self, *more: np.ndarray) -> bytes:
        return pack_arrays(self.place, self.buckets, self.counts, *more)

    @classmethod
    def read(cls, answers: list, more: int = 0) -> tuple[Places, list, list[np.ndarray]]:
        """The places, the answers of the buckets, and what else the block noted."""
        arrays = unpack_arrays(answers[0]["answer"], 3 + more)
        return cls(*arrays[:3]), answers[1:], arrays[3:]

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least value of each key's rows."""
        out = np.full(int(self.counts.sum()), np.iinfo(np.int64).max)
        np.minimum.at(out, self.place, values)
        return out

    def bits(self, answers: list) -> np.ndarray:
        """The answers as one flag per key."""
        return np.concatenate([np.unpackbits(np.frombuffer(a["answer"], dtype=np.uint8), count=n) for a, n in zip(answers, self.counts.tolist(), strict=True)]).astype(bool)

    def names(self, answers: list, columns: int) -> np.ndarray:
        """The answers as ``columns`` names per key: the bucket, then the rank in it."""
        ranks = np.concatenate([np.cumsum(unpacked(a["answer"], columns), axis=1, dtype=np.uint64) for a in answers], axis=1)
        return (np.repeat(self.buckets, self.counts).astype(np.uint64) << np.uint64(32)) | ranks


class Keys:
    """The distinct keys of a block, sorted by bucket and content, and each row's place among them."""

    def __init__(self, columns: list[np.ndarray], bucket: np.ndarray):
        short = len(columns) == 1  # a key of 32 bits: bucket and key in one number
        # Numbers of 16 bits sort in linear time.
        narrow = bucket.astype(np.uint16) if not len(bucket) or int(bucket.max()) < 1 << 16 else bucket
        order, new = groups_of([(bucket << np.uint64(32)) | columns[0]] if short else [narrow, *columns])
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.cumsum(new) - 1
        first = order[new]
        self.columns = [c[first] for c in columns]
        self.bucket = bucket[first].astype(np.int64)
        bounds = np.array(self.bounds(), dtype=np.int64).reshape(-1, 2)
        self.places = Places(self.place, self.bucket[bounds[:, 0]], bounds[:, 1] - bounds[:, 0])

    def bounds(self) -> list[tuple[int, int]]:
        """First and last key of each bucket that has keys."""
        cut = np.flatnonzero(np.diff(np.concatenate([[-1], self.bucket, [-1]]))).tolist()
        return list(zip(cut[:-1], cut[1:], strict=True))

    def rows(self, *more: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(bucket, columns) for each bucket that has keys."""
        for a, b in self.bounds():
            yield int(self.bucket[a]), packed(*[c[a:b] for c in (*self.columns, *more)])


# --- a block of documents --------------------------------------------------

class Block:
    """Documents joined in one array of bytes; positions are those of the array."""

    def __init__(self, ids: list[int], ends: list[int], text: bytes):
        self.ids = np.array(ids, dtype=np.int64)
        self.ends = np.array(ends, dtype=np.int64)
        self.data = np.frombuffer(text, dtype=np.uint8)
        size = np.diff(np.concatenate([[0], self.ends]))
        self.doc = np.repeat(np.arange(len(self.ids)), size)
        #: Whether a window starts here and ends within its document.
        self.window = np.arange(len(self.data)) + SPAN <= self.ends[self.doc] if len(self.data) else np.zeros(0, dtype=bool)

    def phrase_starts(self) -> np.ndarray:
        """Where the stretches of windows between cuts begin."""
        cut = np.zeros(len(self.data), dtype=bool)
        (h,) = window_hashes(self.data, CUT_BYTES)
        cut[: len(h)] = (h & np.uint64(CUT_EVERY - 1)) == 0
        begins = np.concatenate([[0], self.ends[:-1]])
        cut[begins[begins < len(self.data)]] = True
        return np.flatnonzero(cut & self.window)

    def phrase_stops(self, start: np.ndarray) -> np.ndarray:
        """Where they end; a phrase has ``SPAN - 1`` bytes more."""
        stop = np.concatenate([start[1:], [len(self.data)]])
        return np.minimum(stop, self.ends[self.doc[start]] - SPAN + 1)

    def phrase_keys(self, start: np.ndarray, n_buckets: int) -> Keys:
        raw, stop = self.data.tobytes(), self.phrase_stops(start)
        digests = b"".join([xxhash.xxh3_128_digest(raw[a : b + SPAN - 1]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)])
        both = np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2)
        return Keys([both[:, 0].copy(), both[:, 1].copy()], both[:, 0] % np.uint64(n_buckets))

    def anchors(self, windows: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, Keys]:
        """Anchors of the windows, by runs of windows that share one: each window's run, each run's document, the keys of the runs.

        A key is 32 bits of the anchor next to the bucket; a chance equality only makes a candidate too many.
        """
        least = sliding_least(window_hashes(self.data, ANCHOR)[0], SPAN - ANCHOR + 1)[windows]
        doc = self.doc[windows]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
        return np.cumsum(new) - 1, doc[new], Keys([least[new] >> np.uint64(32)], least[new] % np.uint64(n_buckets))


def covered_by(ids: np.ndarray, places: Places, answers: list) -> np.ndarray:
    """Which rows (with these ids) are in a group with a smaller id: by another block's answer or within this block."""
    return (ids > places.least(ids)[places.place]) | places.bits(answers)[places.place]


# --- exchange --------------------------------------------------------------

def exchange(asked: DataFrame, answer: Callable[[list[bytes]], list[bytes]], name: str, n_parts: int) -> DataFrame:
    """Bring all blobs of a bucket together and deal the answers, with the blocks' notes, out to the parts.

    ``part, <name>``: for each block of the part its number and ``bucket, answer`` in the order of the buckets.
    """
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        note = pdf["bucket"].iloc[0] <= NOTE
        bucket, found = (NOTE, pdf["payload"]) if note else (pdf["bucket"], answer(list(pdf["payload"])))
        return pd.DataFrame({"part": pdf["part"], "block": pdf["block"], "bucket": bucket, "answer": found})

    # The notes go the same way, each block's on its own, so that what blocks ask is written only once.
    apart = (F.lit(NOTE) - F.pmod(F.xxhash64("block"), F.lit(1 << 30))).cast("int")
    sent = asked.withColumn("bucket", F.when(F.col("bucket") == NOTE, apart).otherwise(F.col("bucket")))
    found = sent.groupBy("bucket").applyInPandas(one, "part long, block long, bucket int, answer binary")
    dealt = found.repartition(n_parts, "part")
    by_block = dealt.groupBy("part", "block").agg(F.array_sort(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))
    out = bucketed(by_block.groupBy("part").agg(F.collect_list(F.struct("block", "answers")).alias(name)), name, n_parts, "part", "none")
    release(out.sparkSession)
    return out


def smaller_ids(columns: int) -> Callable[[list[bytes]], list[bytes]]:
    """Answers whether another blob has the key with a smaller id (the last column)."""
    def answer(blobs: list[bytes]) -> list[bytes]:
        parts = [unpacked(b, columns + 1) for b in blobs]
        all_ = [np.concatenate([p[i] for p in parts]) for i in range(columns + 1)]
        order, new = groups_of(all_[:-1])
        ids = all_[-1].view(np.int64)
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        out = np.empty(len(order), dtype=bool)
        out[order] = ids[order] > least
        return _cut(np.packbits, out, parts)

    return answer


def _cut(write: Callable, values: np.ndarray, parts: list[np.ndarray]) -> list[bytes]:
    ends = np.cumsum([p.shape[1] for p in parts])
    return [write(values[e - p.shape[1] : e]).tobytes() for e, p in zip(ends, parts, strict=True)]


def other_documents(blobs: list[bytes]) -> list[bytes]:
    """Answers whether an anchor has two documents or more, in one blob or several.

    A blob has each anchor's distance from the one before, twice, plus one if several of its documents have it.
    """
    parts = [unpacked(b, 1) for b in blobs]
    anchor = np.concatenate([np.cumsum(p[0] >> np.uint64(1), dtype=np.uint64) for p in parts])
    docs = np.concatenate([(p[0] & np.uint64(1)) + np.uint64(1) for p in parts])
    order, new = groups_of([anchor])
    total = np.add.reduceat(docs[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    out = np.empty(len(order), dtype=bool)
    out[order] = total > 1
    return _cut(np.packbits, out, parts)


def _ranks(parts: list[np.ndarray], prefixes: list[Callable[[list[np.ndarray]], list[np.ndarray]]]) -> list[bytes]:
    """Names by sorting: the rank of each key's prefix among the bucket's keys, for every prefix."""
    all_ = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
    order = np.lexsort(all_[::-1])
    out = []
    for prefix in prefixes:
        new = np.zeros(len(order), dtype=np.uint64)
        for c in prefix(all_):
            s = c[order]
            new[1:] |= (s[1:] != s[:-1]).astype(np.uint64)
        rank = np.empty(len(order), dtype=np.uint64)
        rank[order] = np.cumsum(new)
        out.append(rank)
    ends = np.cumsum([p.shape[1] for p in parts])
    return [packed(*[np.diff(r[e - p.shape[1] : e], prepend=np.uint64(0)) for r in out]) for e, p in zip(ends, parts, strict=True)]


def name_triples(blobs: list[bytes]) -> list[bytes]:
    return _ranks([unpacked(b, 3) for b in blobs], [lambda c: c])


def name_names(blobs: list[bytes]) -> list[bytes]:
    """Names of 50, 44 and 38 bytes."""
    return _ranks([unpacked(b, 4) for b in blobs], [lambda c: c, lambda c: c[:3], lambda c: [c[0], c[1], c[2] >> np.uint64(48)]])


# --- segments --------------------------------------------------------------

class Segments:
    """Candidate segments of a block, joined, with what the difference cover needs of them."""

    def __init__(self, data: bytes, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        self.starts, self.sizes = starts, sizes  # of the windows, in the block
        length = sizes + SPAN - 1
        first = np.cumsum(length) - length
        seg = np.repeat(np.arange(len(sizes)), sizes)
        local = np.arange(len(seg)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        #: Windows: place in the joined data, place in the block, id.
        self.at = first[seg] + local
        self.in_block = starts[seg] + local
        self.ids = ids[seg]
        padded = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(2 * SPAN, dtype=np.uint8)]).astype(np.uint64)
        self.eight = padded[:-7].copy()  # eight bytes from each place, as a number
        for k in range(1, 8):
            self.eight = (self.eight << np.uint64(8)) | padded[k : len(padded) - 7 + k]
        self.residue = (self.at // STEP) % 3

    def bytes_at(self, at: np.ndarray, n: int) -> np.ndarray:
        return self.eight[at] >> np.uint64(8 * (8 - n))

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places whose names the merge asks for, and the number of each place among them."""
        r, at = self.residue, self.at
        chosen = np.zeros(len(self.eight), dtype=bool)
        chosen[at[r > 0]] = True
        chosen[at[r < 2] + STEP] = True
        chosen[at[r != 1] + 2 * STEP] = True
        return np.flatnonzero(chosen), np.cumsum(chosen) - 1

    def triples(self, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the triples that name ``bases``, and the number of each place among them."""
        chosen = np.zeros(len(self.eight), dtype=bool)
        chosen[bases] = True
        chosen[bases + 3 * STEP] = True
        return np.flatnonzero(chosen), np.cumsum(chosen) - 1

    def triple_keys(self, n_buckets: int) -> Keys:
        at, _ = self.triples(self.sample()[0])
        columns = [self.eight[at], self.eight[at + 8], self.bytes_at(at + 16, 2)]
        return Keys(columns, bucket_of(columns, n_buckets))

    def name_keys(self, n_buckets: int, name: np.ndarray) -> Keys:
        """Keys of the sampled places, with the names of the triples."""
        bases, _ = self.sample()
        _, number = self.triples(bases)
        columns = [name[number[bases]], name[number[bases + 3 * STEP]], self.eight[bases + 36], self.bytes_at(bases + 44, 6)]
        return Keys(columns, bucket_of(columns[:2], n_buckets))  # prefixes that are named stay in one bucket

    def ways(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows of each of the three ways in which windows meet."""
        r = self.residue
        return np.flatnonzero(r > 0), np.flatnonzero(r < 2), np.flatnonzero(r != 1)

    def merge_keys(self, n_buckets: int, named: np.ndarray) -> Keys:
        """Keys of the windows in all ways, with the names of 50, 44 and 38 bytes of the sampled places."""
        number, at = self.sample()[1], self.at
        n50, n44, n38 = named
        a, b, c = self.ways()
        zero = np.uint64(0)
        way = [np.uint64(k << 62) for k in range(3)]  # names are far below
        columns = [
            np.concatenate([n50[number[at[a]]] | way[0], n44[number[at[b] + STEP]] | way[1], n38[number[at[c] + 2 * STEP]] | way[2]]),
            np.concatenate([np.full(len(a), zero), self.bytes_at(at[b], STEP), self.eight[at[c]]]),
            np.concatenate([np.full(len(a), zero), np.full(len(b), zero), self.bytes_at(at[c] + 8, 4)]),
        ]
        return Keys(columns, bucket_of(columns, n_buckets))


# --- jobs ------------------------------------------------------------------

def make_blocks(docs: DataFrame) -> DataFrame:
    """``part, block, ids, ends, text`` of ``doc_id, text`` (bytes), in blocks of whole documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number // PART_BLOCKS], pa.int64()), pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([np.cumsum([len(t) for t in texts])], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())],
                names=["part", "block", "ids", "ends", "text"],
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or b""
                if ids and size + len(text) > BLOCK_BYTES:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if ids:
            yield block()

    return docs.mapInArrow(run, "part long, block long, ids array<long>, ends array<long>, text binary")


def with_answers(blocks: DataFrame, *names: DataFrame) -> DataFrame:
    """``blocks`` (in buckets by part) with their own answers of each exchange; NULL if a block asked nothing."""
    for answers in names:
        name = answers.columns[1]
        joined = blocks.join(answers.hint("shuffle_hash"), "part", "left")
        own = F.filter(F.col(name), lambda x: x["block"] == F.col("block"))
        blocks = joined.withColumn(name, F.try_element_at(own, F.lit(1))["answers"])
    return blocks


def _map(frame: DataFrame, columns: list[str], one: Callable[..., Iterator[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """Apply ``one`` to each block's columns; it yields result rows."""
    fields = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(one(*[c[0].as_py() for c in batch.slice(i, 1).columns]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=fields)

    return frame.select(*columns).mapInArrow(run, schema)


_ASK = "part long, block long, bucket int, payload binary"
_ASK_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def repeated_spans(blocks: DataFrame, n: int, n_parts: int) -> DataFrame:
    """``part, spans`` of parts with something to remove: for each block starts and ends in it, as two arrays of numbers."""
    texts = ["part", "block", "ids", "ends", "text"]

    def ask_phrases(part, block, ids, ends, text):
        b = Block(ids, ends, text)
        start = b.phrase_starts()
        if len(start):
            keys = b.phrase_keys(start, n)
            yield part, block, NOTE, keys.places.note(start)
            for bucket, payload in keys.rows(keys.places.least(b.ids[b.doc[start]]).view(np.uint64)):
                yield part, block, bucket, payload

    phrases = exchange(_map(blocks, texts, ask_phrases, _ASK, _ASK_TYPES), smaller_ids(2), "phrases", n_parts)

    def split(b: Block, answers: list | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that no covered phrase holds, and the covered spans."""
        if not answers:
            return tuple(np.zeros((3, 0), dtype=np.int64))
        places, answers, (start,) = Places.read(answers, 1)
        stop = b.phrase_stops(start)
        gone = covered_by(b.ids[b.doc[start]], places, answers)
        return np.flatnonzero(cover(len(b.data), start[~gone], stop[~gone])), start[gone], stop[gone] + SPAN - 1

    def ask_anchors(part, block, ids, ends, text, answers):
        b = Block(ids, ends, text)
        windows, _, _ = split(b, answers)
        if len(windows):
            run, doc, keys = b.anchors(windows, n)
            counts = document_counts(keys, doc)
            yield part, block, NOTE, keys.places.note(np.bincount(run))
            for a, z in keys.bounds():
                step = np.diff(keys.columns[0][a:z], prepend=np.uint64(0))
                yield part, block, int(keys.bucket[a]), packed(step * np.uint64(2) + counts[a:z] - np.uint64(1))

    def document_counts(keys: Keys, doc: np.ndarray) -> np.ndarray:
        """In how many documents of the block each key occurs, 2 standing for more."""
        low, high = np.full(len(keys.bucket), np.iinfo(np.int64).max), np.full(len(keys.bucket), -1)
        np.minimum.at(low, keys.place, doc)
        np.maximum.at(high, keys.place, doc)
        return (1 + (high > low)).astype(np.uint64)

    known = with_answers(blocks, phrases)
    anchors = exchange(_map(known, [*texts, "phrases"], ask_anchors, _ASK, _ASK_TYPES), other_documents, "anchors", n_parts)

    def cut_segments(part, block, ids, ends, text, phrase_answers, anchor_answers):
        b = Block(ids, ends, text)
        windows, gone_start, gone_end = split(b, phrase_answers)
        candidate = np.zeros(len(b.data), dtype=bool)
        if anchor_answers:
            places, answers, (lengths,) = Places.read(anchor_answers, 1)
            candidate[windows[np.repeat(places.bits(answers)[places.place], lengths)]] = True
        start, stop = spans_of(candidate)
        if len(start) or len(gone_start):
            raw = b.data.tobytes()
            yield (
                part, block, b"".join([raw[a : z + SPAN - 1] for a, z in zip(start.tolist(), stop.tolist(), strict=True)]),
                packed(start), packed(stop - start), packed(b.ids[b.doc[start]].view(np.uint64)), packed(gone_start, gone_end),
            )

    schema = "part long, block long, data binary, starts binary, sizes binary, ids binary, gone binary"
    both = with_answers(known, anchors)
    cut = _map(both, [*texts, "phrases", "anchors"], cut_segments, schema, [pa.int64(), pa.int64(), *[pa.binary()] * 5])
    segments = bucketed(cut, "segments", n_parts, "part", "zstd")
    discard(phrases, anchors)

    def open_(data, starts, sizes, ids) -> Segments:
        return Segments(data, *[unpacked(x, 1)[0].astype(np.int64) for x in (starts, sizes)], unpacked(ids, 1)[0].view(np.int64))

    parts = ["part", "block", "data", "starts", "sizes", "ids"]
    some = segments.filter(F.length("data") > 0)

    def ask(part: int, block: int, keys: Keys, *more: np.ndarray) -> Iterator[tuple]:
        yield part, block, NOTE, keys.places.note()
        yield from ((part, block, bucket, payload) for bucket, payload in keys.rows(*more))

    def ask_triples(part, block, *columns):
        yield from ask(part, block, open_(*columns).triple_keys(n))

    triples = exchange(_map(some, parts, ask_triples, _ASK, _ASK_TYPES), name_triples, "triples", n_parts)

    def ask_names(part, block, *columns):
        places, answers, _ = Places.read(columns[-1])
        yield from ask(part, block, open_(*columns[:-1]).name_keys(n, places.names(answers, 1)[0][places.place]))

    named = exchange(_map(with_answers(some, triples), [*parts, "triples"], ask_names, _ASK, _ASK_TYPES), name_names, "named", n_parts)
    discard(triples)

    def ask_merge(part, block, *columns):
        places, answers, _ = Places.read(columns[-1])
        s = open_(*columns[:-1])
        keys = s.merge_keys(n, places.names(answers, 3)[:, places.place])
        yield from ask(part, block, keys, keys.places.least(np.concatenate([s.ids[w] for w in s.ways()])).view(np.uint64))

    merged = exchange(_map(with_answers(some, named), [*parts, "named"], ask_merge, _ASK, _ASK_TYPES), smaller_ids(3), "merged", n_parts)
    discard(named)

    def found(part, block, data, starts, sizes, ids, gone, answers):
        start, end = unpacked(gone, 2).astype(np.int64)
        if data:
            s = open_(data, starts, sizes, ids)
            places, answers, _ = Places.read(answers)
            row = np.concatenate(s.ways())
            hit = s.in_block[np.unique(row[covered_by(s.ids[row], places, answers)])]
            start, end = np.concatenate([start, hit]), np.concatenate([end, hit + SPAN])
        if len(start):
            a, z = spans_of(cover(int(end.max()), start, end))
            yield part, block, packed(a, z)

    last = _map(with_answers(segments, merged), [*parts, "gone", "merged"], found, "part long, block long, spans binary", [pa.int64(), pa.int64(), pa.binary()])
    dealt = last.repartition(n_parts, "part").groupBy("part").agg(F.collect_list(F.struct("block", F.col("spans").alias("answers"))).alias("spans"))
    out = bucketed(dealt, "spans", n_parts, "part")
    discard(merged, segments)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text`` of every document.

    The digest is that of the remaining bytes; ``kept_text`` leaves out characters that lost some of their bytes.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    named = slim.filter("doc_id IS NOT NULL")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = min(MAX_PART_BUCKETS, max(buckets(total, PART_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    blocks = bucketed(make_blocks(named), "blocks", n_parts, "part", "zstd")
    spans = repeated_spans(blocks, buckets(total, BUCKET_BYTES), n_parts)

    def rest(ids, ends, text, spans_):
        start, end = unpacked(spans_, 2).astype(np.int64) if spans_ else np.zeros((2, 0), dtype=np.int64)
        begin = 0
        for doc, stop in zip(ids, ends, strict=True):
            a, z = np.searchsorted(end, begin, "right"), np.searchsorted(start, stop, "left")
            z = z if stop > begin else a
            own_a, own_z = np.maximum(start[a:z], begin), np.minimum(end[a:z], stop)
            edges = [begin, *np.stack([own_a, own_z], axis=1).ravel().tolist(), stop]
            kept = b"".join([text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
            yield doc, stop - begin, stop - begin - len(kept), len(own_a), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")
            begin = stop

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    done = _map(with_answers(blocks, spans), ["ids", "ends", "text", "spans"], rest, _RESULT, types)
    unnamed = slim.filter("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.col("text").cast("string").alias("kept_text"),
    )
    return done.unionByName(unnamed)
