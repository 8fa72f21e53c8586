"""Benchmark decontamination by question templates.

A text becomes a sequence of template tokens: words in lower case, with
numbers, units and names replaced by typed placeholders whose values are kept
as slots.  Windows of template tokens are joined by hash with the windows of
the benchmark's items.  Along an alignment of a document with an item the slot
values must map consistently - one value of the item to one value of the
document - so that a question with other numbers or names is caught and an
accidental likeness is not.  An alignment follows the order of the item's
windows; between one and the next the document may have a few words more or less.

A capitalised word at the start of a sentence may be a name or not.  Windows
are made for both readings, in items and documents; along an alignment such a
word counts as a name if its values map consistently, and as a word otherwise.

All items are also joined by their words as they stand, in lower case, so that
copies in another letter case are found, in which names cannot be told from
words, and items that are titles, capitals or rows of numbers.  Where an item has
template windows throughout, such a copy must hold nearly all of its words as they stand.  A copy with
other names or numbers is found where its letter case shows its names.

Defined cases
* null or empty text: no window, no match;
* an item shorter than a window is one window of its own length; windows need ``MIN_LITERALS`` words
  that are not placeholders; every item is also looked up literally, and the better of both coverages counts; an item without words, or of fewer than ``WINDOW`` numbers only, matches nothing;
* several alignments of a document with an item: the one that covers most counts;
* items with the same id are one item with the windows of all its rows;
* rows without an id, of documents or items, match nothing;
* a long text is read in stretches of the items' words, a long row of hits is one (document, item) alignment;
* repeated documents give one row per (document id, item); empty tables give no rows;
* extra columns are not carried, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, pairwise

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import staged

WINDOW = 8
MIN_LITERALS = 4
#: Share of an item's windows that a document must hold.
MIN_COVERAGE = 0.5
#: Share of its windows of words as they stand, where the item has template windows throughout: these decide on copies with other values.
LITERAL_COVERAGE = 0.9
#: Template tokens that a document may have more or less between two windows of an alignment.
SLACK = 8
#: A benchmark of up to so many windows is broadcast, and its words then thin out the documents' windows.
BROADCAST_WINDOWS = 200_000

NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
#: Number words and units (fixed values).
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half".split()
)
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz "
    "ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent degree degrees dollar dollars euro euros cent cents usd eur mph kmh".split()
)
#: Words that are no names where they open a sentence (fixed values).
OPENERS = frozenset(
    "a about after all also although an and another any are as at be because been before between both but by can could did do does "
    "during each every few finally for from given had has have he her here his how however i if in is it its let many more most much "
    "must my next no not now of on once one only or other our she should since so some suppose than that the their then there these "
    "they this those though thus to under until was we were what when where whether which while who whom whose why with without "
    "would you your".split()
)
#: Marks the slot value of a word that may be a name.
MAYBE = "?"
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:;|\n]")
_ENDS = frozenset(".!?:;|\n")
_RUN = re.compile(b"\x01+")


def tokens(text: str | None) -> list[str]:
    """Words, numbers and marks that end a sentence."""
    return _TOKEN.findall(text) if text else []


def read(found: list[str], starts: bool = True) -> tuple[list[str], list[str | None], list[int]]:
    """Template tokens, their slot values (none for words), and the positions of words that may be names.

    Neighbouring numbers are one.  A capitalised word inside a sentence is a
    name, neighbouring names are one; at the start of a sentence (``starts``: of the first) it is one if a name
    follows, and may be one unless it is a word that opens sentences.
    """
    out: list[str] = []
    slots: list[str | None] = []
    opens: list[int] = []
    last = None
    for n, t in enumerate(found):
        if t in _ENDS:
            starts, last = True, None
            continue
        low = t.lower()
        if t[0].isdecimal() or low in NUMBER_WORDS:
            kind = NUM
        elif last == NUM and low in UNITS:
            kind = UNIT
        elif t != low and t[0] != low[0] and (not starts or (n + 1 < len(found) and found[n + 1][0].isupper())):
            kind = NAME
        else:
            kind = None
            if starts and t[0] != low[0] and low not in OPENERS:
                opens.append(len(out))
        if kind == last and kind in (NAME, NUM):
            slots[-1] = f"{slots[-1]} {low}"
        else:
            out.append(kind or low)
            slots.append(low if kind else None)
        last, starts = kind, False
    return out, slots, opens


def template(found: list[str], starts: bool = True) -> tuple[list[str], list[str | None]]:
    """Template tokens and slot values, with words that may be names read as words."""
    return read(found, starts)[:2]


def windows(out: list[str], slots: list[str | None], size: int, opens: list[int], first: int = 0) -> Iterator[tuple[int, int, list[str]]]:
    """(position, hash, slot values) of each window with enough words, for each reading of the words at ``opens``."""
    least = min(MIN_LITERALS, size)
    for i in range(len(out) - size + 1):
        part, values = out[i : i + size], slots[i : i + size]
        spare = size - sum(s is not None for s in values) - least
        if spare < 0:
            continue
        yield first + i, _key(part), [s for s in values if s is not None]
        both = [p - i for p in opens[bisect_left(opens, i) : bisect_left(opens, i + size)]]
        for n in range(1, min(len(both), spare) + 1):
            for names in combinations(both, n):
                named, held = part.copy(), values.copy()
                for p in names:
                    named[p], held[p] = NAME, MAYBE + part[p]
                yield first + i, _key(named), [s for s in held if s is not None]


def neighbours(out: list[str], opens: list[int]) -> set[tuple[str, str]]:
    """Pairs of template tokens that follow each other, in each reading of the words at ``opens``."""
    forms = [(t,) for t in out]
    for p in opens:
        forms[p] = (out[p], NAME)
    return {(a, b) for x, y in pairwise(forms) for a in x for b in y}


@cache
def _at_least(n: int) -> re.Pattern[bytes]:
    """Runs of ``n`` flags or more."""
    return re.compile(b"\x01{%d,}" % n)


def likely_windows(out: list[str], slots: list[str | None], size: int, opens: list[int], pairs: frozenset[tuple[str, str]], first: int) -> Iterator[tuple[int, int, list[str]]]:
    """Those of ``windows`` whose neighbouring tokens are all in ``pairs``."""
    least = min(MIN_LITERALS, size)
    known = bytearray(map(pairs.__contains__, pairwise(out)))
    open_ = set(opens)
    for p in opens:  # either reading, beside either reading of its neighbour
        if p and not known[p - 1]:
            known[p - 1] = (out[p - 1], NAME) in pairs or (p - 1 in open_ and ((NAME, out[p]) in pairs or (NAME, NAME) in pairs))
        if p < len(known) and not known[p]:
            known[p] = (NAME, out[p + 1]) in pairs or (p + 1 in open_ and ((out[p], NAME) in pairs or (NAME, NAME) in pairs))
    starts = [i for m in _at_least(size - 1).finditer(known) for i in range(m.start(), m.end() - size + 2)] if size > 1 else range(len(out))
    if not starts:
        return
    forms = [((t, s),) for t, s in zip(out, slots, strict=True)]
    for p in opens:
        forms[p] = ((out[p], None), (NAME, MAYBE + out[p]))
    for i in starts:
        if bisect_left(opens, i) == bisect_left(opens, i + size):
            held = [s for s in slots[i : i + size] if s is not None]
            if size - len(held) >= least:
                yield first + i, _key(out[i : i + size]), held
            continue
        readings = [[x] for x in forms[i]]
        for p in range(i + 1, i + size):
            readings = [[*r, x] for r in readings for x in forms[p] if (r[-1][0], x[0]) in pairs]
            if not readings:
                break
        for r in readings:
            held = [s for _, s in r if s is not None]
            if size - len(held) >= least:
                yield first + i, _key([t for t, _ in r]), held


def _key(words: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(words)) - (1 << 63)


def plain_windows(words: list[str], size: int, first: int = 0) -> Iterator[tuple[int, int, list[str]]]:
    """(position, hash, no slots) of each window of lower-case words as they stand; numbers alone must fill a whole one."""
    for i in range(len(words) - size + 1):
        part = words[i : i + size]
        if size == WINDOW or any(not w[0].isdecimal() and w not in NUMBER_WORDS for w in part):
            yield first + i, _key(part), []


def likely_plain_windows(words: list[str], size: int, pairs: frozenset[tuple[str, str]], first: int) -> Iterator[tuple[int, int, list[str]]]:
    """Those of ``plain_windows`` whose neighbouring words are all in ``pairs``."""
    run = 0
    for end, pair in enumerate(pairwise(words), 1):
        run = run + 1 if pair in pairs else 0
        if run >= size - 1:
            yield first + end - size + 1, _key(words[end - size + 1 : end + 1]), []


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, size, item_pos, key, item_slots, spare, words, pairs, plain_pairs`` of the benchmark's items.

    Every item also has windows of its lower-case words as they stand, with a negative size: they find copies in
    another letter case, whose names cannot be told from words.  They are ``spare`` where the item has windows of its
    template from beginning to end.  An item's first window carries all its words,
    its pairs of neighbouring template tokens, and those of neighbouring words.
    """
    def split(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for item, text in zip(pdf["_id"], pdf["_text"], strict=True):
                found = tokens(text)
                out, slots, opens = read(found)
                size = min(WINDOW, len(out))
                # A word that the item also has in lower case is none of its names.
                opens = [p for p in opens if out[p] not in found]
                made = [(item, size, *w) for w in windows(out, slots, size, opens)] if size else []
                plain = [t.casefold() for t in found if t not in _ENDS]
                size = min(WINDOW, len(plain))
                spare = len({r[2] for r in made}) == len(out) - abs(made[0][1]) + 1 if made else False
                made += [(item, -size, *w) for w in plain_windows(plain, size)] if size else []
                made = [(*m, spare and m[1] < 0) for m in made]
                words, pairs = sorted({t.lower() for t in found}), [" ".join(x) for x in sorted(neighbours(out, opens))]
                own = (words, pairs, [" ".join(x) for x in sorted(set(pairwise(plain)))])
                rows += [(*m, *(([], [], []) if n else own)) for n, m in enumerate(made)]
            yield pd.DataFrame(rows, columns=["item_id", "size", "item_pos", "key", "item_slots", "spare", "words", "pairs", "plain_pairs"])

    slim = items.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).dropna()
    return slim.mapInPandas(split, "item_id long, size int, item_pos int, key long, item_slots array<string>, spare boolean, words array<string>, pairs array<string>, plain_pairs array<string>")


def document_windows(docs: DataFrame, sizes: list[int], vocabulary: frozenset[str] | None, id_col: str = "doc_id", text_col: str = "text",
                     pairs: frozenset[tuple[str, str]] = frozenset(), plain_pairs: frozenset[tuple[str, str]] = frozenset()) -> DataFrame:
    """``doc_id, size, doc_pos, key, doc_slots`` of documents.

    With a ``vocabulary`` only stretches of its words, numbers and capitalised
    words are turned into templates, and of these the windows whose neighbouring
    tokens are ``pairs`` (of the windows of words as they stand, ``plain_pairs``): no other window can be an item's.  Positions count the template tokens (or the words as they stand) of the whole document.
    """
    least = min(map(abs, sizes), default=WINDOW)
    typed, plain = [s for s in sizes if s > 0], [-s for s in sizes if s < 0]

    def all_windows(found: list[str]) -> Iterator[tuple[int, int, int, list[str]]]:
        out, slots, opens = read(found)
        for size in typed:
            yield from ((size, *w) for w in windows(out, slots, size, opens))
        words = [t.casefold() for t in found if t not in _ENDS]
        for size in plain:
            yield from ((-size, *w) for w in plain_windows(words, size))

    def stretch_windows(part: list[str], first: bool) -> Iterator[tuple[int, int, int, list[str]]]:
        """Windows of a stretch, by their places in it."""
        out, slots, opens = read(part, first)
        # Words of no item can only match as names.
        for p in opens:
            if out[p] not in vocabulary:
                out[p], slots[p] = NAME, MAYBE + out[p]
        opens = [p for p in opens if slots[p] is None]
        for size in typed:
            yield from ((size, *w) for w in likely_windows(out, slots, size, opens, pairs, 0))
        words = [t.casefold() for t in part if t not in _ENDS] if plain else []
        for size in plain:
            yield from ((-size, *w) for w in (plain_windows(words, size) if size == 1 else likely_plain_windows(words, size, plain_pairs, 0)))

    def places(found: list[str], may: bytes, stretches: Iterable[int]) -> dict[int, tuple[int, int]]:
        """How many template tokens, and words, stand before each stretch."""
        wanted, out = set(stretches), {}
        typed_at = plain_at = end = 0
        for run in _RUN.finditer(may):
            a, b = run.span()
            typed_at, plain_at, end = typed_at + a - end, plain_at + a - end, b  # words of no item
            if a in wanted:
                out[a] = (typed_at, plain_at)
            part = found[a:b]
            typed_at += len(read(part, a == 0)[0])
            plain_at += sum(t not in _ENDS for t in part)
        return out

    def of_text(text: str) -> Iterator[tuple[int, int, int, list[str]]]:
        found = tokens(text)
        if vocabulary is None:
            yield from all_windows(found)
            return
        may = bytes([t in vocabulary or not t.islower() for t in found])
        made = [(m.start(), w) for m in _at_least(least).finditer(may) for w in stretch_windows(found[m.start() : m.end()], m.start() == 0)]
        if made:  # most documents have no window, and their places are not counted
            before = places(found, may, {a for a, _ in made})
            yield from ((size, at + before[a][int(size < 0)], key, held) for a, (size, at, key, held) in made)

    def split(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["_id"], pdf["_text"], strict=True):
                rows += [(doc, *w) for w in of_text(text)]
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=["doc_id", "size", "doc_pos", "key", "doc_slots"])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "size", "doc_pos", "key", "doc_slots"])

    slim = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).dropna()
    return slim.mapInPandas(split, "doc_id long, size int, doc_pos int, key long, doc_slots array<string>")


Hit = tuple[int, int, list[str], list[str]]


def consistent(hits: list[Hit]) -> tuple[int, bool] | None:
    """(distinct item windows, whether a value differs) of an alignment's hits, or none if a name or number maps to two values.

    A word that may be a name and maps to several values is read as a word:
    windows in which it is another word do not count.
    """
    pairs = [[(i.lstrip(MAYBE), d.lstrip(MAYBE), i[0] == MAYBE or d[0] == MAYBE) for i, d in zip(h[2], h[3], strict=True)] for h in hits]
    values: dict[str, set[str]] = {}
    for i, d, _ in (x for p in pairs for x in p):
        values.setdefault(i, set()).add(d)
    kept = [(h, p) for h, p in zip(hits, pairs, strict=True) if not any(maybe and i != d and len(values[i]) > 1 for i, d, maybe in p)]
    sure: dict[str, str] = {}
    for i, d, maybe in (x for _, p in kept for x in p):
        if not maybe and sure.setdefault(i, d) != d:
            return None
    return len({h[0] for h, _ in kept}), any(i != d for _, p in kept for i, d, _ in p)


def chains(hits: list[Hit]) -> Iterator[list[Hit]]:
    """Longest first: hits whose positions grow in item and document, by nearly the same from one to the next.

    Each (document, item) position belongs to one chain; a hit looks back no further than the item is long.
    """
    by_point: dict[tuple[int, int], list[Hit]] = {}
    for h in hits:
        by_point.setdefault((h[1], h[0]), []).append(h)
    points = sorted(by_point)
    reach = max(i for _, i in points) - min(i for _, i in points) + SLACK
    score, before = [1] * len(points), [-1] * len(points)
    low = 0
    for n, (d, i) in enumerate(points):
        while points[low][0] < d - reach:
            low += 1
        best = (0, 0)
        for m in range(n - 1, low - 1, -1):
            gone, moved = d - points[m][0], i - points[m][1]
            drift = abs(gone - moved)
            if gone > 0 and moved > 0 and drift <= SLACK and (score[m], -drift) > best:
                best, before[n] = (score[m], -drift), m
        score[n] += best[0]
    used = [False] * len(points)
    for n in sorted(range(len(points)), key=lambda n: (-score[n], n)):
        chain = []
        while n >= 0 and not used[n]:
            used[n] = True
            chain += by_point[points[n]]
            n = before[n]
        if chain:
            yield chain


def alignments(hits: list[Hit]) -> Iterator[list[Hit]]:
    """The hits of each alignment of a document with an item: those of a single shift, and chains over neighbouring ones."""
    shifts: dict[int, list[Hit]] = {}
    for h in hits:
        shifts.setdefault(h[1] - h[0], []).append(h)
    yield from (shifts[at] for at in sorted(shifts))
    if len(shifts) > 1:
        yield from chains(hits)


def judge(groups: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The alignment of each document and item that covers most, of those with consistent slots."""
    for pdf in groups:
        rows = []
        for doc, item, of, least, raw in pdf.itertuples(index=False):
            hits = [(h["item_pos"], h["doc_pos"], list(h["item_slots"]), list(h["doc_slots"])) for h in raw]
            hits.sort()
            best: tuple[int, bool] = (0, False)
            for aligned in alignments(hits):
                if len({h[0] for h in aligned}) > best[0] and (found := consistent(aligned)) and found[0] > best[0]:
                    best = found
            if best[0] >= least * of:
                rows.append((doc, item, best[0] / of, *best))
        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "coverage", "n_windows", "reparameterised"])


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, item_id, coverage, n_windows, reparameterised`` of documents that hold an item."""
    rows = staged(item_windows(items, item_id_col, item_text_col), "item_rows")
    asked = staged(rows.drop("words", "pairs", "plain_pairs").groupBy("item_id", "item_pos", "size", "key", "item_slots").agg(F.min("spare").alias("spare")), "items")
    n = asked.count()
    sizes = sorted(r[0] for r in asked.select("size").distinct().collect())
    vocabulary, pairs, plain_pairs = None, frozenset(), frozenset()
    if n <= BROADCAST_WINDOWS:
        vocabulary = NUMBER_WORDS | UNITS | {r[0] for r in rows.select(F.explode("words")).distinct().collect()}
        pairs, plain_pairs = (frozenset(tuple(r[0].split(" ")) for r in rows.select(F.explode(c)).distinct().collect()) for c in ("pairs", "plain_pairs"))
    found = document_windows(docs, sizes, vocabulary, id_col, text_col, pairs, plain_pairs)
    known = asked.drop("spare")
    hits = found.join(F.broadcast(known) if n <= BROADCAST_WINDOWS else known, ["key", "size"])
    literal = (F.col("size") < 0).alias("literal")
    of = asked.groupBy("item_id", literal).agg(F.count_distinct("item_pos").alias("of"), F.min("spare").alias("spare"))
    of = of.select("item_id", "literal", "of", F.when(F.col("spare"), max(LITERAL_COVERAGE, min_coverage)).otherwise(min_coverage).alias("least"))
    grouped = hits.groupBy("doc_id", "item_id", literal).agg(F.collect_set(F.struct("item_pos", "doc_pos", "item_slots", "doc_slots")).alias("hits"))
    grouped = grouped.join(F.broadcast(of) if n <= BROADCAST_WINDOWS else of, ["item_id", "literal"])
    likely = F.size(F.array_distinct(F.transform("hits", lambda h: h["item_pos"]))) / F.col("of") >= F.col("least")
    names = ["coverage", "n_windows", "reparameterised"]
    judged = grouped.filter(likely).select("doc_id", "item_id", "of", "least", "hits").mapInPandas(
        judge, "doc_id long, item_id long, coverage double, n_windows long, reparameterised boolean"
    )
    # The better of both ways; of equal ones that with equal values.
    rank = F.struct("coverage", "n_windows", (~F.col("reparameterised")).alias("same"), *names[2:])
    best = judged.filter(F.col("coverage") >= min_coverage).groupBy("doc_id", "item_id").agg(F.max(rank).alias("best"))
    return best.select("doc_id", "item_id", *[F.col(f"best.{c}").alias(c) for c in names])
