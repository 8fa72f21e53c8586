"""Spelling variants, fill-in-the-middle and block naming: against SQL, against plain Python, and on hard cases."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grievance.llm import exact_dedup, fill_in_middle, spelling
from grievance.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import compare, duckdb_connection  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_fill_in_middle", "op13_exact_dedup"])
def test_query_matches_sql(spark, sf_text, name):
    assert compare(QUERIES[name](spark, sf_text), duckdb_connection(sf_text), ORACLE[name])["ok"]


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_fill_in_middle", "op13_exact_dedup"])
def test_odd_rows_match_sql(spark, odd_docs, scratch, name):
    odd_docs.repartition(4).write.parquet(f"{scratch}/documents.parquet")
    con = duckdb_connection("/nowhere")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')")
    assert compare(QUERIES[name](spark, scratch), con, ORACLE[name])["ok"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, name string")
    assert exact_dedup.label_documents(none).collect() == []
    assert fill_in_middle.with_digests(fill_in_middle.transform(none)).collect() == []
    assert spelling.group_variants(spelling.count_words(none)).collect() == []


# Block naming


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = Counter()
    for low, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, digest = max(known, default=None), hashlib.sha256(low.encode()).hexdigest()
        out.update((i, keep, len(ids), digest) for i in ids)
    return out, len(groups)


def labelled(df):
    got = df.collect()
    return Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), [r for r in got if r.kept]


@pytest.mark.parametrize("block", [1, 3, 8])
def test_block_names_match_plain_groups(spark, block):
    """Many rounds: texts that share blocks, halves, beginnings and ends, and lengths on both sides of powers of two."""
    rng = random.Random(block)
    pool = ["".join(rng.choice("abAB é") for _ in range(n)) for n in (1, 2, 7, 8, 9, 16, 17, 31, 32, 33)]
    rows = [(rng.randint(0, 200), "".join(rng.choice(pool) for _ in range(rng.randint(0, 3)))) for _ in range(250)]
    rows += [(None, "Same"), (None, "sAME"), (5, None), (6, ""), (7, "É"), (8, "é"), (9, "a" * 500), (9, "A" * 500), (3, "a" * 499)]
    expected, groups = plain_groups(rows)
    got, kept = labelled(exact_dedup.label_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), block_bytes=block))
    assert got == expected and len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_a_hash_of_two_blocks_is_not_believed(spark):
    """Where different blocks share a hash, another seed is tried; equal names still mean equal texts."""
    tried = []

    def weak(block, attempt):
        tried.append(attempt)
        return [F.length(block).cast("long"), F.lit(0).cast("long")] if attempt == 0 else exact_dedup.block_hash(block, attempt)

    rows = [(1, "abcdef"), (2, "abcxyz"), (3, "ABCDEF"), (4, "q")]
    got, _ = labelled(exact_dedup.label_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=3, hashes=weak))
    assert tried == [0, 1] and got == plain_groups(rows)[0]


def test_names_grow_in_the_order_of_their_keys(spark):
    keys = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.lit(1).alias("b"))
    named = exact_dedup._numbered(keys, "test").orderBy("a").collect()
    assert [r.name for r in named] == sorted({r.name for r in named})


# Fill in the middle


def plain_cuts(doc_id, text, unit="line"):
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    h = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if doc_id is None or not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["line", "char"])
@pytest.mark.parametrize("slice_bytes", [64, 8 << 20])
def test_cuts_match_plain_python(spark, monkeypatch, unit, slice_bytes):
    monkeypatch.setattr(fill_in_middle, "SLICE_BYTES", slice_bytes)
    rng = random.Random(7)
    texts = ["".join(rng.choice(["a", "é", "日", "𝄞", "\n", "\n\n", "\x0b", "\x8a", "<", "<P", "S>", "\0", "word "]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["\n", "\n\n\n", "x", "x\n", "\nx", "<P>", "a<S>b", "a\n<M>", "<P<S<M", None, "", "q" * 100_000 + "\n" * 9, "\x8a\n" * 50]
    rows = [(i if i % 29 else None, t) for i, t in enumerate(texts)]
    made = fill_in_middle.transform(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), unit=unit)
    got = made.withColumn("back", fill_in_middle.restore(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter((i, *plain_cuts(i, t or "", unit)) for i, t in rows)
    assert Counter((r.doc_id, r.back) for r in got) == Counter((i, t or "") for i, t in rows)
    assert len({r.form for r in got}) == 3


def test_rate_and_order_are_parameters(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\nb\n"), F.col("id").cast("string")).alias("text"))
    forms = Counter(r.form for r in fill_in_middle.transform(docs, rate=25, suffix_first=0).collect())
    assert set(forms) == {"plain", "psm"} and 60 < forms["psm"] < 140
    with pytest.raises(ValueError):
        fill_in_middle.transform(docs, unit="word")


def test_marks_rank_and_select_on_all_bytes():
    """Every neighbouring pair of byte values: no carry or borrow reaches the next byte."""
    data = np.array([x for a in range(256) for b in range(256) for x in (a, b)], dtype=np.uint8)
    for marks, wanted in ((fill_in_middle.mark_newlines, data == 10), (fill_in_middle.mark_continuations, (data & 0xC0) == 0x80)):
        found = fill_in_middle.Marks(marks(fill_in_middle._words(data)))
        at = np.flatnonzero(wanted)
        assert (found.select(np.arange(len(at))) == at).all()
        assert (found.rank(np.arange(len(data) + 1)) == np.concatenate([[0], np.cumsum(wanted)])).all()


# Spelling variants


def plain_near(words):
    """Pairs one edit apart, by the letters."""
    out = set()
    for a in words:
        for b in words:
            if len(a) == len(b):
                near = sum(x != y for x, y in zip(a, b, strict=True)) == 1
            else:
                near = len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))
            if near:
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("parts", [3, 4, 6])
def test_signatures_find_every_pair_one_edit_apart(spark, parts):
    rng = random.Random(parts)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(250)}
    for w in ("aaaaaaa", "abcdefg", "straße" * 3, "ÿ" * 12):
        words |= {w, w + w[-1], w[0] + w, w[:3] + "x" + w[3:], w[:3] + "y" + w[4:], w[1:] + "zz", w[::-1]}
    words = sorted(w for w in words if len(w) >= 7)
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(df, parts=parts).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_near(words)


def test_runs_and_noise_match_zlib(spark):
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcXYZÀéÿ×") for _ in range(rng.randint(5, 12))) + rng.choice("1_-,…Ā ") for _ in range(60)) for _ in range(60)]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "q" * 50_000)]
    words = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            word = low[: h % len(low)] + low[h % len(low) + 1 :] if h % 31 == 0 else low
            words[word] += len(word) >= 7
    got = spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string"), min_count=1).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in words.items() if n}


def test_forms_and_roots(spark):
    rows = [("balance", 5000), ("balanc", 9), ("balances", 400), ("balancest", 40), ("balancestt", 4), ("balancf", 500), ("balancg", 501), ("ballance", 499), ("mortgage", 2)]
    df = spark.createDataFrame(rows, "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.group_variants(df, min_letters=6).collect()}
    assert got["balancestt"] == ("balancest", "balance", 1, 40) and got["balancest"][:2] == ("balances", "balance")
    assert got["balancf"] == ("balance", "balance", 3, 5000) and got["mortgage"] == (None, "mortgage", 0, None)
    tied = spark.createDataFrame([("aaaaaab", 100), ("aaaaaac", 100), ("aaaaaad", 10), ("aaaaaae", 11)], "word string, n long")
    got = {r.word: (r.form, r.form_n) for r in spelling.group_variants(tied).collect()}
    assert got == {"aaaaaab": (None, None), "aaaaaac": (None, None), "aaaaaad": ("aaaaaab", 100), "aaaaaae": (None, None)}
