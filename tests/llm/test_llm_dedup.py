"""Suffix-array and near-duplicate deduplication against brute force, on data and on hard cases."""

import hashlib
import random
import re

import numpy as np
import pytest

from grievance.llm import near_dedup, shingles, suffix_dedup
from grievance.llm.components import components
from grievance.llm.queries import QUERIES


def plain_repeats(docs, span=50):
    """(removed bytes, runs, digest of the rest) per row of (id, text)."""
    least = {}
    for i, t in docs:
        b = t.encode()
        for k in range(len(b) - span + 1):
            s = b[k : k + span]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if least[b[k : k + span]] < i:
                gone[k : k + span] = b"\1" * span
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def removed(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect())


def test_repeats_match_brute_force_on_documents(spark, sf_text):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_text}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_array_dedup"](spark, sf_text).collect())
    assert got == plain_repeats(docs) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("seed", range(3))
def test_repeats_match_brute_force_on_low_entropy_text(spark, seed, monkeypatch):
    """Small alphabets, shifted copies, shared edges of 49 to 51 bytes, over many blocks and buckets."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 900)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    rng = random.Random(seed)
    pool = ["".join(rng.choice(("ab", "abcdefgh é日")[seed % 2]) for _ in range(n)) for n in (49, 50, 51, 75, 130, 300)]
    docs = []
    for i in range(120):
        parts = [rng.choice([*pool, "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 90)))]) for _ in range(rng.randint(0, 5))]
        text = "".join(p[rng.randint(0, 9) :] if rng.random() < 0.3 else p for p in parts)
        docs.append((rng.randint(0, 150), text))
    docs += [(7, "a" * 400), (3, "a" * 60), (160, "a" * 49), (161, ""), (162, "\0" * 120), (163, "\0" * 70)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert removed(df) == plain_repeats(docs)


def test_repeats_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    got = {(r[0], r[2]) for r in map(tuple, [(x.doc_id, x.n_bytes, x.n_removed) for x in suffix_dedup.remove_repeats(odd_docs).collect()])}
    for i, _, gone, _, _ in plain_repeats([d for d in docs if d[0] is not None]):
        assert (i, gone) in got
    assert (None, 0) in got and len(suffix_dedup.remove_repeats(odd_docs).collect()) == len(docs)
    assert suffix_dedup.remove_repeats(odd_docs.limit(0)).collect() == []


def test_remaining_text_drops_half_characters(spark):
    shared = "é" + "x" * 60
    df = spark.createDataFrame([(1, "日" + shared), (2, "本" + shared)], "doc_id long, text string")
    by = {r.doc_id: r.kept_text for r in suffix_dedup.remove_repeats(df).collect()}
    assert by[1] == "日" + shared and by[2] == "本"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain_components(docs):
    sets = [plain_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)], doc == least[find(i)]) for i, (doc, _) in enumerate(docs))


def labelled(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.label_documents(df).collect())


def test_components_match_brute_force_on_documents(spark, sf_text):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_text}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in QUERIES["op8_minhash_near_dedup"](spark, sf_text).collect())
    assert got == plain_components(docs)


def edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randint(0, 10**9)}" for w in words]


@pytest.mark.parametrize("node", [512, 6])
def test_components_match_brute_force_on_families(spark, node, monkeypatch):
    """Families whose members are near, just near enough or just too far, and chains; with small nodes, the recursion."""
    monkeypatch.setattr(near_dedup, "NODE", node)
    monkeypatch.setattr(near_dedup, "BLOCK", 4 * node)
    monkeypatch.setattr(near_dedup, "SHARE", 5)
    rng = random.Random(node)
    docs = []
    for family in range(8):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice((40, 150, 400)))]
        for _ in range(25):
            docs.append(" ".join(edited(rng, base, rng.choice((0.0, 0.005, 0.02, 0.04)))))
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, 0.015)
            docs.append(" ".join(chain))
    docs += ["The Common Line of all " + " ".join(f"u{rng.randint(0, 10**9)}" for _ in range(12)) for _ in range(60)]
    docs += ["", " ", "one two", "ONE  two", "one two three", "a b c d e", "A B C D E", "a b c d f"]
    rows = [(i, t) for i, t in enumerate(docs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert labelled(df) == plain_components(rows)


def test_near_duplicates_odd_rows(spark, odd_docs):
    got = near_dedup.label_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[None].component_id is None and not by[None].kept
    assert {by[i].component_id for i in (1, 2, 7)} == {1} and by[8].component_id == 8 == by[9].component_id
    assert all(by[i].component_id == i and by[i].kept and by[i].n_shingles == 0 for i in (3, 4, 5))
    assert near_dedup.label_documents(odd_docs.limit(0)).collect() == []


def test_shingles_match_plain_sets():
    texts = ["", " \t", "a b", "A  B", "b a", "a b c d e", "a b c d e f", "É é É é É é", "x " * 20, "a b 0", "longword" * 50 + " x y z w v"]
    values, sizes = shingles.shingle_sets([t.encode() for t in texts])
    cut = np.concatenate([[0], np.cumsum(sizes)])
    for i, t in enumerate(texts):
        assert sizes[i] == len(plain_set(t))
        for j, u in enumerate(texts):
            assert shingles.common(values[cut[i] : cut[i + 1]], values[cut[j] : cut[j + 1]]) == len(plain_set(t) & plain_set(u))


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [(900, 901), (901, 902), (902, 900), (902, 3)]
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in (5, *range(200, 260))} == {5} and {got[i] for i in (3, 900, 901, 902)} == {3}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
