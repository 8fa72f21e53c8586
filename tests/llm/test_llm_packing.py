"""Packing: tokens against the tokenizer, exact cover of every document, few sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grievance.llm import packing as K
from grievance.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_tokens_equal_the_tokenizer(tokenizer, spark, sf_text):
    odd = ["", "a", "a b", "  a", "a  b", "a\n b", "x\n", "é²³ 12½ a_b", "don't I'll x'S", "<|endoftext|> a", "\x1c a\x85b\xa0c", "日本 語", "a\n\nb c", " lead", "tail "]
    texts = odd + [r.text for r in spark.read.parquet(f"{sf_text}/documents.parquet").filter("doc_id < 150").collect()]
    got = K.Tokens(PATH).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def check(rows, expected, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, ids in expected.items():
        at = 0
        parts = sorted(by_doc[doc], key=lambda r: r.piece)
        for n, r in enumerate(parts):
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            assert r.length == capacity or n == 0
            at += r.length
        assert at == len(ids) and (len(parts) == 1 or len(ids) > capacity)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


def test_documents_are_covered_and_few_sequences(spark, sf_text, tokenizer):
    docs = spark.read.parquet(f"{sf_text}/documents.parquet").select("doc_id", "text").collect()
    expected = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs}
    n = check(QUERIES["op2_best_fit_packing"](spark, sf_text).collect(), expected, 2048)
    assert n <= -(-sum(map(len, expected.values())) // 2048) + 2


def test_local_search_empties_bins():
    lengths = [6, 6, 4, 4, 3, 3, 2, 2]
    start = [[0, 2], [1], [3, 4], [5, 6], [7]]
    out = K.local_search([list(b) for b in start], lengths, capacity=10)
    assert sorted(i for b in out for i in b) == list(range(8)) and len(out) == 3
    rng = random.Random(3)
    for _ in range(30):
        lengths = [rng.randint(1, 60) for _ in range(120)]
        first = K.best_fit(lengths, 100)
        better = K.local_search([list(b) for b in first], lengths, 100)
        assert sorted(i for b in better for i in b) == list(range(120))
        assert all(sum(lengths[i] for i in b) <= 100 for b in better) and len(better) <= len(first)


def test_exchange_prefers_the_fullest():
    assert K.exchange([0], [1, 2], 3, [5, 2, 3]) == (3, (), (2,))  # a move
    assert K.exchange([0], [1], 2, [5, 7]) == (2, (0,), (1,))  # one for one
    assert K.exchange([0], [1, 2], 1, [5, 3, 3]) == (1, (0,), (1, 2))  # two for one
    assert K.exchange([0], [1], 1, [5, 9]) is None


def test_odd_rows(spark, odd_docs, tokenizer):
    rows = K.pack(K.pieces(odd_docs, PATH)).collect()
    docs = odd_docs.select("doc_id", "text").collect()
    total = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs)
    assert sum(r.length for r in rows) == total
    assert {r.length for r in rows if r.doc_id in (3, 4)} == {1}
    assert K.pack(K.pieces(odd_docs.limit(0), PATH)).collect() == []


def test_local_search_tries_every_underfull_bin():
    rng = random.Random(1)
    lengths = [rng.randint(500, 900) for _ in range(2000)]
    bins = K.best_fit(lengths)
    # 200 emptiest bins bring 769 bins down to 738.
    better = K.local_search([list(b) for b in bins], lengths)
    assert sorted(i for b in better for i in b) == list(range(2000)) and all(sum(lengths[i] for i in b) <= 2048 for b in better)
    assert len(bins) == 769 and len(better) <= 737


def test_many_pieces_of_a_third_of_the_capacity(spark):
    rng = random.Random(2)
    lengths = [rng.randint(500, 900) for _ in range(8000)]
    rows = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], K.PIECE_SCHEMA)
    out = K.pack(rows).collect()
    assert sorted(r.doc_id for r in out) == list(range(8000))
    assert len({r.sequence_id for r in out}) <= 1.09 * sum(lengths) / 2048


def test_a_second_search_changes_nothing():
    for seed, low, high in ((1, 400, 1000), (2, 500, 900), (3, 20, 1500)):
        rng = random.Random(seed)
        lengths = [rng.randint(low, high) for _ in range(1000)]
        bins = K.local_search(K.best_fit(lengths), lengths)
        assert sorted(i for b in bins for i in b) == list(range(1000))
        again = K.local_search([list(b) for b in bins], lengths)
        assert len(again) == len(bins) and sorted(map(sorted, again)) == sorted(map(sorted, bins))


def test_equal_pieces_part_and_end_soon():
    lengths = [600] * 2000
    bins = K.local_search(K.best_fit(lengths), lengths)
    assert len(bins) == 667


def test_waste_does_not_grow_with_the_groups(spark):
    def excess(n, group):
        rng = np.random.default_rng(n)
        lengths = np.clip(rng.lognormal(5.5, 1.0, n), 1, 2048).astype(int).tolist()
        rows = spark.createDataFrame([(i, 0, 0, x, i) for i, x in enumerate(lengths)], K.PIECE_SCHEMA)
        out = K.pack(rows, group=group).select("sequence_id", "length").toPandas()
        assert out.groupby("sequence_id")["length"].sum().max() <= 2048 and len(out) == n
        return out["sequence_id"].nunique() - -(-sum(lengths) // 2048)

    assert excess(3000, 200) <= 2 and excess(12000, 200) <= 2


def test_repeated_rows_meet_in_no_single_group(spark):
    rows = spark.range(9000).selectExpr("7L as doc_id", "0 as piece", "0L as start", "600L as length", "5L as ids_crc32").repartition(4)
    out = K.pack(rows)
    assert out.groupBy("sequence_id").count().agg({"count": "max"}).first()[0] == 3
    assert out.select("sequence_id").distinct().count() <= 3000 + 5
