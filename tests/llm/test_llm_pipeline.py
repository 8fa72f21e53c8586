"""The pipeline, stage by stage, against brute force; odd rows and empty input through all stages."""

import corpus_pipeline as P
import public_tokenizers
from test_llm_dedup import plain_components
from test_llm_packing import check
from tokenizers import Tokenizer

from grievance.llm import decontamination as D
from grievance.llm import language_id


def least_texts(docs, span=50):
    least = {}
    for i, t in docs:
        b = t.encode()
        for k in range(len(b) - span + 1):
            s = b[k : k + span]
            least[s] = min(least.get(s, i), i)
    out = {}
    for i, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if least[b[k : k + span]] < i:
                gone[k : k + span] = b"\1" * span
        if not gone or not all(gone):
            out[i] = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
    return out


def test_stages_match_brute_force(spark, sf_text):
    docs = spark.read.parquet(f"{sf_text}/documents.parquet")
    stage = {name: f for name, f in P.STAGES}
    assert list(stage) == ["language", "near_duplicates", "repeated_passages", "benchmark_leaks", "packed_sequences"]

    def run(name, df):
        out = stage[name](spark, df, sf_text)
        if name != "packed_sequences":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = P.staged(out, name)
        return path, path.collect()

    known, rows = run("language", docs)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in rows} == {
        r.doc_id for r in docs.collect() if not len(language_id.gram_counts(r.text)[0])
    }
    pairs = [(r.doc_id, r.text) for r in rows]
    single, rows = run("near_duplicates", known)
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _, _, kept in plain_components(pairs) if kept)
    pairs = [(r.doc_id, r.text or "") for r in rows]
    rest, rows = run("repeated_passages", single)
    assert {r.doc_id: r.text for r in rows} == least_texts(pairs) and all(r.n_chars == len(r.text) for r in rows)
    flat = [" ".join(t.lower() for t in D.tokens(r.text) if t not in D._ENDS) for r in spark.read.parquet(f"{sf_text}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in rows if any(f" {s} " in f" {' '.join(t.lower() for t in D.tokens(r.text) if t not in D._ENDS)} " for s in flat)}
    clean, kept = run("benchmark_leaks", rest)
    gone = {r.doc_id for r in rows} - {r.doc_id for r in kept}
    assert holds <= gone and len(gone - holds) <= 0.01 * len(rows)
    _, pieces = run("packed_sequences", clean)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in kept}
    assert check(pieces, expected, 2048) <= -(-sum(map(len, expected.values())) // 2048) + 2


def test_odd_rows_and_empty_input_pass_all_stages(spark, sf_text, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, f in P.STAGES:
            docs = P.staged(f(spark, docs, sf_text), name)
        rows = docs.collect()
    assert rows == []


def test_repeated_ids_and_missing_ids(spark, sf_text, odd_docs):
    rows = P.near_duplicates(spark, odd_docs, sf_text).collect()
    ids = [r.doc_id for r in rows]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 8, 10, 11] and ids.count(None) == 1
