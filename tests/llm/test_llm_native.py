"""Quality rules, licence scan, sharding and revisits: DuckDB SQL, brute force, odd rows."""

import itertools
import re
import zlib

import pytest
from oracle_compare import compare, duckdb_connection
from pyspark.sql import functions as F

from grievance.llm import license_scan, license_texts, quality_rules, sharding, warc
from grievance.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_text, name):
    res = compare(QUERIES[name](spark, sf_text), duckdb_connection(sf_text), ORACLE[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", ["op3_quality_rules", "op4_license_scan", "op9_hilbert_sharding"])
def test_native_plans_run_no_python(spark, sf_text, name):
    plan = QUERIES[name](spark, sf_text)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(?!Batch)", plan)


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_measures_match_brute_force(spark):
    texts = ["", " ", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 30, "é# 日本 |\n\n é#\n日本\t|", "a\nb\na\nb\n \n \n", "1 2 3 4 5 6 1 2 3 4 5 7 2 3 4 5 7"]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in quality_rules.judge(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(texts[r.doc_id]), texts[r.doc_id]


def test_bad_host_is_rejected_and_small_hosts_shrink(spark, monkeypatch):
    good, bad = " ".join(f"word{i}" for i in range(40)), "spam spam"
    rows = [(i, bad if h == "bad" and i % 10 else good, h) for h in ("bad", "a", "b", "c") for i in range(200)]
    rows += [(999, bad, "tiny"), (998, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for few in (100_000, 0):  # broadcast, and the salted join
        monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", few)
        out = quality_rules.with_verdicts(m := quality_rules.measure(df), quality_rules.host_verdicts(m))
        failed = {(r.host, r.host_failed) for r in out.collect()}
        assert ("bad", True) in failed and ("a", False) in failed and (None, False) in failed
        assert out.count() == len(rows)


def test_chance_is_no_difference_between_hosts(spark):
    """Small hosts that differ by chance only shrink to the corpus; a real difference keeps its hosts apart."""
    import random

    rng = random.Random(4)
    good, bad = " ".join(f"word{i}" for i in range(40)), "spam spam"
    rows = [(i, bad if rng.random() < 0.3 else good, f"h{i % 300}") for i in range(1500)]
    rates = {r.host: r.few_words_rate for r in quality_rules.host_verdicts(quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert max(rates.values()) - min(rates.values()) < 0.15 and max(rates.values()) < quality_rules.MAX_HOST_RATE
    rows = [(i, bad if i % 3 == 0 else good, "bad" if i % 3 == 0 else f"h{i % 30}") for i in range(1500)]
    found = quality_rules.host_verdicts(quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    assert {r.host for r in found if r.host_failed} == {"bad"}


def test_quality_odd_rows(spark, odd_docs):
    out = quality_rules.judge(odd_docs)
    assert out.count() == odd_docs.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in out.filter("doc_id IN (3, 4, 5)").collect())
    assert quality_rules.judge(odd_docs.limit(0)).collect() == []


def test_licences_are_found_through_spelling_and_layout(spark, odd_docs):
    mit = license_texts.LICENCES[0][1]
    rows = [
        (1, "The MIT Licence (MIT)\n\nCopyright (c) 2019 A. N. Other\nCopyright 2020 B\nAll rights reserved.\n\n" + mit.upper().replace("\n", "  \n ").replace('"', "''")),
        (2, mit.replace("free of charge", "for a fee")), (3, "Some words.\n  RELEASED under the M.I.T. licence\n* Released under the MIT licence!"),
        (4, None), (5, "Copyright 2020 me"), (6, "Licensed under CC BY 4.0."),
        # A statement with more text on its line: the licence begins behind it.
        (7, "Copyright (c) 2020 X Inc. All rights reserved. " + mit.replace("\n", " ")), (8, "(c) 2020 X. Released under the MIT License."),
        (9, "* Copyright 2021 Y, Z Ltd. and others"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = license_scan.known_digests(spark)
    got = {r.doc_id: (r.license_id, r.line_licenses) for r in license_scan.scan(df, known).collect()}
    assert got[1] == ("MIT", None) and got[2] == (None, None) and got[3] == (None, "MIT")
    assert got[4] == (None, None) and got[5] == (None, None) and got[6] == ("CC-BY-4.0", "CC-BY-4.0")
    assert got[7] == ("MIT", "MIT") and got[8] == ("MIT", "MIT") and got[9] == (None, None)
    assert license_scan.scan(odd_docs, known).count() == odd_docs.count()
    assert license_scan.scan(odd_docs.limit(0), known).collect() == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"d{i} int" for i in range(dims)))
    rows = df.select("*", sharding.hilbert_index([F.col(f"d{i}") for i in range(dims)], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(len(cells)))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in itertools.pairwise(rows))


def test_shards_follow_the_row_law(spark, sf_text, odd_docs):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_text}/documents.parquet").collect()}
    rows = QUERIES["op9_hilbert_sharding"](spark, sf_text).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by = {}
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
        by.setdefault(r.shard, []).append(r)
    assert set(by) == set(range(40)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values())
    order = [r.curve for s in sorted(by) for r in sorted(by[s], key=lambda r: r.slot)]
    assert order == sorted(order)
    odd = sharding.assign(odd_docs, shards=4).collect()
    assert len(odd) == odd_docs.count() and {r.shard for r in odd} == {0, 1, 2, 3}
    assert sharding.assign(odd_docs.limit(0)).collect() == []


def test_files_prune_in_every_dimension(spark, sf_text, scratch):
    docs = spark.read.parquet(f"{sf_text}/documents.parquet")
    sharding.write_shards(docs, sharding.assign(docs), scratch, 40)
    files = spark.read.parquet(scratch).groupBy(F.input_file_name().alias("f")).agg(
        F.min("n_chars").alias("a"), F.max("n_chars").alias("b"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("source", "lang") for f in (F.min, F.max)]).collect()
    assert sum(r.a <= 100 <= r.b for r in files) < 0.7 * len(files)
    # What a filter on one name reads, by the files' minima and maxima.
    for c, share in (("source", 0.4), ("lang", 0.75)):
        names = [r[0] for r in docs.select(c).dropna().distinct().collect()]
        read = sum((r[f"min_{c}"] or "") <= n <= (r[f"max_{c}"] or "") for n in names for r in files)
        assert read <= share * len(files) * len(names), (c, read / len(files) / len(names))
    assert spark.read.parquet(scratch).count() == docs.count()


def test_canonical_urls(spark):
    pairs = [
        ("HTTP://WWW.Example.com:80/A/b/?z=1&a=2#x", "example.com/A/b?a=2&z=1"), ("https://example.com", "example.com"),
        ("example.com/", "example.com"), ("https://example.com:8443/p", "example.com:8443/p"), ("", None), (None, None),
    ]
    df = spark.createDataFrame(pairs, "u string, want string")
    assert all(r[0] == r[1] for r in df.select(warc.canonical_url(F.col("u")), "want").collect())


def test_revisits_take_the_latest_earlier_response(spark):
    kind = "record_id long, url string, ts long, etag string, last_modified string, headers map<string,string>"
    h = {"date": "d0", "content-type": "t", "etag": '"1"'}
    day = 86_400
    responses = spark.createDataFrame([
        (1, "http://a/x", 100, '"1"', None, h, "p1"), (2, "http://www.a/x", 50 * day, '"2"', "m2", h, "p2"),
        (3, "http://a/x", 50 * day, '"3"', "m3", None, "p3"), (4, None, 5, None, None, None, "p4"), (5, "http://b/", None, None, None, h, "p5"),
    ], kind + ", payload_digest string")
    asked = [
        (10, "https://a/x#f", 101, 'W/"1"', None, {"date": "d1", "content-length": "0"}), (11, "http://a/x", 100, '"1"', None, None),
        (12, "http://a/x", 49 * day, '"9"', None, None), (13, "http://a/x", 50 * day, None, None, None), (14, "http://a/x/", 51 * day, None, "m3", None),
        (15, "http://a/x", 90 * day, None, "m2", None), (16, None, 7, None, None, None), (17, "http://b", 7, None, None, None), (18, "http://a/x", None, None, None, None),
    ]
    revisits = spark.createDataFrame(asked + asked[:1], kind).withColumn("response", F.lit(1))
    rows = warc.resolve(revisits, responses).collect()
    got = {r.record_id: (r.status, r.response_id, r.payload_digest) for r in rows}
    assert len(rows) == len(asked) + 1
    assert got[10] == ("resolved", 1, "p1") and got[11][0] == "no_prior" and got[12][0] == "validator_mismatch"
    assert got[13] == ("resolved", 1, "p1") and got[14] == ("resolved", 3, "p3") and got[15][0] == "validator_mismatch"
    assert {got[i][0] for i in (16, 17, 18)} == {"no_prior"}
    merged = next(r.headers for r in rows if r.record_id == 10)
    assert merged == {"date": "d1", "content-type": "t", "etag": '"1"'}
    assert warc.resolve(revisits.limit(0), responses).collect() == []
    assert {r.status for r in warc.resolve(revisits, responses.limit(0)).collect()} == {"no_prior"}
