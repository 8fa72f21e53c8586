"""Language identification: profiles against a plain count, held-out accuracy, odd rows."""

import re
from collections import Counter

from pyspark.sql import functions as F

from grievance.llm import language_id as L
from grievance.llm.queries import QUERIES


def plain_counts(text):
    out = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        p = f"_{w}_"
        out.update(g for n in (1, 2, 3) for i in range(len(p) - n + 1) if (g := p[i : i + n]) != "_")
    return out


def test_counts_match_a_plain_count():
    for text in ["", "1 2", "a", "A b", "é", "ab12cd", "_a__b_", "日本 語。x", "The cat, the hat!\nCafé"]:
        grams, counts = L.gram_counts(text)
        assert {L.gram_text(int(g)): int(n) for g, n in zip(grams, counts, strict=True)} == dict(plain_counts(text))


def test_distance_is_out_of_place():
    model = L.ProfileModel({"x": ["a", "_a", "a_"], "y": ["b"]}, size=5)
    # own list: a, _a, _a_, a_ by count and number: two n-grams in the profile, others cost 5
    own = [L.gram_text(int(g)) for g in L.ranked(*L.gram_counts("a"), 5)]
    cost = sum(abs(["a", "_a", "a_"].index(g) - i) if g in ("a", "_a", "a_") else 5 for i, g in enumerate(own))
    assert model.predict("a") == ("x", 1 - cost / (5 * len(own)))
    assert L.ProfileModel({"b": ["a"], "a": ["a"]}).predict("a")[0] == "a"  # tie: first name


def test_held_out_accuracy(spark, sf_text):
    got = QUERIES["op1_language_id"](spark, sf_text)
    docs = spark.read.parquet(f"{sf_text}/documents.parquet").select("doc_id", "lang")
    row = got.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"), F.count("*")).first()
    assert row[0] > 0.97 and 0 <= row[1] and row[2] <= 1 and row[3] > 200


def test_odd_rows(spark, odd_docs):
    profiles = L.fit_profiles(odd_docs)
    out = L.identify(odd_docs, profiles)
    assert out.count() == odd_docs.count() and "_judged" in out.columns
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    for i in (3, 4, 5, 11):
        assert by_id[i] == ("und", 0.0)
    assert by_id[6][0] == "de"
    none = L.identify(odd_docs, {})
    assert {r.lang_pred for r in none.collect()} == {"und"}
    empty = L.predict_documents(odd_docs.limit(0))
    assert empty.collect() == []


def test_the_sample_is_that_of_ranking_all_rows(spark):
    """A hash bound first, for keys from one row to many, with repeated ids: the same rows as ranking them all."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from grievance.llm.sampling import first_by_hash

    rows = spark.range(20_000).select(F.when(F.col("id") < 15_000, "hot").when(F.col("id") < 19_990, "warm").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") % 12_000).alias("i"))
    rows = rows.unionByName(spark.createDataFrame([("one", 5)] * 900, "k string, i long"))
    for n in (3, 40):
        order = Window.partitionBy("k").orderBy(F.xxhash64("i"), "i")
        plain = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n).select("k", "i")
        got = first_by_hash(rows, "k", "i", n)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
