"""Toxicity and decontamination: held-out results, planted cases, brute force, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grievance.llm import decontamination as D
from grievance.llm import toxicity as T
from grievance.llm.queries import QUERIES


def numeric_gradient_sample():
    rng = random.Random(5)
    docs = [{f"n{rng.randint(0, 60)}" for _ in range(12)} | {f"bad{k}" for k in range(rng.choice((0, 0, 1, 3, 6)))} for _ in range(900)]
    return docs, np.array([any(w.startswith("bad") for w in d) for d in docs])


def test_grades_and_order():
    docs, toxic = numeric_gradient_sample()
    y = T.grades(docs, toxic)
    assert set(y) == {0, 1, 2, 3} and all((g == 0) == (not t) for g, t in zip(y, toxic, strict=True))
    model = T.fit(docs, toxic)
    cut = model["thresholds"]
    assert cut == sorted(cut) and len(cut) == 3
    score = np.array([sum(model["words"].get(w, 0) for w in d) for d in docs])
    assert ((score > cut[0]) == toxic).mean() > 0.98
    assert np.corrcoef(score, y)[0, 1] > 0.85
    assert T.fit(docs, np.zeros(len(docs), bool)) == {"words": {}, "thresholds": []}


def test_toxicity_on_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = T.fit_documents(docs, labels.filter("doc_id % 4 < 3"))
    out = T.score(docs, model).select("doc_id", F.col("toxic").alias("said")).join(labels.filter("doc_id % 4 = 3"), "doc_id")
    n = {(r.said, r.toxic): r["count"] for r in out.groupBy("said", "toxic").count().collect()}
    assert n.get((True, 0), 0) <= 0.02 * n[(False, 0)]
    assert n[(True, 1)] >= 0.8 * (n[(True, 1)] + n.get((False, 1), 0))


def test_expected_severity_sums_the_grades(spark):
    model = {"words": {"x": 2.0, "y": 5.0}, "thresholds": [1.0, 3.0, 4.0]}
    df = spark.createDataFrame([(1, "x X x"), (2, "X y"), (3, None), (4, "z")], "doc_id long, text string")
    got = {r.doc_id: r for r in T.score(df, model).collect()}
    s = lambda v: sum(1 / (1 + np.exp(c - v)) for c in model["thresholds"])
    assert got[1].expected_severity == pytest.approx(s(2)) and got[2].expected_severity == pytest.approx(s(7)) and got[3].expected_severity == pytest.approx(s(0))
    assert (got[1].toxic, got[2].grade, got[3].grade, got[4].toxic) == (True, 3, 0, False)


def test_toxicity_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 0, 1), (None, 1, 1), (3, 1, None), (77, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    out = T.score(odd_docs, T.fit_documents(odd_docs, labels))
    assert out.count() == odd_docs.count()
    none = T.score(odd_docs, T.fit_documents(odd_docs, labels.limit(0))).collect()
    assert {(r.expected_severity, r.grade, r.toxic) for r in none} == {(0.0, 0, False)}
    assert T.score(odd_docs.limit(0), T.fit_documents(odd_docs.limit(0), labels)).collect() == []


def test_templates():
    out, slots = D.template(D.tokens("Anna has 3 apples. She gives Tom Smith two km, 4.5 kg and m."))
    assert out == ["anna", "has", "<num>", "apples", "she", "gives", "<name>", "<num>", "<unit>", "<num>", "<unit>", "and", "m"]
    assert slots[2] == "3" and slots[6] == "tom smith" and slots[8] == "km" and slots[-1] is None
    assert D.template(D.tokens("Tom Smith went"))[0] == ["<name>", "went"]


QUESTION = "A train leaves Boston at 5 pm and travels 60 km each hour until it reaches Denver, while a car leaves Boston with 60 liters of fuel. How far apart are they?"


def test_reparameterised_questions_are_caught_and_inconsistent_ones_are_not(spark, monkeypatch):
    items = spark.createDataFrame([(1, QUESTION), (2, "What is the capital of France"), (3, None), (4, "12 7"), (5, "")], "item_id long, text string")
    same = QUESTION.replace("Boston", "Paris").replace("Denver", "Rome").replace("60", "75").replace(" 5 ", " 9 ").replace("km", "miles")
    mixed = QUESTION.replace("Boston", "Paris", 1)
    docs = spark.createDataFrame([
        (1, "Some words before. " + QUESTION + " And after."), (2, "intro of a text " + same + " tail"), (3, "x. " + mixed), (4, "Nothing of the kind 12 7 here."),
        (5, None), (6, "Tell me: what is the capital of France"), (6, "Tell me: what is the capital of France"), (7, QUESTION[:60]),
    ], "doc_id long, text string").withColumn("key", F.lit(1))
    want = {(1, 1, False), (2, 1, True), (6, 2, False)}
    for few in (200_000, 0):  # with the benchmark broadcast, and joined
        monkeypatch.setattr(D, "BROADCAST_WINDOWS", few)
        rows = D.find_leaks(docs, items).collect()
        assert {(r.doc_id, r.item_id, r.reparameterised) for r in rows} == want and len(rows) == 3
    assert D.find_leaks(docs, items.limit(0)).collect() == [] == D.find_leaks(docs.limit(0), items).collect()


def test_leaks_match_brute_force(spark, sf_text):
    docs = spark.read.parquet(f"{sf_text}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_text}/benchmark.parquet").collect()
    flat = {r.item_id: " ".join(t.lower() for t in D.tokens(r.text) if t not in D._ENDS) for r in items}
    want = set()
    for d in docs:
        text = " ".join(t.lower() for t in D.tokens(d.text) if t not in D._ENDS)
        want |= {(d.doc_id, i) for i, s in flat.items() if f" {s} " in f" {text} "}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, sf_text).collect()}
    assert want and want == got


def coverages(spark, monkeypatch, rows, items):
    """(doc, item): (coverage, reparameterised), the same with the benchmark broadcast and joined."""
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = []
    for few in (200_000, 0):
        monkeypatch.setattr(D, "BROADCAST_WINDOWS", few)
        got.append({(r.doc_id, r.item_id): (r.coverage, r.reparameterised) for r in D.find_leaks(docs, bench).collect()})
    assert got[0] == got[1]
    return got[0]


def test_names_at_sentence_starts(spark, monkeypatch):
    alice = "Alice has 5 apples and Bob has 3. Alice gives Bob 2 apples. How many apples does Alice have?"
    maria = "Maria reads 12 pages a day. Maria finishes the whole book in two weeks. The book is old. The cover is red and worn."
    capital = "What is the capital of France"
    rows = [
        (1, alice.replace("Alice", "Carol")), (2, maria.replace("Maria", "John")), (3, "Rome is the capital of Italy"),
        (4, alice.replace("Alice", "Carol", 1).replace("Alice", "Dora")), (5, maria.replace("The cover", "A cover")),
    ]
    got = coverages(spark, monkeypatch, rows, [(1, alice), (2, maria), (3, capital)])
    assert got[1, 1] == (10 / 12, True) and got[2, 2][0] >= 0.9 and got[2, 2][1]
    assert set(got) == {(1, 1), (2, 2), (5, 2)} and got[5, 2][0] < 1 and not got[5, 2][1]


def test_words_inserted_into_an_item(spark, monkeypatch):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(35)]
    items = [(1, " ".join(words)), (2, "The tank at Bristol loses 25 litres of water each hour and the guard from Bristol fills it again with 40 buckets before noon")]
    rows = [(at, " ".join(words[:at] + ["extra"] + words[at:])) for at in (14, 15, 17, 20)]
    rows += [(30, " ".join(words[:17] + words[18:])), (31, " ".join(words[18:] + words[:17]))]
    moved = items[1][1].replace("25", "twenty five").replace("each", "each and every")
    rows += [(40, moved), (41, moved.replace("Bristol", "Derby")), (42, moved.replace("Bristol", "Derby", 1))]
    got = coverages(spark, monkeypatch, rows, items)
    assert {at: got[at, 1][0] for at in (14, 15, 17, 20)} == dict.fromkeys((14, 15, 17, 20), 21 / 28) and got[30, 1][0] == 20 / 28
    assert got[41, 2][1] and not {(31, 1), (42, 2)} & set(got) and got[40, 2][0] == got[41, 2][0] >= 0.5
    assert D.template(D.tokens("It took twenty five km, 3 4 in all"))[0] == ["it", "took", "<num>", "<unit>", "<num>", "<unit>", "all"]


def test_copies_of_items_with_few_words(spark, monkeypatch):
    items = [
        (1, "The Great Fire Of London Began In Pudding Lane And Burned For Four Days"), (2, "WHO WROTE THE PLAY ABOUT THE PRINCE OF DENMARK IN 1601"),
        (3, "Compute 12 + 7 * 3 - 48 / 6 + 5"), (4, "2, 3, 5, 7, 11, 13, 17, 19, 23"), (5, "12 7"), (6, "Tom 3, Anna 5, Bob 7, Eve 9: what is the total number of pears here"),
    ]
    rows = [(i, f"Some words came first, then {text} and it went on.") for i, text in items]
    rows += [(11, "we read that " + items[0][1].lower() + " in all"), (12, "The Great Fire Of London was in 1666"), (13, "Compute 12 + 7 * 3 - 48 / 6 + 4")]
    got = coverages(spark, monkeypatch, rows, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (6, 6), (11, 1)}
    assert set(got.values()) == {(1.0, False)}


def test_positions_do_not_depend_on_the_way_of_joining(spark, monkeypatch):
    first = "we saw. it was. he ran. they sat. she hid. you won. all of us. none of them. some more here. then it was done; now "
    items = [(1, first + "count every red stone that lies near the old bridge before it gets dark"),
             (2, "the tall man sold Tom Lee Roy Poe some good bread. Ann Bo 5 quartz Eve Ray Kim 7 Bob Ty 9 Ida Jo 4 and then he sold the old cart to a man from the town")]
    rows = [(1, "unknown start. " + items[0][1].replace("now count", "now zebra count")), (2, "unknown. " + items[1][1])]
    got = coverages(spark, monkeypatch, rows, items)
    size = len(D.template(D.tokens(items[0][1]))[0]) - 7
    assert got == {(1, 1): ((size - 7) / size, False), (2, 2): (1.0, False)}


@pytest.mark.parametrize("bound", [0, D.BROADCAST_WINDOWS])
def test_copies_in_another_letter_case(spark, sf_text, monkeypatch, bound):
    """Lower, upper and title case of every item, between other words; documents without an item stay clean."""
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", bound)
    items = spark.read.parquet(f"{sf_text}/benchmark.parquet").orderBy("item_id").limit(50)
    names = [(900, "On Monday Alice has 5 apples and Bob has 3 pears, so Alice gives Bob two apples."), (901, "Which river flows through the city of Vienna and then through Budapest?")]
    items = items.select("item_id", "text").unionByName(spark.createDataFrame(names, "item_id long, text string"))
    rows = []
    for r in items.collect():
        for k, cased in enumerate((r.text.lower(), r.text.upper(), r.text.title(), r.text)):
            rows.append((int(r.item_id) * 10 + k, f"Some words before it. {cased} And some words behind."))
    rows += [(10**6 + i, f"a text of words that no item has {i} times over and over again") for i in range(50)] + [(None, rows[0][1]), (10**7, None), (10**7 + 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()}
    wanted = {(int(r.item_id) * 10 + k, int(r.item_id)) for r in items.collect() for k in range(4)}
    assert wanted <= found and {d for d, _ in found} == {d for d, _ in wanted}


def test_leaks_of_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "alpha0 beta0 gamma0 alpha1 beta1 gamma1 alpha2 beta2 gamma2 alpha3"), (None, "x y z"), (2, None), (3, ""), (4, "...")], "item_id long, text string")
    found = D.find_leaks(odd_docs, items.withColumn("doc_id", items.item_id)).collect()
    assert {r.doc_id for r in found} <= {1, 2, 7} and len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert D.find_leaks(odd_docs, items.limit(0)).collect() == [] == D.find_leaks(odd_docs.limit(0), items).collect()
