import pytest

SF_001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf_text():
    import os

    if not os.path.exists(f"{SF_001}/documents.parquet"):
        pytest.skip("test data not available")
    return SF_001


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with awkward names."""
    words = [f"wort{i % 997}" for i in range(60_000)]
    story = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(60))
    rows = [
        (1, story, "en", "a", 10), (2, story, "en", "a", 10), (2, story, "en", "a", 10), (3, None, None, None, None), (4, "", "en", "a", 0),
        (5, " \n\t ", "de", None, 4), (None, story + " x", "en", "a", 3), (6, " ".join(words), "de", "b", 9), (7, story + " omega", None, "b", 1),
        (8, "ab", "en", "b", 2), (9, "ab", "fr", "b", 2), (10, "日本 語 текст ñé <|endoftext|> a\x00b", "ja", "c", 5), (11, "12 34 !!", "en", "c", 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    extra = ("id", "key", "score", "shard", "block", "_text", "_id", "_judged", "kept", "label", "component", "a", "count", "host", "curve")
    return df.select("*", *[F.lit(7).alias(c) for c in extra])
