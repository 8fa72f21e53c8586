"""The corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that its
predecessor kept; all but the last return the columns of ``documents``.  A
stage's result is written as Parquet in the shared folder and read again as
the next one's input.

Defined cases: rows without an id stay wherever an id decides (they are in no
group and no match); repeated rows are reduced to one by the near-duplicate
stage, of rows with one id and different texts the first text in code point
order stays; null and empty texts have no language and go with the first stage;
long texts are worked on whole; empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grievance.llm import decontamination, language_id, near_dedup, packing, suffix_dedup
from grievance.llm.common import read_table, staged
from grievance.llm.queries import tokenizer_path

#: What a stage but the last returns; further columns of its input are dropped.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose best language explains less than this are rejected, as are those without a letter.
MIN_LANGUAGE_SCORE = 0.25
#: Ids to drop are broadcast up to this number, shortened texts up to so many bytes; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
BROADCAST_BYTES = 16_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the documents of ``ids``; only few ids are broadcast."""
    ids = staged(ids.select("doc_id").dropna().distinct(), "dropped")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_anti").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters, or unlike every profile, go."""
    docs = docs.select(*COLUMNS)
    judged = language_id.identify(docs, language_id.fit_profiles(docs))
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return judged.filter(known).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that with the smallest id."""
    left = _without(docs, near_dedup.label_documents(docs).filter("NOT kept"))
    repeated = staged(left.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return left
    order = Window.partitionBy("doc_id").orderBy("text")
    one = left.join(repeated, "doc_id", "left_semi").withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return _without(left, repeated).unionByName(one.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids hold; documents of which nothing is left go."""
    rest = suffix_dedup.remove_repeats(docs).filter("n_removed > 0").select("doc_id", "kept_text", (F.col("n_removed") == F.col("n_bytes")).alias("_gone"))
    rest = staged(rest, "rest")
    small = rest.agg(F.sum(F.octet_length("kept_text"))).first()[0] or 0
    joined = docs.select(*COLUMNS).join(F.broadcast(rest) if small <= BROADCAST_BYTES else rest, "doc_id", "left")
    changed = F.col("kept_text").isNotNull()
    return joined.filter(~F.coalesce("_gone", F.lit(False))).withColumns({
        "text": F.coalesce("kept_text", "text"), "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return _without(docs, decontamination.find_leaks(docs, read_table(spark, sf_dir, "benchmark")))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences."""
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packed_sequences", packed_sequences),
]
#: The stages are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
