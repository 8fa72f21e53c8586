"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.llm import (
    decontamination, exact_dedup, fill_in_middle, language_id, license_scan, near_dedup, packing, quality_rules, sharding, spelling, suffix_dedup, toxicity,
    warc,
)
from grievance.llm.common import read_table


def tokenizer_path() -> str:
    """The vocabulary file that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_documents(read_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read_table(spark, sf_dir, "documents"), tokenizer_path()))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"), license_scan.known_digests(spark))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_documents(docs, read_table(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.label_documents(read_table(spark, sf_dir, "documents"))


def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(*warc.captures(read_table(spark, sf_dir, "pages")))
    return found.withColumn("headers", warc.header_text(F.col("headers")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(read_table(spark, sf_dir, "documents")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.with_digests(fill_in_middle.transform(read_table(spark, sf_dir, "documents")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_documents(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_hilbert_sharding": op9_hilbert_sharding,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_exact_dedup": op13_exact_dedup,
}
ORACLE: dict[str, str] = {
    "op3_quality_rules": quality_rules.ORACLE_SQL,
    "op4_license_scan": license_scan.ORACLE_SQL,
    "op10_warc_revisits": warc.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op13_exact_dedup": exact_dedup.ORACLE_SQL,
}
