"""The dealt operators on the given tables, with production parameters and whole results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import classifier
from weekloom.llm.decontaminate import contaminated
from weekloom.llm.html_text import extract_text
from weekloom.llm.importance import resample
from weekloom.llm.language import held_out, identify, train
from weekloom.llm.licenses import scan_licenses
from weekloom.llm.mixing import mix
from weekloom.llm.near_duplicates import near_duplicates
from weekloom.llm.prefix_trie import prefix_trie
from weekloom.llm.quality import judge
from weekloom.llm.sharding import pack
from weekloom.llm.substrings import remove_repeats
from weekloom.llm.token_files import read_token_files, write_token_files
from weekloom.llm.queries_sql import SQL  # noqa: F401
from weekloom.sources.read import load_data


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_data(spark, f"{folder}/{name}.parquet", "parquet")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(_table(spark, folder, "documents"), shards=16)
    return packed.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(_table(spark, folder, "documents"), tokenizer, end_id=2)
    read = read_token_files(manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_table(spark, folder, "documents"))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(_table(spark, folder, "documents").select("doc_id", "lang", "text"))
    return judged.select(F.col("document.doc_id").alias("doc_id"), *[c for c in judged.columns if c != "document"])


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return identify(docs, train(docs.where(~held_out())))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_table(spark, folder, "documents"), shingle=3, threshold=0.85)
    found = found.select(F.col("document.doc_id").alias("doc_id"), "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeats(_table(spark, folder, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = classifier.train(docs, labels, ~classifier.held_out() & F.col("doc_id").isNotNull())
    scored = classifier.score_quality(docs, model)
    return scored.select("doc_id", classifier.held_out().alias("held_out"), "score", "predicted")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(_table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_token_files": op3_token_files,
    "op4_license_scan": op4_license_scan,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_prefix_trie": op13_prefix_trie,
}
