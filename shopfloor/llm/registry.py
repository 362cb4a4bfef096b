"""The thin queries over the operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import align, chat, decontaminate, licenses, linededup, maintext, neardup, packing, phrases, quality, suffixes, tokenfile, topk


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deduplicate(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("row_key")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = tokenfile.token_file(read(spark, sf_dir, "documents"))
    return ids.select("doc_id", "start", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(read(spark, sf_dir, "documents")).drop("spans")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(read(spark, sf_dir, "documents"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.windows(chat.with_control(read(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_top_k_search": op5_top_k_search,
    "op6_packing": op6_packing,
    "op7_html_extraction": op7_html_extraction,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_token_file": op9_token_file,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_chat_format": op13_chat_format,
}

ORACLES: dict[str, str] = {"op1_line_dedup": linededup.ORACLE_SQL, "op12_phrase_mining": phrases.ORACLE_SQL, "op13_chat_format": chat.ORACLE_SQL}
