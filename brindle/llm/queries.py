"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import decontaminate, hamming_topk, html_main, lexical_search, ngram_join, packing, prefix_trie, quality, secrets, source_mix, token_records, tool_calls, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_bpe() -> str:
    """The file of the tokenizer that the token query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("similarity", F.round("similarity", 6))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(documents(spark, sf_dir), counted=True).select("doc_id", "n_shingles", "component_id", "n_links")


def op3_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_records(documents(spark, sf_dir), word_bpe()).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def byte_bpe() -> str:
    """The file of the tokenizer that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), byte_bpe())


def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_decontaminate, op2_ngram_join, op3_hamming_topk, op4_token_records, op5_quality, op6_source_mix, op7_secrets, op8_html_main, op9_toxicity, op10_tool_calls, op11_prefix_trie, op12_sequence_packing, op13_max_sketch_search)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": decontaminate.SQL, "op2_ngram_join": ngram_join.SQL, "op3_hamming_topk": hamming_topk.SQL, "op6_source_mix": source_mix.SQL, "op10_tool_calls": tool_calls.SQL, "op11_prefix_trie": prefix_trie.SQL, "op13_max_sketch_search": lexical_search.SQL}
