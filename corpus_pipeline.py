"""From documents to token files, in five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's docs;
all but the last return the columns of documents. Decisions take effect: toxic documents go, one document of each group of
near copies stays (five-word shingles, similarity 0.8), documents that leak benchmark items go, documents are dropped or repeated as
the mix takes them, and the last stage writes the token files and returns a row for each document in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import decontaminate, ngram_join, source_mix, token_records, toxicity
from brindle.llm.common import stored, unused
from brindle.llm.queries import word_bpe


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half. The model learns from docs themselves, by the labels of op9's training folds."""
    model = toxicity.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "_score")
    return toxicity.scored(docs, model, tuple(docs.columns), score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component by five-word shingles, similarity 0.8: that of the least doc_id."""
    return ngram_join.first_of_each(docs, n=5, num=80, den=100)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by target weights takes them."""
    return source_mix.copied(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the token files."""
    return token_records.token_records(docs, word_bpe()).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("source_mix", mix_sources),
    ("token_records", write_tokens),
]
#: SQL has neither the classifier nor the tokenizer; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
