"""A corpus from documents: five stages, each written as Parquet and read again as the documents of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiframe.llm import decontaminate, language, minhash, packing, queries, secret_scan
from lexiframe.session import materialize
from lexiframe.sources.readers import read_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; the others go."""
    return language.keep_languages(docs, queries.language_model(spark, docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that are near-duplicates of one of a smaller id: five-word shingles of a Jaccard similarity
    of 0.8 or more, worked out exactly for the candidates that op7's SimHash and minima of hashes find."""
    return minhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced and ``n_chars`` counted anew where they were."""
    return secret_scan.redact(docs, secret_scan.train_net(docs), chars="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, one piece each, with their document."""
    return packing.pieces(docs, queries.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

# A trained network and tokenizers are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
