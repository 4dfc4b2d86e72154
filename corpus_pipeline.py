"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before
the next; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gablework.llm import exact_dedup, language, mixing, near_dedup, sentencepiece_codec
from gablework.llm.common import quoted, stored
from gablework.llm.queries import table, tokenizer_file


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized; rejected ones go."""
    return language.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts so that sources get the square root of their size as weight."""
    return mixing.mix(docs).select(*map(quoted, docs.columns))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number of their SentencePiece ids and hashes of ids and decoded text."""
    return sentencepiece_codec.encoded_digests(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("sentencepiece", encode_texts)]

#: Learned centroids, signatures and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
