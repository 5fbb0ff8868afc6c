"""From raw documents to packed token sequences: five stages, each one operator of ``commentlens.llm``.

A stage takes what its predecessor kept, as a table that was written and read again, and returns documents
(the last one pieces of sequences). Rows that a stage drops are gone for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commentlens.llm import content_sort, language_id, mixing, packing, simhash, word_overlap
from commentlens.llm.queries import documents, tokenizer_file
from commentlens.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no known language: NULL, empty or without a letter. Others stay, whatever their label."""
    return language_id.keep_identified(docs, language_id.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the one with the smallest doc_id stays."""
    return content_sort.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within 2 bits the one with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """After ``drop_near_copies``, documents whose 5-word shingles overlap by 0.8 and more go as well, but for the smallest."""
    kept = written(drop_near_copies(spark, docs, sf_dir), "pipeline")
    return word_overlap.drop_similar(kept)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its hash say, in shuffled order."""
    return mixing.mix(docs).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


# Code lengths, fingerprints and token ids have no form in SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
