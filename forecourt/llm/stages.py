"""The stages of ``corpus_pipeline``: each applies one operator and takes (spark, docs, sf_dir)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import automaton, langid, mixing, planes, shingles, simhash
from forecourt.llm.common import corpus_table

TOKENIZER = "byte_bpe_50k.json"


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model trained on them rejects go."""
    return langid.keep_accepted(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words.

    Operator 2 links fingerprints at two bits or fewer. It misses most pairs of a
    similarity of 0.8, and the 12 bits that would reach them leave blocks of four
    bits, under which all pairs meet. So bands of minimum hashes, verified on whole
    sets, add those pairs to its links.
    """
    return simhash.one_per_component(
        docs, near=shingles.near_copies, max_distance=simhash.MAX_DISTANCE
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return automaton.decontaminate(docs, corpus_table(spark, sf_dir, "benchmark"))


def balance_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: texts repeated, whole, in parts or not at all."""
    return mixing.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: token-id files, read back as one row per document."""
    return planes.token_files(spark, docs, public_tokenizers.path(TOKENIZER))
