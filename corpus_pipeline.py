"""From raw documents to token files, in five stages.

Every stage takes the documents its predecessor kept, read again from Parquet,
and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm.common import corpus_table, scratch_path
from forecourt.llm.stages import (
    balance_sources,
    drop_contaminated,
    drop_near_copies,
    drop_unknown_language,
    write_token_files,
)

STAGES = [
    ("language_id", drop_unknown_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", balance_sources),
    ("token_files", write_token_files),
]

# Neither a trained language model nor BPE encoding can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table ``documents``; the rows of the last one."""
    docs = corpus_table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
