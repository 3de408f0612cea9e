"""Token counts: an exact length histogram and its suffix sums (operator 10)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage, row_slices
from forecourt.llm.tokenizing import encoder

END_TOKENS = 1
BUCKET = 64


def length_histogram(
    docs: DataFrame, tokenizer_path: str, end_tokens: int = END_TOKENS, text: str = "text"
) -> DataFrame:
    """``n_tokens, n_docs``: how many texts have each encoded length.

    A text counts ``end_tokens`` ids more than it encodes to; a null text is
    empty. Repeated rows count each time. Lengths are counted in each task, so
    only one row per task and length is shuffled. No rows: an empty histogram.
    """

    def count(batches):
        ids_of = encoder(tokenizer_path)
        for batch in batches:
            lengths = [
                len(ids) // 4 + end_tokens
                for part in row_slices(batch, "__text")
                for ids in ids_of.encode(part.column("__text").to_pylist())
            ]
            values, counts = np.unique(np.array(lengths, dtype=np.int64), return_counts=True)
            yield pa.record_batch({"n_tokens": values, "n_docs": counts.astype(np.int64)})

    counted = docs.select(F.col(text).cast("string").alias("__text")).mapInArrow(
        count, "n_tokens bigint, n_docs bigint"
    )
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per length L with the sums that answer every context limit.

    ``docs_at_least`` / ``tokens_at_least``: documents of L tokens or more, and
    their tokens. ``docs_at_most``: of L or fewer. ``truncated_tokens``: tokens
    left if every document is cut at L. ``cumulative_share``: docs_at_most over
    all documents, so the q-quantile is the least L with a share of q or more.

    Sums run inside buckets of ``bucket`` lengths and over the bucket totals, so
    no task holds the whole histogram, whatever the longest document. The
    histogram is written first, since it is read for both.
    """
    rows = cut_lineage(histogram).select(
        "n_tokens",
        "n_docs",
        (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / bucket).alias("__bucket"),
    )
    sums = rows.groupBy("__bucket").agg(
        F.sum("n_docs").alias("__docs"), F.sum("tokens").alias("__tokens")
    )
    higher = Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = sums.select(
        "__bucket",
        F.coalesce(F.sum("__docs").over(higher), F.lit(0)).alias("__docs_above"),
        F.coalesce(F.sum("__tokens").over(higher), F.lit(0)).alias("__tokens_above"),
        F.sum("__docs").over(everything).alias("__all_docs"),
        F.sum("__tokens").over(everything).alias("__all_tokens"),
    )
    inside = (
        Window.partitionBy("__bucket")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = rows.join(sums, "__bucket").select(
        "*",
        (F.col("__docs_above") + F.sum("n_docs").over(inside)).alias("docs_at_least"),
        (F.col("__tokens_above") + F.sum("tokens").over(inside)).alias("tokens_at_least"),
    )
    at_most = F.col("__all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return rows.select(
        "n_tokens",
        "n_docs",
        "tokens",
        "docs_at_least",
        "tokens_at_least",
        at_most.alias("docs_at_most"),
        (
            F.col("__all_tokens")
            - F.col("tokens_at_least")
            + F.col("n_tokens") * F.col("docs_at_least")
        ).alias("truncated_tokens"),
        (at_most / F.col("__all_docs")).alias("cumulative_share"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, docs_cut, truncated_tokens`` of any limits, present as a length or not.

    The least length that reaches the limit holds the suffix sums; beyond the
    longest document nothing is cut. An empty histogram gives zeros.
    """
    total = F.coalesce(F.sum("tokens"), F.lit(0))
    answers = []
    for limit in limits:
        reaching = F.when(F.col("n_tokens") > limit, F.col("n_tokens"))
        docs = F.coalesce(F.min_by("docs_at_least", reaching), F.lit(0))
        tokens = F.coalesce(F.min_by("tokens_at_least", reaching), F.lit(0))
        answers.append(
            F.struct(
                F.lit(limit).cast("bigint").alias("context_limit"),
                docs.alias("docs_cut"),
                (total - tokens + docs * limit).alias("truncated_tokens"),
            )
        )
    return sums.agg(F.array(*answers).alias("__answers")).select(F.inline("__answers"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, n_tokens``: the least length that at least this share of documents does not pass."""
    answers = [
        F.struct(
            F.lit(float(share)).alias("share"),
            F.min(F.when(F.col("cumulative_share") >= share, F.col("n_tokens"))).alias("n_tokens"),
        )
        for share in shares
    ]
    return sums.agg(F.array(*answers).alias("__answers")).select(F.inline("__answers"))
