"""MinHash near-dedup with odd sketches (operator 13)."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm import crowds
from forecourt.llm.common import cut_lineage, row_slices
from forecourt.llm.shingles import (
    BAND_ROWS,
    BANDS,
    SEED,
    band_keys,
    chosen_rows,
    minimum_hashes,
    node_rows,
    row_key,
    set_name,
    sets_of_rows,
    shingle_hashes,
)
from forecourt.llm.simhash import component_ids

SHINGLE_WORDS = 2
LEAST_PERCENT = 80
SKETCH_BITS = 512
DEVIATIONS = 6

SAMPLES = BANDS * BAND_ROWS
_places = np.random.default_rng(SEED + 1)
_SPREAD = _places.integers(0, 2**63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.uint64(64 - int(math.log2(SKETCH_BITS)))


def word_shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted; none if it has no words."""
    if not text or not text.encode().split():
        return np.zeros(0, np.uint64)
    return shingle_hashes(text, words)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmap of the minimum hashes: each flips the bit that it and its place hash to.

    Samples that two sets have in common flip the same bits in both sketches, so
    the exclusive or of two sketches is the sketch of the differing samples.
    """
    numbered = least.astype(np.uint64) + (np.arange(1, SAMPLES + 1, dtype=np.uint64) << np.uint64(32))
    flips = np.bincount(((numbered * _SPREAD) >> _SHIFT).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").view(np.int64)


def estimate(differing: float, bits: int = SKETCH_BITS, samples: int = SAMPLES) -> float:
    """Jaccard similarity from the number of bits in which two odd sketches differ."""
    inside = 1 - 2 * differing / bits
    return 1 + bits / (4 * samples) * math.log(inside) if inside > 0 else 0.0


def most_differing(percent: int, deviations: float = DEVIATIONS) -> int:
    """Differing bits beyond which a similarity of ``percent`` is refused.

    The estimate varies by the samples, s (1 - s) / samples, and by the bits that
    two flips share; a similar pair lies ``deviations`` of that above the limit.
    """
    s = percent / 100
    expected = SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - s) / SKETCH_BITS))
    slope = SKETCH_BITS / (4 * SAMPLES) * 2 / (SKETCH_BITS - 2 * expected)
    spread = math.sqrt(s * (1 - s) / SAMPLES + slope**2 * expected * (1 - expected / SKETCH_BITS))
    floor = s - deviations * spread
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - floor) / SKETCH_BITS)))


def _differing(a: Column, b: Column) -> Column:
    words = range(SKETCH_BITS // 64)
    return reduce(add, (F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in words))


def near_copies(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    percent: int = LEAST_PERCENT,
    crowded: int = crowds.CROWDED,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    Two texts are linked if the Jaccard similarity of their sets of ``words``-word
    shingles is ``percent`` or more; ``component_id`` is the least ``doc_id`` that can
    be reached over links, ``kept`` says that it is the row's own.

    Texts with equal sets are one node. Nodes meet under bands of their minimum
    hashes (a pair at 0.8 misses all 28 with a chance of 4 in ten million), the
    odd sketches of the same samples refuse pairs six deviations away, and the
    others are confirmed on whole sets; crowded bands by ``crowds.similar_links``.

    A text of fewer words than a shingle is one shingle; null texts and those
    without words have no set and no links. Repeated rows each stay; a null id
    links others but is never a ``component_id`` itself, and such rows are not kept.
    Columns other than ``doc_id`` and ``text`` are ignored. No rows give none.
    """

    def sketch(batches):
        for batch in batches:
            for rows in row_slices(batch, "__text"):
                found = [word_shingles(t, words) for t in rows.column("__text").to_pylist()]
                least = [minimum_hashes(h) if len(h) else None for h in found]
                kept = {name: rows.column(name) for name in ("doc_id", "text_hash")}
                names = [set_name(h) if len(h) else None for h in found]
                bands = [None if low is None else band_keys(low) for low in least]
                odd = [None if low is None else odd_sketch(low).tolist() for low in least]
                yield pa.record_batch(
                    kept
                    | {
                        "node": pa.array(names, pa.int64()),
                        "size": pa.array(list(map(len, found)), pa.int64()),
                        "sketch": pa.array(odd, pa.list_(pa.int64())),
                        "bands": pa.array(bands, pa.list_(pa.int64())),
                    }
                )

    marked = cut_lineage(
        docs.select(*row_key(docs), F.col("text").alias("__text")).mapInArrow(
            sketch,
            "doc_id bigint, text_hash bigint, node bigint, size bigint, "
            "sketch array<bigint>, bands array<bigint>",
        )
    )
    nodes = node_rows(marked.filter("node IS NOT NULL"))
    limit = most_differing(percent)
    links = crowds.similar_links(
        nodes.select("node", "size", "sketch", F.col("bands").alias("keys")),
        lambda asked: sets_of_rows(docs, chosen_rows(nodes, asked), word_shingles, words),
        lambda a, b: _differing(a, b) <= limit,
        percent,
        crowded,
    )
    classes = component_ids(nodes.select(F.col("node").alias("key"), "first_id"), links)
    rows = marked.select("doc_id", "size", "node")
    linked = rows.filter("node IS NOT NULL").join(classes, F.col("node") == F.col("key"))
    alone = rows.filter("node IS NULL").withColumn("component_id", F.col("doc_id"))
    return linked.select(*alone.columns).unionByName(alone).select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
