"""Near copies by their shared word shingles: SimHash blocks and minimum-hash bands, verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm import crowds
from forecourt.llm.common import cut_lineage, row_slices
from forecourt.llm.simhash import close_pairs, component_ids, majority_bits, way_keys

SHINGLE_WORDS = 5
LEAST_PERCENT = 80
BANDS, BAND_ROWS = 28, 4
FAR_BITS = 32  # fingerprints of sets at 0.8 differ in 10 to 14 of 64 bits, five deviations below this
SEED = 42  # fixed value: the hash seed of shingles and bands

_rng = np.random.default_rng(SEED)
_FACTORS = _rng.integers(0, 2**31, BANDS * BAND_ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _rng.integers(0, 2**32, BANDS * BAND_ROWS, np.uint32)


def shingle_hashes(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted; a shorter text is one shingle."""
    data = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    join, hashed = b" ".join, xxhash.xxh64_intdigest
    if len(data) <= words:
        return np.array([hashed(join(data), SEED)], np.uint64)
    runs = map(join, zip(*(data[k:] for k in range(words)), strict=False))
    return np.unique(
        np.fromiter((hashed(s, SEED) for s in runs), np.uint64, len(data) - words + 1)
    )


def set_name(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set of hashes."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def minimum_hashes(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` times ``BAND_ROWS`` minimum hashes of a set."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * BAND_ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(short), 1024):
        mixed = (short[None, at : at + 1024] ^ _MASKS[:, None]) * _FACTORS[:, None]
        np.minimum(least, mixed.min(1), out=least)
    return least


def band_keys(least: np.ndarray) -> list[int]:
    """One signed 64-bit key for each band of ``minimum_hashes``.

    Sets of similarity s share a key with 1 - (1 - s^4)^28: all but 4 in ten
    million pairs at 0.8, more above.
    """
    keys = [
        xxhash.xxh64_intdigest(band.tobytes(), number)
        for number, band in enumerate(least.reshape(BANDS, BAND_ROWS))
    ]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def row_key(docs: DataFrame) -> list[Column]:
    """``doc_id, text_hash``: what tells the rows of ``docs`` apart, copies aside."""
    return [
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
    ]


def sets_of_rows(docs: DataFrame, chosen: DataFrame, hashes_of, words: int) -> DataFrame:
    """``node, grams, parity``: the whole sets of the rows ``doc_id, text_hash, node`` of ``chosen``."""

    def collect(batches):
        for batch in batches:
            for rows in row_slices(batch, "__text"):
                found = [hashes_of(t, words) for t in rows.column("__text").to_pylist()]
                grams = _long_lists([h.view(np.int64) for h in found])
                parity = _long_lists([crowds.parity_bitmap(h) for h in found])
                yield pa.record_batch(
                    {"node": rows.column("node"), "grams": grams, "parity": parity}
                )

    rows = docs.select(*row_key(docs), F.col("text").alias("__text")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (
        F.col("d.text_hash") == F.col("c.text_hash")
    )
    texts = rows.join(chosen.alias("c"), same).select("node", "__text")
    found = texts.mapInArrow(collect, "node bigint, grams array<bigint>, parity array<bigint>")
    return found.groupBy("node").agg(*(F.first(c).alias(c) for c in ("grams", "parity")))


def _long_lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def near_copies(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    percent: int = LEAST_PERCENT,
    crowded: int = crowds.CROWDED,
    max_distance: int | None = None,
) -> DataFrame:
    """``doc_id, component_id, text_hash``: one row per row of ``docs``.

    Texts are linked if the Jaccard similarity of their shingles of ``words``
    words is ``percent`` or more; ``component_id`` is the least ``doc_id`` that can
    be reached over links. Texts with equal shingles are one node. Candidates meet
    under a SimHash block (the closest pairs) or a band of minimum hashes (the
    others); pairs of distant fingerprints are refused, and the rest verified on
    whole sets, in crowds by ``crowds.similar_links``. Null and empty texts are
    copies of each other. Ids and repeated rows are treated as by
    ``simhash.near_copies``.

    With ``max_distance`` texts whose SimHash fingerprints are at most so many bits
    apart are linked too, whatever their similarity: blocks, distances and links are
    those of ``simhash.close_pairs``.
    """

    def sketch(batches):
        for batch in batches:
            for rows in row_slices(batch, "__text"):
                found = [shingle_hashes(t, words) for t in rows.column("__text").to_pylist()]
                kept = {name: rows.column(name) for name in ("doc_id", "text_hash")}
                prints = np.array([majority_bits(h) for h in found], np.uint64).view(np.int64)
                bands = [band_keys(minimum_hashes(h)) for h in found]
                yield pa.record_batch(
                    kept
                    | {
                        "node": pa.array([set_name(h) for h in found], pa.int64()),
                        "size": pa.array(list(map(len, found)), pa.int64()),
                        "sketch": pa.array(prints),
                        "bands": pa.array(bands, pa.list_(pa.int64())),
                    }
                )

    marked = cut_lineage(
        docs.select(*row_key(docs), F.col("text").alias("__text")).mapInArrow(
            sketch,
            "doc_id bigint, text_hash bigint, node bigint, size bigint, sketch bigint, "
            "bands array<bigint>",
        )
    )
    nodes = node_rows(marked)
    members = nodes.select(
        "node", "size", "sketch", F.concat("bands", way_keys(F.col("sketch"))).alias("keys")
    )
    links = crowds.similar_links(
        members,
        lambda asked: sets_of_rows(docs, chosen_rows(nodes, asked), shingle_hashes, words),
        lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= FAR_BITS,
        percent,
        crowded,
    )
    if max_distance is not None:
        links = links.unionAll(fingerprint_links(nodes, max_distance))
    classes = component_ids(nodes.select(F.col("node").alias("key"), "first_id"), links)
    return marked.select("doc_id", "text_hash", "node").join(
        classes, F.col("node") == F.col("key")
    ).select("doc_id", "component_id", "text_hash")


def fingerprint_links(nodes: DataFrame, max_distance: int) -> DataFrame:
    """Links ``a, b`` that join all nodes whose fingerprints are within the distance."""
    prints = cut_lineage(nodes.groupBy("sketch").agg(F.min("node").alias("first")))
    close = close_pairs(prints.select(F.col("sketch").alias("fp")), max_distance)
    one = prints.select(F.col("sketch").alias("a"), F.col("first").alias("first_a"))
    other = prints.select(F.col("sketch").alias("b"), F.col("first").alias("first_b"))
    near = close.join(one, "a").join(other, "b").select("first_a", "first_b")
    equal = nodes.select("node", "sketch").join(prints, "sketch").filter("node <> first")
    return near.unionAll(equal.select("first", "node")).toDF("a", "b")


def node_rows(marked: DataFrame) -> DataFrame:
    """One row per node: its sketch and bands, its least id, and a row that has its text."""
    return cut_lineage(
        marked.groupBy("node").agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("row"),
            *(F.first(c).alias(c) for c in ("size", "sketch", "bands")),
        )
    )


def chosen_rows(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    return nodes.join(asked, "node", "left_semi").select("row.doc_id", "row.text_hash", "node")
