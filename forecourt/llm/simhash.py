"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified links, components (operator 2)."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage, helper_prefix, row_slices
from forecourt.llm.components import component_roots

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42  # fixed value: the hash seed of the fingerprint
N_BLOCKS = 4
CROWDED = 64


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if it is set in over half the hashes of the text's shingles."""
    data = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not data:
        return 0
    join, hashed = b" ".join, xxhash.xxh64_intdigest
    if len(data) <= words:
        return hashed(join(data), SEED)
    shingles = map(join, zip(*(data[k:] for k in range(words)), strict=False))
    return majority_bits(
        np.fromiter((hashed(s, SEED) for s in shingles), "<u8", len(data) - words + 1)
    )


def majority_bits(hashes: np.ndarray) -> int:
    """64 bits; a bit is set if it is set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        octets = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint as a signed long, a row per row of ``docs``."""

    def sketch(batches):
        for batch in batches:
            for rows in row_slices(batch, "__text"):
                prints = [fingerprint(t, words) for t in rows.column("__text").to_pylist()]
                signed = np.array(prints, np.uint64).view(np.int64)
                kept = {name: rows.column(name) for name in ("doc_id", "text_hash")}
                yield pa.record_batch(kept | {"fp": pa.array(signed)})

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").alias("__text"),
    ).mapInArrow(sketch, "doc_id bigint, text_hash bigint, fp bigint")


def _block_keys(fp: Column, max_distance: int, n_blocks: int) -> Column:
    """One key for each way to leave ``max_distance`` of the blocks out.

    At most ``max_distance`` blocks of a close pair differ, so the pair agrees
    in all other blocks and meets under at least one key. With 4 blocks of 16
    bits and 2 bits of distance a key has 32 bits of fingerprint.
    """
    width = 64 // n_blocks
    keys = []
    for number, chosen in enumerate(combinations(range(n_blocks), n_blocks - max_distance)):
        mask = sum(((1 << width) - 1) << (width * k) for k in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(
            F.struct(F.lit(number).alias("way"), fp.bitwiseAND(F.lit(signed)).alias("block"))
        )
    return F.array(*keys)


def way_keys(
    fp: Column, max_distance: int = MAX_DISTANCE, n_blocks: int = N_BLOCKS
) -> Column:
    """The block keys of a fingerprint as one array of longs."""
    return F.transform(
        _block_keys(fp, max_distance, n_blocks), lambda k: F.xxhash64(k["way"], k["block"])
    )


def close_pairs(
    prints: DataFrame,
    max_distance: int = MAX_DISTANCE,
    n_blocks: int = N_BLOCKS,
    crowded: int = CROWDED,
) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that join all pairs within the distance.

    ``prints`` has distinct values ``fp``. Blocks of up to ``crowded``
    fingerprints are joined with themselves and verified, so each link there is
    a close pair. Fingerprints of a fuller block, all pairs of which would be
    too many, are linked through shared neighbours instead (``_through_neighbours``),
    which joins the same components with links in proportion to the fingerprints.
    """
    if not 0 <= max_distance < n_blocks or 64 % n_blocks:
        raise ValueError("the blocks must divide 64 bits and outnumber the distance")
    keys = prints.select(
        "fp", F.inline(_block_keys(F.col("fp"), max_distance, n_blocks))
    ).select("fp", "way", "block")
    sizes = cut_lineage(
        keys.groupBy("way", "block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    shared = cut_lineage(keys.join(sizes, ["way", "block"]))
    few = shared.filter(F.col("n") <= crowded)
    left = few.select("way", "block", F.col("fp").alias("a"))
    right = few.select("way", "block", F.col("fp").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (
        left.join(right, ["way", "block"])
        .filter((F.col("a") < F.col("b")) & (apart <= max_distance))
        .select("a", "b")
    )
    many = shared.filter(F.col("n") > crowded).select("fp").distinct()
    return pairs.unionAll(_through_neighbours(many, max_distance)).distinct()


def _through_neighbours(prints: DataFrame, max_distance: int) -> DataFrame:
    """Chains that join the fingerprints within the distance, also in a crowd.

    Two values differ in up to 2r bits exactly if some value differs in up to r
    bits from both. So every value is listed under all values up to r bits away
    and linked with the least one listed there; a list holds as many values as
    there are ways to flip r bits, however large the crowd. An odd distance is
    brought to 2r + 1 by listing one side r + 1 bits away, verified afterwards.
    """
    near = _flips((max_distance + 1) // 2)
    listed = prints.select(
        "fp",
        F.explode(
            F.transform(F.array(*map(F.lit, near)), lambda flip: F.col("fp").bitwiseXOR(flip))
        ).alias("spot"),
    )
    lists = listed.groupBy("spot").agg(F.sort_array(F.collect_set("fp")).alias("all"))
    lists = lists.filter(F.size("all") > 1).select("all")
    if max_distance % 2 == 0:
        ends = F.transform(F.slice("all", 2, F.size("all")), lambda other: F.struct(
            F.get("all", F.lit(0)).alias("a"), other.alias("b")
        ))
        return lists.select(F.inline(ends))
    first = lists.select("all", F.explode("all").alias("a"))
    pairs = first.select("a", F.explode("all").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.filter((F.col("a") < F.col("b")) & (apart <= max_distance))


def _flips(bits: int) -> list[int]:
    """All masks with up to so many bits set, as signed longs."""
    masks = [
        sum(1 << k for k in chosen)
        for size in range(bits + 1)
        for chosen in combinations(range(64), size)
    ]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def near_copies(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    n_blocks: int = N_BLOCKS,
    crowded: int = CROWDED,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, text_hash``: one row per row of ``docs``.

    ``fingerprint`` is 16 hex digits, ``component_id`` the least ``doc_id`` that
    can be reached over links of at most ``max_distance`` differing bits. A null
    or empty text has the fingerprint zero and is linked like any other. Rows
    with equal ids or texts each stay. A null id links the others but is never a
    ``component_id`` itself (null only if no reachable row has an id). Columns
    other than ``doc_id`` and ``text`` are ignored. No rows give none.

    Equal fingerprints are one node, so exact copies add nothing to the joins.
    """
    marked = cut_lineage(with_fingerprints(docs, words))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = close_pairs(nodes.select("fp"), max_distance, n_blocks, crowded)
    classes = component_ids(nodes.select(F.col("fp").alias("key"), "first_id"), links)
    return marked.join(classes, F.col("fp") == F.col("key")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "text_hash",
    )


def component_ids(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``key, component_id``: of each node ``key, first_id`` the least ``first_id`` over ``links``."""
    roots = component_roots(links)
    linked = cut_lineage(
        nodes.join(roots, F.col("key") == F.col("node")).select("key", "first_id", "root")
    )
    least = cut_lineage(linked.groupBy("root").agg(F.min("first_id").alias("linked_id")))
    linked = linked.join(least, "root").select("key", "linked_id")
    return cut_lineage(
        nodes.join(linked, "key", "left").select(
            "key", F.coalesce("linked_id", "first_id").alias("component_id")
        )
    )


def one_per_component(docs: DataFrame, near=near_copies, **settings) -> DataFrame:
    """The rows of ``docs`` without their near copies: of each component the least id stays.

    ``near`` gives ``doc_id, component_id, text_hash`` for every row of ``docs``.

    Repeated rows of that id with the same text count as copies too: one of them
    stays. Rows without an id stay only if their component has no id at all, and
    of equal texts among them one. Other columns pass through, whatever their names.
    """
    p = helper_prefix(docs.columns)

    def key(text_hash: Column) -> Column:
        named = F.col("doc_id").cast("bigint").cast("string")
        return F.coalesce(named, F.concat(F.lit("text "), text_hash)).alias(f"{p}key")

    kept = near(docs, **settings).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = cut_lineage(kept.select(key(F.col("text_hash"))).distinct())
    rows = docs.select("*", key(F.xxhash64("text"))).join(keep, f"{p}key", "left_semi")
    return rows.dropDuplicates([f"{p}key", "text"]).select(*docs.columns)
