"""Links between similar sets that share a key, however many sets share it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage
from forecourt.llm.components import component_roots

CROWDED = 32
FIRST_HUBS, MORE_HUBS = 2, 32
PARITY_BITS = 1024
_SHIFT = np.uint64(64 - 10)  # the leading 10 bits of a hash

Close = Callable[[Column, Column], Column]


def _may_link(one: str, other: str, close: Close, percent: int) -> Column:
    """What a pair must meet before its whole sets are compared: sizes and sketches."""
    a, b = F.col(f"{one}.size"), F.col(f"{other}.size")
    sizes = F.least(a, b) * 100 >= F.greatest(a, b) * percent
    return sizes & close(F.col(f"{one}.sketch"), F.col(f"{other}.sketch"))


def parity_bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bits that an odd number of the set's hashes fall on, as signed longs."""
    flips = np.bincount((hashes >> _SHIFT).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _few_apart(percent: int) -> Column:
    """Whether two sets may be similar by their parity bitmaps, which is never wrong.

    The bitmaps differ in at most as many bits as there are elements in one set
    only, and those are at most (100 - p) / (100 + p) of both sizes together.
    """
    apart = reduce(
        add,
        (
            F.bit_count(F.get("l.parity", F.lit(k)).bitwiseXOR(F.get("r.parity", F.lit(k))))
            for k in range(PARITY_BITS // 64)
        ),
    )
    sizes = F.col("l.size") + F.col("r.size")
    return apart * (100 + percent) <= sizes * (100 - percent)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` whose whole sets have a Jaccard similarity of ``percent`` or more."""
    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    other = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    full = pairs.join(one, "a").join(other, "b").withColumn("both", both)
    union = F.size("grams_a") + F.size("grams_b") - F.col("both")
    return full.filter(F.col("both") * 100 >= union * percent).select("a", "b")


def _pairs(
    left: DataFrame,
    right: DataFrame,
    chosen: Column,
    close: Close,
    percent: int,
    last: Column | None = None,
) -> DataFrame:
    met = left.alias("l").join(right.alias("r"), "key")
    asked = chosen & _may_link("l", "r", close, percent)
    met = met.filter(asked if last is None else asked & last)
    ends = (F.col("l.node"), F.col("r.node"))
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def similar_links(
    members: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    close: Close,
    percent: int,
    crowded: int = CROWDED,
) -> DataFrame:
    """Links ``a, b`` that join all nodes which share a key and are similar.

    ``members`` has one row per node: ``node``, ``size`` of its set, ``sketch`` and
    ``keys``. ``sets_of`` gives ``node, grams, parity`` for a frame of nodes: the whole
    sets and their ``parity_bitmap``. Every link is verified on whole sets; each pair of nodes under a common key with a Jaccard
    similarity of ``percent`` is linked or joined by other links. ``close`` may only
    refuse pairs of sketches that cannot be similar.

    All pairs under a key of up to ``crowded`` nodes are compared. Under a fuller
    key a few hubs are compared with all others, first those nodes that stand
    under most of the crowded keys: the original of many variants is one of them.
    Then only nodes outside a key's largest component can add anything, and only
    with nodes of other components; they are the next hubs, many times more in
    every round, until no key has nodes of two components that were not compared.
    The parity bitmap of the whole set spares pairs too far apart the comparison.
    No pair is left out: a crowd of near copies takes a few comparisons a node, and
    only nodes outside the largest component of a crowd are held against all of it.
    """
    keys = members.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = cut_lineage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = keys.join(sizes, "key").join(members.select("node", "size", "sketch"), "node")
    shared = cut_lineage(shared)
    few = shared.filter(F.col("n") <= crowded).drop("n")
    many = shared.filter(F.col("n") > crowded).drop("n")
    pairs = _pairs(few, few, F.col("l.node") < F.col("r.node"), close, percent)
    pairs = cut_lineage(pairs)
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionAll(many.select("node"))
    sets = cut_lineage(sets_of(asked.distinct()))
    links = cut_lineage(_similar(pairs, sets, percent))

    hubs_a_key = FIRST_HUBS
    many = many.join(sets.select("node", "parity"), "node")
    many = cut_lineage(many.withColumns({"root": F.col("node"), "stray": F.lit(True)}))
    while not many.isEmpty():
        hubs = cut_lineage(_hubs(many, hubs_a_key))
        apart = F.col("l.root") != F.col("r.root")
        pairs = _pairs(hubs, many, apart, close, percent, _few_apart(percent))
        links = cut_lineage(links.unionAll(_similar(pairs, sets, percent)))
        rest = many.join(hubs.select("key", "node"), ["key", "node"], "left_anti")
        many = _still_open(rest.drop("root", "stray"), component_roots(links))
        hubs_a_key *= MORE_HUBS
    return links


def _hubs(rows: DataFrame, number: int) -> DataFrame:
    """Of each key the stray nodes that stand under most keys."""
    spread = rows.groupBy("node").agg(F.count(F.lit(1)).alias("spread"))
    best = Window.partitionBy("key").orderBy(F.desc("spread"), "node")
    ranked = rows.filter("stray").join(spread, "node").withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= number).drop("rank", "spread", "stray")


def _still_open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of keys with several components, marked ``stray`` outside the largest of them."""
    placed = rows.join(roots, "node", "left")
    placed = cut_lineage(placed.withColumn("root", F.coalesce("root", "node")))
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    keys = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "root")).alias("largest")
    )
    keys = cut_lineage(keys.filter("parts > 1").select("key", F.col("largest.root").alias("main")))
    return cut_lineage(
        placed.join(keys, "key").withColumn("stray", F.col("root") != F.col("main")).drop("main")
    )
