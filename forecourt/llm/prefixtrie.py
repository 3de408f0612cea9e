"""Conversations as a prefix trie, and subtree totals by centroid decomposition (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage
from forecourt.operators.paging import with_row_number

WORD = r"[^\x20\x09-\x0D]+"
HEAD_TURNS = 3  # h is a remainder of 4, so no more than 3 turns are taken from elsewhere
BLOCK_ROWS = 65_536
LOCAL_WEIGHT = 32_768
LIST_IDS = 4_096


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, row_no, c1, c2, words``: the turns in order, numbered through.

    Turns are ordered by ``turn``, null first, then by role and text; a row's
    number grows through all conversations, so that a long one is spread over
    many tasks. ``c1, c2`` are two hashes of role and text, nulls being empty.
    Rows without a ``conv_id`` belong to no conversation.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("tie"),  # equal rows may be split, too
    )
    numbered = with_row_number(rows, ["conv_id", "turn", "role", "text", "tie"])
    return cut_lineage(
        numbered.select(
            "conv_id",
            "row_no",
            F.xxhash64("role", "text").alias("c1"),
            F.xxhash64("text", "role", F.lit(1)).alias("c2"),
            F.size(F.regexp_extract_all("text", F.lit(WORD), 0)).cast("bigint").alias("words"),
        )
    )


def rebuilt_turns(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first turns taken from the first of their family.

    Of ``placed_turns`` the result is ``conv_id, place, size, block, c1, c2, words``
    and, one row each, ``conv_id, size``. Conversation c starts with the first h
    turns of conversation c - c % ``family`` (as many as there are), h being the
    crc32 of its decimal id modulo ``heads``; its own turns after its first h follow.
    ``block`` cuts the turns of a conversation into runs of bounded length.
    """
    c = F.col("conv_id")
    spans = cut_lineage(
        turns.groupBy("conv_id").agg(
            F.min("row_no").alias("first_no"), F.count(F.lit(1)).alias("own")
        )
    )
    taken = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(heads)).cast("bigint")
    first = spans.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    known = spans.withColumn("h", taken).withColumn("base", c - c % family).join(first, "base", "left")
    known = known.withColumn("m", F.least("h", F.coalesce("base_own", F.lit(0))))
    size = F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    known = cut_lineage(known.withColumn("size", size))

    here = turns.join(known.select("conv_id", "first_no", "h", "m", "size"), "conv_id")
    here = here.withColumn("at", F.col("row_no") - F.col("first_no") + 1)
    own = here.filter("at > h").select(
        "conv_id",
        (F.col("at") - F.col("h") + F.col("m")).alias("place"),
        "size",
        F.floor(F.col("row_no") / BLOCK_ROWS).alias("block"),
        "c1",
        "c2",
        "words",
    )
    starts = here.filter((c % family == 0) & (F.col("at") < heads)).select(
        F.col("conv_id").alias("base"), F.col("at").alias("place"), "c1", "c2", "words"
    )
    head = known.filter("m > 0").select("conv_id", "base", "m", "size").join(starts, "base")
    head = head.filter("place <= m").withColumn("block", F.lit(-1).cast("bigint"))
    return own.unionByName(head.select(*own.columns)), known.select("conv_id", "size")


def prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """``conv_id, depth, x1, x2, t1, t2, words, size``: a row for each prefix of a conversation.

    ``x1, x2`` identify the sequence of the first ``depth`` turns: the exclusive
    or of two hashes of every (place, role, text) up to there, 128 bits in all.
    ``t1, t2`` are those of the last turn alone, so x xor t is the parent. Sums
    run inside blocks first and are carried from block to block, so the longest
    conversation is no single task's work.
    """
    marked = turns.select(
        "conv_id",
        F.col("place").alias("depth"),
        "block",
        F.xxhash64("place", "c1", "c2").alias("t1"),
        F.xxhash64("c2", "c1", "place").alias("t2"),
        "words",
        "size",
    )
    run = Window.partitionBy("conv_id", "block").orderBy("depth")
    inside = marked.withColumns({f"x{k}": F.bit_xor(f"t{k}").over(run) for k in (1, 2)})
    blocks = marked.groupBy("conv_id", "block").agg(*(F.bit_xor(f"t{k}").alias(f"b{k}") for k in (1, 2)))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id", "block", *(F.bit_xor(f"b{k}").over(before).alias(f"y{k}") for k in (1, 2))
    ).filter("y1 IS NOT NULL")
    whole = inside.join(carried, ["conv_id", "block"], "left").select(
        "conv_id",
        "depth",
        *(F.col(f"x{k}").bitwiseXOR(F.coalesce(f"y{k}", F.lit(0))).alias(f"x{k}") for k in (1, 2)),
        "t1",
        "t2",
        "words",
        "size",
    )
    none = F.lit(0).cast("bigint")
    roots = sizes.select(
        "conv_id", *(none.alias(n) for n in ("depth", "x1", "x2", "t1", "t2", "words")), "size"
    )
    return cut_lineage(whole.unionByName(roots))


KEY = ["depth", "x1", "x2"]


def trie_nodes(lines: DataFrame) -> DataFrame:
    """One row per node: ``conv, depth, parent, n_convs, n_children, words, weight`` and its key.

    ``conv`` is the smallest member and, with the depth, names the node; ``weight``
    is the sum of ``n_convs`` over the subtree, taken from what the members still
    have below the node, without looking at the tree.
    """
    nodes = cut_lineage(
        lines.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("words").alias("words"),
            F.sum(F.col("size") - F.col("depth") + 1).alias("weight"),
            F.min(F.col("x1").bitwiseXOR(F.col("t1"))).alias("p1"),
            F.min(F.col("x2").bitwiseXOR(F.col("t2"))).alias("p2"),
        )
    )
    over = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x1").alias("p1"),
        F.col("x2").alias("p2"),
        F.col("conv").alias("parent"),
    )
    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), "p1", "p2")
    below = below.agg(F.count(F.lit(1)).alias("n_children"))
    below = below.withColumnsRenamed({"p1": "x1", "p2": "x2"})
    linked = nodes.join(over, ["depth", "p1", "p2"], "left").join(below, KEY, "left")
    return cut_lineage(
        linked.select(
            "conv", *KEY, "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "words", "weight",
        )
    )


def ends_digests(lines: DataFrame) -> DataFrame:
    """``depth, x1, x2, ends_sha256`` of the nodes where conversations end.

    The ids of a node are joined in lists of bounded length by many tasks; the
    digest of a node is fed with its lists one after the other, so a node where a
    third of all conversations end is held in memory nowhere.
    """
    ends = lines.filter("depth = size").select("conv_id", *KEY)
    placed = with_row_number(ends, [*KEY, "conv_id"])
    lists = placed.groupBy(*KEY, F.floor(F.col("row_no") / LIST_IDS).alias("list_no")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
        .alias("ids")
    )

    def digest(batches):
        last, state = None, None
        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield _digest_rows(done)
        if last is not None:
            yield _digest_rows([(*last, state.hexdigest())])

    return (
        lists.repartition(*KEY)
        .sortWithinPartitions(*KEY, "list_no")
        .mapInArrow(digest, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")
    )


def _digest_rows(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found, strict=True)
    names = ("depth", "x1", "x2", "ends_sha256")
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def subtree_totals(
    nodes: DataFrame, lines: DataFrame, values: Sequence[str], local_weight: int = LOCAL_WEIGHT
) -> DataFrame:
    """``conv, depth`` and, for every column of ``values``, its sum over the node's subtree.

    ``nodes`` has ``conv, depth, parent`` (the parent is ``parent, depth - 1``; of
    the root null), ``weight`` (a positive measure summed over the subtree) and the
    long columns to add; ``lines`` has ``conv, depth, node, over``: of each ``conv``
    that names a node, its ancestors ``node`` and their parents ``over``.

    Centroid decomposition of the parent edges: in every round each component has
    one centroid, the deepest node under which more than half of its weight lies.
    The nodes with more than half of the weight are the path from the component's
    top to the centroid, so no path is walked. The component's total under the
    centroid is added to the nodes of that path, the centroid is finished, and
    its children and the rest above it are components of at most half the weight. A
    round is a few joins; there are as many rounds as the weight can be halved,
    however deep the tree is. Components of up to ``local_weight`` are gathered and
    taken through the same rounds inside one task each.
    """
    accs = [f"__acc_{v}" for v in values]
    root = nodes.filter("parent IS NULL").select("conv", "weight").first()
    top, total = (root["conv"], root["weight"]) if root else (None, 0)
    zero = F.lit(0).cast("bigint")
    state = nodes.select(
        "conv", "depth", "parent", "weight", F.lit(top).cast("bigint").alias("top"),
        zero.alias("top_depth"), F.lit(total).cast("bigint").alias("total"),
        *values, *(zero.alias(a) for a in accs),
    )
    finished, small = [], []
    state = cut_lineage(state)
    while True:
        small.append(state.filter(F.col("total") <= local_weight))
        state = state.filter(F.col("total") > local_weight)
        if state.isEmpty():
            break
        state, done = _split_components(state, lines, values, accs)
        finished.append(done)
    local = _inside_tasks(reduce(DataFrame.unionByName, small), values, accs, local_weight)
    return reduce(DataFrame.unionByName, finished, local)


def _split_components(
    state: DataFrame, lines: DataFrame, values: Sequence[str], accs: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """One round of the decomposition: the smaller components, and the finished centroids."""
    component = ["top", "top_depth"]
    heavy = F.col("weight") * 2 > F.col("total")
    deepest = state.filter(heavy).groupBy(*component).agg(
        F.max(F.struct("depth", "conv", "weight")).alias("c")
    )
    chosen = deepest.select(
        *component, F.col("c.depth").alias("c_depth"), F.col("c.conv").alias("c_conv"),
        F.col("c.weight").alias("c_weight"),
    )
    steps = lines.select(
        "conv", (F.col("depth") - 1).alias("c_depth"), F.col("node").alias("child"), "over"
    )
    marked = state.join(chosen, component)
    # Only nodes deeper than the centroid can lie under it; they have an ancestor at its depth.
    deeper = marked.filter("depth > c_depth").join(steps, ["conv", "c_depth"])
    deeper = deeper.withColumn("under", F.col("over") == F.col("c_conv")).drop("over")
    others = marked.filter("depth <= c_depth").withColumns({
        "child": F.lit(None).cast("bigint"),
        "under": (F.col("depth") == F.col("c_depth")) & (F.col("conv") == F.col("c_conv")),
    })
    marked = cut_lineage(deeper.unionByName(others))
    totals = marked.filter("under").groupBy(*component).agg(*(F.sum(v).alias(f"__sum_{v}") for v in values))
    added = {a: F.col(a) + F.col(f"__sum_{v}") for v, a in zip(values, accs, strict=True)}
    centroid = F.col("under") & F.col("child").isNull()
    path = marked.filter(heavy).join(totals, component)
    done = cut_lineage(
        path.filter(centroid).select("conv", "depth", *(added[a].alias(v) for v, a in zip(values, accs, strict=True)))
    )
    kept = ["conv", "depth", "parent", "weight", *component, "total", *values, *accs]
    rest = {"total": F.col("total") - F.col("c_weight")}
    upper = path.filter(~centroid).withColumns(added | rest | {"weight": F.col("weight") - F.col("c_weight")})
    aside = marked.filter(~heavy & ~F.col("under")).withColumns(rest)
    tops = marked.filter("under AND depth = c_depth + 1").select(
        F.col("conv").alias("child"), "depth", F.col("weight").alias("total")
    )
    tops = tops.withColumnRenamed("depth", "top_depth")
    lower = marked.filter("under AND child IS NOT NULL").drop(*component, "total")
    lower = lower.withColumn("top_depth", F.col("c_depth") + 1).join(tops, ["child", "top_depth"])
    lower = lower.withColumnRenamed("child", "top")
    pieces = (upper.select(*kept), aside.select(*kept), lower.select(*kept))
    return cut_lineage(reduce(DataFrame.unionByName, pieces)), done


def _inside_tasks(
    state: DataFrame, values: Sequence[str], accs: Sequence[str], local_weight: int
) -> DataFrame:
    """Components of bounded weight, several to a group, finished by ``forest_totals``."""
    groups = max(1, -(-state.count() // local_weight))

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("depth", kind="stable", ignore_index=True)
        place = pd.Series(part.index, index=pd.MultiIndex.from_frame(part[["conv", "depth"]]))
        inner = (part["depth"] > part["top_depth"]).to_numpy()
        parent = np.full(len(part), -1, np.int64)
        over = pd.MultiIndex.from_arrays([part["parent"][inner].astype("int64"), part["depth"][inner] - 1])
        parent[inner] = place.reindex(over).to_numpy(np.int64)
        added = forest_totals(parent, part["weight"].to_numpy(), part[list(values)].to_numpy(np.int64))
        sums = part[list(accs)].to_numpy(np.int64) + added
        return pd.concat(
            [part[["conv", "depth"]], pd.DataFrame(sums, columns=list(values))], axis=1
        )

    schema = "conv bigint, depth bigint, " + ", ".join(f"{v} bigint" for v in values)
    group = F.pmod(F.xxhash64("top", "top_depth"), F.lit(groups))
    return state.groupBy(group).applyInPandas(finish, schema)


def forest_totals(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of the rows of ``values`` over a forest, by centroid decomposition.

    Parents come before their children; a top has the parent -1. ``weight`` is a
    positive measure already summed over subtrees.
    """
    n = len(parent)
    parent, weight = parent.copy(), weight.astype(np.int64)
    found = np.zeros_like(values)
    index = np.arange(n)
    top = _piece_tops(parent, index)
    alive = np.ones(n, bool)
    while alive.any():
        on_path = alive & (2 * weight > weight[top])
        centroid = np.full(n, -1)
        np.maximum.at(centroid, top[on_path], index[on_path])  # deeper rows come later
        mine = np.where(alive, centroid[top], -1)
        chosen = alive & (mine == index)
        cut = alive & (parent >= 0) & chosen[parent]
        pieces = _piece_tops(np.where(cut | chosen, -1, parent), index)
        under = alive & (chosen | cut[pieces])
        sums = np.zeros_like(values)
        np.add.at(sums, top[under], values[under])
        found[on_path] += sums[top[on_path]]
        above = on_path & ~chosen
        weight[above] -= weight[mine[above]]
        alive &= ~chosen
        parent[cut] = -1
        top = pieces
    return found


def _piece_tops(parent: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The top of each node's piece, by doubling the jumps."""
    jump = np.where(parent >= 0, parent, index)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


def conversation_trie(conversations: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree: words of the
    last turn that other members need not repeat), ``ends_sha256`` of the ids of the
    members that end here.

    Null roles and texts are empty, a null ``turn`` comes first, equal turns are
    ordered by role and text, repeated rows are turns of their own. Rows without a
    ``conv_id`` and columns besides the four are ignored; no conversations give no
    rows, not even a root.
    """
    turns, sizes = rebuilt_turns(placed_turns(conversations))
    lines = prefixes(turns, sizes)
    nodes = trie_nodes(lines)
    own = nodes.select(
        "conv", "depth", "parent", "weight",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    named = nodes.select(*KEY, F.col("conv").alias("node"), F.col("parent").alias("over"))
    needed = nodes.select(F.col("conv").alias("conv_id")).distinct()
    steps = lines.join(needed, "conv_id", "left_semi").select(F.col("conv_id").alias("conv"), *KEY)
    steps = cut_lineage(steps.join(named, KEY).select("conv", "depth", "node", "over"))
    totals = subtree_totals(own, steps, ["n_leaves", "saved_tokens"], local_weight)
    return (
        nodes.join(totals, ["conv", "depth"])
        .join(ends_digests(lines), KEY, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )
