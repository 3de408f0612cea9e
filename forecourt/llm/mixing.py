"""Mixing sources to target weights by Sainte-Laguë quotas of equal blocks (operator 3)."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage, helper_prefix, row_slices

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK_WORDS = 64
LEAST_BLOCK = 8
BLOCKS_OF_SMALLEST = 256
SHARD_DOCS = 20_000
MAX_SOURCES = 1_000_000
BROADCAST_SOURCES = 10_000
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def targets_of(
    sizes: Sequence[int], weights: Sequence[float], share: float = 1.0, cap: float = CAP
) -> list[float]:
    """Words wanted of each source: ``share`` of all words by weight, none above cap × its size.

    What a capped source can't take goes to the others by weight, until none is
    above its cap.
    """
    found = [0.0] * len(sizes)
    left, total = share * sum(sizes), sum(w for w in weights if w > 0)
    # Those with the least room for their weight are full first.
    order = sorted((i for i, w in enumerate(weights) if w > 0), key=lambda i: sizes[i] / weights[i])
    for place, i in enumerate(order):
        if left * weights[i] <= cap * sizes[i] * total:
            for other in order[place:]:
                found[other] = left * weights[other] / total
            break
        found[i] = float(cap * sizes[i])
        left -= found[i]
        total -= weights[i]
    return found


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients weight / (2k + 1), at most ``most[i]`` each; ties to the first.

    Starts from the quotas rounded down less one half of a seat, which the
    highest quotients always grant, so the heap only deals the few seats left.
    """
    total = sum(weights)
    seats = min(seats, sum(m for m, w in zip(most, weights, strict=True) if w > 0))
    given = [0] * len(weights)
    if not total or seats <= 0:
        return given
    divisor = total / seats * (1 + 1e-9)
    while True:  # as many as this divisor grants, and not more than there are
        given = [
            min(int(m), max(0, int(np.floor(w / divisor + 0.5))))
            for w, m in zip(weights, most, strict=True)
        ]
        if sum(given) <= seats:
            break
        divisor *= 1 + 1 / (2 * seats + len(weights))
    heap = [
        (-w / (2 * g + 1), i)
        for i, (w, g, m) in enumerate(zip(weights, given, most, strict=True))
        if w > 0 and g < m
    ]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * given[i] + 1), i))
    return given


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, text_hash`` of every row; size counts words, 0 for null."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words.cast("bigint").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: float = CAP
) -> list[tuple[str | None, int, int, float]]:
    """``(source, words, rows, target)``, sources by code point and null last.

    A weight has to be named for every source, so one row per source reaches the
    driver; more than ``MAX_SOURCES`` raise an error.
    """
    rows = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        .limit(MAX_SOURCES + 1)
        .collect()
    )
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["words"] for r in rows]
    dealt = [weights[i % len(weights)] for i in range(len(rows))]
    wanted = targets_of(sizes, dealt, share, cap)
    return [(r["source"], r["words"], r["n"], t) for r, t in zip(rows, wanted, strict=True)]


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_docs: int = SHARD_DOCS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of each row of ``docs``.

    ``doc_id, source, size, source_size, target, taken, text_hash, passes, spans``: the mix
    takes the whole text ``passes`` times, and once more the words of ``spans``
    (start, stop); ``taken`` counts these words, repeats included.

    Each source is cut into shards of about ``shard_docs`` rows by a hash of id
    and size, and the words of a shard, in the order of a seeded hash, into
    blocks of ``block_words``, or fewer (8 at least) if the smallest source would have
    less than 256 such blocks. Sainte-Laguë gives each source its number of
    blocks, the same method deals them to the source's shards; a shard takes all
    its blocks as often as its quota has room for, then the blocks with the
    least seeded hashes. So a hot source is spread over many tasks, and a rerun
    takes the same words. Rows without words are taken 0 times; a null text has
    none; rows with equal id and size are interchangeable.
    """
    spark = docs.sparkSession
    sized = cut_lineage(sized_documents(docs))
    sources = source_targets(sized, weights, share, cap)
    smallest = min((words for _, words, _, _ in sources if words), default=0)
    block_words = min(block_words, max(LEAST_BLOCK, smallest // BLOCKS_OF_SMALLEST))
    blocks = [-(-words // block_words) for _, words, _, _ in sources]
    goal = round(sum(t for *_, t in sources) / block_words)
    quotas = sainte_lague([t for *_, t in sources], goal, [cap * b for b in blocks])
    table = spark.createDataFrame(
        [
            (number, name, words, target, -(-rows // shard_docs), quota)
            for number, ((name, words, rows, target), quota) in enumerate(
                zip(sources, quotas, strict=True)
            )
        ],
        "source_no long, name string, source_size long, target double, shards long, quota long",
    )
    if len(sources) <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    known = sized.join(table, F.col("source").eqNullSafe(F.col("name")))
    mixed = F.xxhash64("doc_id", "size", F.lit(seed))
    placed = cut_lineage(
        known.select(
            F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no long beside a null
            "source",
            "size",
            "text_hash",
            "source_no",
            F.pmod(mixed, F.col("shards")).alias("shard"),
            F.xxhash64(mixed).alias("place"),
        )
    )
    totals = (
        placed.groupBy("source_no", "shard")
        .agg(F.sum("size").alias("words"))
        .join(table.select("source_no", "source_size", "target", "quota"), "source_no")
    )

    def deal(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard")
        held = (-(-shards["words"] // block_words)).tolist()
        quota = int(shards["quota"].iloc[0])
        passes, rest = divmod(quota, max(sum(held), 1))
        extra = sainte_lague(held, rest, held)
        shards["blocks"] = [passes * h + e for h, e in zip(held, extra, strict=True)]
        return shards[["source_no", "shard", "source_size", "target", "blocks"]]

    dealt = cut_lineage(
        totals.groupBy("source_no").applyInPandas(
            deal, "source_no long, shard long, source_size long, target double, blocks long"
        )
    )

    def take(rows: pd.DataFrame, quota: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=_PLAN_COLUMNS)
        rows = rows.sort_values(["place", "doc_id", "text_hash"]).reset_index(drop=True)
        size = rows["size"].to_numpy(np.int64)
        ends = size.cumsum()
        n_blocks = -(-int(ends[-1]) // block_words)
        shard = quota.iloc[0]
        passes, rest = divmod(int(shard["blocks"]), max(n_blocks, 1))
        key = (seed, int(shard["source_no"]), int(shard["shard"]))
        chosen = np.zeros(n_blocks, bool)
        chosen[np.random.default_rng(key).permutation(n_blocks)[:rest]] = True
        spans = _chosen_spans(chosen, ends - size, ends, block_words)
        once = [sum(b - a for a, b in found) for found in spans]
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"],
                "source": rows["source"],
                "size": size,
                "source_size": int(shard["source_size"]),
                "target": float(shard["target"]),
                "taken": passes * size + np.array(once, np.int64),
                "text_hash": rows["text_hash"],
                "passes": np.where(size > 0, passes, 0),
                "spans": [[{"start": a, "stop": b} for a, b in found] for found in spans],
            }
        )

    return (
        placed.groupBy("source_no", "shard")
        .cogroup(dealt.groupBy("source_no", "shard"))
        .applyInPandas(take, _PLAN)
        .withColumn("doc_id", F.col("doc_id").cast("bigint"))
    )


_PLAN = (
    "doc_id string, source string, size long, source_size long, target double, taken long, "
    "text_hash long, passes int, spans array<struct<start: long, stop: long>>"
)
_PLAN_COLUMNS = [field.split()[0] for field in _PLAN.split(", ")][:9]


def _chosen_spans(
    chosen: np.ndarray, starts: np.ndarray, ends: np.ndarray, block_words: int
) -> list[list[tuple[int, int]]]:
    """For each document, the runs of its words that lie in chosen blocks."""
    edges = np.diff(np.concatenate(([0], chosen.view(np.int8), [0])))
    run_start = np.flatnonzero(edges == 1) * block_words
    run_stop = np.flatnonzero(edges == -1) * block_words
    first = np.searchsorted(run_stop, starts, side="right")
    found = []
    for begin, end, run in zip(starts.tolist(), ends.tolist(), first.tolist(), strict=True):
        spans = []
        while run < len(run_start) and run_start[run] < end:
            a, b = max(begin, int(run_start[run])), min(end, int(run_stop[run]))
            if a < b:
                spans.append((a - begin, b - begin))
            run += 1
        found.append(spans)
    return found


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix: whole copies of texts, and a row for what is taken once more.

    The columns are those of ``docs``; the ``text`` of such a row has a line for
    each run of words taken, and ``n_chars``, where present, counts it. Rows of
    which nothing is taken go; repeated rows (equal id, text and source) are one
    row; all other columns pass through, whatever their names.
    """
    p = helper_prefix(docs.columns)
    plan = plan_mix(docs, **settings).filter("taken > 0").select(
        F.coalesce("doc_id", F.lit(0)).alias(f"{p}id"),
        F.xxhash64("text_hash", "source").alias(f"{p}same"),
        F.col("passes").alias(f"{p}passes"),
        F.col("spans").alias(f"{p}spans"),
    )
    names = docs.columns
    texts = docs.withColumns(
        {
            f"{p}id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
            f"{p}same": F.xxhash64(F.xxhash64("text"), F.col("source").cast("string")),
        }
    ).dropDuplicates([f"{p}id", f"{p}same"])
    joined = texts.join(plan, [f"{p}id", f"{p}same"]).select(*names, f"{p}passes", f"{p}spans")

    def cut(batches):
        for batch in batches:
            for rows in row_slices(batch, "text"):
                places, out = [], []
                for place, (text, passes, spans) in enumerate(
                    zip(
                        rows.column("text").to_pylist(),
                        rows.column(f"{p}passes").to_pylist(),
                        rows.column(f"{p}spans").to_pylist(),
                        strict=True,
                    )
                ):
                    found = [text] * passes
                    if spans:
                        found.append(cut_words(text, [(s["start"], s["stop"]) for s in spans]))
                    places += [place] * len(found)
                    out += found
                some = rows.take(pa.array(places, pa.int64()))
                new = {
                    "text": pa.array(out, pa.string()),
                    "n_chars": pa.array([len(t) for t in out], pa.int64()),
                }
                yield pa.record_batch(
                    [
                        new[name].cast(some.column(name).type) if name in new else some.column(name)
                        for name in names
                    ],
                    names=names,
                )

    return joined.mapInArrow(cut, docs.schema)


_SPACES = bytes(32 if b == 32 or 9 <= b <= 13 else 0 for b in range(256))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of the spans as they stand in the text, a line for each span."""
    data = text.encode()
    inside = np.frombuffer(data.translate(_SPACES), np.uint8) == 0
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if spans == [(0, len(starts))]:
        return text
    return "\n".join(data[starts[a] : ends[b - 1]].decode() for a, b in spans)


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row."""
    return plan_mix(docs, **settings).select("doc_id", "size", "source_size", "target", "taken")
