"""Benchmark decontamination with a generalised suffix automaton of test items (operator 9)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import (
    cut_lineage,
    helper_prefix,
    list_files,
    open_input,
    row_slices,
    scratch_path,
)

WINDOW = 10
SHARD_WORDS = 1_000_000

# Bytes that belong to words: digits, ASCII letters (lowered) and everything beyond ASCII.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters, as UTF-8."""
    return (text or "").encode().translate(_TO_WORDS).split()


class SuffixAutomaton:
    """All runs of words of all items, each in one state; built word by word.

    ``longest[s]`` is the length of the longest run of state s, ``link[s]`` the
    state of its longest suffix that ends elsewhere too. Items are separated by
    starting again at the root, so no run reaches across two items.
    """

    def __init__(self, items: Iterable[tuple[str, Sequence[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.vocabulary: dict[bytes, int] = {}
        self.item_ids: list[str] = []
        coded: list[list[int]] = []
        for item_id, words in items:
            if not words:
                continue
            self.item_ids.append(item_id)
            coded.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            last = 0
            for word in coded[-1]:
                last = self._extend(last, word)
        self._mark_windows(coded)

    def _new(self, longest: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state of its own for the runs of ``target`` that extend those of ``state``."""
        copy = self._new(self.longest[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # the run is known from an earlier item
            if self.longest[target] == self.longest[last] + 1:
                return target
            return self._split(last, word, target)
        new = self._new(self.longest[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            if self.longest[target] == self.longest[state] + 1:
                self.link[new] = target
            else:
                self.link[new] = self._split(state, word, target)
        return new

    def _mark_windows(self, coded: list[list[int]]) -> None:
        """At the state of each window: the window's words and the items that have it.

        A window of ``window`` words ends in one state, as does a whole item of
        fewer words; ``ending[s]`` lists (words, items) of windows whose state is
        s or one of its suffix links, longest first.
        """
        own: dict[int, dict[int, set[int]]] = {}
        for item, words in enumerate(coded):
            size = min(self.window, len(words))
            state, held = 0, 0
            for place, word in enumerate(words):
                state, held = self.next[state][word], held + 1
                while self.longest[self.link[state]] >= size:
                    state = self.link[state]
                held = min(held, self.longest[state])
                if place + 1 >= size:
                    own.setdefault(state, {}).setdefault(size, set()).add(item)
        self.shortest = min(map(len, coded), default=0)
        self.shortest = min(self.shortest, self.window)
        self.ending: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        for state in range(len(self.link)):
            found, at = [], state
            while at > 0:
                for size in sorted(own.get(at, ()), reverse=True):
                    found.append((size, tuple(sorted(own[at][size]))))
                at = self.link[at]
            if found:
                self.ending[state] = found

    def matches(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The hit spans (start, end) of a text in order, and the items with a window in it."""
        if not self.vocabulary or len(words) < self.shortest:
            return [], set()
        known = self.vocabulary.get
        codes = np.fromiter((known(w, -1) for w in words), np.int64, len(words))
        edges = np.diff(np.concatenate(([0], (codes >= 0).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long_enough = ends - starts >= self.shortest
        spans: list[list[int]] = []
        items: set[int] = set()
        for start, end in zip(
            starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True
        ):
            self._walk(codes[start:end].tolist(), start, spans, items)
        return [(a, b) for a, b in spans], items

    def _walk(self, codes: list[int], place: int, spans: list[list[int]], items: set[int]) -> None:
        follow, link, longest, ending = self.next, self.link, self.longest, self.ending
        state, held = 0, 0
        for place, word in enumerate(codes, place + 1):
            to = follow[state].get(word)
            if to is None:
                while to is None and state > 0:
                    state = link[state]
                    to = follow[state].get(word)
                if to is None:
                    state, held = 0, 0
                    continue
                held = longest[state]
            state, held = to, held + 1
            windows = ending.get(state)
            if windows is None:
                continue
            widest = 0
            for size, having in windows:
                if size <= held:
                    widest = max(widest, size)
                    items.update(having)
            if widest:
                first = place - widest
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = place
                else:
                    spans.append([first, place])


def _join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return [tuple(span) for span in joined]


_SPANS = "array<struct<start: int, stop: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_automata: dict[tuple[str, int], SuffixAutomaton] = {}


def _automaton(folder: str, window: int) -> SuffixAutomaton:
    """Of one shard's files; a worker process keeps the last one it built, and no other."""
    key = (folder, window)
    if key not in _automata:
        _automata.clear()
        _automata[key] = SuffixAutomaton(
            (
                (item_id, words_of(text))
                for path in list_files(folder)
                for item_id, text in _stored_items(path)
            ),
            window,
        )
    return _automata[key]


def _stored_items(path: str) -> Iterator[tuple[str, str]]:
    with open_input(path) as file:
        for batch in pq.ParquetFile(file).iter_batches(batch_size=1000):
            yield from zip(*(batch.column(c).to_pylist() for c in ("id", "text")), strict=True)


def write_shards(benchmark: DataFrame, shard_words: int) -> list[str]:
    """Write the items to a folder per shard of about so many words; the folders.

    Items are dealt by a hash, each whole, so one item may be larger than a shard is
    meant to be. Only two totals reach the driver.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text")
    ).filter("id is not null and text is not null")
    n_items, words = items.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.regexp_count("text", F.lit(_WORD))), F.lit(0))
    ).first()
    shards = max(1, min(n_items, -(-words // shard_words)))
    root = scratch_path(benchmark.sparkSession, "benchmark-shards")
    shard = F.pmod(F.xxhash64("id", "text"), F.lit(shards))
    items.withColumn("shard", shard).repartition("shard").write.partitionBy("shard").parquet(root)
    return [f"{root}/shard={i}" for i in range(shards)]


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with the spans of benchmark windows in each text, in new last columns.

    The names start with ``helper_prefix``, ``__`` unless a column has that.
    ``__words``: the text's words; ``__spans``: disjoint spans of word places
    inside any occurrence of a window, in order; ``__items``: sorted ids of the
    items that have such a window. A window is ``window`` words in a row of an
    item, or a whole item of fewer words. Null and empty texts and items have no
    words; items without an id are left out; repeated items and rows are
    separate rows with equal results. Columns of ``docs`` pass through.

    Each worker builds the automaton of the items once, from files in the shared
    folder, and streams the documents through it: no shuffle, no join. Benchmarks of
    more than ``shard_words`` words are cut into shards, one pass over the documents
    each. Between passes the rows are written to the shared folder, so a worker holds
    one automaton at a time and memory does not grow with the benchmark.
    """
    names, p = docs.columns, helper_prefix(docs.columns)
    out = docs.withColumns(
        {
            f"{p}words": F.lit(0).cast("int"),
            f"{p}spans": F.array().cast(_SPANS),
            f"{p}items": F.array().cast("array<string>"),
        }
    )
    schema = out.schema
    for number, folder in enumerate(write_shards(benchmark, shard_words)):
        if number:
            out = cut_lineage(out)

        def scan(batches, folder=folder):
            automaton = _automaton(folder, window)
            ids = automaton.item_ids
            for batch in batches:
                for rows in row_slices(batch, "text"):
                    counts, all_spans, all_items = [], [], []
                    texts = rows.column("text").to_pylist()
                    before = rows.column(f"{p}spans").to_pylist()
                    had = rows.column(f"{p}items").to_pylist()
                    for text, spans_before, items_before in zip(texts, before, had, strict=True):
                        words = words_of(text)
                        spans, items = automaton.matches(words)
                        found = {ids[i] for i in items}
                        if spans_before:
                            spans = _join_spans(
                                spans + [(s["start"], s["stop"]) for s in spans_before]
                            )
                        counts.append(len(words))
                        all_spans.append([{"start": a, "stop": b} for a, b in spans])
                        all_items.append(sorted(found.union(items_before)))
                    kept = [rows.column(name) for name in names]
                    yield pa.record_batch(
                        [
                            *kept,
                            pa.array(counts, pa.int32()),
                            pa.array(all_spans, _SPAN_TYPE),
                            pa.array(all_items, pa.list_(pa.string())),
                        ],
                        names=[*names, f"{p}words", f"{p}spans", f"{p}items"],
                    )

        out = out.mapInArrow(scan, schema)
    return out


def overlap_report(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    hit = F.aggregate(
        "__spans", F.lit(0).cast("bigint"), lambda total, s: total + s["stop"] - s["start"]
    )
    return find_overlaps(rows, benchmark, **settings).select(
        "doc_id",
        F.col("__words").cast("bigint").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    min_span: int = 1,
    max_coverage: float = 0.0,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without overlaps: rows beyond the coverage limit go, spans are cut from the rest.

    A row goes if more than ``max_coverage`` of its words lie in spans of
    ``min_span`` words or more; 0 drops every row with such a span, 1 none. From
    rows that stay the spans are removed with the text between their words.
    Shorter spans stay; by default there are none, as a whole item of few words
    is a span too. Null texts stay null.
    """
    found, p = find_overlaps(docs, benchmark, window, shard_words), helper_prefix(docs.columns)
    spans = F.filter(f"{p}spans", lambda s: s["stop"] - s["start"] >= min_span)
    found = found.withColumn(f"{p}spans", spans)
    hit = F.aggregate(f"{p}spans", F.lit(0), lambda total, s: total + s["stop"] - s["start"])
    names = docs.columns
    found = found.filter(hit <= F.lit(max_coverage) * F.col(f"{p}words"))

    def cut(batches):
        for batch in batches:
            for rows in row_slices(batch, "text"):
                texts = [
                    text if not spans else cut_spans(text, [(s["start"], s["stop"]) for s in spans])
                    for text, spans in zip(
                        rows.column("text").to_pylist(),
                        rows.column(f"{p}spans").to_pylist(),
                        strict=True,
                    )
                ]
                yield pa.record_batch(
                    [
                        pa.array(texts, pa.string()) if name == "text" else rows.column(name)
                        for name in names
                    ],
                    names=names,
                )

    if max_coverage <= 0:
        return found.select(*names)
    return found.mapInArrow(cut, docs.schema)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode()
    mapped = np.frombuffer(data.translate(_TO_WORDS), np.uint8) != 32
    edges = np.diff(np.concatenate(([0], mapped.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()
    out, at = [], 0
    for first, last in spans:
        out.append(data[at : starts[first]])
        at = ends[last - 1]
    return b"".join([*out, data[at:]]).decode()
