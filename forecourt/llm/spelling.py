"""Spelling variants: words one edit apart, found by a bidirectional FM-index (operator 12)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage

LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5
DAMAGE_EVERY = 199
SHARD_CHARS = 100_000
DELIMITER = "\0"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(docs: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """``word``: a row for every run of Latin letters, one in ``DAMAGE_EVERY`` without one letter.

    Which run loses which letter follows from the crc32 of ``<doc_id>:<run>``; a
    null id is written as nothing. Null texts have no words, and runs that are
    too short from the start are left out at once.
    """
    text = F.translate("text", UPPER, LOWER)
    runs = F.regexp_extract_all(text, F.lit("[A-Za-zÀ-ÿ]{%d,}" % least_letters), F.lit(0))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    rows = docs.filter(F.col("text").isNotNull()).select(name.alias("name"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("name", "run").cast("binary"))
    rows = rows.select("run", h.alias("h"), (h % F.length("run")).cast("int").alias("at"))
    run, at = F.col("run"), F.col("at")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return rows.select(F.when(F.col("h") % DAMAGE_EVERY == 0, without).otherwise(run).alias("word"))


def vocabulary(words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the distinct words that are long and frequent enough."""
    counted = words.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


class BidirectionalIndex:
    """FM-index of a delimited list of words that extends a match at either end.

    A match is the interval of rotations that start with it, in the rotated text
    and in the rotated reversed text: ``lo, back_lo, size``, arrays of many
    matches. ``below[c, i]`` counts the symbols less than c among the first i
    of the transformed text, which gives both the new interval in one order and
    the offset in the other. Memory is 8 bytes for each letter of the words and of
    the alphabet.
    """

    def __init__(self, words: list[str]):
        letters = _code_points(DELIMITER + DELIMITER.join(words))
        self.alphabet, text = np.unique(letters, return_inverse=True)
        self.size = len(text)
        self.order = _rotations(text)
        self.word_at = np.cumsum(text == 0) - 1
        self.below = self._below(text, self.order)
        self.back_below = self._below(text[::-1], _rotations(text[::-1]))
        self.first = self.below[:, -1].astype(np.int64)

    def _below(self, text: np.ndarray, order: np.ndarray) -> np.ndarray:
        last = text[order - 1]
        found = np.zeros((len(self.alphabet) + 1, len(text) + 1), np.int32)
        found[last + 1, np.arange(1, len(text) + 1)] = 1
        np.cumsum(found, axis=1, out=found)
        return np.cumsum(found, axis=0, out=found)

    def symbols(self, letters: np.ndarray) -> np.ndarray:
        """Ranks of code points in the alphabet, -1 for those that no word has."""
        place = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == letters, place, -1)

    def _extend(self, below, symbol, lo, back_lo, size):
        at_lo, at_hi = below[symbol, lo], below[symbol, lo + size]
        occ_lo, occ_hi = below[symbol + 1, lo] - at_lo, below[symbol + 1, lo + size] - at_hi
        return self.first[symbol] + occ_lo, back_lo + (at_hi - at_lo), occ_hi - occ_lo

    def extend_left(self, symbol, lo, back_lo, size):
        return self._extend(self.below, symbol, lo, back_lo, size)

    def extend_right(self, symbol, lo, back_lo, size):
        back_lo, lo, size = self._extend(self.back_below, symbol, back_lo, lo, size)
        return lo, back_lo, size

    def followers(self, back_lo, size) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of matches, and letters (not the delimiter) that follow them somewhere."""
        seen = np.diff(self.back_below[:, back_lo + size] - self.back_below[:, back_lo], axis=0)
        symbol, match = np.nonzero(seen[1:])
        return match, symbol + 1

    def words_at(self, lo) -> np.ndarray:
        """Numbers of the words whose leading delimiter the matches of size one start with."""
        return self.word_at[self.order[lo]]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the sorted rotations of a text, by doubling the compared length."""
    rank, n, step = text.astype(np.int64), len(text), 1
    while step < n:
        rank = np.unique(rank * (n + 1) + np.roll(rank, -step), return_inverse=True)[1].astype(np.int64)
        if rank.max() == n - 1:
            break
        step *= 2
    return np.argsort(rank, kind="stable")


def one_edit_apart(items: list[str], queries: list[str], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query number, item number) of words exactly one edit apart that share the query's start.

    Search scheme: the first ``halves[q]`` letters of a query are matched exactly, from
    their end to the delimiter in front of them; the match is then extended to
    the right letter by letter, allowing one replaced, additional or missing
    letter, up to the delimiter behind the word. All queries advance together.
    """
    index = BidirectionalIndex(items)
    lengths = np.array([len(q) for q in queries])
    offset = np.cumsum(lengths) - lengths
    letters = index.symbols(_code_points("".join(queries)))
    q = np.arange(len(queries))
    half = np.array(halves)
    lo, back_lo = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
    size = np.full(len(q), index.size, np.int64)
    for step in range(half.max() + 1):
        go = np.flatnonzero(step <= half[q])
        at = half[q[go]] - step - 1
        symbol = np.where(at >= 0, letters[offset[q[go]] + np.maximum(at, 0)], 0)
        lo[go], back_lo[go], size[go] = index.extend_left(symbol, lo[go], back_lo[go], size[go])
        size[go[symbol < 0]] = 0
        held = size > 0
        q, lo, back_lo, size = q[held], lo[held], back_lo[held], size[held]
    clean = (q, half[q], lo, back_lo, size)
    edited = tuple(part[:0] for part in clean)
    found = []
    while len(clean[0]) or len(edited[0]):
        again = []
        q, at, lo, back_lo, size = edited
        if len(q):
            ended = at == lengths[q]
            symbol = np.where(ended, 0, letters[np.minimum(offset[q] + at, len(letters) - 1)])
            lo, back_lo, size = index.extend_right(symbol, lo, back_lo, size)
            size = np.where(symbol < 0, 0, size)
            hit = ended & (size > 0)
            found.append((q[hit], index.words_at(lo[hit])))
            on = ~ended & (size > 0)
            again.append((q[on], at[on] + 1, lo[on], back_lo[on], size[on]))
        q, at, lo, back_lo, size = clean
        inside = at < lengths[q]
        again.append((q[inside], at[inside] + 1, lo[inside], back_lo[inside], size[inside]))
        match, symbol = index.followers(back_lo, size)
        lo, back_lo, size = index.extend_right(symbol, lo[match], back_lo[match], size[match])
        q, at, inside = q[match], at[match], inside[match]
        again.append((q, at, lo, back_lo, size))
        same = inside & (letters[np.minimum(offset[q] + at, len(letters) - 1)] == symbol)
        for chosen, where in ((inside & ~same, again), (same, None)):
            step = (q[chosen], at[chosen] + 1, lo[chosen], back_lo[chosen], size[chosen])
            if where is None:
                clean = step
            else:
                where.append(step)
        edited = tuple(np.concatenate(parts) for parts in zip(*again, strict=True))
    pairs = np.unique(np.concatenate([np.stack(f) for f in found], axis=1), axis=1) if found else np.zeros((2, 0), int)
    return pairs[0], pairs[1]


def _half(side: int, length: Column) -> Column:
    """Letters of a query that are matched exactly from its start (0) or from its end (1)."""
    return F.floor((length + side) / 2).cast("int")


def near_words(words: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``word, near, near_n``: all pairs of the distinct ``word, n`` one edit apart, both ways.

    One edit leaves the first or the second half of a word as it is, so a search
    needs only the words that start, or end, with its half: words are dealt to
    index shards by halves (by those of all lengths an edit can give), and every
    query goes to one shard for each of its halves. A shard of more than
    ``shard_chars`` letters is cut, and its searches are made in every part. The
    search from the end is the same one over reversed words.
    """
    length = F.length("word")
    sides = []
    for side in (0, 1):
        sizes = F.array_distinct(F.array(*(_half(side, length + step) for step in (-1, 0, 1))))
        turned = F.col("word") if side == 0 else F.reverse("word")
        rows = words.select(turned.alias("word"), "n", F.explode(sizes).alias("half"))
        sides.append(
            rows.select(
                F.lit(side).alias("side"), "word", "n", "half",
                (F.col("half") == _half(side, length)).alias("asks"),
                F.substring(F.col("word"), F.lit(1), F.col("half")).alias("start"),
            )
        )
    rows = sides[0].unionByName(sides[1])
    total = words.agg(F.sum(length + 1)).first()[0] or 0
    shards = max(1, -(-4 * total // shard_chars))
    rows = cut_lineage(
        rows.withColumn("shard", F.pmod(F.xxhash64("start"), F.lit(shards)) * 2 + F.col("side")).drop("start", "side")
    )
    parts = rows.groupBy("shard").agg(F.ceil(F.sum(length + 1) / (2 * shard_chars)).cast("int").alias("parts"))
    rows = rows.join(parts, "shard").withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    items = rows.select("shard", "word", "n", "half", F.lit(False).alias("asks"), F.explode(every).alias("q_part"), F.col("own").alias("i_part"))
    queries = rows.filter("asks").select("shard", "word", "n", "half", "asks", F.col("own").alias("q_part"), F.explode(every).alias("i_part"))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        held = part[~part["asks"]].drop_duplicates("word")
        asked = part[part["asks"]]
        turned = bool(part["shard"].iloc[0] % 2)
        q, i = (np.zeros(0, int),) * 2
        if len(held) and len(asked):
            q, i = one_edit_apart(held["word"].tolist(), asked["word"].tolist(), asked["half"].tolist())
        found = pd.DataFrame({
            "word": asked["word"].to_numpy(object)[q],
            "near": held["word"].to_numpy(object)[i],
            "near_n": held["n"].to_numpy(np.int64)[i],
        })
        if turned:
            found["word"], found["near"] = found["word"].str[::-1], found["near"].str[::-1]
        return found

    dealt = items.unionByName(queries).groupBy("shard", "q_part", "i_part")
    return dealt.applyInPandas(search, "word string, near string, near_n bigint").distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word that the forms lead to.

    The way followed doubles in every round, so the rounds are the logarithm of
    the longest way; forms must not lead in a circle.
    """
    ways = cut_lineage(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if ways.join(on, "root", "left_semi").isEmpty():
            return ways
        longer = ways.join(on, "root", "left")
        ways = cut_lineage(longer.select("word", F.coalesce("further", "root").alias("root")))


def spelling_variants(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    form_ratio: int = FORM_RATIO,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: a row per frequent word of the texts.

    Two words are near if they differ by exactly one inserted, deleted or replaced
    letter. The ``form`` of a word is its near word of largest count, the first in
    code-point order among equals, if that has ``form_ratio`` times the word's
    count or more; ``root`` follows the forms to the last.

    Null and empty texts have no words; very long words are words like any other
    (an index shard holds at least one whole word); repeated rows count again;
    columns besides ``doc_id`` and ``text`` are ignored; no documents give no rows.
    """
    words = cut_lineage(vocabulary(damaged_words(docs, least_letters), least_letters, least_count))
    found = near_words(words, shard_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    enough = -F.col("best.less") >= F.col("n") * form_ratio
    formed = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = cut_lineage(formed)
    return formed.join(last_forms(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
