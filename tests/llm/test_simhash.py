"""Operator 2: SimHash near-dedup against brute force."""

import random

import pytest
import xxhash

from forecourt.llm import simhash
from forecourt.llm.components import component_roots
from tests.llm.conftest import AWKWARD


def slow_fingerprint(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    shingles = [" ".join(words[i : i + 3]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, near):
    """The least index that each index reaches."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints_of_awkward_texts():
    for row in AWKWARD:
        assert simhash.fingerprint(row[1]) == slow_fingerprint(row[1])


@pytest.mark.parametrize("crowded", [1, 3, 64])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_close_values_join_the_same_components(spark, crowded, distance):
    rng = random.Random(distance)
    values = {0, -1}
    for _ in range(6):
        value = rng.getrandbits(64)
        for _ in range(12):
            value ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3)))
            value &= (1 << 64) - 1
            values.add(value - (1 << 64) if value >> 63 else value)
    values = sorted(values)
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    n_blocks = 4 if distance < 3 else 8
    found = simhash.close_pairs(prints, distance, n_blocks, crowded).collect()
    for a, b in found:
        assert (a ^ b).bit_count() <= distance or (a ^ b) & (1 << 64) - 1
    index = {v: i for i, v in enumerate(values)}
    linked = {(index[a], index[b]) for a, b in found}
    mask = (1 << 64) - 1
    wanted = components(values, lambda a, b: ((a ^ b) & mask).bit_count() <= distance)
    got = components(
        range(len(values)), lambda a, b: (a, b) in linked or (b, a) in linked
    )
    assert got == wanted


def test_near_copies_of_awkward_rows(docs_of):
    found = simhash.near_copies(docs_of(AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    by_print = {}
    for row in found:
        by_print.setdefault(row["fingerprint"], set()).add(row["component_id"])
    assert all(len(ids) == 1 for ids in by_print.values())
    assert by_print["0" * 16] == {1}
    assert {r["component_id"] for r in found if r["doc_id"] == 5} == {5}


def test_one_row_of_each_component_stays(docs_of):
    docs = docs_of(AWKWARD)
    kept = simhash.one_per_component(docs).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 4, 5, 6, 7, 8]
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["no id at all"]
    assert kept[0].asDict().keys() == dict.fromkeys(docs.columns).keys()


def test_no_rows(docs_of):
    assert simhash.near_copies(docs_of([])).collect() == []
    assert simhash.one_per_component(docs_of([])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    links += [(7, 7), (3, 2), (3, 2), (200, None)]
    found = component_roots(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert roots == dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100)
