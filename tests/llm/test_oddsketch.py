"""MinHash near-dedup with odd sketches against brute force."""

import random

import numpy as np
import pytest

from forecourt.llm import crowds, oddsketch, shingles
from tests.llm.conftest import AWKWARD
from tests.llm.test_shingles import edited, variants
from tests.llm.test_simhash import components


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def slow_rows(rows):
    sets = [slow_set(text) for _, text, *_ in rows]
    roots = components(sets, lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b))
    ids = {}
    for row, root in zip(rows, roots, strict=True):
        if row[0] is not None:
            ids[root] = min(ids.get(root, row[0]), row[0])
    out = []
    for row, found, root in zip(rows, sets, roots, strict=True):
        component = ids.get(root) if found else row[0]
        out.append((row[0], len(found), component, row[0] is not None and row[0] == component))
    return sorted(out, key=repr)


def found(df, **settings):
    result = oddsketch.near_copies(df, **settings)
    assert result.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, result.collect()), key=repr)


@pytest.mark.parametrize("crowded", [32, 3])
def test_against_brute_force(spark, docs_of, crowded):
    rng = random.Random(crowded)
    rows = list(AWKWARD)
    for size in (3, 6, 12, 60, 150):
        for _ in range(4):
            words = [f"w{rng.randrange(40 if size < 20 else 3000)}" for _ in range(size)]
            rows += [(100 + len(rows), edited(rng, words, rng.randint(0, max(1, size // 15)))) for _ in range(9)]
            rows.append((100 + len(rows), " ".join(words).upper()))
    rng.shuffle(rows)
    wanted = slow_rows(rows)
    assert len({r[2] for r in wanted}) < len(wanted) - 20
    assert found(docs_of(rows), crowded=crowded) == wanted


def test_a_crowd_of_variants_is_one_component(spark, docs_of):
    texts = variants(random.Random(5), 120, 700)
    rows = list(enumerate(texts, 10))
    got = found(docs_of([*rows, *rows, (5, texts[0])]))
    assert {r[2] for r in got} == {5} and sum(r[3] for r in got) == 1


def test_empty_table(spark, docs_of):
    assert found(docs_of([]).limit(0)) == []
    assert found(docs_of([(2, None), (1, " ")])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    limit = oddsketch.most_differing(80)
    assert 0.45 < oddsketch.estimate(limit) < 0.6
    for shared in (0.8, 0.9, 0.98):
        errors = []
        for _ in range(60):
            hashes = rng.integers(0, 2**64, 2000, np.uint64)
            apart = round(2000 * (1 - shared) / 2)
            one, other = hashes[apart:], hashes[: 2000 - apart]
            a, b = (oddsketch.odd_sketch(shingles.minimum_hashes(h)) for h in (one, other))
            differing = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
            assert differing <= limit
            errors.append(oddsketch.estimate(differing) - (2000 - 2 * apart) / 2000)
        assert abs(np.mean(errors)) < 0.03


def test_parity_bitmaps_never_refuse_a_similar_pair():
    rng = np.random.default_rng(2)
    for size in (1, 5, 150, 4000):
        hashes = rng.integers(0, 2**64, size + size // 9, np.uint64)
        one, other = hashes[:size], hashes[size // 9 :]
        a, b = map(crowds.parity_bitmap, (one, other))
        differing = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
        assert differing * 180 <= (len(one) + len(other)) * 20
