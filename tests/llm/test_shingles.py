"""The near-dedup stage of the pipeline against brute force."""

import random

import pytest

from forecourt.llm import shingles
from forecourt.llm.stages import drop_near_copies
from tests.llm.conftest import AWKWARD
from tests.llm.test_simhash import components


def slow_shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def slow_components(texts):
    sets = list(map(slow_shingles, texts))
    return components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))


def edited(rng, words, edits):
    words = list(words)
    for place in rng.sample(range(len(words)), edits):
        words[place] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def planted(copies):
    rng = random.Random(copies)
    texts = []
    for size in (40, 90, 200):
        for _ in range(4):
            words = [f"w{rng.randrange(5000)}" for _ in range(size)]
            texts.append(" ".join(words))
            for _ in range(copies):
                texts.append(edited(rng, words, rng.randint(1, max(1, size // 40))))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("copies, crowded", [(2, 16), (6, 3), (20, 4)])
def test_near_copies_against_brute_force(spark, docs_of, copies, crowded):
    texts = planted(copies)
    wanted = slow_components(texts)
    found = shingles.near_copies(docs_of(list(enumerate(texts))), crowded=crowded).collect()
    got = {r["doc_id"]: r["component_id"] for r in found}
    assert [got[i] for i in range(len(texts))] == wanted


def variants(rng, size, count):
    """A text and variants of it at 0.8 or more, which are mostly not that near to each other."""
    words = [f"w{rng.randrange(5000)}" for _ in range(size)]
    return [" ".join(words), *(edited(rng, words, 4) for _ in range(count))]


@pytest.mark.parametrize("count", [400, 2000])
def test_a_crowd_of_variants_is_one_component(spark, docs_of, count):
    rng = random.Random(count)
    texts = variants(rng, 204, count)
    base, other = map(slow_shingles, texts[:2])
    assert len(base & other) >= 0.8 * len(base | other)
    alone = ["nothing like the others " * 3]
    found = shingles.near_copies(docs_of(list(enumerate(texts + alone)))).collect()
    assert {r["component_id"] for r in found} == {0, count + 1}


def test_a_crowd_of_several_components(spark, docs_of):
    """Chains and clusters under common keys: every link counts, also far from the hubs."""
    rng = random.Random(3)
    texts = variants(rng, 120, 1)[:1]
    for _ in range(12):  # cousins under 0.8, each with near copies of its own and of those
        cousin = edited(rng, texts[0].split(), 5)
        texts.append(cousin)
        for _ in range(6):
            texts.append(edited(rng, cousin.split(), 2))
            texts.append(edited(rng, texts[-1].split(), 2))
    rng.shuffle(texts)
    wanted = slow_components(texts)
    found = shingles.near_copies(docs_of(list(enumerate(texts))), crowded=3).collect()
    got = {r["doc_id"]: r["component_id"] for r in found}
    assert [got[i] for i in range(len(texts))] == wanted and 1 < len(set(wanted)) < len(texts)


def test_the_stage_drops_planted_near_copies(spark, docs_of):
    texts = planted(2)
    wanted = set(slow_components(texts))
    assert len(wanted) < len(texts)
    kept = drop_near_copies(spark, docs_of(list(enumerate(texts))), "").collect()
    assert {r["doc_id"] for r in kept} == wanted


def test_the_stage_with_awkward_rows(spark, docs_of):
    docs = docs_of(AWKWARD)
    kept = drop_near_copies(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 4, 5, 6, 7, 8]
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["no id at all"]
    assert drop_near_copies(spark, docs.limit(0), "").collect() == []


def test_the_stage_drops_what_simhash_links(spark, docs_of):
    """Fingerprints one bit apart at a similarity of 15 / 19, under the bar for whole sets."""
    words = "w77 w55 w78 w3 w69 w56 w59 w39 w8 w21 w92 w55 w67 w85 w45 w82 w0 w9 w3 w98 w13"
    texts = [words, words.replace("w98", "x6349"), "nothing like the others at all"]
    kept = drop_near_copies(spark, docs_of(list(enumerate(texts))), "").collect()
    assert {r["doc_id"] for r in kept} == {0, 2}
