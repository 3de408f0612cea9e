"""Operator 3: targets, quotas and what the mix takes."""

import collections
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import mixing, simhash
from tests.llm.conftest import AWKWARD, with_clashes


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 60), st.integers(0, 25)), min_size=1, max_size=6),
    st.integers(0, 60),
)
def test_quotas_are_the_highest_quotients(parties, seats):
    weights, most = [w for w, _ in parties], [m for _, m in parties]
    given_ = mixing.sainte_lague(weights, seats, most)
    quotients = sorted(
        ((-w / (2 * k + 1), i) for i, (w, m) in enumerate(parties) for k in range(m) if w),
    )[:seats]
    wanted = collections.Counter(i for _, i in quotients)
    # Equal quotients of different sources may fall either way at the border.
    worst = quotients[-1][0] if quotients else 0
    for i, w in enumerate(weights):
        if given_[i] != wanted[i]:
            spare = min(given_[i], wanted[i])
            assert w / (2 * spare + 1) == pytest.approx(-worst)
    assert sum(given_) == len(quotients)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8))
def test_targets(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    found = mixing.targets_of(sizes, weights)
    assert sum(found) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s + 1e-6 for t, s in zip(found, sizes, strict=True))
    below = [t / w for t, s, w in zip(found, sizes, weights, strict=True) if t < 3 * s - 1e-6]
    assert max(below, default=0) == pytest.approx(min(below, default=0))


def rows_of(spark, n=400):
    return [
        (i if i % 50 else None, " ".join(f"w{i}x{k}" for k in range(i % 37)), source)
        for i in range(n)
        for source in [("a", "b", "é", None)[min(3, i % 9)]]
    ]


def test_many_sources_have_targets_soon():
    sizes = [(i * 7919) % 1000 for i in range(100_000)]
    weights = [1 + i % 3 for i in range(100_000)]
    start = time.perf_counter()
    found = mixing.targets_of(sizes, weights)
    assert time.perf_counter() - start < 2
    assert sum(found) == pytest.approx(sum(sizes))


def test_large_ids_beside_a_null(spark, docs_of):
    ids = [2**60 + 1, 2**60 + 3, 2**60 + 5, 2**60 + 7, None]
    rows = [(i, f"some words of text {n}", "a") for n, i in enumerate(ids)]
    assert {r["doc_id"] for r in mixing.mix_report(docs_of(rows)).collect()} == set(ids)
    assert {r["doc_id"] for r in mixing.mix(docs_of(rows)).collect()} == set(ids)


def test_clashing_columns_pass_through(spark, docs_of):
    docs = with_clashes(docs_of(rows_of(spark, 60)))
    mixed, kept = mixing.mix(docs), simhash.one_per_component(docs)
    for found in (mixed, kept):
        assert found.columns == docs.columns
        assert {(r["__id"], r["__passes"], r["__key"], r["node"]) for r in found.collect()} == {("own",) * 4}


def test_sources_come_near_their_targets(spark, docs_of):
    rows = rows_of(spark)
    plan = mixing.plan_mix(docs_of(rows), shard_docs=30).collect()
    assert len(plan) == len(rows)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = ["a", "b", "é", None]
    targets = dict(zip(order, mixing.targets_of([sizes[s] for s in order], [1, 2, 3, 1]), strict=True))
    taken = collections.Counter()
    for row in plan:
        assert row["target"] == pytest.approx(targets[row["source"]])
        assert row["source_size"] == sizes[row["source"]]
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source"]] += row["taken"]
    for source in order:
        assert taken[source] == pytest.approx(targets[source], rel=0.02, abs=20)
    again = mixing.mix_report(docs_of(rows[::-1]).repartition(3), shard_docs=30).collect()
    names = ["doc_id", "size", "taken"]
    assert sorted(repr([r[n] for n in names]) for r in plan) == sorted(
        repr([r[n] for n in names]) for r in again
    )


def test_mixed_texts_hold_the_words_taken(spark, docs_of):
    rows = rows_of(spark, 200)
    docs = docs_of(rows)
    plan = {}
    for row in mixing.plan_mix(docs, shard_docs=30).collect():
        plan[row["doc_id"]] = plan.get(row["doc_id"], 0) + row["taken"]
    mixed = mixing.mix(docs, shard_docs=30).collect()
    texts = collections.defaultdict(set)
    for doc_id, text, _ in rows:
        texts[doc_id].update(text.split())
    found = collections.Counter()
    for row in mixed:
        assert set(row["text"].split()) <= texts[row["doc_id"]]
        assert row["n_chars"] == len(row["text"]) and row["size"] == "x"
        found[row["doc_id"]] += len(row["text"].split())
    assert dict(found) == {i: n for i, n in plan.items() if n}


def test_awkward_and_no_rows(docs_of):
    plan = mixing.plan_mix(docs_of(AWKWARD)).collect()
    assert len(plan) == len(AWKWARD)
    assert all(r["taken"] == 0 for r in plan if r["size"] == 0)
    mixing.mix(docs_of(AWKWARD)).collect()
    assert mixing.mix_report(docs_of([])).collect() == []
    assert mixing.mix(docs_of([])).collect() == []
