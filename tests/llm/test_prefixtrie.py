"""The conversation trie against a brute-force version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def slow_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = convs.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        under = [p for p in members if p[: len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = sum(all(q[: len(p)] != p or q == p for q in under) for p in under)
        saved = sum(
            (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p
        )
        ends = ",".join(map(str, sorted(c for c in ids if len(rebuilt[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(path), parent, len(ids), len(children), leaves, saved, digest))
    return sorted(out, key=repr)


def found(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    trie = prefixtrie.conversation_trie(df, **settings)
    assert trie.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return sorted(map(tuple, trie.collect()), key=repr)


def random_rows(seed, convs, turns):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        for t in range(rng.randint(1, turns)):
            turn = rng.choice([None, t, t]) if rng.random() < 0.1 else t
            rows.append((c, turn, rng.choice(["user", None]), rng.choice(["a b", "a b", "", None, "c d e"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("local_weight", [prefixtrie.LOCAL_WEIGHT, 40, 1])
def test_against_brute_force(spark, local_weight):
    rows = random_rows(local_weight, 60, 6) + [(None, 0, "user", "lost"), (-7, 0, "user", "a b")]
    assert found(spark, rows, local_weight=local_weight) == slow_trie(rows)


def test_long_hot_conversation_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK_ROWS", 16)
    monkeypatch.setattr(prefixtrie, "LIST_IDS", 4)
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(41, 5, "user", "same")] * 30
    rows += [(c, t, "user", f"x{t}") for c in range(60, 95) for t in range(2)]
    assert found(spark, rows, local_weight=60) == slow_trie(rows)


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 12)]
    assert found(spark, rows) == slow_trie(rows)
    assert found(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(-5, 5), st.integers(1, 4)), min_size=1, max_size=60))
def test_forest_totals(rows):
    n = len(rows)
    parent = np.array([p % (i + 1) - 1 for i, (p, _, _) in enumerate(rows)])
    values, weight = np.array([[v, 1] for _, v, _ in rows]), np.array([w for *_, w in rows])
    sums, heavy = values.copy(), weight.copy()
    for i in reversed(range(n)):
        if parent[i] >= 0:
            sums[parent[i]] += sums[i]
            heavy[parent[i]] += heavy[i]
    assert (prefixtrie.forest_totals(parent, heavy, values) == sums).all()
