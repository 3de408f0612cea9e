"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import spelling
from tests.llm.conftest import AWKWARD

LETTERS = "abß÷ÿ"


def edits(word, alphabet):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in alphabet}
    return (found | {a + c + b for a, b in cut for c in alphabet}) - {word}


def slow_variants(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    alphabet = set("".join(counts))
    form, out = {}, {}
    for word, n in counts.items():
        near = sorted((-counts[u], u) for u in edits(word, alphabet) if u in counts)
        if near and -near[0][0] >= 5 * n:
            form[word] = near[0][1]
        out[word] = (n, len(near))
    rows = []
    for word, (n, n_near) in out.items():
        root = word
        while root in form:
            root = form[root]
        target = form.get(word)
        rows.append((word, target, root, n, n_near, counts.get(target)))
    return sorted(rows, key=repr)


def found(df, **kw):
    return sorted(map(tuple, spelling.spelling_variants(df, **kw).collect()), key=repr)


def some_rows(seed):
    rng = random.Random(seed)
    weights = {"Wordwise": 9, "wordwisé": 1, "wordwis": 1, "ÀÉÎÕÜÿ": 1, "long" * 50: 6, "long" * 49 + "lon": 1}
    for _ in range(20):
        word = "".join(rng.choice(LETTERS) for _ in range(rng.randint(6, 8)))
        for weight in (30, 4, 0.5):
            weights[word] = weight
            for other in rng.sample(sorted(edits(word, LETTERS)), 3):
                weights[other] = weight / 8
            word = rng.choice(sorted(edits(word, LETTERS)))
    picked = rng.choices(list(weights), list(weights.values()), k=15_000)
    return [(n, " ".join(picked[n * 30 : n * 30 + 30]).replace("b ", "b1,")) for n in range(500)]


@pytest.mark.parametrize("shard_chars", [spelling.SHARD_CHARS, 300])
def test_against_brute_force(spark, docs_of, shard_chars):
    rows = some_rows(shard_chars) + [(None, "Wordwise " * 3), (3, None), (4, "")]
    wanted = slow_variants(rows)
    assert any(r[1] and r[2] != r[1] for r in wanted) and any(r[4] > 3 for r in wanted)
    assert found(docs_of(rows), shard_chars=shard_chars) == wanted


def test_awkward_rows(spark, docs_of):
    assert found(docs_of(AWKWARD)) == []
    assert found(docs_of(AWKWARD * 5)) == slow_variants(AWKWARD * 5)
    assert found(docs_of([]).limit(0)) == []


words_ = st.lists(st.text(LETTERS, min_size=2, max_size=7), min_size=1, max_size=25, unique=True)


@settings(max_examples=150, deadline=None)
@given(words_, words_, st.integers(1, 2))
def test_index_finds_what_shares_the_start(items, queries, less):
    halves = [max(1, len(q) // less // 2) for q in queries]
    q, i = spelling.one_edit_apart(items, queries, halves)
    wanted = {
        (a, b)
        for a, word in enumerate(queries)
        for b, item in enumerate(items)
        if item[: halves[a]] == word[: halves[a]] and item[halves[a] :] in edits(word[halves[a] :], LETTERS)
    }
    assert set(zip(q.tolist(), i.tolist(), strict=True)) == wanted and len(q) == len(wanted)
