"""Operators 5 and 9, and the pipeline, against brute force."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from forecourt.llm import automaton, linefreq
from forecourt.llm.common import list_files
from tests.llm.conftest import AWKWARD, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def slow_overlap(text, items, window=10):
    words, hit, having = slow_words(text), set(), set()
    for item_id, item in items:
        item_words = slow_words(item)
        size = min(window, len(item_words))
        if not size:
            continue
        runs = {tuple(item_words[i : i + size]) for i in range(len(item_words) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                hit.update(range(i, i + size))
                having.add(item_id)
    return len(words), hit, sorted(having)


LETTER = st.sampled_from("abc")


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(LETTER, max_size=12), max_size=5),
    st.lists(st.lists(LETTER, max_size=40), min_size=1, max_size=3),
    st.integers(1, 5),
)
def test_automaton_finds_every_window(items, texts, window):
    named = [(f"i{k}", " ".join(words)) for k, words in enumerate(items)]
    machine = automaton.SuffixAutomaton(
        ((i, automaton.words_of(t)) for i, t in named), window
    )
    for letters in texts:
        text = " ".join(letters)
        spans, found = machine.matches(automaton.words_of(text))
        _, hit, having = slow_overlap(text, named, window)
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert all(x[1] < y[0] or x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert sorted(machine.item_ids[i] for i in found) == having


LONG = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [
    ("10", LONG),
    ("9", "Größe Ñandú 漢字"),
    ("8", LONG.upper() + "!"),
    ("7", None),
    ("6", ""),
    (None, "one two"),
    ("5", "a b c d e f g"),
    ("5", "a b c d e f g"),
]
TEXTS = [
    *((r[0], r[1]) for r in AWKWARD),
    (20, f"before {LONG}, after"),
    (21, "größe Ñandú 漢字 x größe ñandú 漢字"),
    (22, "eleven twelve one two three four five six seven eight nine"),
    (23, f"{LONG} {LONG}" * 300),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id string, text string, n_hit int")


@pytest.mark.parametrize("shard_words", [1, 1_000_000])
def test_overlap_report(docs_of, benchmark, shard_words):
    found = automaton.overlap_report(docs_of(TEXTS), benchmark, shard_words=shard_words).collect()
    items = [i for i in ITEMS if i[0] is not None]
    wanted = []
    for doc_id, text in TEXTS:
        n_words, hit, having = slow_overlap(text, items)
        digest = hashlib.sha256(",".join(having).encode()).hexdigest()
        wanted.append((doc_id, n_words, len(hit), len(having), digest, bool(hit)))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_items_are_dealt_to_shards_whole(benchmark):
    folders = automaton.write_shards(benchmark, 3)
    stored = [list(map(tuple, _items(f))) for f in folders]
    items = [(i, t) for i, t in ITEMS if i is not None and t is not None]
    assert sorted(sum(stored, [])) == sorted(items)
    assert 1 < len(folders) <= len(items)
    assert len(automaton.write_shards(benchmark, 1_000_000)) == 1
    for folder in folders:  # a worker holds one automaton at a time
        assert automaton._automaton(folder, 10) is automaton._automaton(folder, 10)
        assert len(automaton._automata) == 1


def _items(folder):
    return [row for path in list_files(folder) for row in automaton._stored_items(path)]


def test_decontaminated_texts(docs_of, benchmark):
    docs = docs_of(TEXTS)
    kept = automaton.decontaminate(docs, benchmark).collect()
    assert {r["doc_id"] for r in kept}.isdisjoint({5, 20, 21, 23})
    assert kept[0].asDict().keys() == dict.fromkeys(docs.columns).keys()
    cut = automaton.decontaminate(docs, benchmark, min_span=5, max_coverage=1.0).collect()
    assert len(cut) == len(TEXTS)
    by_id = {r["doc_id"]: r["text"] for r in cut if r["doc_id"]}
    assert by_id[20] == "before , after" and by_id[1] is None
    assert by_id[21] == TEXTS[-3][1]  # three words are shorter than the least span
    assert automaton.decontaminate(docs, benchmark.limit(0)).count() == len(TEXTS)
    assert automaton.overlap_report(docs.limit(0), benchmark).collect() == []


def slow_measures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [li for li in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", li)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p + k for ps in places.values() if len(ps) > 1 for p in ps for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


BOILER = "Subscribe to our letter 2024 and get ten things for free"


def quality_rows():
    rows = [*AWKWARD]
    for i in range(60):
        own = " ".join(f"word{'x' * i}n{chr(97 + k)}" for k in range(12 if i % 2 else 1))
        rows.append((100 + i, f"{own}\n{BOILER.replace('2024', str(2000 + i))}\n", "h"))
    rows += [(200 + i, "the same copy of a long text " * 3 + "\nagain", "h") for i in range(40)]
    rows.append((300, f"x y\n{BOILER} \n" * 2 + "a b c d e a b c d e # $ %", "other"))
    return rows


def test_clashing_columns_pass_through(docs_of, benchmark):
    docs = with_clashes(docs_of(TEXTS))
    for found in (automaton.decontaminate(docs, benchmark, min_span=5, max_coverage=1.0), linefreq.clean(docs)):
        assert found.columns == docs.columns
        assert {(r["__id"], r["lost"], r["__items"], r["size"]) for r in found.collect()} == {("own",) * 4}


def letters(number):
    """A word without digits, as lines are compared with all digits alike."""
    return "".join(chr(97 + int(d)) for d in str(number))


def test_the_limit_of_lines_does_not_grow_with_the_host(docs_of):
    line = "the same notice is on all these pages"
    for host_size in (50, 400, 3000):
        rows = [
            (i, f"{' '.join(f'w{letters(i)}x{letters(k)}' for k in range(20))}\n{line if i < 11 else ''}", "h")
            for i in range(host_size)
        ]
        found = linefreq.judge(docs_of(rows)).filter("removed_words > 0").count()
        assert found == 11
        fewer = [(i, t if i < 10 else t.replace(line, ""), s) for i, t, s in rows]
        assert linefreq.judge(docs_of(fewer)).filter("removed_words > 0").count() == (10 if host_size < 200 else 0)


def test_copies_count_by_their_ids(docs_of):
    copies = [(i, "one two three four five six\nseven eight nine ten eleven", "h") for i in range(11)]
    rows = copies + [(1000 + i, f"{letters(i)} x{letters(i)} " * 8, "h") for i in range(300)]
    found = {r["doc_id"]: r["removed_words"] for r in linefreq.judge(docs_of(rows)).collect()}
    assert all(found[i] == 11 for i in range(11)) and not any(v for k, v in found.items() if k >= 1000)


def test_quality_measures(docs_of):
    rows = quality_rows()
    found = linefreq.judge(docs_of(rows)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted(repr((r["doc_id"], *(r[n] for n in names))) for r in found)
    assert got == sorted(repr((r[0], *slow_measures(r[1]))) for r in rows)
    for row in found:
        failed = row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])
        if row["doc_id"] and 100 <= row["doc_id"] < 160:
            assert row["removed_words"] == 11
            assert row["kept"] == bool(row["doc_id"] % 2)
        elif row["doc_id"] and 200 <= row["doc_id"] < 300:  # forty documents, if equal ones
            assert row["removed_words"] == row["n_words"] and not row["kept"]


def test_cleaned_texts(docs_of):
    docs = docs_of(quality_rows())
    kept = {r["doc_id"]: r["text"] for r in linefreq.clean(docs).collect() if r["doc_id"]}
    assert BOILER.split()[0] not in kept[101] and kept[101].startswith("wordxna")
    assert 100 not in kept and 300 in kept and BOILER in kept[300]
    assert linefreq.clean(docs).columns == docs.columns
    assert linefreq.clean(docs.limit(0)).collect() == []
    assert linefreq.judge(docs.limit(0)).collect() == []


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "source_mixing",
        "token_files",
    ]
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [
        (r["item_id"], r["text"])
        for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    ]
    ids = {r["doc_id"] for r in rows}
    clean = {i for i, t in texts.items() if not slow_overlap(t, [(str(a), b) for a, b in items])[1]}
    assert ids <= clean and len(ids) > 0.6 * len(clean)
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted(r["doc_id"] for r in rows)
    ends = [r["start"] + r["n_tokens"] for r in ordered]
    assert [r["start"] for r in ordered] == [0, *ends[:-1]]
