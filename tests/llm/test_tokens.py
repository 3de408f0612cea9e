"""Operators 4 and 10: token files and length histogram."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from forecourt.llm import lengths, planes
from forecourt.llm.common import scratch_path
from pyspark.sql import functions as F

from forecourt.llm.tokenizing import encoder
from tests.llm.conftest import AWKWARD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ADDED = "<|endoftext|>"
ALPHABET = "ab'sStTredvlm \n\t\r12²½_-.,!éßÀñŸ\"<|endoftext|>漢​\x85\x1c　\xa0"


@settings(max_examples=400, deadline=None)
@given(
    st.lists(
        st.text(alphabet=ALPHABET, max_size=50)
        | st.text(max_size=30)
        | st.lists(st.sampled_from([ADDED, "a", " ", "é", "ab's", "<|", "\n"]), max_size=8).map("".join),
        max_size=5,
    )
)
def test_pieces_encode_like_the_whole_text(plain, texts):
    texts = [t for t in texts if t.encode("utf-8", "ignore").decode() == t]
    for text, ids in zip(texts, encoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text)


def test_added_tokens_are_one_id():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|><|endoftext|> 漢", "<|endoftext>"]
    for text, ids in zip(texts, encoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder(PATH).encode(texts[:1])[0], "<u4").tolist() == [64, 50256, 65]


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(0, 2**32 - 1), max_size=300),
    st.sampled_from(["byte", "bit"]),
)
def test_planes_round_trip(ids, kind):
    block = np.array(ids, "<u4")
    found = planes.to_planes(block, kind)
    assert len(found) == (4 if kind == "byte" else 32)
    if ids:
        assert planes.from_planes(found, len(ids), kind).tolist() == ids


class _Kept(io.BytesIO):
    def close(self):
        pass

    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_has_chunks_and_documents(kind):
    stream, rng = _Kept(), np.random.default_rng(1)
    writer = planes.PlaneWriter(stream, kind, chunk_ids=10)
    documents = [(k if k % 3 else None, rng.integers(0, 60_000, k * 3)) for k in range(9)]
    for doc_id, ids in documents:
        writer.add(doc_id, ids.astype("<u4").tobytes())
    writer.close()
    reader = planes.PlaneReader(stream)
    assert [n for _, n, _ in reader.footer["chunks"]] == [10] * 10 + [8]
    found = [(d, np.concatenate(p or [[]]).tolist()) for d, p in reader.documents()]
    assert found == [(d, i.tolist()) for d, i in documents]


def _expected(rows, plain):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1]))
    start, found = 0, []
    for doc_id, text, *_ in ordered:
        ids = np.array([*plain(text), 2], "<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def _order(row):
    return tuple((v is not None, v or 0) for v in row)


def test_token_files_of_awkward_rows(spark, docs_of, plain):
    found = planes.token_files(spark, docs_of(AWKWARD), PATH).collect()
    assert sorted(map(tuple, found), key=_order) == sorted(_expected(AWKWARD, plain), key=_order)


def test_small_files_are_many(spark, docs_of, plain):
    docs = docs_of(AWKWARD)
    folder = scratch_path(spark, "small")
    manifest = planes.write_planes(docs, PATH, folder, kind="bit", chunk_ids=7, file_ids=20)
    assert manifest.count() >= 4
    read = planes.read_planes(manifest)
    assert read.select(F.spark_partition_id()).distinct().count() >= 4
    found = read.collect()
    assert sorted(map(tuple, found), key=_order) == sorted(_expected(AWKWARD, plain), key=_order)


def test_no_documents_no_files(spark, docs_of):
    assert planes.token_files(spark, docs_of([]), PATH).collect() == []


def test_histogram_against_brute_force(docs_of, plain):
    sums = lengths.suffix_sums(lengths.length_histogram(docs_of(AWKWARD), PATH), bucket=2)
    all_lengths = [len(plain(r[1])) + 1 for r in AWKWARD]
    rows = {r["n_tokens"]: r for r in sums.collect()}
    assert sorted(rows) == sorted(set(all_lengths))
    for n, row in rows.items():
        assert row["n_docs"] == all_lengths.count(n)
        assert row["docs_at_least"] == sum(x >= n for x in all_lengths)
        assert row["tokens_at_least"] == sum(x for x in all_lengths if x >= n)
        assert row["docs_at_most"] == sum(x <= n for x in all_lengths)
        assert row["truncated_tokens"] == sum(min(x, n) for x in all_lengths)
        assert row["cumulative_share"] == row["docs_at_most"] / len(all_lengths)
    for limit, cut, tokens in lengths.at_limits(sums, [1, 3, 9, 10**9]).collect():
        assert tokens == sum(min(x, limit) for x in all_lengths)
        assert cut == sum(x > limit for x in all_lengths)
    half = lengths.quantiles(sums, [0.5]).first()["n_tokens"]
    assert half == sorted(all_lengths)[(len(all_lengths) + 1) // 2 - 1]


def test_empty_histogram(docs_of):
    sums = lengths.suffix_sums(lengths.length_histogram(docs_of([]), PATH))
    assert sums.collect() == []
    assert lengths.at_limits(sums, [5]).first()["truncated_tokens"] == 0
