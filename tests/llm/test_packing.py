from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from conftest import SF001
from helpers import AWKWARD, docs, empty, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from metalake.llm.common import arrow_bytes
from metalake.llm.packing import Encoder, first_fit_decreasing, pack_documents, pack_group
from metalake.llm.queries import op1_packing, tokenizer_file

FILE = tokenizer_file("byte_bpe_50k.json")


def expected_ids(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [(i, e.ids + [1]) for (i, _), e in
            zip(rows, t.encode_batch([x or "" for _, x in rows], add_special_tokens=False))]


def check(pieces, rows, min_share=0.97):
    """Every id lies in one piece, sequences are gapless and well filled."""
    want = expected_ids(rows)
    by_doc = defaultdict(list)
    seqs = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        seqs[p.sequence_id].append(p)
    for doc_id in {i for i, _ in want}:
        whole = [ids for i, ids in want if i == doc_id]
        got = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert sum(p.length for p in got) == sum(map(len, whole))
        for p in got:
            assert any(p.doc_tokens == len(ids) and p.start + p.length <= len(ids) and
                       zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32
                       for ids in whole)
        if len(whole) == 1:
            assert [p.start for p in got] == np.cumsum([0] + [p.length for p in got])[:-1].tolist()
    used = padded = 0
    for s in seqs.values():
        s.sort(key=lambda p: p.offset)
        fill = sum(p.length for p in s)
        assert [p.offset for p in s] == np.cumsum([0] + [p.length for p in s])[:-1].tolist()
        assert 0 < fill <= 2048 and all(p.length > 0 for p in s)
        used += fill
        padded += fill if fill & (fill - 1) == 0 else 2048
    assert used / padded >= min_share


def test_query_packs_whole_table(spark):
    check(op1_packing(spark, SF001).collect(), texts(SF001), 0.99)


def test_awkward_rows(spark):
    check(pack_documents(docs(spark), FILE).collect(), AWKWARD)


def test_empty_table(spark):
    out = pack_documents(empty(spark), FILE)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \t\n'.é1\x1c <|>", max_size=60))
def test_chunked_encoding_is_the_tokenizer(text):
    enc = ENC
    assert np.frombuffer(enc(text), enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


ENC = Encoder(FILE)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "a", " ", "é", "b c", "\n", "中", "  ", "|>"]), max_size=12))
def test_added_tokens_are_matched_as_by_the_file(parts):
    from tokenizers import Tokenizer
    text = "".join(parts)
    want = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENC(text), ENC.dtype).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n'.é1\x1c <|>中\u0301", max_size=40),
                          st.lists(st.sampled_from(["the", "word", "<|endoftext|>", "Ünï", "x" * 80, "中文", "", "\n"]), max_size=9)
                          .map(" ".join)), max_size=12))
def test_batches_are_encoded_like_texts(texts):
    got = ENC.batch(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [ENC.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_batches_hold_so_many_bytes():
    texts = ["a" * n for n in (3, 4, 50, 0, 0, 1)] + [None, "b" * 9]
    parts = list(arrow_bytes(iter([pa.record_batch({"n": range(8), "t": pa.array(texts, pa.string())})]), 1, 10))
    assert [p.column(1).to_pylist() for p in parts] == [texts[:2], texts[2:3], texts[3:8]]


def test_added_token_is_one_id(spark):
    assert np.frombuffer(ENC("a <|endoftext|> b"), ENC.dtype).tolist() == [64, 220, 50256, 275]
    got = pack_documents(docs(spark, [(1, "a <|endoftext|> b")]), FILE).collect()
    assert {r.doc_tokens for r in got} == {5}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing_by_brute_force(sizes):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b in bins:
            if sum(sizes[k] for k in b) + sizes[i] <= 64:
                b.append(i)
                break
        else:
            bins.append([i])
    assert first_fit_decreasing(np.array(sizes, np.int64), 64) == bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 63), max_size=60))
def test_group_is_partitioned(lengths):
    seen = [np.zeros(n, int) for n in lengths]
    for seq in pack_group(np.array(lengths, np.int64), 64, 4):
        assert 0 < sum(n for _, _, n in seq) <= 64
        for item, start, n in seq:
            seen[item][start:start + n] += 1
    assert all((s == 1).all() for s in seen)
