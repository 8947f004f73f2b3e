from __future__ import annotations

import numpy as np
import sentencepiece
from conftest import SF001
from helpers import AWKWARD, LONG, docs, empty, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from metalake.llm.queries import op6_sentencepiece, tokenizer_file
from metalake.llm.subword import _PLACE, _STRETCH, SPACE, Codec, _mixed, decode_documents, encode_documents, round_trip

FILE = tokenizer_file("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)
PLAIN, DROPPED = Codec(FILE, dropout=0.0), Codec(FILE, dropout=0.3, seed=4)
ROOMS: dict = {}
ANY = st.text(alphabet="ab theringo \n\té😀\x00<s>/▁0x", max_size=80)


@settings(max_examples=150, deadline=None)
@given(ANY)
def test_without_dropout_it_is_the_library(text):
    text = text.replace(SPACE, "")
    assert PLAIN.encode(text).tolist() == LIBRARY.encode(text)


@settings(max_examples=150, deadline=None)
@given(ANY, st.integers(0, 5))
def test_decodes_to_itself(text, key):
    assert PLAIN.decode(PLAIN.encode(text)) == text
    assert DROPPED.decode(DROPPED.encode(text, key)) == text


@settings(max_examples=150, deadline=None)
@given(ANY, st.integers(0, 3))
def test_list_and_heap_agendas_merge_alike(text, key):
    symbols = [SPACE if c == " " else None if c == SPACE else c for c in text]
    for codec in (PLAIN, DROPPED):
        assert codec._short(list(symbols), key) == codec._long(list(symbols), key)


def test_every_piece_of_a_segmentation_is_reachable_by_merges():
    ids = DROPPED.encode("the internationalisation of the internationalisation", 1)
    names = {i: p for p, i in DROPPED.pieces.items()}
    assert all(i in names or DROPPED.raw[i] for i in ids.tolist())
    assert len(ids) > len(LIBRARY.encode("the internationalisation of the internationalisation"))


def test_segmentations_vary_and_repeat():
    text = "international understanding " * 20
    some = {tuple(DROPPED.encode(text, key).tolist()) for key in range(20)}
    assert len(some) > 10
    again = Codec(FILE, dropout=0.3, seed=4, room=3)
    assert all((again.encode(text, k) == DROPPED.encode(text, k)).all() for k in range(20))
    assert (Codec(FILE, dropout=0.3, seed=5).encode(text).tolist()) != DROPPED.encode(text).tolist()


def test_share_of_skipped_merges():
    """A word whose only merge is its last one is split at the dropout rate."""
    words = [w for w, i in DROPPED.pieces.items() if len(w) == 2 and w.isascii() and w.isalpha()]
    split = np.mean([len(DROPPED.merge(w, v)) == 2 for w in words for v in range(4)])
    assert abs(split - 0.3) < 0.05


def test_two_candidates_of_one_word_are_skipped_independently():
    codec, rnd = Codec(FILE, dropout=0.1), np.random.default_rng(3)
    keys = [int(k) for k in rnd.integers(0, 1 << 64, 2000, dtype=np.uint64)]
    for a, b in [((0, 300), (1, 300)), ((0, 300), (2, 4000)), ((5, 900), (6, 901)), ((3, 20_000), (9_000, 20_000)),
                 ((9_000, 700), (9_001, 700)), ((4_000, 700), (4_000 + 4096, 700))]:
        one, two = (np.array([codec._skips(k, *c) for k in keys]) for c in (a, b))
        assert abs(one.mean() - 0.1) < 0.03 and abs(two.mean() - 0.1) < 0.03
        assert 0.003 < (one & two).mean() < 0.02


def test_segmentations_of_a_word_grow_with_its_occurrences():
    """Each occurrence draws its own skips, whatever is remembered."""
    codec = Codec(FILE, dropout=0.3, seed=4)
    drawn = [codec.encode("internationalisation", key).tobytes() for key in range(2000)]
    assert len(set(drawn[:200])) > 20 and len(set(drawn)) > 2 * len(set(drawn[:200]))


@settings(max_examples=150, deadline=None)
@given(ANY, st.integers(0, 5))
def test_remembered_merges_are_the_direct_ones(text, key):
    stretches = _STRETCH.findall(" " + text) if text else []
    keys = _mixed(np.arange(len(stretches), dtype=np.uint64) * np.uint64(_PLACE) ^ np.uint64(key))
    direct = [i for s, k in zip(stretches, keys.tolist()) for i in DROPPED.merge(s, k)]
    assert DROPPED.encode(text, key).tolist() == direct


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(ANY, st.text(alphabet="the rnig▁q", max_size=200)), st.integers(0, 2)), max_size=4),
       st.sampled_from([7, 60, 1 << 18]))
def test_texts_merged_side_by_side_are_the_direct_ones(rows, room):
    codec = ROOMS.setdefault(room, Codec(FILE, dropout=0.3, seed=4, room=room))
    for (text, key), ids in zip(rows, codec.encode_all([t for t, _ in rows], [k for _, k in rows]), strict=True):
        stretches = _STRETCH.findall(" " + text) if text else []
        keys = _mixed(np.arange(len(stretches), dtype=np.uint64) * np.uint64(_PLACE) ^ np.uint64(key))
        assert ids.tolist() == [i for s, k in zip(stretches, keys.tolist()) for i in codec.merge(s, k)]


def test_no_word_is_merged_by_itself(monkeypatch):
    """Outcomes not met before cost no agenda of their own in Python."""
    words = " ".join(f"{a}{b}ing" for a in PLAIN.pieces if a.isalpha() for b in "xyz")[:200_000]
    want = DROPPED.encode(words, 9).tolist()
    assert len(want) > len(PLAIN.encode(words))
    codec = Codec(FILE, dropout=0.3, seed=4)
    monkeypatch.setattr(codec, "_short", None)
    assert codec.encode(words, 9).tolist() == want
    assert codec.decode(codec.encode(words, 9)) == words


def test_query_is_lossless_on_the_whole_table(spark):
    got = {r.doc_id: r for r in op6_sentencepiece(spark, SF001).collect()}
    for i, t in texts(SF001):
        assert got[i].lossless and got[i].n_bytes == len((t or "").encode())
        assert got[i].n_ids >= len(LIBRARY.encode(t or ""))


def test_awkward_rows(spark):
    got = round_trip(docs(spark), FILE).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in AWKWARD)
    assert all(r.lossless for r in got)
    back = decode_documents(encode_documents(docs(spark), FILE), FILE).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in AWKWARD), key=str)
    assert LONG in {r.text for r in back}
    assert round_trip(empty(spark), FILE).count() == 0
    assert encode_documents(empty(spark), FILE).count() == 0


def test_ids_outside_the_model(spark):
    codec = Codec(FILE)
    word = codec.encode("abc").tolist()
    rows = [(1, [*word, 10 ** 6]), (2, [None, *word]), (3, [-1]), (4, []), (5, None), (None, word)]
    got = decode_documents(spark.createDataFrame(rows, "doc_id long, ids array<int>"), FILE).collect()
    assert {r.doc_id: r.text for r in got} == {1: "abc\ufffd", 2: "\ufffd abc", 3: "\ufffd", 4: "", 5: None, None: "abc"}
