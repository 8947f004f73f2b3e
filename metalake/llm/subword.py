"""SentencePiece merge encoding with seeded merge-dropout, and lossless decoding.

A text's characters are merged by an agenda (best piece first, ties to the
left). Every candidate merge that reaches the head of the agenda is skipped
with a given probability, decided by a hash keyed with seed, document, number
of the stretch in its text, place and piece: the same key always gives the same
segmentation, on any machine and after any retry. Pieces never run past the end
of a word, so stretches (the spaces before a word, and the word) are encoded on
their own, and every occurrence draws its own skips.

The agendas of many stretches are walked side by side: a column for each, a row
for each character, and in every step the least entry of each column is merged
or skipped. How many go together decides nothing: the ids are the same.

Without dropout the ids are those of the SentencePiece library, except that
the character U+2581 itself, which the library turns into a space, is kept by
its bytes: every text decodes to itself.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_bytes, arrow_rows, prepare

SPACE = "▁"
_MASK = (1 << 64) - 1
# Odd multipliers of 64-bit multiply-shift mixing.
_PLACE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_NEVER = float("inf")
_STRETCH = re.compile(r" *[^ ]+| +")
#: Stretches up to this length are merged side by side, longer ones each by itself.
_WORD = 48
#: Most characters of the stretches that share a table.
_WIDTHS = (3, 5, 7, 9, 12, 16, 24, _WORD)
#: Rows of such a table take so many bits; an entry of the agenda from here on is none.
_ROW_BITS, _NO_ENTRY = 6, 1 << 60
_CUT = re.compile("[^ ](?= )")
#: Text encoded at a time, in bytes.
_BATCH = 1 << 19


def _mixed(x: np.ndarray) -> np.ndarray:
    """The mixing of ``Codec._skips`` for many values."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(_MIX)
    x = (x ^ x >> np.uint64(29)) * np.uint64(_MIX)
    return x ^ x >> np.uint64(32)


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, dropout: float = 0.1, seed: int = 0, room: int = 1 << 18):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, int] = {}
        self.rank: list[float] = []
        self.raw: list[bytes] = []
        self.byte: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            self.rank.append(-model.get_score(i))
            if model.is_byte(i):
                self.byte[int(name[1:-1], 16)] = i
                self.raw.append(bytes([int(name[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.pieces[name] = i
                self.raw.append(name.replace(SPACE, " ").encode())
        self.limit = int(dropout * (1 << 64))
        # keyed hashing: a random number for each piece, mixed with key and place in _skips
        self.of_piece = [xxhash.xxh64_intdigest(f"piece {i}", seed) for i in range(len(self.raw))]
        self.drawn = np.array(self.of_piece, np.uint64)
        self.room = room  # characters whose stretches are merged side by side
        self._tabulate()

    def _tabulate(self) -> None:
        """What the merging of many stretches looks up: the symbol of each
        character, the piece of each two symbols, the order of the pieces."""
        n = len(self.raw)
        symbols = dict(self.pieces)
        for c in sorted(set().union(*self.pieces) - symbols.keys()):
            symbols[c] = n + len(symbols) - len(self.pieces)  # no piece itself, but part of one
        self.none = n + len(symbols)  # any other character: takes part in no merge
        self.symbol = np.full(0x110000, self.none, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        self.symbol[ord(" ")], self.symbol[ord(SPACE)] = self.symbol[ord(SPACE)], self.none
        _, order = np.unique(self.rank, return_inverse=True)
        self.order = np.append(order.astype(np.int64) << _ROW_BITS, _NO_ENTRY)  # the last one is of the piece -1
        pairs = [(symbols[w[:k]] * (self.none + 1) + symbols[w[k:]], i) for w, i in self.pieces.items()
                 for k in range(1, len(w)) if w[:k] in symbols and w[k:] in symbols]
        keys, found = np.array(pairs, np.int64).reshape(-1, 2).T
        self.shift = np.uint64(64 - max(4, (16 * len(keys)).bit_length()))
        self.slot_key = np.full(1 << 64 - int(self.shift), -1, np.int64)
        self.slot_piece = np.full(len(self.slot_key), -1, np.int32)
        at = self._slots(keys)
        while len(keys):  # the next free slot from its own one on; keys that met there go on
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = keys[free]
            here = self.slot_key[at] == keys
            self.slot_piece[at[here]] = found[here]
            keys, found, at = keys[~here], found[~here], (at[~here] + 1) % len(self.slot_key)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(_PLACE) >> self.shift).view(np.int64)

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each two symbols make; -1: none."""
        keys = a.astype(np.int64) * (self.none + 1) + b
        at = self._slots(keys)
        there = self.slot_key[at]
        out = self.slot_piece[at]
        missed = there != keys
        out[missed] = -1
        on = np.flatnonzero(missed & (there >= 0))
        keys, at = keys[on], at[on]
        while len(on):
            at = (at + 1) % len(self.slot_key)
            there = self.slot_key[at]
            here = there == keys
            out[on[here]] = self.slot_piece[at[here]]
            on, keys, at = (x[~here & (there >= 0)] for x in (on, keys, at))
        return out

    def _symbols(self, stretch: str) -> list[str | None]:
        if SPACE in stretch:  # a literal U+2581 is no space: it takes part in no merge and is written by its bytes
            return [SPACE if c == " " else None if c == SPACE else c for c in stretch]
        return list(stretch.replace(" ", SPACE))

    def _ids(self, merged: list[str | None]) -> list[int]:
        out, find = [], self.pieces.get
        for s in merged:
            i = None if s is None else find(s)
            if i is None:
                out += [self.byte[x] for x in (SPACE if s is None else s).encode()]
            else:
                out.append(i)
        return out

    def merge(self, stretch: str, key: int) -> list[int]:
        """Ids of one stretch; its spaces are still spaces."""
        symbols = self._symbols(stretch)
        return self._ids(self._short(symbols, key) if len(symbols) <= _WORD else self._long(symbols, key))

    def _skips(self, key: int, place: int, piece: int) -> bool:
        """Whether the candidate for ``piece`` at the character ``place`` is dropped."""
        # Mixed after combining: a bare XOR would tie the candidates of one key to each other.
        h = (key ^ place * _PLACE ^ self.of_piece[piece]) & _MASK
        h = (h ^ h >> 32) * _MIX & _MASK
        h = (h ^ h >> 29) * _MIX & _MASK
        return h ^ h >> 32 < self.limit

    def _short(self, symbols: list[str | None], key: int) -> list[str | None]:
        """The agenda as a list with one entry per neighbouring pair: its least
        entry (the first of equal ones) comes next. For words this is faster
        than a heap; the merges are the same."""
        find, rank, limit = self.pieces.get, self.rank, self.limit
        ids = [None if a is None or b is None else find(a + b) for a, b in zip(symbols, symbols[1:])]
        agenda = [_NEVER if i is None else rank[i] for i in ids]
        place = list(range(len(symbols)))
        while agenda:
            best = min(agenda)
            if best == _NEVER:
                break
            k = agenda.index(best)
            if limit and self._skips(key, place[k], ids[k]):
                agenda[k] = _NEVER
                continue
            joined = symbols[k] = symbols[k] + symbols[k + 1]
            del symbols[k + 1], place[k + 1], agenda[k], ids[k]
            if k:
                a = symbols[k - 1]
                i = ids[k - 1] = None if a is None else find(a + joined)
                agenda[k - 1] = _NEVER if i is None else rank[i]
            if k < len(agenda):
                b = symbols[k + 1]
                i = ids[k] = None if b is None else find(joined + b)
                agenda[k] = _NEVER if i is None else rank[i]
        return symbols

    def _long(self, symbols: list[str | None], key: int) -> list[str | None]:
        """The agenda as a heap over linked symbols, for stretches of any length."""
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        pieces, rank, agenda = self.pieces, self.rank, []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and symbols[a] is not None and symbols[b] is not None:
                i = pieces.get(symbols[a] + symbols[b])
                if i is not None:
                    heapq.heappush(agenda, (rank[i], a, b, len(symbols[a]) + len(symbols[b]), i))

        for a in range(n - 1):
            offer(a, a + 1)
        while agenda:
            _, a, b, size, i = heapq.heappop(agenda)
            if right[a] != b or not symbols[a] or not symbols[b] or len(symbols[a]) + len(symbols[b]) != size:
                continue  # one side has been merged since
            if self.limit and self._skips(key, a, i):
                continue
            symbols[a] += symbols[b]
            symbols[b] = ""
            right[a] = right[b]
            if right[a] < n:
                left[right[a]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [s for s in symbols if s != ""]

    def _side_by_side(self, table: np.ndarray, keys: np.ndarray) -> None:
        """Merges every column of symbols as ``_short`` does, in place: a merged
        symbol stands in the row of its first character, its other rows are -1.
        The first and the last row are no symbols, so that all have neighbours."""
        rows, n = table.shape
        row = np.arange(rows)[:, None]
        after = np.repeat(row + 1, n, 1).ravel()
        before = np.repeat(row - 1, n, 1).ravel()
        symbols, pieces = table.ravel(), self._pairs(table[:-1].ravel(), table[1:].ravel())
        agenda = self.order[pieces].reshape(rows - 1, n) + row[:-1]
        column = np.arange(n)
        while True:
            best = agenda.min(0)
            left = np.flatnonzero(best < _NO_ENTRY)
            if len(left) < len(column):
                if not len(left):
                    return
                agenda, column, best = agenda.take(left, 1), column[left], best[left]
            entries, width, at = agenda.ravel(), len(column), np.arange(len(column))
            k = best & (1 << _ROW_BITS) - 1
            here = k * n + column
            piece = pieces[here]
            if self.limit:
                skip = _mixed(keys[column] ^ (k - 1).view(np.uint64) * np.uint64(_PLACE) ^ self.drawn[piece]) <= np.uint64(self.limit - 1)
                entries[k[skip] * width + at[skip]] = _NO_ENTRY
                go = np.flatnonzero(~skip)
                at, k, here, piece = at[go], k[go], here[go], piece[go]
            of = column[at]
            gone = after[here]
            there = gone * n + of
            last, first = after[there], before[here]
            symbols[here], symbols[there] = piece, -1
            after[here] = last
            before[last * n + of] = k
            entries[gone * width + at] = _NO_ENTRY
            there = first * n + of
            found = self._pairs(np.concatenate([piece, symbols[there]]), np.concatenate([symbols[last * n + of], piece]))
            pieces[here], pieces[there] = found[:len(k)], found[len(k):]
            ranks = self.order[found]
            entries[k * width + at] = ranks[:len(k)] + k
            entries[first * width + at] = ranks[len(k):] + first

    def _encode(self, texts: list[str], starts: list[bool], numbers: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        """Ids of some texts or parts of texts that begin with a stretch. ``starts``:
        whether a text begins there. ``numbers``: how many stretches of the text
        came before (moved on), ``keys``: the numbers of their documents."""
        whole = "".join([" " + t if s else t for t, s in zip(texts, starts)])  # the model's dummy prefix
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) + s for t, s in zip(texts, starts)])
        begins = np.append(0, ends[:-1])
        blank = codes == ord(" ")
        first = blank & ~np.append(True, blank[:-1])
        first[begins] = True
        first = np.flatnonzero(first)
        sizes = np.diff(first, append=len(codes))
        text = np.searchsorted(begins, first, "right") - 1
        counts = np.bincount(text, minlength=len(texts))
        place = np.arange(len(first)) - (np.cumsum(counts) - counts)[text] + numbers[text]
        numbers += counts
        drawn = _mixed(place.astype(np.uint64) * np.uint64(_PLACE) ^ keys[text])
        symbols, wide = self.symbol[codes], {}
        low = 1
        for width in _WIDTHS:
            some = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if len(some):
                row = np.arange(width)[:, None]
                inside = row < sizes[some]
                at = (first[some] + row)[inside]
                table = np.full((width + 2, len(some)), self.none, np.int32)
                table[1:-1][inside] = symbols[at]
                self._side_by_side(table, drawn[some])
                symbols[at] = table[1:-1][inside]
        for i in np.flatnonzero(sizes > _WORD).tolist():
            at = int(first[i])
            symbols[at:at + sizes[i]] = -1
            wide[at] = self.merge(whole[at:at + int(sizes[i])], int(drawn[i]))
        # every symbol left gives an id, or one for each of its bytes
        n_ids = (symbols >= 0).astype(np.int64)
        odd = np.flatnonzero(symbols >= len(self.raw))
        kinds, kind = np.unique(codes[odd], return_inverse=True)
        spelt = [[self.byte[x] for x in (SPACE if c == ord(" ") else chr(c)).encode()] for c in kinds.tolist()]
        n_ids[odd] = np.array([len(x) for x in spelt], np.int64)[kind]
        for at, ids in wide.items():
            n_ids[at] = len(ids)
        to = np.cumsum(n_ids)
        out = np.empty(int(to[-1]), "<i4")
        plain = np.flatnonzero((symbols >= 0) & (symbols < len(self.raw)))
        out[to[plain] - 1] = symbols[plain]
        for j in range(max(map(len, spelt), default=0)):
            has = np.array([len(x) > j for x in spelt])[kind]
            out[(to - n_ids)[odd[has]] + j] = np.array([x[j] if len(x) > j else 0 for x in spelt])[kind[has]]
        for at, ids in wide.items():
            out[to[at] - len(ids):to[at]] = ids
        return np.split(out, to[ends[:-1] - 1])

    def _parts(self, text: str) -> Iterator[str]:
        """A text cut before stretches, into parts of about ``room`` characters."""
        at = 0
        while len(text) - at > self.room:
            cut = _CUT.search(text, at + self.room - 1)
            if not cut:
                break
            yield text[at:cut.end()]
            at = cut.end()
        yield text[at:]

    def encode_all(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of whole texts; a key (a document's number) draws the skips."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        numbers, keys = np.zeros(len(texts), np.int64), np.array([k & _MASK for k in keys], np.uint64)
        parts: list[tuple[int, str, bool]] = []
        size = 0

        def flush() -> None:
            of = np.array([i for i, _, _ in parts])
            before = numbers[of]
            for i, ids in zip(of.tolist(), self._encode([p for _, p, _ in parts], [s for _, _, s in parts], before, keys[of])):
                out[i].append(ids)
            numbers[of] = before
            parts.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            for j, part in enumerate(self._parts(text)):
                if j and parts:  # the next part of a text counts on from the one before
                    flush()
                    size = 0
                parts.append((i, part, not j))
                size += len(part)
                if size >= self.room:
                    flush()
                    size = 0
        if parts:
            flush()
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, "<i4"), *x]) for x in out]

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        """Ids of a whole text; ``key`` (a document's number) draws the skips."""
        return self.encode_all([text], [key])[0]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.raw.__getitem__, ids.tolist()))[1:].decode("utf-8")


def _key(doc_id: int | None, seed: int) -> int:
    return xxhash.xxh64_intdigest(str(doc_id), seed)


def encode_documents(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """``doc_id``, ``ids`` of every whole text (null and empty: no ids)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model, dropout, seed)
        for b in arrow_bytes(batches, 1, _BATCH):
            ids = codec.encode_all([t or "" for t in b.column(1).to_pylist()], [_key(i, seed) for i in b.column(0).to_pylist()])
            ends = np.cumsum([0] + [len(x) for x in ids])
            values = pa.array(np.concatenate(ids).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                                             names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``text`` of ``doc_id``, ``ids`` (null ids: null text; no ids:
    the empty text). An id that is null or outside the model is U+FFFD, and so
    are bytes that are no UTF-8. An empty table gives no rows; other columns
    are ignored."""
    prepare(encoded.sparkSession)

    def text_of(codec: Codec, ids: list) -> str:
        if all(i is not None and 0 <= i < len(codec.raw) for i in ids):
            whole = b"".join(map(codec.raw.__getitem__, ids))
        else:
            whole = b"".join(codec.raw[i] if i is not None and 0 <= i < len(codec.raw) else "\ufffd".encode() for i in ids)
        return whole[whole[:1] == b" ":].decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for b in arrow_rows(batches, 64):
            texts = [None if x is None else text_of(codec, x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def round_trip(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_ids, ids_crc32, lossless``.

    Every whole text is encoded and its ids are decoded again; ``lossless``
    says whether the text came back. Null counts as empty and has no ids.
    Rows repeated under one id get the same segmentation for the same text;
    a null id is a key like any other; an empty table gives no rows; other
    columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model, dropout, seed)
        for b in arrow_bytes(batches, 1, _BATCH):
            cols: list[list] = [[], [], [], []]
            texts = [t or "" for t in b.column(1).to_pylist()]
            for text, ids in zip(texts, codec.encode_all(texts, [_key(i, seed) for i in b.column(0).to_pylist()])):
                for c, v in zip(cols, (len(text.encode()), len(ids), zlib.crc32(ids.tobytes()), codec.decode(ids) == text)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.bool_())],
                names=["doc_id", "n_bytes", "n_ids", "ids_crc32", "lossless"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_ids long, ids_crc32 long, lossless boolean")
