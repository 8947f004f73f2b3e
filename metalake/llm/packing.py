"""Packing tokenised documents into fixed-length training sequences.

First-fit decreasing over a tournament tree of bin capacities, run on its own
in every randomised group of documents. The number of groups follows the
number of documents, so a group (and a task's memory) stays the same size at
any scale, and no source, length or id decides where a document goes.

A document's whole blocks of ``seq_len`` ids fill sequences by themselves;
only its remainder competes for space. After the first fit, gaps of at least
``min_cut`` ids are topped up from the emptiest bins (a piece is cut where it
is longer than the gap), and the one bin that is left is cut into powers of
two, which need no padding.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_bytes, prepare

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_TOKENS = "grp long, doc_id long, doc_tokens long, block_crcs array<long>, rest binary"
_SAFE = re.compile(r"(?<=\S) (?=\S)")


#: A chunk that its neighbours decide how to cut, and one not met before.
_ODD, _NEW = object(), object()


class Encoder:
    """Ids of whole texts under one public tokenizer file, as
    ``encode(text, add_special_tokens=False)`` gives them.

    Plain Latin chunks, nearly all there are, go through a second library that
    is given the file's own vocabulary (a byte-level BPE merges in the order of
    its ids) and does less for each call; others, on whose letters the two
    libraries' character tables may differ, go through the first. So do, uncut,
    texts that spell one of the file's added tokens.
    """

    # Fixed value: the pattern by which this kind of tokenizer cuts a text before merging.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str, cache_room: int = 400_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        letters = {c: b for b, c in enumerate(_byte_letters())}
        ranks = {bytes(letters[c] for c in piece): i
                 for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.latin = tiktoken.Encoding("latin", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaces = np.zeros(max(ranks.values()) + 1, bool)  # ids whose bytes start with a space
        self.spaces[[i for piece, i in ranks.items() if piece[:1] == b" "]] = True
        self.known: dict[str, object] = {}
        self.room = cache_room

    def _encode(self, text: str) -> bytes:
        if text.isascii() or max(text) < "\u0250":
            ids = self.latin.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.dtype.char, ids).tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids of one text, cut only at single spaces between solid letters."""
        if not text:
            return b""
        if any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        head, *more = _SAFE.split(text)
        known = iter(self._spaced([c for c in more if " " not in c]))
        ids = [_ODD if " " in c else next(known) for c in more]
        return self._encode(head) + b"".join(self._encode(" " + c) if x is _ODD else x for c, x in zip(more, ids))

    def _spaced(self, chunks: list[str]) -> list:
        """Ids (bytes) of every chunk after a space, or ``_ODD`` for one that is
        empty or has white space at an edge. New Latin chunks are encoded in
        one call: an id that starts with a space starts a chunk."""
        if len(self.known) > self.room:
            self.known.clear()
        get = self.known.get
        out = [get(c, _NEW) for c in chunks]
        new = [i for i, x in enumerate(out) if x is _NEW]
        plain = []
        for i in new:
            c = chunks[i]
            if not c or c[0].isspace() or c[-1].isspace():
                out[i] = _ODD
            elif c.isascii() or max(c) < "\u0250":
                plain.append(i)
            else:
                out[i] = self._encode(" " + c)
        if plain:
            ids = self.latin.encode_to_numpy(" " + " ".join([chunks[i] for i in plain]), disallowed_special=()).astype(self.dtype)
            at = np.flatnonzero(self.spaces[ids])
            if len(at) != len(plain):
                raise ValueError("the vocabulary merges across a space between words")
            raw, at = ids.tobytes(), (at * self.dtype.itemsize).tolist()
            for i, a, b in zip(plain, at, [*at[1:], len(raw)]):
                out[i] = raw[a:b]
        for i in new:
            if len(chunks[i]) <= 64:
                self.known[chunks[i]] = out[i]
        return out

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of many texts. Chunks are cut and told apart in Arrow, every
        different one is looked up once, and the ids are gathered by their
        places, so that little is done for each word."""
        texts = texts.fill_null("")
        cut = pc.split_pattern(texts, " ")
        first = cut.offsets.to_numpy().astype(np.int64)
        told = cut.flatten().dictionary_encode()
        chunks = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        code = told.indices.to_numpy().astype(np.int64)
        known = self._spaced(chunks)
        heads = [b"" if known[i] is _ODD else self._encode(chunks[i]) for i in code[first[:-1]]]
        # chunks that their neighbours cut, and texts with added tokens, go the long way
        odd = np.add.reduceat(np.array([k is _ODD for k in known], np.int64)[code], first[:-1]) > 0 if len(code) else np.zeros(0, bool)
        for t in self.added:
            odd |= np.asarray(pc.match_substring(texts, t))
        parts = [b"" if x is _ODD else x for x in known] + heads
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        start = np.cumsum(size) - size
        code[first[:-1]] = len(chunks) + np.arange(len(texts))
        ends = np.cumsum(size[code])
        at = np.repeat(start[code] - (ends - size[code]), size[code]) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(parts), self.dtype)[at]
        bounds = np.concatenate(([0], ends[first[1:] - 1])) if len(texts) else [0]
        return [np.frombuffer(self(texts[i].as_py()), self.dtype) if odd[i] else ids[bounds[i]:bounds[i + 1]]
                for i in range(len(texts))]


def _byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself where
    it prints, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers. A tournament tree keeps, over all bins in opening
    order, the largest free capacity below each node; the walk down takes the
    left child whenever it has room, which is the first bin that fits."""
    order = np.argsort(-sizes, kind="stable").tolist()
    sizes = sizes.tolist()
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins: list[list[int]] = [[] for _ in range(leaves)]
    for item in order:
        size = sizes[item]
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[node - leaves].append(item)
        tree[node] -= size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left > right else right
    return [b for b in bins if b]


def pack_group(lengths: np.ndarray, seq_len: int, min_cut: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) over the remainders of one group."""
    todo = np.flatnonzero(lengths > 0)
    bins = [[(int(todo[i]), 0, int(lengths[todo[i]])) for i in b]
            for b in first_fit_decreasing(lengths[todo], seq_len)]
    fill = [sum(p[2] for p in b) for b in bins]
    done = [b for b, f in zip(bins, fill) if f == seq_len]
    part = sorted(([f, b] for b, f in zip(bins, fill) if f < seq_len), key=lambda x: -x[0])
    lo, hi = 0, len(part) - 1
    while lo < hi:
        gap = seq_len - part[lo][0]
        if gap < min_cut:
            lo += 1
            continue
        item, start, length = part[hi][1].pop()
        take = min(gap, length)
        if take < length:
            part[hi][1].append((item, start + take, length - take))
        part[lo][1].append((item, start, take))
        part[lo][0] += take
        part[hi][0] -= take
        if not part[hi][1]:
            hi -= 1
    done += [b for _, b in part[:hi]]
    if hi >= 0 and part and part[hi][1]:
        done += _powers(part[hi][1])
    return done


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    out, queue = [], list(reversed(pieces))
    left = sum(p[2] for p in pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            item, start, length = queue.pop()
            take = min(room, length)
            if take < length:
                queue.append((item, start + take, length - take))
            sequence.append((item, start, take))
            room -= take
        out.append(sequence)
    return out


def tokenise(docs: DataFrame, tokenizer: str, seq_len: int, eos_id: int, groups: int, seed: int) -> DataFrame:
    """One row per document: its group, the checksums of its whole blocks and
    the ids of its remainder (the only ids that are shuffled)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        eos = np.array([eos_id], encode.dtype)
        for b in arrow_bytes(batches, 2, 8 << 20):
            sizes, crcs, rests = [], [], []
            for ids in encode.batch(b.column(2)):
                ids = np.concatenate((ids, eos))
                whole = len(ids) - len(ids) % seq_len
                sizes.append(len(ids))
                crcs.append([crc(ids[i:i + seq_len]) for i in range(0, whole, seq_len)])
                rests.append(ids[whole:].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())],
                names=["grp", "doc_id", "doc_tokens", "block_crcs", "rest"])

    # The running number keeps repeated (or null) ids from meeting in one group.
    grp = F.pmod(F.xxhash64(F.col("doc_id"), F.monotonically_increasing_id(), F.lit(seed)), F.lit(groups))
    return docs.select(grp.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, _TOKENS)


def pack_documents(docs: DataFrame, tokenizer: str, seq_len: int = 2048, eos_id: int = 1,
                   docs_per_group: int = 1024, min_cut: int = 16, seed: int = 17) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``) in packed sequences.

    Null and empty texts are the single id ``eos_id``. Rows repeated under
    one id are packed as documents of their own. A null ``doc_id`` stays
    null. An empty table gives no rows. Other columns are ignored.
    """
    if seq_len & (seq_len - 1) or seq_len < 1:
        raise ValueError("seq_len must be a power of two")
    prepare(docs.sparkSession)
    groups = max(1, -(-docs.count() // docs_per_group))
    tokens = tokenise(docs, tokenizer, seq_len, eos_id, groups, seed)
    wide = Encoder(tokenizer).dtype

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rest = [np.frombuffer(r, wide) for r in group["rest"].to_pylist()]
        ids, sizes = group["doc_id"].to_pylist(), group["doc_tokens"].to_pylist()
        rows, sequence = [], key[0].as_py() << 32
        for i, crcs in enumerate(group["block_crcs"].to_pylist()):
            for k, c in enumerate(crcs):
                rows.append((ids[i], k * seq_len, seq_len, c, sizes[i], sequence, 0))
                sequence += 1
        for pieces in pack_group(np.array([len(r) for r in rest], np.int64), seq_len, min_cut):
            offset = 0
            for item, start, length in pieces:
                rows.append((ids[item], sizes[item] - len(rest[item]) + start, length,
                             crc(rest[item][start:start + length]), sizes[item], sequence, offset))
                offset += length
            sequence += 1
        names = PIECES.replace(" long", "").split(", ")
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, zip(*rows))})

    return tokens.groupBy("grp").applyInArrow(run, PIECES)
