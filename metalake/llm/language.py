"""Language identification by prediction by partial matching (PPM).

Per language, a byte context tree of variable order is trained on a bounded
sample and frozen. A symbol seen in a context has probability n / (T + q)
(T symbols, q distinct ones); any other is escaped to the next shorter
context with probability q / (T + q), the symbols already refused being
excluded, so the probabilities of every context add up to one and the sum of
-log2 p is the exact length of a code of the text. The language with the
shortest code is predicted.

Frozen trees of all languages are compiled into one automaton over the union
of their contexts: a table of next states and a table of code lengths, one
column per language. A state depends on the last few bytes only, so texts of
any length are cut into chunks that start with those bytes, and thousands of
chunks step through the automaton side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, held_out, materialise, prepare

UND = "und"
_CHUNK = 512
_BLOCK = 4096
_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Automaton:
    langs: list[str]
    order: int
    classes: np.ndarray  # byte -> symbol class
    pad: int             # the class after all others: costs nothing
    step: np.ndarray     # state * classes + class -> next state * classes
    bits: np.ndarray     # state * classes + class -> code length per language


def _grams(data: np.ndarray, m: int) -> np.ndarray:
    """All runs of ``m`` bytes as integers, first byte highest."""
    n = len(data) - m + 1
    key = np.zeros(max(n, 0), np.uint64)
    for i in range(m):
        key = (key << np.uint64(8)) | data[i:i + max(n, 0)].astype(np.uint64)
    return key


def train(samples: dict[str, list[str]], order: int = 4, max_contexts: int = 12_000) -> Automaton:
    """Compile the context trees of all languages. ``max_contexts`` is the size
    of the union of the trees: the most frequent contexts are kept (a context
    is never more frequent than the shorter ones inside it)."""
    langs = sorted(samples)
    data = [np.frombuffer((b"\n" * order).join([b""] + [t.lower().encode() for t in samples[lg]] + [b""]), np.uint8)
            for lg in langs]
    seen = np.unique(np.concatenate(data)) if data else np.zeros(0, np.uint8)
    classes = np.full(256, len(seen), np.int64)  # bytes never seen share the class after the others
    classes[seen] = np.arange(len(seen))
    width = len(seen) + 1
    strangers = 256 - len(seen)
    grams = [[np.unique(_grams(d, m), return_counts=True) for d in data] for m in range(1, order + 2)]

    # the union of contexts by length, most frequent first over all lengths
    keys, freq, size = [], [], []
    for m in range(1, order + 1):
        k = np.concatenate([g[0] for g in grams[m - 1]])
        c = np.concatenate([g[1] / max(1, len(d)) for g, d in zip(grams[m - 1], data)])
        u, at = np.unique(k, return_inverse=True)
        keys.append(u)
        freq.append(np.bincount(at, c))
        size.append(np.full(len(u), m))
    best = np.lexsort((np.concatenate(size), -np.concatenate(freq)))[:max_contexts]
    pick = np.sort(best)
    all_keys, all_size = np.concatenate(keys)[pick], np.concatenate(size)[pick]
    ctx = [np.zeros(1, np.uint64)] + [all_keys[all_size == m] for m in range(1, order + 1)]
    # a context whose shorter end is missing (equal frequencies) goes too
    for m in range(2, order + 1):
        tail = ctx[m] & np.uint64((1 << (8 * (m - 1))) - 1)
        ctx[m] = ctx[m][np.isin(tail, ctx[m - 1])]
    start = np.concatenate(([0], np.cumsum([len(c) for c in ctx])))

    def find(m: int, key: np.ndarray) -> np.ndarray:
        """State of each context of length ``m``, -1 where there is none."""
        if not len(ctx[m]):
            return np.full(len(key), -1)
        at = np.searchsorted(ctx[m], key).clip(max=len(ctx[m]) - 1)
        return np.where(ctx[m][at] == key, at + start[m], -1)

    states, n = int(start[-1]), len(langs)
    p = np.empty((states, n, width))
    step = np.zeros((states, width), np.int64)
    for m in range(order + 1):
        rows = slice(start[m], start[m + 1])
        if m:
            below = find(m - 1, ctx[m] & np.uint64((1 << (8 * (m - 1))) - 1))
            low, step[rows] = p[below], step[below]
        else:
            low = np.full((1, n, width), 1 / 256)
            low[:, :, -1] = strangers / 256
        count = np.zeros(low.shape)
        for i in range(n):
            g, c = grams[m][i]
            at = find(m, g >> np.uint64(8))
            ok = at >= 0
            count[at[ok] - start[m], i, classes[(g[ok] & np.uint64(255)).astype(np.int64)]] = c[ok]
        total, kinds = count.sum(2, keepdims=True), (count > 0).sum(2, keepdims=True)
        refused = (low * (count > 0)).sum(2, keepdims=True)
        full = 1 - refused < 1e-9
        scale = np.where(full, 0, kinds / np.maximum(total + kinds, 1) / np.maximum(1 - refused, 1e-9))
        fresh = np.where(total > 0, low * scale, low)
        p[rows] = np.where(count > 0, count / np.maximum(total + np.where(full, 0, kinds), 1), fresh)
        # the next state: this context and the symbol, if that is a context of at most ``order`` bytes
        if m < order:
            g = ctx[m + 1]
            at = find(m, g >> np.uint64(8))
            ok = at >= 0
            step[at[ok], classes[(g[ok] & np.uint64(255)).astype(np.int64)]] = np.flatnonzero(ok) + start[m + 1]
    # contexts of full length follow through their shorter end, which was copied above
    p[:, :, -1] /= max(1, strangers)
    bits = np.zeros((states, width + 1, n), np.float32)
    bits[:, :-1] = -np.log2(np.maximum(p, 1e-300)).transpose(0, 2, 1)
    nxt = np.zeros((states, width + 1), np.int32)
    nxt[:, :-1] = step * (width + 1)
    return Automaton(langs, order, classes.astype(np.uint16), width, nxt.ravel(), bits.reshape(-1, n))


def code_lengths(model: Automaton, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language's frozen statistics."""
    k, pad = model.order, model.pad
    out = np.zeros((len(texts), len(model.langs)))
    held, owners, n = [], [], 0

    def flush():
        nonlocal held, owners, n
        if not n:
            return
        cells = np.ascontiguousarray(np.concatenate(held).T)
        state = np.zeros(n, np.int32)
        total = np.zeros((n, len(model.langs)))
        for j, column in enumerate(cells):
            at = state + column
            if j >= k:
                total += model.bits[at]
            state = model.step[at]
        np.add.at(out, np.concatenate(owners), total)
        held, owners, n = [], [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        symbols = model.classes[np.frombuffer(b"\n" * k + text, np.uint8)].astype(np.int32)
        chunks = -(-len(text) // _CHUNK)
        line = np.full(k + chunks * _CHUNK, pad, np.int32)
        line[:len(symbols)] = symbols
        view = np.lib.stride_tricks.sliding_window_view(line, k + _CHUNK)[::_CHUNK]
        for at in range(0, chunks, _BLOCK):
            part = view[at:at + _BLOCK]
            held.append(part)
            owners.append(np.full(len(part), i))
            n += len(part)
            if n >= _BLOCK:
                flush()
    flush()
    return out


def sample_texts(docs: DataFrame, per_lang: int, max_bytes: int, all_bytes: int) -> dict[str, list[str]]:
    """At most about ``per_lang`` texts a language (twice that for certain), of
    at most ``max_bytes`` bytes each and ``all_bytes`` over all languages,
    picked by a hash of id and text."""
    ready = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), 3, 1) & F.col("text").isNotNull()
                       & (F.octet_length("text") <= max_bytes))
    counts = materialise(ready.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    langs = counts.count()
    if not langs:
        return {}
    dice = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    one = Window.partitionBy("lang").orderBy("dice", "doc_id", "text")
    rows = (ready.select("doc_id", "lang", "text", dice.alias("dice")).join(counts, "lang")
            .where(F.col("dice") < F.lit(float(per_lang)) / F.col("n"))
            .withColumn("nth", F.row_number().over(one)).where(F.col("nth") <= 2 * per_lang)
            .withColumn("sum", F.sum(F.octet_length("text")).over(one)).where(F.col("sum") <= all_bytes // langs)
            .select("lang", "text").collect())
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def identify(docs: DataFrame, per_lang: int = 300, max_bytes: int = 1 << 16, all_bytes: int = 64 << 20, order: int = 4,
             max_contexts: int = 12_000) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document.

    Learns from a bounded sample (``per_lang`` texts of at most ``max_bytes``
    bytes per language, ``all_bytes`` in all) of rows with a language whose crc32(doc_id) mod 3 is
    not 1 (a null id has no remainder: it is not held out). Every whole text
    is scored; case is folded. ``score`` is the predicted language's share of
    2^-bits over all languages. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if nothing can be learned.
    Ties go to the first language by name; repeated rows are scored alike; an
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    samples = sample_texts(base, per_lang, max_bytes, all_bytes)
    model = spark.sparkContext.broadcast(train(samples, order, max_contexts)) if samples else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 512):
            texts = [t.lower().encode() if t and known else b"" for t, known in
                     zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            names, scores = [UND] * len(texts), [0.0] * len(texts)
            if model is not None:
                m = model.value
                cost = code_lengths(m, texts)
                best = cost.argmin(axis=1)
                share = 1 / np.exp2(np.maximum(cost.min(axis=1, keepdims=True) - cost, -1000)).sum(axis=1)
                for i, t in enumerate(texts):
                    if t:
                        names[i], scores[i] = m.langs[best[i]], float(share[i])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return (base.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "text", letters.alias("known"))
            .mapInArrow(run, _SCHEMA))
