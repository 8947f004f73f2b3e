"""Removal of every byte covered by a long string that starts anywhere else.

Suffixes are sampled by content: of the 201 grams of 200 bytes in each window
of 400 bytes, the one with the smallest hash anchors the window, so that equal
windows have equal anchors wherever they stand. Neighbouring windows with one
anchor form a stretch. Three steps settle all windows:

1. Screening. Stretches are counted by anchor. An anchor that occurs once has
   no repeated window. Stretches that are equal as a whole are repeated as a
   whole. Only anchors with several different stretches need the text.
2. Suffix sorting. Sampled splitters (Spark's range partitioner) divide these
   suffixes by their leading tokens, the first bytes at the anchor. Each bucket
   sorts the 400-byte suffixes at all window starts of an anchor by multikey
   quicksort, eight bytes at a time: neighbours that stay equal over 400 bytes
   are repeated. One stretch stands for all that are equal to it.
3. Boundaries. An anchor with more stretches than a bucket should hold is cut
   into several pieces in several buckets. Each piece passes on one suffix of
   each kind, and these are compared across the pieces by their digests.

All comparisons are between input texts; what is removed is decided before
anything is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialise, prepare, text_bytes

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_SEGMENT = 1 << 18
DIGEST = ("d1", "d2")
_ODD = 0x9E3779B97F4A7C15


class Anchors:
    """Stretches of windows that share an anchor, for texts of any length."""

    def __init__(self, width: int, gram: int):
        self.width, self.gram, self.reach = width, gram, width - gram + 1
        size = _SEGMENT + width + 1
        back = pow(_ODD, -1, 1 << 64)
        self.up = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size, _ODD, np.uint64))))
        self.down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size, back, np.uint64))))
        h = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        self.letter = h ^ (h >> np.uint64(29))

    def _grams(self, b: np.ndarray) -> np.ndarray:
        """Mixed rolling hashes of all grams of a segment."""
        n = len(b)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.letter[b] * self.down[:n], out=sums[1:])
        h = (sums[self.gram:] - sums[:-self.gram]) * self.up[:n - self.gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x7FB5D329728EA185)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x81DADEF4BC2DD44D)
        h ^= h >> np.uint64(33)
        return h

    def of(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first window, last window, anchor's place, anchor's hash) of the
        stretches, a segment of window starts at a time."""
        whole = np.frombuffer(text, np.uint8)
        for at in range(0, len(text) - self.width + 1, _SEGMENT):
            g = self._grams(whole[at:at + _SEGMENT + self.width - 1])
            windows = len(g) - self.reach + 1
            low, span = g, 1
            while 2 * span <= self.reach:
                low = np.minimum(low[:-span], low[span:])
                span *= 2
            rest = self.reach - span
            low = np.minimum(low[:windows], low[rest:rest + windows])
            turn = np.flatnonzero(low[1:] != low[:-1])
            first, last, place = [], [], []
            for i, j in zip([0, *(turn + 1).tolist()], [*turn.tolist(), windows - 1]):
                while True:  # a hash that recurs within its reach anchors several stretches
                    k = i + int(g[i:i + self.reach].argmin())
                    first.append(i)
                    last.append(min(j, k))
                    place.append(k)
                    if k >= j:
                        break
                    i = k + 1
            first, last, place = (np.array(x, np.int64) for x in (first, last, place))
            yield first + at, last + at, place + at, low[first].view(np.int64)


def digest(data: bytes | memoryview) -> bytes:
    """What decides that bytes are equal without looking at them again: 128
    bits of BLAKE2b, for which no two inputs can be made to collide."""
    return hashlib.blake2b(data, digest_size=16).digest()


def stretches(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """One row per stretch: document, first and last window, place and hash of
    the anchor, and the digest of all bytes the stretch covers in two numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(width, gram)
        for b in arrow_rows(batches, 128):
            ids, tids = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[list] = [[], [], [], [], [], [], []]
            for i, text in enumerate(text_bytes(b.column(2))):
                view = memoryview(text)
                for first, last, place, key in anchors.of(text):
                    out[0] += [ids[i]] * len(first)
                    out[1] += [tids[i]] * len(first)
                    for c, v in zip(out[2:6], (first, last, place, key)):
                        c.append(v)
                    out[6].append(np.frombuffer(b"".join(digest(view[s:e + width]) for s, e in zip(first.tolist(), last.tolist())),
                                                np.int64).reshape(-1, 2))
            if out[2]:
                cols = [np.concatenate(c) for c in out[2:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), *map(pa.array, cols[:-1]),
                     *(pa.array(np.ascontiguousarray(cols[-1][:, i])) for i in (0, 1))],
                    names=["doc_id", "tid", "lo", "hi", "at", "anchor", "d1", "d2"])

    return docs.where(F.octet_length("text") >= width).mapInArrow(
        run, "doc_id long, tid long, lo long, hi long, at long, anchor long, d1 long, d2 long")


# --- suffix sorting -----------------------------------------------------------

def words_of(data: bytes) -> np.ndarray:
    """The eight bytes from every position on, as big-endian numbers: their
    order is the order of the bytes."""
    b = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint64)
    n = len(data)
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | b[i:i + n]
    return out


def multikey_quicksort(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at ``starts`` by their first ``width`` bytes. Returns
    the order of those that share all of them with another, and the number of
    the group each is in.

    Groups that agree so far are split by their next eight bytes; a group of
    one is done. Only groups whose next bytes differ are sorted again. The
    last comparison ends exactly at ``width``.
    """
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    for at in [*range(0, width - 8, 8), width - 8]:
        if not len(order):
            break
        w = words[starts[order] + at]
        same = group[1:] == group[:-1]
        differs = np.concatenate(([False], same & (w[1:] != w[:-1])))
        if differs.any():
            torn = np.zeros(int(group[-1]) + 1, bool)
            torn[group[differs]] = True
            rows = np.flatnonzero(torn[group])
            by = rows[np.lexsort((w[rows], group[rows]))]
            order[rows], w[rows] = order[by], w[by]  # groups stay where they are
            same = group[1:] == group[:-1]
            starts_new = np.concatenate(([True], ~same | (w[1:] != w[:-1])))
        else:
            starts_new = np.concatenate(([True], ~same))
        group = np.cumsum(starts_new) - 1
        keep = np.bincount(group)[group] > 1
        if not keep.all():
            order = order[keep]
            group = group[keep]
            group = np.cumsum(np.concatenate(([False], group[1:] != group[:-1]))) if len(group) else group
    return order, group


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_SUFFIXES = ("lead0 long, lead1 long, anchor long, piece long, pieces long, doc_id long, tid long, lo long, "
             "settled boolean, content binary")
_FOUND = "doc_id long, tid long, start long, stop long, h1 long, h2 long, settled boolean"


def _cut_out(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Suffix rows (with their bytes) of the stretches a document has to show."""
    big = 1 << 63
    for b in arrow_rows(batches, 64):
        cols: list[list] = [[] for _ in range(10)]
        for doc_id, tid, text, wanted in zip(*(b.column(i).to_pylist() for i in range(4))):
            for w in wanted:
                lead = text[w["at"]:w["at"] + 16].ljust(16, b"\0")
                row = (int.from_bytes(lead[:8], "big") - big, int.from_bytes(lead[8:], "big") - big, w["anchor"],
                       w["piece"], w["pieces"], doc_id, tid, w["lo"], w["settled"], text[w["lo"]:w["hi"] + width])
                for c, v in zip(cols, row):
                    c.append(v)
        kinds = [pa.int64()] * 8 + [pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=[x.split()[0] for x in _SUFFIXES.split(", ")])


def _sort_bucket(batches: Iterator[pa.RecordBatch], width: int, rows_at_once: int = 400) -> Iterator[pa.RecordBatch]:
    """One bucket, its rows ordered by leading tokens, anchor and piece.

    Found rows carry removed runs (``start``, ``stop``). Rows with ``h1``,
    ``h2`` are suffixes (``start``) of a piece of a larger group, to be
    compared with the other pieces.
    """
    names = ["anchor", "piece", "pieces", "doc_id", "tid", "lo", "settled", "content"]
    held: list[dict] = []

    def settle(rows: list[dict]) -> pa.RecordBatch:
        data = b"".join(r["content"] for r in rows)
        counts = np.array([len(r["content"]) - width + 1 for r in rows])
        begin = np.cumsum([0] + [len(r["content"]) for r in rows])[:-1]
        owner = np.repeat(np.arange(len(rows)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        order, group = multikey_quicksort(words_of(data), begin[owner] + inside, width)
        hit = np.zeros(len(owner), bool)
        hit[order] = True
        settled = np.array([r["settled"] for r in rows])
        open_ = np.array([r["pieces"] > 1 for r in rows])
        out: list[list] = [[] for _ in range(7)]

        def add(r, start, stop, h1, h2, done):
            for c, v in zip(out, (r["doc_id"], r["tid"], start, stop, h1, h2, done)):
                c.append(v)

        ends = np.cumsum(counts)
        for k in np.flatnonzero(~settled):
            r = rows[k]
            for s, e in zip(*_runs(hit[ends[k] - counts[k]:ends[k]])):
                add(r, r["lo"] + int(s), r["lo"] + int(e) - 1 + width, None, None, True)
        if open_.any():
            first = np.ones(len(owner), bool)  # one suffix of each group of equal ones goes on
            first[order] = np.concatenate(([True], group[1:] != group[:-1])) if len(order) else True
            for x in np.flatnonzero(open_[owner] & first):
                r = rows[owner[x]]
                d = digest(r["content"][inside[x]:inside[x] + width])
                add(r, r["lo"] + int(inside[x]), None, int.from_bytes(d[:8], "big", signed=True),
                    int.from_bytes(d[8:], "big", signed=True), bool(hit[x] or settled[owner[x]]))
        kinds = [pa.int64()] * 6 + [pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                          names=[x.split()[0] for x in _FOUND.split(", ")])

    for b in batches:
        rows = b.select(names).to_pylist()
        for r in rows:
            if len(held) >= rows_at_once and (r["anchor"], r["piece"]) != (held[-1]["anchor"], held[-1]["piece"]):
                yield settle(held)
                held = []
            held.append(r)
    if held:
        yield settle(held)


# --- the operator -------------------------------------------------------------

def remove_repeats(docs: DataFrame, width: int = 400, gram: int = 200, piece_rows: int = 8192) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``.

    A text is its UTF-8 bytes; null is empty; matches never cross documents.
    Texts shorter than ``width`` bytes keep everything. Rows repeated under
    one id and text match each other and give the same result each; null ids
    are documents like any other. An empty table gives no rows; other columns
    are ignored. ``piece_rows`` bounds the different stretches of one anchor
    that one task sorts; more are split and compared across the pieces.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tid"),
                       F.col("text").cast("string").alias("text"))
    found = materialise(stretches(base, width, gram), "suffix-stretches")

    # 1. screening: anchors seen more than once, and whether their stretches differ
    # (counts are written before they are joined: both sides of the join are
    # then plain shuffles, and Spark can split an anchor that holds many rows)
    often = materialise(found.groupBy("anchor")
                        .agg(F.count(F.lit(1)).alias("n"), *[f(d).alias(f"{d}_{f.__name__}") for d in DIGEST for f in (F.min, F.max)])
                        .where("n > 1").select("anchor", F.expr("d1_min <> d1_max OR d2_min <> d2_max").alias("mixed")), "suffix-often")
    suspects = materialise(found.join(often, "anchor"), "suffix-suspects")
    where = F.struct("doc_id", "tid", "lo", "hi", "at")
    kinds = materialise(suspects.where("mixed").groupBy("anchor", *DIGEST)
                        .agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("one")), "suffix-kinds")
    equal = suspects.join(kinds.where("n > 1").select("anchor", *DIGEST), ["anchor", *DIGEST], "left_semi")
    whole = (suspects.where("NOT mixed").unionByName(equal)
             .select("doc_id", "tid", F.col("lo").alias("start"), (F.col("hi") + width).alias("stop")))
    sizes = materialise(kinds.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / piece_rows).alias("pieces")),
                        "suffix-sizes")
    shown = (kinds.join(sizes, "anchor")
             .select("one.*", "anchor", (F.col("n") > 1).alias("settled"), "pieces",
                     F.pmod(F.xxhash64(*DIGEST, F.lit(9)), F.col("pieces")).alias("piece")))
    of_doc = (whole.withColumn("w", F.lit(None).cast(
        "struct<lo:bigint,hi:bigint,at:bigint,anchor:bigint,piece:bigint,pieces:bigint,settled:boolean>"))
        .unionByName(shown.select("doc_id", "tid", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"),
                                  F.struct("lo", "hi", "at", "anchor", "piece", "pieces", "settled").alias("w")))
        .groupBy("doc_id", "tid")
        .agg(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop"))).alias("spans"),
             F.collect_set("w").alias("wanted")))

    # every document beside its stretches; only those that have any keep their text
    key = ["id", "tid"]
    left = base.select("*", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    right = of_doc.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "tid", "spans", "wanted")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    state = materialise(left.join(right, key, "left").select(
        "doc_id", "tid", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("sha"),
        F.when(F.col("spans").isNotNull(), raw).alias("text"), "spans", "wanted"), "suffix-state")

    # 2. suffix sorting of the stretches that differ
    suffixes = (state.where(F.size("wanted") > 0).select("doc_id", "tid", "text", "wanted")
                .mapInArrow(lambda it: _cut_out(it, width), _SUFFIXES))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ["lead0", "lead1", "anchor", "piece"]
    settled = materialise(materialise(suffixes, "suffix-cut").repartitionByRange(parts, *ordered)
                          .sortWithinPartitions(*ordered)
                          .mapInArrow(lambda it: _sort_bucket(it, width), _FOUND), "suffix-found")
    runs = settled.where("h1 IS NULL").select("doc_id", "tid", "start", "stop")

    # 3. suffixes of groups that were cut, compared across the pieces
    border = settled.where("h1 IS NOT NULL")
    twice = border.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = (border.where("NOT settled").join(twice, ["h1", "h2"], "left_semi")
           .select("doc_id", "tid", "start", (F.col("start") + width).alias("stop")))
    more = runs.unionByName(met).groupBy("doc_id", "tid").agg(F.collect_set(F.struct("start", "stop")).alias("more"))

    calm = state.where("spans IS NULL").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                                               F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"))
    touched = (state.where("spans IS NOT NULL").withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
               .join(more.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "tid", "more"), key, "left")
               .select("doc_id", "text", "spans", "more").mapInArrow(_remove, RESULT))
    return calm.unionByName(touched)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge a document's runs and cut them out."""
    for b in arrow_rows(batches, 128):
        rows: list[tuple] = []
        for doc_id, text, spans, more in zip(*(b.column(i).to_pylist() for i in range(4))):
            merged: list[list[int]] = []
            for s, e in sorted((x["start"], x["stop"]) for x in [*spans, *(more or [])]):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            kept, at = hashlib.sha256(), 0
            for s, e in merged:
                kept.update(text[at:s])
                at = e
            kept.update(text[at:])
            rows.append((doc_id, len(text), sum(e - s for s, e in merged), len(merged), kept.hexdigest()))
        names = [x.split()[0] for x in RESULT.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.string()]
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)
