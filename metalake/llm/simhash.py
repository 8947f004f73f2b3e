"""SimHash near-duplicates through a byte-position inverted index.

Fingerprints within three bits of each other agree in at least five of their
eight positional bytes. Postings of single positional bytes would grow with
the square of the corpus, so the index is keyed by quadruples of positions:
the 14 planes of the affine space over {0..7} hold, for any three positions
that may differ, one quadruple that avoids all three, so every such pair
meets in some posting. Within a posting, the shared positional bytes of each
pair are tallied, pairs below the guaranteed minimum of five are left out,
and the rest are verified bit by bit.

Equal fingerprints are folded before indexing (a group of copies costs one
posting per plane), and a posting gives the edges of a spanning forest rather
than its pairs. A posting that grows beyond a fixed size is taken apart by
further bytes and half bytes, with the same guarantee, until twelve bits are
free at most: no task holds more than some thousand fingerprints at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, first_of_repeated, materialise, prepare, row_key, text_bytes
from .components import connected_components

#: Quadruples of byte positions whose numbers cancel: any three positions are missed by one of them.
PLANES = [q for q in combinations(range(8), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_STEP = 1 << 20


def _words(text: bytes, carry: int) -> Iterator[list[bytes]]:
    """Runs of words of a text of any length; each run repeats the last
    ``carry`` words of the one before."""
    if len(text) <= 2 * _STEP:
        yield text.split()
        return
    at, kept = 0, []
    while at < len(text):
        cut = _SPACE.search(text, min(len(text), at + _STEP))
        end = cut.start() if cut else len(text)
        words = kept + text[at:end].split()
        at = end
        if len(words) > carry or at >= len(text):
            yield words
            kept = words[-carry:] if carry else []
        else:
            kept = words


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed long."""
    ones, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    text = text.lower()  # bytes.lower() is ASCII only
    short: list[bytes] = []
    for words in _words(text, shingle - 1):
        if len(words) < shingle:
            short = words
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = np.array([digest(line[s:e], seed) for s, e in
                           zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], ">u8")
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
    if not n:
        if not short:
            return 0
        return int(np.array([digest(b" ".join(short), seed)], np.uint64).view(np.int64)[0])
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, tid, fp`` of every whole text; ``tid`` tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 256):
            fps = [fingerprint(t, shingle, seed) for t in text_bytes(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["doc_id", "tid", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tid"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, tid long, fp long"))


def spanning_links(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one posting.
    Each fingerprint reached is taken out, so that a dense group is done after
    few comparisons and memory follows the posting's size."""
    least = 8 - bits
    left, out = fps, []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            node = front.pop()
            x = left ^ node
            shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # tally of positional bytes
            near = np.flatnonzero(shared >= least)
            near = near[np.bitwise_count(x[near].view(np.uint64)) <= bits]
            if len(near):
                got = left[near]
                out += [(int(node), int(g)) for g in got]
                front += got.tolist()
                left = np.delete(left, near)
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks(level: int) -> list[list[int]]:
    """For every mask of a level of the index the finer masks of the next: a
    pair within three bits that agrees under one mask agrees under one of those.

    Level 0 has a quadruple of bytes; of the other four bytes one is the same
    (level 1); of the six half bytes that are left three are the same (level
    2). Under a mask of level 2 only twelve bits are free, so a posting of it
    holds at most 4096 fingerprints.
    """
    first = [sum(0xFF << (8 * p) for p in q) for q in PLANES]
    if level == 0:
        return [[m | 0xFF << (8 * p) for p in range(8) if not m >> (8 * p) & 1] for m in first]
    halves = lambda m: [0xF << (4 * h) for h in range(16) if not m >> (4 * h) & 1]
    return [[m | sum(c) for c in combinations(halves(m), 3)] for finer in masks(0) for m in finer]


def postings(nodes: DataFrame, crowded: int = 2048) -> DataFrame:
    """``label, key, fp``: the fingerprints under every mask. A posting of more
    than ``crowded`` is taken apart by the finer masks instead."""
    keyed = lambda ms, at: F.array(*[F.struct(F.lit(at + i).alias("label"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                                     for i, m in enumerate(ms)])
    first = [sum(0xFF << (8 * p) for p in q) for q in PLANES]
    rows = nodes.select(F.explode(keyed(first, 0)).alias("at"), "fp").select("at.*", "fp")
    done, low = None, 0
    for level in (0, 1):
        full = materialise(rows.groupBy("label", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded)
                           .select("label", "key"), "simhash-crowded")
        if full.isEmpty():
            break
        calm = rows.join(full, ["label", "key"], "left_anti")
        done = calm if done is None else done.unionByName(calm)
        finer = masks(level)
        high = low + len(finer)
        by_label, at = [], high
        for ms in finer:
            by_label.append(keyed(ms, at))
            at += len(ms)
        choice = F.coalesce(*[F.when(F.col("label") == low + i, c) for i, c in enumerate(by_label)])
        rows = materialise(rows.join(full, ["label", "key"], "left_semi").select(F.explode(choice).alias("at"), "fp")
                           .select("at.*", "fp").distinct(), "simhash-finer")
        low = high
    return rows if done is None else done.unionByName(rows)


def links(nodes: DataFrame, bits: int = 3) -> DataFrame:
    """Links (``a``, ``b``) among distinct fingerprints (``fp``) that connect
    exactly the fingerprints connected by pairs of at most ``bits`` bits."""
    if not 0 <= bits <= 3:
        raise ValueError("the quadruple index guarantees pairs of at most three bits")
    ordered = postings(nodes).select(F.col("label").alias("plane"), "key", "fp").repartition("plane", "key").sortWithinPartitions("plane", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Postings arrive one after the other; one may go on in later batches."""
        held = [np.zeros(0, np.int64) for _ in range(3)]
        open_run: list[np.ndarray] = []
        last = None

        def done(found):
            a = pa.array([x for x, _ in found], pa.int64())
            return pa.RecordBatch.from_arrays([a, pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for b in batches:
            plane, key, fp = (np.asarray(b.column(i).to_numpy(zero_copy_only=False), np.int64) for i in range(3))
            if not len(fp):
                continue
            new = np.flatnonzero(np.concatenate(([True], (plane[1:] != plane[:-1]) | (key[1:] != key[:-1]))))
            runs = np.split(fp, new[1:])
            found = []
            if last == (plane[0], key[0]):
                open_run.append(runs[0])
                runs = runs[1:]
            if runs:
                if open_run:
                    found += spanning_links(np.concatenate(open_run), bits)
                for r in runs[:-1]:
                    if len(r) > 1:
                        found += spanning_links(r, bits)
                open_run = [runs[-1]]
            last = (plane[-1], key[-1])
            if found:
                yield done(found)
        if open_run:
            yield done(spanning_links(np.concatenate(open_run), bits))

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _grouped(docs: DataFrame, shingle: int, bits: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """All rows' fingerprints, and for each fingerprint the first row of its group."""
    prepare(docs.sparkSession)
    rows = materialise(fingerprints(docs, shingle, seed), "simhash-fps")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tid")
    nodes = materialise(rows.groupBy("fp").agg(F.min(row).alias("least")), "simhash-nodes")
    roots = connected_components(links(nodes.select("fp"), bits))
    placed = materialise(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                         .withColumn("root", F.coalesce("root", "fp")), "simhash-placed")
    # written before they are joined: a group or fingerprint that holds a third of all rows is then split
    least = materialise(placed.groupBy("root").agg(F.min("least").alias("first")), "simhash-least")
    return rows, materialise(placed.select("fp", "root").join(least, "root").select("fp", "first"), "simhash-first")


def simhash_groups(docs: DataFrame, shingle: int = 3, bits: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id`` (smallest ``doc_id`` reachable over links of at most
    ``bits`` bits).

    Null and empty texts have no words and the fingerprint zero, which links
    like any other. Texts of fewer words than a shingle are one shingle.
    Very long texts are read in steps of a megabyte, whole. Rows repeated under
    an id are rows of their own. Null ids are reachable but never the smallest (``component_id`` is null if all are). An empty
    table gives no rows; other columns are ignored.
    """
    rows, first = _grouped(docs, shingle, bits, seed)
    return rows.join(first, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         F.col("first.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, seed: int = 42) -> DataFrame:
    """One row of every group, with all its columns: the one with the smallest
    ``doc_id`` (null ids last; texts of one id in the order of their hash).
    Null, empty and wordless texts have the fingerprint zero and form a group
    like any other; rows repeated under one id and text leave one. An empty
    table stays empty."""
    _, first = _grouped(docs, shingle, bits, seed)
    stays = first.select(row_key("first.doc_id").alias("id"), F.col("first.tid").alias("tid")).distinct()
    return first_of_repeated(docs, F.xxhash64("text"), stays)
