"""Exact deduplication of incoming documents against immutable snapshots.

A snapshot is a table of digests that never changes, with one static
binary-fuse filter per digest shard. Incoming digests are first grouped among
themselves (duplicates of the new batch), then screened by the filters; only
positives are joined with the snapshot's exact buckets. Every group that has
more than one row is then checked byte by byte: texts that merely share a
digest are separated.

The shards follow the number of digests, so that a filter and the work of one
task stay the same size at any scale. Groups are reduced to one row per
digest before each shuffle; a group of copies that holds a third of all rows
costs one row per input partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, arrow_rows, first_of_repeated, materialise, prepare, row_key, text_bytes

DECISIONS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


# --- binary-fuse filter -----------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class BinaryFuse8:
    """Static 3-wise binary-fuse filter with 8-bit fingerprints over distinct
    64-bit keys: about 9 bits a key, no false negatives, 1/256 false positives."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = _mix(keys, seed)
        first = (h >> np.uint64(40)) % np.uint64(segments)
        low = h & np.uint64(0xFFFFFFFFFF)
        within = [low % np.uint64(segment), (low >> np.uint64(13)) % np.uint64(segment),
                  (low >> np.uint64(26)) % np.uint64(segment)]
        places = np.stack([((first + np.uint64(i)) * np.uint64(segment) + within[i]).astype(np.int64)
                           for i in range(3)])
        prints = _mix(h, 1).astype(np.uint8)
        return places, prints

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse8:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, min(13, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        size = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))) + segment
        segments = max(1, -(-size // segment) - 2)
        for seed in range(1, 200):
            built = cls._peel(keys, seed, segment, segments)
            if built is not None:
                return cls(seed, segment, segments, built)
        raise RuntimeError("no seed gave a peelable filter")

    @classmethod
    def _peel(cls, keys, seed, segment, segments) -> np.ndarray | None:
        places, prints = cls._places(keys, seed, segment, segments)
        cells = (segments + 2) * segment
        degree = np.bincount(places.ravel(), minlength=cells)
        names = np.zeros(cells, np.int64)  # xor of the incident key numbers
        for row in places:
            np.bitwise_xor.at(names, row, np.arange(len(keys)))
        waves, left = [], len(keys)
        free = np.flatnonzero(degree == 1)
        while len(free):
            key, at = np.unique(names[free], return_index=True)
            slot = free[at]
            waves.append((key, slot))
            left -= len(key)
            touched = places[:, key]
            np.subtract.at(degree, touched.ravel(), 1)
            np.bitwise_xor.at(names, touched.ravel(), np.tile(key, 3))
            near = np.unique(touched.ravel())
            free = near[degree[near] == 1]
        if left:
            return None
        table = np.zeros(cells, np.uint8)
        for key, slot in reversed(waves):  # keys of one wave do not touch each other's slots
            p = places[:, key]
            table[slot] = 0
            table[slot] = prints[key] ^ table[p[0]] ^ table[p[1]] ^ table[p[2]]
        return table

    def contains(self, keys: np.ndarray) -> np.ndarray:
        p, prints = self._places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.cells[p[0]] ^ self.cells[p[1]] ^ self.cells[p[2]]) == prints

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.segments], "<i8").tobytes() + self.cells.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> BinaryFuse8:
        seed, segment, segments = np.frombuffer(raw[:24], "<i8").tolist()
        return cls(seed, segment, segments, np.frombuffer(raw, np.uint8, offset=24))


def _keys(digests: pa.ChunkedArray) -> np.ndarray:
    """The first eight bytes of each digest (shorter digests are padded)."""
    return np.frombuffer(b"".join(d[:8].ljust(8, b"\0") for d in digests.to_pylist()), "<u8")


# --- digests ----------------------------------------------------------------

def _digests(docs: DataFrame, digest_bytes: int, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``digest`` (the key of a group) and ``text_sha256`` of every
    whole text, lower-cased in A-Z only; with the text itself if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 256):
            texts = [t.lower() for t in text_bytes(b.column(1))]  # bytes.lower() is ASCII only
            shas = [hashlib.sha256(t).digest() for t in texts]
            cols = [b.column(0), pa.array([s[:digest_bytes] for s in shas], pa.binary())]
            cols.append(pa.array(texts, pa.binary()) if with_text else pa.array([s.hex() for s in shas]))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "digest", last])

    last = "norm" if with_text else "text_sha256"
    kind = "binary" if with_text else "string"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id long, digest binary, {last} {kind}"))


def _groups(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


# --- snapshot and screening ---------------------------------------------------

def shards_for(n: int, keys_per_shard: int = 16_384) -> int:
    return max(1, -(-n // keys_per_shard))


def _shard(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n)).alias("shard")


def build_filters(buckets: DataFrame, shards: int) -> DataFrame:
    """One binary-fuse filter per digest shard of a snapshot's buckets."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        raw = BinaryFuse8.build(_keys(group["digest"])).to_bytes()
        return pa.table({"shard": [key[0].as_py()], "filter": pa.array([raw], pa.binary())})

    return (buckets.select(_shard(shards), "digest").groupBy("shard")
            .applyInArrow(run, "shard long, filter binary"))


def screen(incoming: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Incoming groups with ``maybe``: whether the snapshot's filter holds the digest."""
    names = ["digest", "keep_id", "group_size"]

    def run(key: tuple[pa.Scalar, ...], batch: pa.Table, held: pa.Table) -> pa.Table:
        out = batch.select(names)
        if batch.num_rows and held.num_rows:
            maybe = BinaryFuse8.from_bytes(held["filter"][0].as_py()).contains(_keys(batch["digest"]))
        else:
            maybe = np.zeros(batch.num_rows, bool)
        return out.append_column("maybe", pa.array(maybe))

    return (incoming.select(_shard(shards), *names).groupBy("shard")
            .cogroup(filters.groupBy("shard"))
            .applyInArrow(run, "digest binary, keep_id long, group_size long, maybe boolean"))


# --- the operator -------------------------------------------------------------

def exact_dedup(docs: DataFrame, digest_bytes: int = 32, keys_per_shard: int = 16_384) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null equals empty.
    Of equal texts the row with the largest ``doc_id`` stays (a null id is
    smaller than any other; if all are null, ``keep_id`` is null and one row
    stays). Rows repeated with the same id and text are members like any
    other, and exactly one of them stays. An empty table gives no rows; other
    columns are ignored. ``digest_bytes`` may shorten the screening digest;
    the byte check keeps results exact for any length.

    The older half of the ids is the immutable snapshot, the rest is the
    incoming batch.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = materialise(_digests(docs, digest_bytes), "dedup-digests")
    middle = rows.agg(F.percentile_approx("doc_id", 0.5, 1000)).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    shards = shards_for(rows.count(), keys_per_shard)

    buckets = _groups(rows.where(old), "digest")
    incoming = _groups(rows.where(~old), "digest")
    screened = screen(incoming, build_filters(buckets, shards), shards)
    positives = screened.where("maybe").select("digest", F.col("keep_id").alias("new_id"),
                                               F.col("group_size").alias("new_size"))
    fresh = screened.where(~F.col("maybe")).drop("maybe")
    # A positive that the exact buckets do not hold was a false one: it stays a group of its own.
    met = buckets.join(positives, "digest", "full_outer").select(
        "digest", F.greatest("keep_id", "new_id").alias("keep_id"),
        (F.coalesce("group_size", F.lit(0)) + F.coalesce("new_size", F.lit(0))).alias("group_size"))
    groups = materialise(met.unionByName(fresh), "dedup-groups")

    # Byte check of all groups of several rows, one text per group and map task.
    checked = (_digests(docs, digest_bytes, with_text=True)
               .join(groups.where("group_size > 1").select("digest"), "digest", "left_semi"))
    mixed = materialise(checked.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b"))
                        .where("a <> b").select("digest"), "dedup-mixed")
    out = _decide(rows.join(mixed, "digest", "left_anti"), groups, "digest") if not mixed.isEmpty() \
        else _decide(rows, groups, "digest")
    if not mixed.isEmpty():
        apart = (_digests(docs, digest_bytes, with_text=True).join(mixed, "digest", "left_semi")
                 .withColumn("text_sha256", F.sha2("norm", 256)))
        out = out.unionByName(_decide(apart, _groups(apart, "digest", "norm"), "digest", "norm"))
    return out


def _decide(rows: DataFrame, groups: DataFrame, *by: str) -> DataFrame:
    """Each row beside its group. Rows are folded to one per (group, id) first
    and unfolded after, so that repeated rows need no row number."""
    folded = rows.groupBy("doc_id", *dict.fromkeys([*by, "text_sha256"])).agg(F.count(F.lit(1)).cast("int").alias("n"))
    met = folded.join(groups, list(by))
    return (met.select("*", F.posexplode(F.sequence(F.lit(1), "n")).alias("nth", "_"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 0))
            .select(*DECISIONS))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Null and empty texts are equal and leave one row; of rows repeated under
    one id and text the first stays; null ids are smaller than any other. An
    empty table stays empty."""
    kept = exact_dedup(docs).where("kept").select(row_key("doc_id").alias("id"), F.col("text_sha256").alias("tid"))
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, UPPER.lower())
    return first_of_repeated(docs, F.sha2(lower.cast("binary"), 256), kept)
