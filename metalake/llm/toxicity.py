"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the distinct hashes of its words, of the words' first
letters (so that inflected forms share evidence), of neighbouring word pairs
and of pairs with one word skipped. FTRL-proximal keeps a learning rate for
each coordinate and its L1 term leaves most weights at exactly zero: what is
broadcast is a short list of coordinates and weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import arrow_rows, held_out, prepare

_STEP = 1 << 16
_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Features(dict):
    """Distinct feature hashes of texts. Words are hashed once per worker: the
    dictionary gives a word's row in the tables of hashes. It is emptied when
    it is full."""

    PREFIXES = (4, 5, 6)

    def __init__(self, bits: int, room: int = 600_000):
        import xxhash

        super().__init__()
        self.bits, self.room, self.hash = bits, max(room, 2 * _STEP), xxhash.xxh64_intdigest
        self.words = np.zeros(self.room, np.uint64)
        self.forms = np.zeros((self.room, 1 + len(self.PREFIXES)), np.int32)
        self.fresh: list[tuple[int, ...]] = []
        self.shift = np.uint64(64 - bits)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        bare = word.strip(".,;:!?\"'()[]{}*#$%&|<>-_") or word
        h = self.hash
        self.fresh.append((h(bare), *(h(bare[:k], k) for k in self.PREFIXES)))
        return row

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self) + len(words) > self.room:
            self.clear()
        known = len(self)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            new = np.array(self.fresh, np.uint64)
            self.words[known:known + len(new)] = new[:, 0]
            self.forms[known:known + len(new)] = new >> self.shift
            self.fresh = []
        return rows

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """Feature numbers of a text of any length, a stretch of words at a time."""
        words = text.lower().split()
        for at in range(0, len(words), _STEP):
            some = words[at:at + _STEP + 2]  # two words more: pairs across the cut
            rows = self.rows(some)
            h = self.words[rows]
            pairs = (h[:-1] * _A + h[1:] * _B + np.uint64(1)) * _A >> self.shift
            skips = (h[:-2] * _A + h[2:] * _B + np.uint64(2)) * _A >> self.shift
            yield np.concatenate((self.forms[rows].ravel(), pairs.astype(np.int32), skips.astype(np.int32)))

    def of(self, text: str) -> np.ndarray:
        found = [np.unique(p) for p in self.parts(text)]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


@dataclass
class Weights:
    bits: int
    at: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.at] = self.weight
        return w


def ftrl(examples: list[tuple[int, np.ndarray]], bits: int, alpha: float, beta: float, l1: float, l2: float,
         passes: int, seed: int) -> Weights:
    """FTRL-proximal with a free intercept over (label, feature numbers)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    z0 = n0 = b = 0.0
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for k in order.permutation(len(examples)).tolist():
            y, idx = examples[k]
            zi, ni = z[idx], n[idx]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + root) / alpha + l2), 0.0)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = p - y
            g2 = g * g
            z[idx] = zi + g - (np.sqrt(ni + g2) - root) / alpha * w
            n[idx] = ni + g2
            z0 += g - (np.sqrt(n0 + g2) - np.sqrt(n0)) / alpha * b
            n0 += g2
            b = -z0 / ((beta + np.sqrt(n0)) / alpha)
    w = np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    at = np.flatnonzero(w)
    return Weights(bits, at.astype(np.int32), w[at].astype(np.float32), float(b))


def score_texts(features: Features, dense: np.ndarray, intercept: float, texts: list[str]) -> np.ndarray:
    out = np.full(len(texts), intercept)
    for i, t in enumerate(texts):
        hit = [np.zeros(0, np.int32)]
        for part in features.parts(t):
            hit.append(np.unique(part[dense[part] != 0]))  # only weights that are not zero count
        out[i] += dense[np.unique(np.concatenate(hit))].sum(dtype=np.float64)
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, max_bytes: int,
                    class_bytes: int) -> tuple[DataFrame, float]:
    """At most ``per_class`` labelled documents and ``class_bytes`` bytes of each
    class, by a hash of id and text, and the log odds to add back for taking the classes at different rates."""
    ready = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in ready.groupBy("toxic").count().collect()}
    picked = None
    for label in (0, 1):
        some = ready.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    odds = np.log(max(1, counts.get(1, 0)) / max(1, min(per_class, counts.get(1, 0)))) \
        - np.log(max(1, counts.get(0, 0)) / max(1, min(per_class, counts.get(0, 0))))
    texts = (docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
             .join(F.broadcast(picked), "doc_id"))  # at most 2 * per_class rows of two numbers
    # ids may repeat in the documents: which of their rows count does not depend on the order of tasks
    one = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), F.xxhash64("text"), "text")
    texts = (texts.withColumn("nth", F.row_number().over(one)).where(F.col("nth") <= per_class)
             .withColumn("sum", F.sum(F.octet_length("text")).over(one)).where(F.col("sum") <= class_bytes))
    return texts.select("text", "toxic"), float(odds)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, max_bytes: int = 1 << 16,
          class_bytes: int = 32 << 20, bits: int = 20,
          alpha: float = 0.5, beta: float = 1.0, l1: float = 4.0, l2: float = 1.0, passes: int = 3,
          seed: int = 11) -> Weights | None:
    sample, odds = labelled_sample(docs, labels, per_class, max_bytes, class_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for b in arrow_rows(batches, 256):
            raw = [features.of(t or "").tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(raw, pa.binary())], names=["toxic", "at"])

    # small partitions, so that no task's result is large; Arrow, so that the driver holds them once
    rows = sample.repartition(64, F.xxhash64("text")).mapInArrow(run, "toxic int, at binary").toArrow()
    if not rows.num_rows:
        return None
    examples = sorted(zip(rows["toxic"].to_pylist(), rows["at"].to_pylist()))
    weights = ftrl([(y, np.frombuffer(a, np.int32)) for y, a in examples], bits, alpha, beta, l1, l2, passes, seed)
    weights.intercept += odds
    return weights


def score_toxicity(docs: DataFrame, labels: DataFrame, columns: bool = False, **settings) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; with
    ``columns``, the documents' own columns as a struct ``row`` and ``predicted``.

    Learns ``labels.toxic`` from a bounded sample (``per_class`` documents of
    each class of at most ``max_bytes`` bytes, ``class_bytes`` in all) of rows whose crc32(doc_id) mod
    5 is not 0. Every whole text is scored; null counts as empty and scores
    by the intercept. Null ids are not held out. Without any label every
    score is 0. Rows repeated under one id are scored alike (and, in the
    sample, each counts); an empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = train(base, labels, **settings)
    model = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        features, dense = (Features(w.bits), w.dense()) if w else (None, None)
        for b in arrow_rows(batches, 512):
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            score = score_texts(features, dense, w.intercept, texts) if w else np.zeros(len(texts))
            predicted = pa.array((score >= 0.5).astype(np.int32))
            head = [b.column(0)] if columns else [b.column(0), b.column(1), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*head, predicted], names=names)

    if columns:
        names = ["row", "predicted"]
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                           F.col("text").cast("string").alias("text"))
        return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("predicted", T.IntegerType())]))
    names = ["doc_id", "held_out", "score", "predicted"]
    return (base.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text")
            .mapInArrow(run, _SCHEMA))


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns.

    Null and empty texts score by the intercept alone, repeated rows alike; a
    null id is no hindrance. Without any label nothing is dropped, and an empty
    table stays empty."""
    return score_toxicity(docs, labels, columns=True, **settings).where("predicted = 0").select("row.*")
