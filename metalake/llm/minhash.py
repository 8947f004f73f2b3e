"""MinHash near-duplicates of word shingles.

Every set of shingles gets the minima of many universal hash functions. Bands
of minima are the keys of buckets in which similar sets meet; the share of
equal minima sifts the pairs of a bucket, and pairs that remain are compared
on their full sets. With 32 bands of 4 minima a pair at a similarity of 0.8
misses all buckets with a probability of 5e-8, and the signature check leaves
out pairs more than six standard deviations below the threshold. Of a band
six bytes of a hash are kept, of a minimum its last byte: equal ones stay
equal, so that no pair is lost; one in 256 unequal minima counts as equal.

Pairs of a bucket are not all emitted. First its smallest row is compared with
its other members, and links that hold join components (alternating
large-star and small-star); in most groups of copies this settles the bucket.
Buckets that still hold several components are compared in blocks: the
strangers of a bucket with each other and with its commonest component, and
each task passes on a spanning forest of the links that its full sets hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialise, prepare, sieved, text_bytes
from .components import connected_components

_ROWS = "row long, doc_id long, digest binary, n_shingles long, words binary, bands binary, signature binary"
_SEED = np.uint64(0x9E3779B97F4A7C15)
#: Bytes kept of a band's hash.
_BAND = 6


def words_of(text: bytes) -> list[bytes]:
    """A-Z folded words between space, tab, line feed, vertical tab, form feed and return."""
    return text.lower().split()


def shingles(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``size`` words; fewer words are one run, none is the empty set."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)]))


def packed(words: list[bytes]) -> bytes:
    """A sequence of words as it is kept and shuffled."""
    return zstandard.compress(b" ".join(words), 1)


def unpacked(kept: bytes) -> list[bytes]:
    return zstandard.decompress(kept).split()


def hash_family(hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift functions x -> (a x + b mod 2^64) >> 32, a universal family over 32 bits."""
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 1 << 63, hashes, np.uint64) << np.uint64(1) for _ in range(2))
    return a | np.uint64(1), b | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _SEED
    return x ^ (x >> np.uint64(29))


def signature(keys: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 512) -> np.ndarray:
    """Minimum of every function over the 32-bit ``keys`` of a set."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(keys), step):
        np.minimum(least, (keys[at:at + step, None] * a + b).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(">u4")


def band_bytes(minima: np.ndarray, bands: int) -> bytes:
    """``_BAND`` bytes of a hash of every band's minima."""
    key = np.zeros(bands, np.uint64)
    for column in minima.astype(np.uint64).reshape(bands, -1).T:
        key = _mixed(key * _SEED + column)
    return key.astype(">u8").view(np.uint8).reshape(bands, 8)[:, :_BAND].tobytes()


def signatures(docs: DataFrame, size: int, bands: int, hashes: int, seed: int) -> DataFrame:
    """One row per document: the packed sequence of its words, its SHA-256, the
    number of distinct shingles, the hashes of the bands of their set's
    signature and the last byte of each minimum."""
    a, b = hash_family(hashes, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 128):
            texts = [words_of(t) for t in text_bytes(batch.column(2))]
            held = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
            known = held.dictionary.to_pylist()
            word_hash = np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest()) for w in known], np.uint64)
            code = held.indices.to_numpy().astype(np.int64)
            counts, keys, signs, at = [], [], [], 0
            for words in texts:
                ids = code[at:at + len(words)]
                at += len(words)
                if len(ids) < size:
                    grams = ids[None, :] if len(ids) else np.zeros((0, size), np.int64)
                else:
                    grams = np.stack([ids[i:len(ids) - size + 1 + i] for i in range(size)], axis=1)
                    if size == 2:  # two word numbers fit into one
                        pairs = np.unique(grams[:, 0] * len(known) + grams[:, 1])
                        grams = np.stack([pairs // len(known), pairs % len(known)], axis=1)
                    else:
                        grams = np.unique(grams, axis=0)
                counts.append(len(grams))
                if not len(grams):
                    keys.append(None)
                    signs.append(None)
                    continue
                key = np.full(len(grams), grams.shape[1], np.uint64)
                for k in range(grams.shape[1]):
                    key = _mixed(key * _SEED + word_hash[grams[:, k]])
                minima = signature(key >> np.uint64(32), a, b)
                keys.append(band_bytes(minima, bands))
                signs.append(minima.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([hashlib.sha256(b" ".join(w)).digest() for w in texts], pa.binary()),
                 pa.array(counts, pa.int64()), pa.array([packed(w) for w in texts], pa.binary()),
                 pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                names=["row", "doc_id", "digest", "n_shingles", "words", "bands", "signature"])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, _ROWS)


def least_agreeing(hashes: int, share: int) -> int:
    """Equal minima that a pair of ``share`` percent has but for six standard deviations."""
    s = share / 100
    return max(1, int(hashes * s - 6 * (hashes * s * (1 - s)) ** 0.5))


def _agreeing(pairs: DataFrame, signs: DataFrame, hashes: int, share: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose sizes allow ``share`` percent and whose
    signatures agree in no fewer minima than such a pair nearly always does."""
    least = least_agreeing(hashes, share)
    one = lambda x: signs.select(F.col("row").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                 F.col("signature").alias(f"s_{x}"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, hashes) for i in (2, 3))
            yield batch.filter(pa.array((x == y).sum(axis=1) >= least)).select(["a", "b"])

    fit = 100 * F.least("n_a", "n_b") >= share * F.greatest("n_a", "n_b")
    return (pairs.join(one("a"), "a").join(one("b"), "b").where(fit).select("a", "b", "s_a", "s_b")
            .mapInArrow(agree, "a long, b long"))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, share: int) -> DataFrame:
    """``a, b`` of the pairs with 100 * |intersection| >= ``share`` * |union| of their full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in arrow_rows(batches, 64):
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if left != last:
                    last, held = left, shingles(unpacked(left), size)
                other = shingles(unpacked(right), size)
                both = len(held & other)
                keep.append(100 * both >= share * (len(held) + len(other) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    one = lambda x: texts.select(F.col("row").alias(x), F.col("words").alias(f"w_{x}"))
    return (pairs.join(one("b"), "b").join(one("a"), "a").select("a", "b", "w_a", "w_b")
            .mapInArrow(compare, "a long, b long"))


def banded(rows: DataFrame, bands: int) -> DataFrame:
    """``key, row`` for every band of every signature."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("bands", 1 + i * _BAND, _BAND)) for i in range(bands)])
    return rows.select(F.explode(keys).alias("key"), "row")


def star_links(active: DataFrame, near: DataFrame, size: int, share: int, hashes: int) -> DataFrame:
    """Links of every bucket's smallest row with the bucket's other members."""
    pairs = active.where("a < row").select("a", F.col("row").alias("b")).distinct()
    maybe = materialise(_agreeing(materialise(pairs, "minhash-pairs"), near, hashes, share), "minhash-maybe")
    return materialise(confirmed(maybe, near, size, share), "minhash-links")


def unsettled(active: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, row, root`` of the buckets that hold several components, without
    the smallest rows: what these link with is known."""
    rest = materialise(active.where("a < row").join(roots.withColumnRenamed("node", "row"), "row", "left")
                       .select("key", "row", F.coalesce("root", "row").alias("root")), "minhash-rest")
    several = materialise(rest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                          .where("low <> high").select("key"), "minhash-open")
    return materialise(rest.join(several, "key"), "minhash-active")


def overlaps(left: list[set], right: list[set], step: int = 8192) -> np.ndarray:
    """Sizes of all intersections, as products of incidence matrices over ``step`` shingles at a time."""
    number = {g: i for i, g in enumerate(set().union(*left) & set().union(*right))}
    at = [[np.array([number[g] for g in s if g in number], np.int64) for s in side] for side in (left, right)]
    out = np.zeros((len(left), len(right)), np.float32 if len(number) < 1 << 24 else np.float64)
    for low in range(0, len(number), step):
        x, y = (np.zeros((len(side), min(step, len(number) - low)), out.dtype) for side in at)
        for m, side in ((x, at[0]), (y, at[1])):
            for i, ids in enumerate(side):
                m[i, ids[(ids >= low) & (ids < low + step)] - low] = 1
        out += x @ y.T
    return out.astype(np.int64)


def block_links(active: DataFrame, near: DataFrame, size: int, share: int, hashes: int, block: int = 256,
                block_bytes: int = 4 << 20) -> DataFrame:
    """Links among the components of each bucket, found block by block.

    In every bucket the commonest component is left out of the left side, so
    that a large group with a few strangers costs one comparison of the
    strangers with it. A block holds about ``block`` rows and ``block_bytes``
    of packed words. Each task sifts its pairs of different components by signature,
    compares full sets, and passes on a spanning forest of its links.
    """
    least = least_agreeing(hashes, share)
    sizes = (active.join(near.select("row", F.octet_length("words").alias("bytes")), "row")
             .groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")))
    blocks = lambda n, b: F.greatest(F.ceil(n / block), F.ceil(b / block_bytes))
    plan = (sizes.groupBy("key").agg(F.max(F.struct("n", "bytes", "root")).alias("core"), F.sum("n").alias("n"),
                                     F.sum("bytes").alias("bytes"))
            .select("key", F.col("core.root").alias("core"), blocks(F.col("core.n"), F.col("core.bytes")).alias("cores"),
                    blocks(F.col("n") - F.col("core.n"), F.col("bytes") - F.col("core.bytes")).alias("others")))
    placed = active.join(materialise(plan, "minhash-plan"), "key")
    is_core = F.col("root") == F.col("core")
    nth = F.when(is_core, F.col("others") + F.pmod(F.xxhash64("row"), F.col("cores"))).otherwise(
        F.pmod(F.xxhash64("row"), F.col("others")))
    to_left = F.sequence(nth, F.col("others") + F.col("cores") - 1)
    to_right = F.sequence(F.lit(0), F.least(nth, F.col("others") - 1))
    left = placed.where(~is_core).select("key", nth.alias("i"), F.explode(to_left).alias("t"), "root", "row").join(near, "row")
    right = placed.select(F.col("key").alias("key"), nth.alias("t"), F.explode(to_right).alias("i"), F.col("root").alias("root"),
                          F.col("row").alias("row")).join(near.select(*[F.col(c).alias(c) for c in near.columns]), "row")
    by = ["key", "i", "t"]

    def compare(key: tuple[pa.Scalar, ...], a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if a.num_rows and b.num_rows:
            ids, roots, counts = ([np.asarray(t[c]) for t in (a, b)] for c in ("row", "root", "n_shingles"))
            signs_a, signs_b = (np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint8).reshape(-1, hashes) for t in (a, b))
            maybe = roots[0][:, None] != roots[1]
            if key[1].as_py() == key[2].as_py():
                maybe &= ids[0][:, None] < ids[1]
            small, large = (f(counts[0][:, None], counts[1]) for f in (np.minimum, np.maximum))
            maybe &= 100 * small >= share * large
            for i in np.flatnonzero(maybe.any(axis=1)):
                maybe[i] &= (signs_a[i] == signs_b).sum(axis=1) >= least
            rows, others = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
            if len(rows):
                sets = [[shingles(unpacked(t["words"][int(i)].as_py()), size) for i in some] for t, some in ((a, rows), (b, others))]
                both = overlaps(*sets)
                union = counts[0][rows][:, None] + counts[1][others] - both
                hit = np.argwhere((100 * both >= share * union) & maybe[np.ix_(rows, others)])
                found = forest([(int(roots[0][rows[i]]), int(roots[1][others[j]])) for i, j in hit])
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return materialise(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, "a long, b long").distinct(),
                       "minhash-block-links")


def forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of ``links`` that join what was not joined yet."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for a, b in links:
        if (x := top(a)) != (y := top(b)):
            up[x] = y
            out.append((a, b))
    return out


def near_rows(rows: DataFrame, met: DataFrame) -> DataFrame:
    """``rows`` that are in ``met`` (each ``row`` once). No semi join: Spark moves
    one below the sieve, and all rows are shuffled once ``met`` is not broadcast."""
    return sieved(rows, met, "row").join(met, "row")


def links(rows: DataFrame, firsts: DataFrame, size: int, share: int, bands: int, hashes: int) -> DataFrame:
    """``node, root`` of all linked ones among ``firsts`` (``row``), one for each
    distinct sequence of words in ``rows`` (see ``signatures``)."""
    all_keys = materialise(banded(rows.select("row", "bands").join(firsts, "row", "left_semi"), bands), "minhash-bands")
    shared = materialise(all_keys.groupBy("key").agg(F.min("row").alias("a"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("key", "a"), "minhash-shared")
    active = materialise(all_keys.join(shared, "key"), "minhash-active")
    met = materialise(active.select("row").distinct(), "minhash-met")
    # the words of rows that met no other stay where they are: only those of the others are shuffled
    near = materialise(near_rows(rows.select("row", "n_shingles", "words", "signature"), met), "minhash-near")
    roots = connected_components(star_links(active, near, size, share, hashes))
    active = unsettled(active, roots)
    if active.isEmpty():
        return roots
    more = block_links(active, near, size, share, hashes)
    if more.isEmpty():
        return roots
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def minhash_groups(docs: DataFrame, size: int = 5, share: int = 80, bands: int = 32, rows: int = 4,
                   seed: int = 1) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents link where 100 * |intersection| >= ``share`` * |union| of their
    sets of ``size``-word shingles; ``component_id`` is the smallest ``doc_id``
    reachable, ``kept`` tells whether it is the document's own.

    Null, empty and wordless texts have no shingles and link with nothing,
    not even with each other. Texts of fewer words are one shingle. Texts with the same sequence
    of words (by SHA-256) are folded before the signatures are compared; rows
    repeated under an id are rows of their own. Null ids are reachable but
    never the smallest (``component_id`` and ``kept`` are null if all are). A
    text's set is held in one task, however long the text. An empty table
    gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    hashes = bands * rows
    all_rows = materialise(signatures(docs, size, bands, hashes, seed), "minhash-rows")
    texts = all_rows.where("n_shingles > 0").groupBy("digest").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"))
    texts = materialise(texts, "minhash-texts")
    roots = links(all_rows, texts.select("row"), size, share, bands, hashes)
    placed = materialise(texts.join(roots.withColumnRenamed("node", "row"), "row", "left")
                         .select("digest", "least", F.coalesce("root", "row").alias("root")), "minhash-placed")
    smallest = materialise(placed.groupBy("root").agg(F.min("least").alias("component_id")), "minhash-smallest")
    groups = materialise(placed.join(smallest, "root").select("digest", "component_id"), "minhash-groups")
    known = all_rows.where("n_shingles > 0").select("doc_id", "n_shingles", "digest").join(groups, "digest")
    alone = all_rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    cols = ["doc_id", "n_shingles", "component_id"]
    return known.select(cols).unionByName(alone.select(cols)).withColumn("kept", F.col("doc_id") == F.col("component_id"))
