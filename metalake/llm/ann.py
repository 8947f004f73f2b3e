"""Approximate nearest neighbours in a hierarchical k-means tree.

The tree is fitted on a bounded sample and holds only centroids; every vector
is indexed under its leaf. A query walks the tree best bin first: a priority
queue over nodes, keyed by the inner product with their centroid, yields the
leaves in the order of their promise. How many of them are visited is
calibrated: a set of calibration queries is answered by brute force over all
vectors, and visits widen until the wanted share of their true neighbours
lies in the visited leaves.

The radius of every leaf bounds the inner product that a query can have in it;
once a query has its first neighbours, leaves that cannot reach their scores
are left out. Leaves are cut into blocks of bounded size, and so are the queries that visit
a leaf; each task scores one block of vectors against one block of queries
and passes on the best of each query: after a few leaves only what reaches the
score that the query's best already have.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, prepare

RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass
class Tree:
    centroids: np.ndarray    # one row per node, the root first
    first: np.ndarray        # first child of each node; children are neighbours
    children: np.ndarray     # number of children, 0 for a leaf
    leaf: np.ndarray         # leaf number, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def leaf_centroids(self) -> np.ndarray:
        out = np.zeros((self.leaves, self.centroids.shape[1]))
        out[self.leaf[self.leaf >= 0]] = self.centroids[self.leaf >= 0]
        return out

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: at every level the child with the nearest centroid."""
        node = np.zeros(len(x), np.int64)
        while True:
            inner = self.children[node] > 0
            if not inner.any():
                return self.leaf[node]
            for v in np.unique(node[inner]):
                rows = np.flatnonzero(node == v)
                c = self.centroids[self.first[v]:self.first[v] + self.children[v]]
                near = x[rows] @ c.T - 0.5 * (c * c).sum(axis=1)
                node[rows] = self.first[v] + near.argmax(axis=1)

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, v = heapq.heappop(queue)
            if not self.children[v]:
                yield int(self.leaf[v])
                continue
            at = int(self.first[v])
            promise = self.centroids[at:at + self.children[v]] @ q
            for i, p in enumerate(promise.tolist()):
                heapq.heappush(queue, (-p, at + i))


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        label = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        used = np.unique(label)
        c = np.stack([x[label == j].mean(axis=0) for j in used])
        if len(used) == 1:
            break
    return c, (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)


def grow(sample: np.ndarray, per_leaf: float, branching: int = 16, seed: int = 5) -> Tree:
    """Split nodes of more than ``per_leaf`` sampled vectors."""
    rng = np.random.default_rng(seed)
    centroids, first, children, leaf = [sample.mean(axis=0)], [0], [0], [-1]
    queue, leaves = [(0, sample)], 0
    while queue:
        node, x = queue.pop(0)
        k = int(min(branching, len(x) // 2, np.ceil(2 * len(x) / per_leaf)))
        c = label = None
        if len(x) > per_leaf and k > 1:
            c, label = _k_means(x, k, rng)
        if c is None or len(c) < 2 or len(np.unique(label)) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        first[node], children[node] = len(centroids), len(c)
        for j in range(len(c)):
            queue.append((len(centroids), x[label == j]))
            centroids.append(c[j])
            first.append(0)
            children.append(0)
            leaf.append(-1)
    return Tree(np.array(centroids), np.array(first), np.array(children), np.array(leaf))


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(flat.flatten(), np.float64).reshape(-1, dim)


def _top(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best rows for one query: picked by the block product, with all
    rows that rounding could have put behind, then scored row by row."""
    rough = np.where(ids == own, -np.inf, rough)
    if len(rough) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        near = np.flatnonzero(rough >= least - 1e-9 * max(1.0, abs(least)))
    else:
        near = np.arange(len(rough))
    near = near[np.isfinite(rough[near])]
    score = (x[near] * q).sum(axis=1)
    best = np.lexsort((ids[near], -score))[:k]
    return ids[near][best], score[best]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of the vectors that take part: no null,
    no null or non-finite component, not zero, and of the commonest length."""
    e = F.col("embedding")
    sound = (e.isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists(e, lambda x: x != 0))
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding")).where(F.coalesce(sound, F.lit(False)))
    sizes = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    return good.where(F.size("embedding") == (sizes[0]["dim"] if sizes else 0))


def _best_of(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int, extra: str | None = None) -> DataFrame:
    """The true neighbours of a few queries, which travel to all partitions.
    ``extra`` names an integer column to carry along."""
    dim = len(queries[0][1])
    qs = np.array([q for _, q in queries], np.float64)
    own = [i for i, _ in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), dim)
            ids = np.array([-1 if i is None else i for i in b.column(0).to_pylist()])
            rough = qs @ x.T
            cols = [[], [], [], []]
            tag = np.asarray(b.column(2)) if extra else np.zeros(len(ids), np.int64)
            for j, q in enumerate(qs):
                at = np.arange(len(ids))
                pick, score = _top(at, x, q, -1, np.where(ids == own[j], -np.inf, rough[j]), k)
                cols[0] += [own[j]] * len(pick)
                cols[1] += ids[pick].tolist()
                cols[2] += score.tolist()
                cols[3] += tag[pick].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                 pa.array(cols[3], pa.int64())], names=["query_id", "vec_id", "score", "tag"])

    found = vectors.select("vec_id", "embedding", *([F.col(extra).cast("long")] if extra else []))
    return _best_of(found.mapInArrow(run, "query_id long, vec_id long, score double, tag long"), k)


def calibrate(tree: Tree, indexed: DataFrame, queries: list[tuple[int, list[float]]], k: int,
              recall: float) -> tuple[int, float]:
    """The fewest leaf visits at which ``recall`` of the true neighbours of the
    calibration queries lie in visited leaves, and the share reached."""
    truth: dict[int, list[int]] = {}
    for r in brute_force(indexed, queries, k, "leaf").select("query_id", "tag").collect():
        truth.setdefault(r["query_id"], []).append(r["tag"])
    need = []
    for i, q in queries:
        wanted = truth.get(i, [])
        left = set(wanted)
        for visit, leaf in enumerate(tree.best_bins(np.array(q)), 1):
            if leaf in left:
                left.discard(leaf)
                need += [visit] * wanted.count(leaf)
            if not left:
                break
    if not need:
        return tree.leaves, 1.0
    need.sort()
    visits = need[min(len(need), int(np.ceil(recall * len(need)))) - 1]
    return visits, sum(n <= visits for n in need) / len(need)


def _spread(salt: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(salt, F.lit(3)), blocks)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, per_leaf: int = 256,
                       sample: int = 32_768, calibration: int = 128, recall: float = 0.97,
                       block: int = 4096, first: int = 2, widen: int = 4) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each query by
    inner product, ties to the smaller id.

    Null, zero, non-finite vectors and vectors of another length than the
    commonest take no part. Queries are the rows where ``is_query`` holds; of
    rows repeated under one query id the smallest vector asks, and no row of
    that id is a candidate. Other repeated rows are candidates of their own; a
    null id is a candidate and comes last among ties. Every query goes on
    visiting leaves until they hold ``k`` candidates, so fewer rows are
    returned only where there are fewer candidates. An empty table gives no
    rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    good = materialise(usable(vectors), "ann-vectors")
    n = good.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    share = min(1.0, 1.1 * sample / n)
    dice = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30))
    some = good.where(dice < int(share * (1 << 30)) + 1).limit(sample).select("embedding").collect()
    some = some or good.limit(1).select("embedding").collect()
    x = np.array(sorted(r["embedding"] for r in some))
    dim = x.shape[1]
    tree = grow(x, max(1.0, per_leaf * len(x) / n))
    shipped = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(1), dim)
            leaf = shipped.value.assign(v) if b.num_rows else np.zeros(0, np.int64)
            off = np.linalg.norm(v - centres[leaf], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int64()), pa.array(off, pa.float64())],
                                             names=["vec_id", "embedding", "leaf", "off"])

    centres = tree.leaf_centroids()
    indexed = materialise(good.mapInArrow(place, "vec_id long, embedding array<double>, leaf long, off double"), "ann-index")
    rows = indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("off").alias("off")).collect()  # one row per leaf
    held = {r["leaf"]: r["n"] for r in rows}
    radius = np.zeros(tree.leaves)
    for r in rows:
        radius[r["leaf"]] = r["off"]
    queries = materialise(good.where(F.col("vec_id").isNotNull()).groupBy("vec_id")
                          .agg(F.min(F.when(is_query, F.col("embedding"))).alias("embedding"), F.count(F.lit(1)).alias("own"))
                          .where(F.col("embedding").isNotNull()), "ann-queries")
    trial = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(calibration).collect()
    if not trial:
        return spark.createDataFrame([], RESULT)
    visits, _ = calibrate(tree, indexed, [(r["vec_id"], list(r["embedding"])) for r in trial], k, recall)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            bins, most = [], []
            for q, own in zip(_matrix(b.column(1), dim), b.column(2).to_pylist()):
                leaves, others = [], -own  # own rows may lie in any leaf
                for leaf in shipped.value.best_bins(q):
                    if len(leaves) >= visits and others >= k:
                        break
                    leaves.append(leaf)
                    others += held.get(leaf, 0)
                bins.append(leaves)
                # no vector of a leaf can have a larger inner product with the query
                most.append((centres[leaves] @ q + np.linalg.norm(q) * radius[leaves]).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bins, pa.list_(pa.int64())), pa.array(most, pa.list_(pa.float64()))],
                                             names=["vec_id", "leaves", "most"])

    asked = (queries.mapInArrow(walk, "vec_id long, leaves array<long>, most array<double>")
             .select(F.col("vec_id").alias("query_id"), F.posexplode(F.arrays_zip("leaves", "most")).alias("visit", "at"))
             .select("query_id", "visit", F.col("at.leaves").alias("leaf"), F.col("at.most").alias("most")))
    asked = materialise(asked, "ann-visits")  # numbers only: vectors are joined to the visits that are made
    vectors_of = queries.select(F.col("vec_id").alias("query_id"), "embedding")

    def score(key: tuple[pa.Scalar, ...], asks: pa.Table, held: pa.Table) -> pa.Table:
        cols: list[list] = [[], [], []]
        if asks.num_rows and held.num_rows:
            x = _matrix(held["embedding"], dim)
            qs = _matrix(asks["embedding"], dim)
            raw = held["vec_id"].to_pylist()
            last = np.iinfo(np.int64).max
            ids = np.array([last if i is None else i for i in raw])
            for at in range(0, len(qs), 256):
                rough = qs[at:at + 256] @ x.T
                floors = asks["floor"][at:at + 256].to_pylist()
                for j, own in enumerate(asks["query_id"][at:at + 256].to_pylist()):
                    if floors[j] is not None:  # what cannot enter the query's best is not passed on
                        rough[j][rough[j] < floors[j] - 1e-9 * max(1.0, abs(floors[j]))] = -np.inf
                    got, value = _top(ids, x, qs[at + j], own, rough[j], k)
                    cols[0] += [own] * len(got)
                    cols[1] += [None if i == last else i for i in got.tolist()]
                    cols[2] += value.tolist()
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    def visit(some: DataFrame) -> DataFrame:
        """The best of each query and block over some visits (``floor``: the
        score that a query's best already reach). Leaves and queries come in
        blocks; their counts are one row per leaf of a tree of bounded size."""
        counts = F.broadcast(
            indexed.groupBy("leaf").count().withColumnRenamed("count", "held")
            .join(some.groupBy("leaf").count().withColumnRenamed("count", "visited"), "leaf")
            .select("leaf", F.ceil(F.col("held") / block).alias("vs"), F.ceil(F.col("visited") / block).alias("qs")))
        left = (some.join(counts, "leaf").withColumn("q", _spread(F.col("query_id"), F.col("qs"))).join(vectors_of, "query_id")
                .select("leaf", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)).alias("v"), "q", "query_id", "embedding", "floor"))
        right = (indexed.withColumn("nth", F.monotonically_increasing_id()).join(counts, "leaf")
                 .withColumn("v", _spread(F.col("nth"), F.col("vs")))
                 .select("leaf", "v", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"), "vec_id", "embedding"))
        by = ["leaf", "v", "q"]
        return (left.groupBy(*by).cogroup(right.groupBy(*by))
                .applyInArrow(score, "query_id long, vec_id long, score double"))

    # Visits widen by a factor; after each round a query's best set the floor
    # that candidates of further leaves have to reach to be passed on.
    best, low, high = None, 0, first
    while low < visits:
        some = asked.where((F.col("visit") >= low) & (F.col("visit") < high))
        if best is None:
            some = some.withColumn("floor", F.lit(None).cast("double"))
        else:
            # leaves whose bound lies below a query's floor are certified to hold none of its neighbours
            some = some.join(best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
                             .select("query_id", F.when(F.col("n") >= k, F.col("worst")).alias("floor")), "query_id", "left")
            some = materialise(some.where("floor IS NULL OR most >= floor - 1e-9 * greatest(1, abs(floor))"), "ann-open")
        found = visit(some)
        best = materialise(_best_of(found if best is None else best.unionByName(found), k).drop("rank"), "ann-best")
        low, high = high, high * widen
    return _best_of(best, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
