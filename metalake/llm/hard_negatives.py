"""Hard negatives from lists that clusters of anchors share.

Anchors are clustered by direction. For an anchor a of a cluster with centre c
and radius r (the largest angle between a member and c), the angle to a
candidate x is at least angle(x, c) - r, so a.x is at most |a| times
|x| cos(max(0, angle(x, c) - r)). That bound does not depend on the member: the
candidates are sorted by it once per cluster, and every member walks the list
from the top until |a| times the bound falls below the score that it still
needs. What has not been walked is then certified not to count.

Anchors and candidates come in groups and blocks of bounded size, and a task
holds one group against one block; its best rows go to a ranking over all
blocks. Positives come first, because their scores set the window of the
negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ann import grow
from .common import materialise, prepare

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: Stands for a null id, which comes last among ties.
_LAST = np.iinfo(np.int64).max
#: Numbers in the sample that the clusters are fitted on.
_SAMPLED = 1 << 21


def integral(vectors: DataFrame, is_anchor: Column, label: Column, scale: int) -> DataFrame:
    """``vec_id, label, asks, vec`` of the rows that take part; a component x
    becomes floor(``scale`` * x), kept as a double, which holds it exactly.
    Inner products need one length: the commonest (ties: the smallest)."""
    e = F.col("embedding").cast("array<double>")
    sound = F.size(F.filter(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))) == 0
    # Spark's floor gives a long; beyond 2^53 a double has no fraction.
    whole = F.transform(e, lambda x: F.when(F.abs(x * scale) < 2.0 ** 53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    good = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("string").alias("label"),
                           F.coalesce(is_anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("asks"),
                           F.when(e.isNotNull() & sound, whole).alias("vec"))
            .where("label IS NOT NULL AND vec IS NOT NULL"))
    sizes = good.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    return good.where(F.size("vec") == (sizes[0]["dim"] if sizes else 0))


def _matrix(rows: pa.Table, dim: int) -> np.ndarray:
    return np.asarray(rows["vec"].combine_chunks().flatten(), np.float64).reshape(rows.num_rows, dim)


def angular_bounds(members: np.ndarray, items: np.ndarray) -> np.ndarray:
    """For every item the largest inner product that it can have with a member
    of length one, from its angle to the members' centre. Items and members
    may be zero. A margin covers rounding."""
    length, norms = (np.linalg.norm(x, axis=1) for x in (members, items))
    units = members[length > 0] / length[length > 0, None]
    centre = units.sum(axis=0)
    size = np.linalg.norm(centre)
    if not size > 1e-9:
        return norms * (1 + 1e-6)
    centre /= size
    radius = np.arccos(np.clip(units @ centre, -1, 1)).max()
    angle = np.arccos(np.clip(items @ centre / np.where(norms > 0, norms, 1), -1, 1))
    return norms * (np.cos(np.maximum(0, angle - radius - 1e-6)) + 1e-6)


class SharedList:
    """A block of candidates in the order of a cluster's bounds."""

    def __init__(self, members: np.ndarray, items: np.ndarray, times: int):
        # Doubles hold all scores, and ``times`` as much, exactly; else Python's integers do.
        top = [float(np.abs(x).max(initial=0)) for x in (members, items)]
        exact = top[0] * top[1] * max(1, items.shape[1]) * times < 2 ** 53
        bounds = angular_bounds(members, items) if exact else np.full(len(items), np.inf)
        self.order = np.argsort(-bounds, kind="stable")
        self.bounds = bounds[self.order]
        self.lengths = np.linalg.norm(members, axis=1) if exact else np.ones(len(members))
        items = items[self.order]
        self.members, self.items = (members, items) if exact else (_integers(members), _integers(items))
        self.walked = 0

    def walk(self, least: list[float], step: int = 512) -> Iterator[tuple[int, slice, np.ndarray]]:
        """Goes down the list in growing steps, for all members that are not
        done: yields member, places and scores. ``least[i]`` is the score below
        which member ``i`` needs nothing; the caller raises it on the way."""
        alive, at = np.arange(len(self.members)), 0
        while at < len(self.items):
            alive = alive[self.lengths[alive] * self.bounds[at] >= np.array(least, np.float64)[alive]]
            if not len(alive):
                return
            places = slice(at, min(len(self.items), at + step))
            scores = self.members[alive] @ self.items[places].T
            self.walked += scores.size
            for i, row in zip(alive.tolist(), scores):
                yield i, places, row
            at, step = places.stop, 2 * step


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


class _Task:
    """One group of anchors and one block of candidates, cluster by cluster."""

    def __init__(self, asks: pa.Table, held: pa.Table, dim: int, times: int):
        self.asks, self.held, self.times = asks, held, times
        self.x, self.y = _matrix(asks, dim), _matrix(held, dim)
        self.own, self.ids = (np.array([_LAST if i is None else i for i in t["vec_id"].to_pylist()], np.int64) for t in (asks, held))
        codes = pa.concat_arrays([t["label"].combine_chunks() for t in (asks, held)]).dictionary_encode().indices.to_numpy()
        self.labels = codes[:asks.num_rows], codes[asks.num_rows:]

    def lists(self) -> Iterator[tuple[np.ndarray, SharedList]]:
        cluster = np.asarray(self.asks["cluster"])
        for c in np.unique(cluster):
            rows = np.flatnonzero(cluster == c)
            yield rows, SharedList(self.x[rows], self.y, self.times)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: int = 256, per_cluster: int = 128, group: int = 2048,
                   block: int = 16_384, sample: int = 16_384) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its first ``positives`` other rows of its label;
    for each, the first ``negatives`` rows of other labels are returned whose
    score is ``low`` to ``high`` percent of the positive's. Rows come by
    falling inner product of the integral vectors, ties by smaller id.

    Rows with a null label, a null vector or a null or non-finite component
    take no part, nor do vectors of another length than the commonest. Zero
    vectors score 0. Rows under the anchor's own id are never its candidates;
    other repeated rows are candidates of their own, and an anchor's repeated
    rows ask each for themselves. A null id is no anchor, but a candidate that
    comes last among ties. Scores are exact; one beyond a long raises an
    error. An empty table gives no rows; other columns are ignored.

    Clusters are fitted on at most ``sample`` anchors (and two million
    numbers) and hold about ``per_cluster`` of them; all anchors and all rows
    are used.
    """
    spark = vectors.sparkSession
    prepare(spark)
    good = materialise(integral(vectors, is_anchor, label, scale), "negatives-vectors")
    anchors = materialise(good.where("asks").drop("asks").withColumn("nth", F.monotonically_increasing_id()), "negatives-anchors")
    n, m = good.count(), anchors.count()
    if not m:
        return spark.createDataFrame([], RESULT)
    dim = anchors.select(F.size("vec")).first()[0]
    groups, blocks = -(-m // group), -(-n // block)
    some = (anchors.orderBy(F.xxhash64("vec_id", "vec"), "nth").limit(min(sample, max(1, _SAMPLED // max(1, dim))))
            .select("vec").toArrow())
    asks = materialise(_clustered(anchors, _matrix(some, dim), m, dim, per_cluster)
                       .withColumn("g", F.pmod("cluster", F.lit(groups))), "negatives-asks")
    items = good.select("vec_id", "label", "vec", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("b"))

    def against(left: DataFrame, fn, schema: str) -> DataFrame:
        """Every group of anchors meets every block of candidates."""
        a = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
        b = items.select("vec_id", "label", "vec", "b", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("g"))
        return a.groupBy("g", "b").cogroup(b.groupBy("g", "b")).applyInArrow(fn, schema)

    def alike(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of an anchor's own label."""
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            task = _Task(left, right, dim, high)
            for rows, shared in task.lists():
                best: list[tuple] = [((), ())] * len(rows)
                least = [-np.inf] * len(rows)
                for i, places, scores in shared.walk(least):
                    at = shared.order[places]
                    fit = np.flatnonzero((task.labels[1][at] == task.labels[0][rows[i]]) & (task.ids[at] != task.own[rows[i]])
                                         & (scores >= least[i]))
                    best[i] = _merged(best[i], scores[fit], task.ids[at[fit]], positives)
                    if len(best[i][0]) == positives:
                        least[i] = best[i][0][-1]
                for i, row in enumerate(rows.tolist()):
                    out[0] += [left["nth"][row].as_py()] * len(best[i][0])
                    out[1] += best[i][1]
                    out[2] += best[i][0]
        return _table(("nth", "vec_id", "score"), out)

    def unlike(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of other labels in the window of each positive."""
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            task = _Task(left, right, dim, high)
            wanted = left["scores"].to_pylist()
            for rows, shared in task.lists():
                windows = [[(-(-low * p // 100), high * p // 100) for p in wanted[r]] for r in rows]
                best: list[list[tuple]] = [[((), ())] * len(w) for w in windows]
                needs = [[lo if lo <= hi else np.inf for lo, hi in w] for w in windows]
                least = [float(min(x, default=np.inf)) for x in needs]
                for i, places, scores in shared.walk(least):
                    at = shared.order[places]
                    fit = np.flatnonzero((task.labels[1][at] != task.labels[0][rows[i]]) & (task.ids[at] != task.own[rows[i]])
                                         & (scores >= least[i]))
                    for j, (_, most) in enumerate(windows[i]):
                        pick = fit[(scores[fit] >= needs[i][j]) & (scores[fit] <= most)]
                        best[i][j] = _merged(best[i][j], scores[pick], task.ids[at[pick]], negatives)
                        if len(best[i][j][0]) == negatives:
                            needs[i][j] = best[i][j][0][-1]
                    least[i] = float(min(needs[i], default=np.inf))
                for i, row in enumerate(rows.tolist()):
                    for j, (scores, ids) in enumerate(best[i]):
                        out[0] += [left["nth"][row].as_py()] * len(ids)
                        out[1] += [j + 1] * len(ids)
                        out[2] += ids
                        out[3] += scores
        return _table(("nth", "place", "vec_id", "score"), out)

    order = [F.desc("score"), F.col("vec_id").asc_nulls_last()]
    near = against(asks, alike, "nth long, vec_id long, score long")
    near = materialise(near.withColumn("place", F.row_number().over(Window.partitionBy("nth").orderBy(*order)))
                       .where(F.col("place") <= positives), "negatives-positives")
    scores = near.groupBy("nth").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("near"))  # `positives` at most
    far = against(asks.join(scores.select("nth", F.col("near.score").alias("scores")), "nth"), unlike,
                  "nth long, place long, vec_id long, score long")
    far = (far.withColumn("rank", F.row_number().over(Window.partitionBy("nth", "place").orderBy(*order)))
           .where(F.col("rank") <= negatives))
    return (far.select("nth", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near.select("nth", F.col("place").cast("long").alias("place"), F.col("vec_id").alias("positive_id"),
                              F.col("score").alias("positive_score")), ["nth", "place"])
            .join(asks.select("nth", F.col("vec_id").alias("anchor_id")), "nth")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _clustered(anchors: DataFrame, sampled: np.ndarray, m: int, dim: int, per_cluster: int) -> DataFrame:
    """``anchors`` with their ``cluster``: a leaf of a tree over directions;
    leaves that hold more than ``per_cluster`` are dealt into several."""
    def units(x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(length > 0, length, 1)

    tree = grow(units(sampled), max(1.0, per_cluster * len(sampled) / m))
    shipped = anchors.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = shipped.value.assign(units(_matrix(pa.Table.from_batches([b]), dim))) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int64())], names=[*b.schema.names, "leaf"])

    placed = materialise(anchors.mapInArrow(place, "vec_id long, label string, vec array<double>, nth long, leaf long"),
                         "negatives-leaves")
    parts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / per_cluster).alias("parts"))
    return (placed.join(parts, "leaf")
            .withColumn("cluster", F.xxhash64("leaf", F.pmod(F.xxhash64("nth"), F.col("parts")))).drop("leaf", "parts"))


def _merged(best: tuple, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list]:
    """Scores and ids of the ``k`` first of both, by falling score, then rising id."""
    if not len(scores):
        return best
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        near = near[np.lexsort((ids[near], -scores[near]))[:k]]
        scores, ids = scores[near], ids[near]
    both = sorted(zip((-s for s in [*best[0], *map(int, scores)]), [*best[1], *ids.tolist()]))[:k]
    return [-s for s, _ in both], [i for _, i in both]


def _table(names: tuple[str, ...], columns: list[list]) -> pa.Table:
    return pa.table({name: pa.array([None if name == "vec_id" and v == _LAST else v for v in values], pa.int64())
                     for name, values in zip(names, columns)})
