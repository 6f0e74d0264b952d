"""Nearest neighbours from balanced posting lists on storage and a graph of centroids in memory.

* *Points.*  Equal vectors are one point that keeps its least ids, one more than are asked
  for; no other id of the group can be in an answer, because ties go to smaller ids.
* *Centroids.*  A sample of at most ``SAMPLE`` points is halved at the median along its widest
  direction until the parts are small, which makes parts of equal size; a few rounds of
  assignment follow that charge full lists.  There are at most ``LISTS`` centroids, so they
  and the graph of their neighbours have a bounded size and are sent to the tasks.
* *Lists.*  Every point is looked up in the graph and goes to its nearest centroid and to those
  of the next ``REPLICAS - 1`` that are at most ``1 + REPLICATE`` times as far: points on a
  boundary are in the lists of both sides.
* *Search.*  A query goes to the lists whose centroids are at most ``1 + PRUNE`` times as far as
  the nearest that, with those before it, are home to one id more than asked for: many where
  lists lie close together, few elsewhere.  A query that still comes back short is searched
  once more in all lists.  Lists are cut in blocks, and all queries of a list are compared
  with a block at once, in double precision.

Vectors that are null or zero, hold a null, NaN or infinite component, or differ in length
from most of the table take no part, nor do null ids.  Rows that share the query's id are not
its candidates.  A table without a query row, or with it alone, gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselens.llm.common import sample_by_hash
from caselens.storage import settle

SAMPLE, LISTS, LIST_POINTS = 1 << 15, 1 << 11, 256
REPLICATE, REPLICAS = 0.1, 6
#: On vectors without any structure, lists overlap so much that half of them are within this ratio.
PRUNE, PROBES = 0.35, 256
DEGREE, BEAM = 24, 32
#: Points of a block, and parts that a list is dealt to.
BLOCK, DEAL = 512, 8
#: Queries whose best points a task holds at once.
HELD = 1 << 15


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding: the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    # A negative zero is a zero, also to hashes.
    plain = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return rows.where(F.size("embedding") == (sizes["n"] if sizes else -1)).withColumn("embedding", plain)


def points_of(rows: DataFrame, keep: int) -> DataFrame:
    """point, embedding, ids: distinct vectors with their ``keep`` least ids.  The rank is cut before rows are shuffled."""
    by = Window.partitionBy("embedding").orderBy("vec_id")
    # Rows that are repeated count once.
    least = rows.select("vec_id", "embedding").distinct().withColumn("r", F.row_number().over(by)).where(F.col("r") <= keep)
    return least.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select(
        F.xxhash64("embedding").alias("point"), "embedding", "ids"
    )


@dataclass(frozen=True)
class Graph:
    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray
    #: The median distance from a sampled point to its centroid.
    usual: float = 0.0

    def nearest(self, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids near each row of x, nearest first, by best-first search of all rows side by side."""
        rows, beam = len(x), min(BEAM + most, len(self.centroids))
        at = np.arange(rows)[:, None]
        ids = np.broadcast_to(self.entries, (rows, len(self.entries))).copy()
        dist = self._squared(x, ids)
        fresh = np.ones(ids.shape, bool)
        while True:
            best = np.where(fresh, dist, np.inf).argmin(1)
            open_ = fresh[at[:, 0], best]
            if not open_.any():
                break
            go = np.flatnonzero(open_)
            fresh[go, best[go]] = False
            new = self.neighbours[ids[go, best[go]]]
            known = (new[:, :, None] == ids[go][:, None, :]).any(2)
            far = np.where(known, np.inf, self._squared(x[go], new))
            all_ids, all_dist = np.concatenate([ids[go], new], 1), np.concatenate([dist[go], far], 1)
            all_fresh = np.concatenate([fresh[go], ~known], 1)
            order = np.argsort(all_dist, 1, kind="stable")[:, :beam]
            if ids.shape[1] < order.shape[1]:
                pad = order.shape[1] - ids.shape[1]
                ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
                dist = np.pad(dist, ((0, 0), (0, pad)), constant_values=np.inf)
                fresh = np.pad(fresh, ((0, 0), (0, pad)))
            pick = np.arange(len(go))[:, None]
            ids[go], dist[go], fresh[go] = all_ids[pick, order], all_dist[pick, order], all_fresh[pick, order]
            fresh &= np.isfinite(dist)
        order = np.argsort(dist, 1, kind="stable")[:, :most]
        return ids[at, order], np.sqrt(np.maximum(dist[at, order], 0))

    def _squared(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        c = self.centroids[ids]
        return ((c - x[:, None, :]) ** 2).sum(2)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 6) -> np.ndarray:
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        parts.sort(key=len)
        part = parts.pop()
        if len(part) < 2:
            parts.append(part)
            break
        centred = sample[part] - sample[part].mean(0)
        direction = centred[np.abs(centred).sum(1).argmax()]
        for _ in range(3):  # power iteration: the widest direction
            direction = centred.T @ (centred @ direction)
            direction /= np.linalg.norm(direction) or 1.0
        order = np.argsort(centred @ direction, kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    centres = np.stack([sample[p].mean(0) for p in parts])
    charge = np.zeros(len(centres))
    usual = len(sample) / len(centres)
    for _ in range(rounds):
        squared = (sample**2).sum(1)[:, None] - 2 * sample @ centres.T + (centres**2).sum(1)
        scale = np.median(squared.min(1))
        home = (squared + charge * scale).argmin(1)
        size = np.bincount(home, minlength=len(centres))
        charge += 0.2 * (size / usual - 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def centroid_graph(centres: np.ndarray) -> Graph:
    """Each centroid with its nearest others, and a step to the next one so that the graph is in one piece."""
    k = len(centres)
    degree = min(DEGREE, k - 1)
    near = np.zeros((k, degree + 1), np.int64)
    for start in range(0, k, 512):
        part = centres[start : start + 512]
        d = (part**2).sum(1)[:, None] - 2 * part @ centres.T + (centres**2).sum(1)
        d[np.arange(len(part)), np.arange(start, start + len(part))] = np.inf
        near[start : start + 512, :degree] = np.argsort(d, 1, kind="stable")[:, :degree]
    near[:, degree] = (np.arange(k) + 1) % k
    return Graph(centres, near, np.unique(np.linspace(0, k - 1, min(32, k)).astype(np.int64)))


def fit(points: DataFrame) -> Graph | None:
    n = points.count()
    if not n:
        return None
    few = sample_by_hash(points.withColumn("h", F.xxhash64("point", F.lit(5))), "h", n, SAMPLE)
    sample = _matrix(few.select("embedding").toArrow().column("embedding").combine_chunks())
    lists = max(1, min(LISTS, n // LIST_POINTS, len(sample) // 8))
    found = centroid_graph(balanced_centroids(sample, lists))
    return replace(found, usual=float(np.median(found.nearest(sample[:1024], 1)[1])))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def assigned(
    points: DataFrame, graph, ratio: float, most: int, least: float = 0.0, sizes: np.ndarray | None = None, need: int = 0
) -> DataFrame:
    """point, embedding, ids, home, list: each point with the lists within ``1 + ratio`` times the nearest distance.

    ``home``: the list is the nearest.  ``least``: a nearest distance below it counts as this, so that a query that is a
    centroid itself looks around.  ``sizes``: with the ids at home in each list, the distance of the list that fills up
    ``need`` ids counts as the nearest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = graph.value
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists, dist = g.nearest(_matrix(batch.column("embedding")), most)
                real = (lists >= 0) & np.isfinite(dist)
                near = np.maximum(dist[:, :1], least)
                if sizes is not None:
                    enough = np.cumsum(np.where(real, sizes[lists], 0), 1) >= need
                    near = np.maximum(near, np.where(enough, dist, np.inf).min(1, keepdims=True))
                use = (dist <= (1 + ratio) * near) & real
                row, col = np.nonzero(use)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(col == 0), pa.array(lists[row, col])], names=[*taken.schema.names, "home", "list"])

    return points.select("point", "embedding", "ids").mapInArrow(
        run, "point long, embedding array<double>, ids array<bigint>, home boolean, list long"
    )


def blocks_of(rows: DataFrame, deal: int, size: int) -> DataFrame:
    """list, points, vectors, ids, at_home: the rows of a list in blocks, and how many of the ids are at home in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(key: int) -> pa.RecordBatch:
            got = pa.Table.from_batches(held.pop(key)).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([got.column("point").to_pylist()], pa.list_(pa.int64())),
                 pa.array([_matrix(got.column("embedding")).tobytes()], pa.binary()),
                 pa.array([got.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                 pa.array([sum(map(len, got.filter(got.column("home")).column("ids").to_pylist()))], pa.int64())],
                names=["list", "points", "vectors", "ids", "at_home"])

        for batch in batches:
            lists = batch.column("list").to_numpy()
            for key in np.unique(lists):
                part = held.setdefault(int(key), [])
                part.append(batch.filter(pa.array(lists == key)))
                if sum(p.num_rows for p in part) >= size:
                    yield block(int(key))
        for key in list(held):
            yield block(key)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, F.col("list"), F.pmod("point", F.lit(deal))).mapInArrow(
        run, "list long, points array<bigint>, vectors binary, ids array<array<bigint>>, at_home long"
    )


def compared(queries: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """point, ids, score: the k nearest points to each query among the blocks that a task has met.

    A task keeps the best of up to ``HELD`` queries while it walks its blocks, so what it hands on doesn't
    grow with the number of blocks.
    """
    both = lists.join(queries.select("list", F.col("points").alias("q_points"), F.col("vectors").alias("q_vectors")), "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int, list[int]]]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(point, ids, d) for point, near in best.items() for d, _, ids in near]
            best.clear()
            point, ids, score = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(point, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(score, pa.float64())],
                names=["point", "ids", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c: batch.column(c)[row]  # noqa: E731, B023
                q_points, ids = get("q_points").as_py(), get("ids").as_py()
                q = np.frombuffer(get("q_vectors").as_py()).reshape(len(q_points), -1)
                x = np.frombuffer(get("vectors").as_py()).reshape(len(ids), -1)
                for name, one in zip(q_points, q):
                    d = np.sqrt(((x - one) ** 2).sum(1))
                    near = best.get(name, [])
                    most = near[-1][0] if len(near) == k else np.inf
                    if len(d) > k:
                        most = min(most, np.partition(d, k - 1)[k - 1])
                    new = {ids[j][0]: (float(d[j]), ids[j][0], ids[j]) for j in np.flatnonzero(d <= most).tolist()}
                    if new:
                        best[name] = sorted({**{n[1]: n for n in near}, **new}.values(), key=lambda n: n[:2])[:k]
                if len(best) > HELD:
                    yield flush()
        yield flush()

    return both.select("points", "vectors", "ids", "q_points", "q_vectors").mapInArrow(
        run, "point long, ids array<bigint>, score double"
    )


def search(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    points = settle(points_of(rows, k + 1), "points")
    asked = settle(
        rows.where(F.col("vec_id") % every == 0).select(
            F.col("vec_id").alias("query_id"), F.xxhash64("embedding").alias("point"), "embedding").distinct(), "queries")
    empty = "query_id long, rank int, vec_id long, score double"
    fitted = fit(points)
    if fitted is None:
        return spark.createDataFrame([], empty)
    graph = spark.sparkContext.broadcast(fitted)
    lists = settle(blocks_of(assigned(points, graph, REPLICATE, REPLICAS), DEAL, BLOCK), "posting-lists")
    sizes = np.zeros(len(fitted.centroids), np.int64)
    for r in lists.groupBy("list").agg(F.sum("at_home").alias("n")).collect():
        sizes[r["list"]] = r["n"]
    wanted = points.join(asked.select("point").distinct(), "point", "left_semi")
    first = settle(
        answered(asked, assigned(wanted, graph, PRUNE, PROBES, fitted.usual, sizes, k + 1), lists, k), "neighbours")
    short = first.where(F.size("near") < k)
    if len(sizes) > 1 and not short.isEmpty():
        left = short.select("query_id", "point")
        everywhere = points.join(left.select("point").distinct(), "point", "left_semi").select(
            "point", "embedding", "ids", F.lit(False).alias("home"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(sizes) - 1).cast("long"))).alias("list"))
        first = first.where(F.size("near") >= k).unionByName(answered(left, everywhere, lists, k))
    return first.select("query_id", F.posexplode("near").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def answered(asked: DataFrame, placed: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """query_id, point, near: the k nearest (score, vec_id) in the lists that each query is ``placed`` in."""
    found = compared(blocks_of(placed, 1, BLOCK), lists, k + 1)
    # A point met in two lists is one answer; a point gives each of its ids.
    answers = found.select("point", F.explode("ids").alias("vec_id"), "score").distinct()
    by = Window.partitionBy("point").orderBy("score", "vec_id")
    best = answers.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1)
    # One id more than asked for, for the query itself; it may be a repeated id and stand twice.
    per = best.groupBy("point").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    return asked.join(per, "point").select(
        "query_id", "point", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
