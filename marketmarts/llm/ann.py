"""Approximate nearest neighbours over balanced posting lists.

A bounded sample is split by halves along its widest direction until every
cell holds the same number of vectors; the cells' means are the centroids.
Their neighbours form an in-memory graph (the nearest ones and a few far
ones) that is searched best first.

Every row is indexed: its vector goes to its nearest centroid's list and, if
it lies near a border, also to lists whose centroid is at most
``1 + border`` times as far, up to ``copies`` lists.  A query searches the
graph and reads the lists whose centroid is at most ``1 + reach`` times as
far as its nearest one, and further lists in order of distance until they
hold ``least`` times the wanted neighbours.  Distances are then exact.

Lists are read in two rounds: first the nearest ones, as many as the square
root of their number; the k-th distance found there is the query's bound.
From the other lists only rows within it leave their task, since no other can
enter the result.

Lists of a hot region are dealt into parts of about ``part_rows`` rows, equal
vectors are indexed once with the ids that can matter, and a task compares
one part with the queries that read its list.  The centroids (about
``max_lists``) and their links are all that is sent to every task.

Vectors of different lengths have no distance.  Every length has lists of its
own, in proportion to its share of the sample; a length that the sample does
not hold has one list, which all its queries read.

Nulls and ties: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; repeated rows count
once; ties go to the smaller id; candidates of a query are the rows of its
length; with no more than k candidates all are returned; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import stored
from marketmarts.llm.vectors import Batches, distinct_vectors, finite, ranked

SAMPLE_ROWS = 20_000
LIST_ROWS = 128
MAX_LISTS = 2048
PART_ROWS = 4096
BORDER = 0.1
COPIES = 3
REACH = 0.13
LEAST = 40
SEED = 11


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """Means of cells of equal size: each cell is halved at the median along the line between two far points."""
    rng = np.random.default_rng(seed)
    cells = [np.arange(len(sample))]
    while len(cells) < lists and max(map(len, cells)) > 1:
        cells.sort(key=len)
        cell = cells.pop()
        x = sample[cell]
        far = x[((x - x[rng.integers(len(x))]) ** 2).sum(axis=1).argmax()]
        other = x[((x - far) ** 2).sum(axis=1).argmax()]
        order = np.argsort(x @ (other - far), kind="stable")
        half = len(order) // 2
        cells += [cell[order[:half]], cell[order[half:]]]
    return np.array([sample[c].mean(axis=0) for c in cells if len(c)])


def centroid_links(centroids: np.ndarray, near: int = 16, far: int = 4, seed: int = SEED) -> list[np.ndarray]:
    """Per centroid its links: near ones, a few far ones, the next one, and all that link to it."""
    n = len(centroids)
    rng = np.random.default_rng(seed)
    norms = (centroids**2).sum(axis=1)
    links = []
    for i in range(n):
        d = norms - 2 * centroids @ centroids[i]
        close = np.argsort(d, kind="stable")[:near + 1]
        links.append(set(close.tolist()) | set(rng.integers(n, size=far).tolist()) | {(i + 1) % n})
    for i in range(n):
        for j in list(links[i]):
            links[j].add(i)
    return [np.array(sorted(x - {i}), np.int64) for i, x in enumerate(links)]


class CentroidGraph:
    """Centroids with their links; searched best first.  Built in tasks from the arrays they are sent."""

    def __init__(self, centroids: np.ndarray, links: list[np.ndarray]):
        self.centroids, self.links = centroids, links

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of about the ``width`` nearest, ascending."""
        n = len(self.centroids)
        if n <= width:
            d = np.sqrt(((self.centroids - x) ** 2).sum(axis=1))
            order = np.argsort(d, kind="stable")
            return order, d[order]
        met = np.zeros(n, bool)
        first = np.unique(np.linspace(0, n - 1, 8).astype(int))
        met[first] = True
        dist = np.sqrt(((self.centroids[first] - x) ** 2).sum(axis=1))
        open_, best = [], []
        for d, i in zip(dist.tolist(), first.tolist()):
            heapq.heappush(open_, (d, i))
            heapq.heappush(best, (-d, i))
        while open_:
            d, i = heapq.heappop(open_)
            if len(best) >= width and d > -best[0][0]:
                break
            fresh = self.links[i][~met[self.links[i]]]
            if not len(fresh):
                continue
            met[fresh] = True
            for dj, j in zip(np.sqrt(((self.centroids[fresh] - x) ** 2).sum(axis=1)).tolist(), fresh.tolist()):
                if len(best) < width or dj < -best[0][0]:
                    heapq.heappush(open_, (dj, j))
                    heapq.heappush(best, (-dj, j))
                    if len(best) > width:
                        heapq.heappop(best)
        best = sorted((-d, i) for d, i in best)
        return np.array([i for _, i in best]), np.array([d for d, _ in best])

    def reached(self, x: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """All centroids within ``1 + share`` of the nearest distance that a widening search finds."""
        width = 32
        while True:
            ids, d = self.search(x, width)
            if len(ids) == len(self.centroids) or d[-1] > (1 + share) * d[0]:
                near = d <= (1 + share) * d[0]
                return ids[near], d[near]
            width *= 2


def nearest(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
            sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS,
            part_rows: int = PART_ROWS, border: float = BORDER, copies: int = COPIES, reach: float = REACH,
            least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query row, with Euclidean distances."""
    spark = vectors.sparkSession
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = stored(vectors.filter(F.col(id_col).isNotNull() & finite(F.col(vec_col))).select(
        F.col(id_col).cast("bigint").alias("id"), vec.alias("vec"), is_query.alias("asks"))
        .filter(F.exists("vec", lambda x: x != 0)), "ann-rows")
    points = stored(distinct_vectors(rows, k + 1), "ann-points")
    n = points.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample: dict[int, list] = {}
    for v in points.select("vec").orderBy(F.xxhash64("vec")).limit(sample_rows).toArrow().column("vec").to_pylist():
        sample.setdefault(len(v), []).append(v)
    sampled = sum(map(len, sample.values()))
    arrays = {}
    for dim, vecs in sample.items():
        share = len(vecs) / sampled
        found = balanced_centroids(np.array(vecs), int(max(1, min(-(-max_lists * share // 1), len(vecs), -(-n * share // list_rows)))))
        arrays[dim] = found, centroid_links(found)
    shared = spark.sparkContext.broadcast(arrays)  # about max_lists centroids with some 40 links each
    parts = max(1, -(-n * copies // (sum(len(c) for c, _ in arrays.values()) * part_rows)))

    def graphs() -> dict[int, CentroidGraph]:
        return {dim: CentroidGraph(*a) for dim, a in shared.value.items()}

    def indexed(batches: Batches) -> Batches:
        by_length = graphs()
        for b in batches:
            where, lists_ = [], []
            for i, v in enumerate(b.column(0)):
                g = by_length.get(len(v))
                if g is None:
                    where.append(i)
                    lists_.append(0)
                    continue
                ids, d = g.search(np.array(v.as_py()), 16)
                for j in ids[d <= (1 + border) * d[0]][:copies].tolist():
                    where.append(i)
                    lists_.append(j)
            t = b.take(pa.array(where, pa.int32()))
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(lists_, pa.int32())], names=["vec", "ids", "list"])

    dim = F.size("vec").alias("dim")
    postings = stored(points.mapInArrow(indexed, "vec array<double>, ids array<bigint>, list int").select("*", dim), "ann-lists")
    held = {k: np.zeros(len(c), np.int64) for k, (c, _) in arrays.items()}
    for r in postings.filter(F.col("dim").isin(list(held))).groupBy("dim", "list").count().collect():  # one row per list
        held[r["dim"]][r["list"]] = r["count"]
    sizes = spark.sparkContext.broadcast(held)

    def probes(batches: Batches) -> Batches:
        by_length = graphs()
        for b in batches:
            where, lists_, early = [], [], []
            for i, v in enumerate(b.column(0)):
                g, size = by_length.get(len(v)), sizes.value.get(len(v))
                if g is None:
                    where.append(i)
                    lists_.append(0)
                    early.append(True)
                    continue
                x = np.array(v.as_py())
                ids, _ = g.reached(x, reach)
                wide = len(ids)
                while size[ids].sum() < least * k * copies and len(ids) < len(size):
                    wide *= 2
                    ids, _ = g.search(x, wide)
                where += [i] * len(ids)
                lists_ += ids.tolist()
                early += (np.arange(len(ids)) < np.sqrt(len(ids))).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(where, pa.int32())), pa.array(lists_, pa.int32()),
                                              pa.array(early, pa.bool_())], names=["vec", "list", "early"])

    asked = rows.filter("asks").select("id", "vec").distinct()
    asking = stored(asked.select("vec").distinct().mapInArrow(probes, "vec array<double>, list int, early boolean")
                    .select("*", dim), "ann-asking")
    dealt = postings.withColumn("part", F.pmod(F.xxhash64("vec"), F.lit(parts)).cast("int"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if len(left) and len(right):
            x = np.array(right.column("vec").to_pylist())
            ids = right.column("ids").to_pylist()
            for q, bound in zip(left.column("vec").to_pylist(), left.column("bound").to_pylist()):
                d = np.sqrt(((x - np.array(q)) ** 2).sum(axis=1))
                edge = min(np.partition(d, min(k, len(d) - 1))[min(k, len(d) - 1)], bound)
                hits = sorted((d[r], v) for r in np.flatnonzero(d <= edge).tolist() for v in ids[r])[:k + 1]
                out_q += [q] * len(hits)
                out_v += [v for _, v in hits]
                out_s += [float(s) for s, _ in hits]
        return pa.table({"q": pa.array(out_q, pa.list_(pa.float64())), "vec_id": pa.array(out_v, pa.int64()),
                         "score": pa.array(out_s, pa.float64())})

    def hits(some: DataFrame) -> DataFrame:
        each = some.select("vec", "dim", "list", "bound", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        key = ["dim", "list", "part"]
        return each.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(
            compare, "q array<double>, vec_id bigint, score double").distinct()

    no_bound = F.lit(float("inf"))
    early = stored(ranked(hits(asking.filter("early").withColumn("bound", no_bound)), ["q"], F.asc("score"), k + 1), "ann-early")
    bounds = early.filter(F.col("rank") == k + 1).select(F.col("q").alias("vec"), F.col("score").alias("bound"))
    late = hits(asking.filter("not early").join(bounds, "vec", "left").withColumn("bound", F.coalesce("bound", no_bound)))
    found = ranked(early.drop("rank").union(late).distinct(), ["q"], F.asc("score"), k + 1).drop("rank")
    mine = asked.select(F.col("id").alias("query_id"), F.col("vec").alias("q"))
    others = mine.join(found, "q").filter("vec_id <> query_id")
    return ranked(others, ["query_id", "q"], F.asc("score"), k).select("query_id", "rank", "vec_id", "score")
