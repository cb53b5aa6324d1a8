"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors become integers floor(scale * x) and are packed once into blocks of at
most ``block_rows``: per dimension the values that occur in the block,
ascending, and for each vector the place of its value among them.  A round
tabulates, for each dimension, occurring value and centroid, the squared
difference; a vector's distances are then table rows gathered by its places
and summed over the dimensions, in NumPy and in 64-bit integers throughout.

The blocks are stored, so a round reads finished files and a lost executor
costs its running tasks.  Every task sums the vectors it assigned per cluster
and dimension; those sums are aggregated by Spark, and a round brings
clusters * (dimensions + 1) numbers to the driver, whatever the input.

Centroids 0, 1, ... start as the vectors with the smallest sha256 of
``<seed>:<id>``; each round assigns every vector to the nearest centroid (ties:
the smaller number) and replaces every centroid that has vectors by their
componentwise floor(sum / count).  Then vectors are assigned once more.

Nulls and ties: vectors that are null, of another length, or hold null or
non-finite components take no part; a null id takes part but is no start;
rows of equal hash start in the order of their vectors, repeated rows count
as often as they stand; with fewer vectors than clusters there are as many
clusters as vectors; a vector with a component whose integer reaches 2^27
fails the job, since distances might not fit 64 bits; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import field_type, stored
from marketmarts.llm.vectors import finite

SCALE = 1024
WIDTH = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
BLOCK_ROWS = 8192
LARGEST = 1 << 27

Batches = Iterator[pa.RecordBatch]


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int, width: int) -> DataFrame:
    """(id, vec array<bigint>) of the vectors that take part."""
    scaled = F.transform(F.col(vec_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    large = F.exists(scaled, lambda x: F.abs(x) >= LARGEST)
    failed = F.raise_error(F.lit(f"a component times {scale} reaches {LARGEST}")).cast("array<bigint>")
    vec = F.when(large, failed).otherwise(F.transform(scaled, lambda x: F.floor(x)))
    return vectors.filter((F.size(vec_col) == width) & finite(F.col(vec_col))).select(F.col(id_col).alias("id"), vec.alias("vec"))


def starts(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The first centroids, ``clusters`` rows at most."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.filter(F.col("id").isNotNull()).select("vec", by_hash.alias("h")).orderBy("h", "vec").limit(clusters)
    return np.array([r["vec"] for r in first.collect()], np.int64)


def blocks(rows: DataFrame, width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ids, n, values, sizes, places): vectors as places among the occurring values of each dimension."""
    kind = field_type(rows, "id")

    def packed(batches: Batches) -> Batches:
        ids, vecs, n = [], [], 0

        def block() -> pa.RecordBatch:
            matrix = np.concatenate(vecs)
            values, places = zip(*(np.unique(column, return_inverse=True) for column in matrix.T))
            all_ids = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), all_ids), pa.array([len(matrix)], pa.int32()),
                pa.array([np.concatenate(values).astype("<i8").tobytes()], pa.binary()),
                pa.array([np.array([len(v) for v in values], "<i4").tobytes()], pa.binary()),
                pa.array([np.array(places, "<u2").tobytes()], pa.binary())], names=["ids", "n", "values", "sizes", "places"])

        for b in batches:
            for at in range(0, b.num_rows, block_rows):
                part = b.slice(at, block_rows)
                if n and n + part.num_rows > block_rows:
                    yield block()
                    ids, vecs, n = [], [], 0
                ids.append(part.column(0))
                vecs.append(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                n += part.num_rows
        if n:
            yield block()

    return rows.select("id", "vec").mapInArrow(
        packed, f"ids array<{kind}>, n int, values binary, sizes binary, places binary")


def distances(n: int, values: bytes, sizes: bytes, places: bytes, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (n, clusters) of a block's vectors: one table per dimension, gathered and summed."""
    occurring = np.split(np.frombuffer(values, "<i8"), np.cumsum(np.frombuffer(sizes, "<i4"))[:-1])
    total = np.zeros((n, len(centroids)), np.int64)
    for dimension, (value, place) in enumerate(zip(occurring, np.frombuffer(places, "<u2").reshape(len(occurring), n))):
        table = (value[:, None] - centroids[None, :, dimension]) ** 2
        total += table[place]
    return total


def _columns(b: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(b.column(k).to_pylist() for k in ("n", "values", "sizes", "places")))


def cluster_sums(packed: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int], int, int]]:
    """Per cluster that has vectors: its number, the sums of their components, their count, their distances' sum."""
    clusters, width = centroids.shape

    def run(batches: Batches) -> Batches:
        # the last two columns: count, and distance by its two halves of 32 bits
        sums = np.zeros((clusters, width + 3), np.int64)
        for b in batches:
            for n, values, sizes, places in _columns(b):
                d = distances(n, values, sizes, places, centroids)
                nearest = d.argmin(axis=1)
                least = d.min(axis=1)
                occurring = np.split(np.frombuffer(values, "<i8"), np.cumsum(np.frombuffer(sizes, "<i4"))[:-1])
                place = np.frombuffer(places, "<u2").reshape(width, n)
                for c in np.unique(nearest).tolist():
                    mine = np.flatnonzero(nearest == c)
                    for dimension, value in enumerate(occurring):
                        sums[c, dimension] += value[place[dimension, mine]].sum()
                    sums[c, width:] += (len(mine), (least[mine] >> 32).sum(), (least[mine] & 0xFFFFFFFF).sum())
        where = np.flatnonzero(sums[:, width])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(where, width + 3), pa.int32()), pa.array(np.tile(np.arange(width + 3), len(where)), pa.int32()),
            pa.array(sums[where].ravel(), pa.int64())], names=["cluster", "what", "amount"])

    parts = packed.drop("ids").mapInArrow(run, "cluster int, what int, amount bigint")
    found: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "what").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).collect():
        found.setdefault(r["cluster"], [0] * (width + 3))[r["what"]] = int(r["amount"])
    return [(c, s[:width], s[width], (s[width + 1] << 32) + s[width + 2]) for c, s in sorted(found.items())]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: int = SEED,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per vector: id, cluster, distance, cluster_inertia, inertia and centroid_sha256 (of its cluster's final centroid)."""
    if not 0 < block_rows <= 1 << 16:
        raise ValueError("places are 16-bit numbers")
    rows = integer_vectors(vectors, id_col, vec_col, scale, width)
    kind = field_type(rows, "id")
    packed = stored(blocks(rows, width, block_rows), "centroid-blocks")
    centroids = starts(rows, clusters, seed)
    shape = f"id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], shape).withColumnRenamed("id", id_col)
    for _ in range(rounds):
        for c, sums, count, _ in cluster_sums(packed, centroids):
            centroids[c] = [s // count for s in sums]
    inertia = {c: apart for c, _, _, apart in cluster_sums(packed, centroids)}
    own = pa.array([inertia.get(c, 0) for c in range(len(centroids))], pa.int64())
    all_of_it = sum(inertia.values())
    named = pa.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])

    def assigned(batches: Batches) -> Batches:
        for b in batches:
            for ids, block in zip(b.column("ids"), _columns(b)):
                d = distances(*block, centroids)
                nearest = pa.array(d.argmin(axis=1), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    ids.values, nearest, pa.array(d.min(axis=1), pa.int64()), own.take(nearest),
                    pa.array(np.full(len(d), all_of_it), pa.int64()), named.take(nearest)],
                    names=["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return packed.mapInArrow(assigned, shape).withColumnRenamed("id", id_col)


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``cluster`` at its defaults: plain squared differences, one step of SQL per round."""
    hashed = "ORDER BY sha256('3:' || vec_id), v"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS d, arg_min(c, (d, c)) AS c FROM
  (SELECT k.r, k.vec_id, k.v, m.c, list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
   FROM k CROSS JOIN m{i} m) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""m{i + 1} AS MATERIALIZED (SELECT m.c, coalesce(n.v, m.v) AS v FROM m{i} m LEFT JOIN
  (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM
    (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(i) GROUP BY c, i) GROUP BY c) n USING (c))""")
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m0 AS MATERIALIZED (SELECT (row_number() OVER ({hashed}) - 1)::INTEGER AS c, v FROM k WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER ({hashed}) <= {clusters}),
{", ".join(steps)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN m{rounds} m USING (c)"""
