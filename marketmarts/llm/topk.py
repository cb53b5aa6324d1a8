"""Exact top-k by inner product: aggregation of sorted lists without random access.

Vectors become integers, floor(64 x).  Different candidate vectors are dealt
into blocks of about ``block_rows``; a block keeps, per dimension, its
vectors in descending order of the component.  A query reads the lists of the
dimensions it uses, from the top where its component is positive and from the
bottom where it is negative, deeper in steps of a share of the block.  For every vector met
it holds the sum of what was read, a lower bound (unread lists at their worst
value) and an upper bound (unread lists at the value just read).  Reading
stops when neither an unseen vector nor all but a few of the seen ones can
still reach the k-th lower bound; the scores of these few are then resolved
from the block's rows.  Upper bounds equal to the k-th lower bound stay in,
so ties are decided by id.

Queries meet all candidates block by block: each query block (packed, of
bounded size) goes to each candidate block.  That product is of blocks, and
all it emits are k + 1 rows per query and block.

Nulls and ties: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows with a null id; equal vectors are scored
once and share the result; repeated rows count once; a query meets only
vectors of its own length; with fewer than k candidates all are returned;
scores are exact, and a score or component beyond 64 bits fails the job; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import stored
from marketmarts.llm.vectors import Batches, distinct_vectors, finite, packed, ranked

SCALE = 64
BLOCK_ROWS = 2048
QUERY_ROWS = 512
FIRST_DEPTH = 64
FEW = 256


class SortedLists:
    """One block: per dimension the components in descending order, and each row's place in that order.

    At depth t exactly the rows placed among the first t of a list (the last
    t, for a negative weight) have been read from it.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        n, width = x.shape
        order = np.argsort(-x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, order, axis=0).astype(np.float64)
        self.place = np.empty((n, width), np.int32)
        np.put_along_axis(self.place, order, np.arange(n, dtype=np.int32)[:, None], axis=0)
        self.place_up = n - 1 - self.place
        self.largest = float(np.abs(x).max(initial=0))

    def top(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the (rows, scores) that hold the k best rows of the block and all that tie with them.

        What has been read at a depth depends on a weight's sign only, so the
        bounds of all queries still reading are two matrix products each.
        """
        n, width = self.x.shape
        whole = [(np.arange(n), None)] * len(queries)
        span = self.largest * float(np.abs(queries).max(initial=0)) * width
        if n > max(k, FEW) and span < 1 << 53:
            # sums of whole numbers below 2^24 are exact in single precision, below 2^53 in double
            kind = np.float32 if span < 1 << 24 else np.float64
            x = self.x.astype(kind)
            falling, rising = np.maximum(queries, 0).astype(kind).T, np.minimum(queries, 0).astype(kind).T
            top, bottom = self.sorted[0].astype(kind), self.sorted[-1].astype(kind)
            reading = np.arange(len(queries))
            depth, step = 0, max(FIRST_DEPTH, n // 8)
            while len(reading):
                depth, step = min(n, depth + step), max(step, n // 4)
                down, up = self.place < depth, self.place_up < depth
                edge_down, edge_up = self.sorted[depth - 1].astype(kind), self.sorted[n - depth].astype(kind)
                f, r = falling[:, reading], rising[:, reading]
                lower = np.where(down, x, bottom) @ f + np.where(up, x, top) @ r
                least = np.partition(lower, n - k, axis=0)[n - k]
                settled = (edge_down @ f + edge_up @ r < least) | (depth == n)  # else an unseen row could still qualify
                upper = np.where(down, x, edge_down) @ f[:, settled] + np.where(up, x, edge_up) @ r[:, settled]
                alive = upper >= least[settled]
                few = (alive.sum(axis=0) <= FEW) | (depth == n)
                for j, q in zip(np.flatnonzero(few), reading[settled][few]):
                    whole[q] = (np.flatnonzero(alive[:, j]), None)
                reading = np.setdiff1d(reading, reading[settled][few], assume_unique=True)
        if span >= 1 << 62:  # beyond 64-bit sums: Python's integers, and a score that is no bigint fails the job
            return [(rows, self.x[rows].astype(object) @ q.astype(object)) for (rows, _), q in zip(whole, queries)]
        return [(rows, self.x[rows] @ q) for (rows, _), q in zip(whole, queries)]


def _deal(rows: DataFrame, name: str, per_block: int) -> tuple[DataFrame, int]:
    blocks = max(1, -(-rows.count() // per_block))
    return rows.withColumn(name, F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int")).withColumn("dim", F.size("vec")), blocks


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows of every query row."""
    too_large = F.raise_error(F.lit(f"a component times {scale} reaches 2^62")).cast("bigint")
    grid = F.transform(F.col(vec_col), lambda x: F.when(F.abs(x.cast("double") * scale) >= 2.0**62, too_large).otherwise(
        F.floor(x.cast("double") * scale)))
    rows = stored(vectors.filter(F.col(id_col).isNotNull() & finite(F.col(vec_col))).select(
        F.col(id_col).cast("bigint").alias("id"), grid.alias("vec"), is_query.alias("asks")), "topk-rows")
    asked = stored(rows.filter("asks").select("id", "vec").distinct(), "topk-queries")
    candidates, n_blocks = _deal(stored(distinct_vectors(rows, k + 1), "topk-vectors"), "block", block_rows)
    questions = asked.select("vec").distinct()
    questions, _ = _deal(stored(questions.withColumn("ids", F.array().cast("array<bigint>")), "topk-questions"), "part", query_rows)
    blocks = packed(candidates, ["dim", "block"], "<i8")
    parts = packed(questions, ["dim", "part"], "<i8").select(
        F.col("dim").alias("q_dim"), "part", F.col("n").alias("q_n"), F.col("vecs").alias("q_vecs"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("q_block"))
    # both sides dealt to one task per block: the work of a block is far larger than its bytes
    parts = parts.repartition(n_blocks, "q_dim", "q_block")
    pairs = parts.join(blocks.repartition(n_blocks, "dim", "block"), (F.col("q_dim") == F.col("dim")) & (F.col("q_block") == F.col("block"))).select(
        "dim", "block", "vecs", "ids", "q_vecs")

    def run(batches: Batches) -> Batches:
        at, lists, ids = None, None, None
        for b in batches:
            for i in range(b.num_rows):
                dim, block = (b.column(c)[i].as_py() for c in (0, 1))
                if at != (dim, block):
                    x = np.frombuffer(b.column(2)[i].as_py(), "<i8").reshape(-1, dim)
                    at, lists, ids = (dim, block), SortedLists(x), b.column(3)[i].as_py()
                out = []
                asked_here = np.frombuffer(b.column(4)[i].as_py(), "<i8").reshape(-1, dim)
                for q, (hit, scores) in zip(asked_here, lists.top(asked_here, k + 1)):
                    best = np.argsort(-scores, kind="stable")
                    edge = scores[best[min(k, len(best) - 1)]] if len(best) else 0
                    found = sorted((-int(s), v) for r, s in zip(hit[scores >= edge], scores[scores >= edge]) for v in ids[r])
                    out += [(q.tolist(), v, -s) for s, v in found[:k + 1]]
                if out:
                    q, v, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.list_(pa.int64())), pa.array(v, pa.int64()), pa.array(s, pa.int64())],
                                                     names=["q", "vec_id", "score"])

    found = ranked(pairs.mapInArrow(run, "q array<bigint>, vec_id bigint, score bigint"), ["q"], F.desc("score"), k + 1)
    mine = asked.select(F.col("id").alias("query_id"), F.col("vec").alias("q"))
    others = mine.join(found.drop("rank"), "q").filter("vec_id <> query_id")
    return ranked(others, ["query_id", "q"], F.desc("score"), k).select("query_id", "rank", "vec_id", "score")
