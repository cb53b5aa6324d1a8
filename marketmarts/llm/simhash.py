"""SimHash near-duplicates with pigeonring candidate pruning.

A 64-bit fingerprint is read as a ring of four 16-bit segments.  If two
fingerprints differ in at most t = 3 bits, some segment i starts a chain all
of whose prefixes stay within their proportional budget: the first l segments
from i on differ in at most l * t / 4 bits, that is 0, 1, 2 and 3 bits for
l = 1..4.  Candidates must therefore agree on a whole segment and differ in
at most one bit of the next one, so they agree on three of its four nibbles:
16 keys of 28 bits per fingerprint instead of 4 keys of 16 bits.  Within a
key the longer chains are tested before the full Hamming distance.

Rows with one key are walked breadth first, so a group of near copies yields
a spanning forest (one link per fingerprint), never all its pairs.  A key
with more than ``bucket_rows`` fingerprints is split exactly by the chains of
length 3 and 4 (two nibbles of the third and one of the fourth segment),
after which at most 2^24 different fingerprints can share a key.

Nulls and ties: null text counts as empty (fingerprint zero, linked like any
other); null ids are carried and ignored for the smallest id, so a component
with null ids only has a null id; repeated rows share fingerprint and
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmarts.llm.common import field_type, stored
from marketmarts.llm.components import components

SEED = 42
HASH_BLOCK = 1 << 15
CHAIN_BUDGET = (0, 1, 2, 3)
BUCKET_ROWS = 20_000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority bits of the XXH64 values of all word shingles (repeats included), as unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    left = n
    while left:
        size = min(left, HASH_BLOCK)
        h = np.fromiter((xxhash.xxh64_intdigest(next(grams), SEED) for _ in range(size)), np.uint64, size)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= size
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) per row; fp is the signed 64-bit image of the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {field_type(docs, id_col)}, fp bigint")


def _segment(i: int, fp: Column | None = None) -> Column:
    x = F.col("fp") if fp is None else fp
    return F.shiftrightunsigned(x, 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF).cast("long"))


def _without(seg: Column, nibbles: tuple[int, ...]) -> Column:
    mask = 0xFFFF
    for q in nibbles:
        mask &= ~(0xF << (4 * q))
    return seg.bitwiseAND(F.lit(mask).cast("long"))


def _chain_keys(fps: DataFrame) -> DataFrame:
    """16 keys per fingerprint: whole segment i, segment i+1 without one nibble."""
    keys = [F.struct(F.lit(i).alias("start"),
                     (F.shiftleft(_segment(i), 18) + F.shiftleft(_without(_segment(i + 1), (q,)), 2) + q).alias("key"))
            for i in range(4) for q in range(4)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.start", "k.key")


def _longer_keys(rows: DataFrame) -> DataFrame:
    """24 keys per row: also two nibbles of the third and one of the fourth segment."""
    third = F.element_at(F.array(*[_segment(i + 2) for i in range(4)]), F.col("start") + 1)
    fourth = F.element_at(F.array(*[_segment(i + 3) for i in range(4)]), F.col("start") + 1)
    subs = []
    for a in range(4):
        for b in range(a + 1, 4):
            for c in range(4):
                kept_of_4th = _without(fourth, tuple(q for q in range(4) if q != c))
                subs.append(F.struct(F.lit((a * 4 + b) * 4 + c).alias("way"),
                                     (F.shiftleft(_without(third, (a, b)), 16) + kept_of_4th).alias("sub")))
    return rows.select("fp", "start", "key", F.explode(F.array(*subs)).alias("s")).select(
        "fp", "start", F.xxhash64("start", "key", "s.way", "s.sub").alias("key"))


def _linked(x: np.ndarray, start: int, budget: tuple[int, ...]) -> np.ndarray:
    """Which of the xor values pass the whole chain from segment ``start``."""
    ok = np.ones(len(x), bool)
    total = np.zeros(len(x), np.int64)
    for step, most in enumerate(budget):
        seg = (x >> np.uint64(16 * ((start + step) % 4))) & np.uint64(0xFFFF)
        total += np.bitwise_count(seg)
        ok &= total <= most
    return ok


def spanning_links(fps: np.ndarray, start: int, budget: tuple[int, ...] = CHAIN_BUDGET) -> list[tuple[int, int]]:
    """Breadth-first forest over the values of one key; each value is visited once."""
    rest = np.unique(fps)
    out: list[tuple[int, int]] = []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            p = queue.pop()
            near = _linked(rest ^ p, start, budget)
            if near.any():
                hit = rest[near]
                out += [(int(p), int(h)) for h in hit]
                queue += list(hit)
                rest = rest[~near]
    return out


def _bucket_links(limit: int | None, budget: tuple[int, ...]):
    """Stream rows sorted by (start, key); groups over ``limit`` come back as rows with b null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        held: list[np.ndarray] = []
        over = False

        def batch(a, b, start, key) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(start, pa.int32()), pa.array(key, pa.int64())],
                names=["a", "b", "start", "key"])

        def passed_on(xs: np.ndarray) -> pa.RecordBatch:
            return batch(xs, [None] * len(xs), [at[0]] * len(xs), [at[1]] * len(xs))

        def close() -> list[tuple[int, int]]:
            xs = np.concatenate(held) if held else np.empty(0, np.int64)
            if over or len(xs) < 2:
                return []
            return spanning_links(xs.view(np.uint64), at[0], budget)

        for b in batches:
            fp, start, key = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edge = np.flatnonzero((np.diff(start) != 0) | (np.diff(key) != 0)) + 1
            links: list[tuple[int, int]] = []
            for lo, hi in zip([0, *edge], [*edge, len(fp)]):
                if lo == hi:
                    continue
                if (group := (int(start[lo]), int(key[lo]))) != at:
                    links += close()
                    at, held, over = group, [], False
                held.append(fp[lo:hi])
                if limit is not None and (over or sum(map(len, held)) > limit):
                    over = True
                    yield passed_on(np.concatenate(held))
                    held = []
            if links:
                xs = np.array(links, np.uint64).view(np.int64)
                yield batch(xs[:, 0], xs[:, 1], [None] * len(xs), [None] * len(xs))
        if links := close():
            xs = np.array(links, np.uint64).view(np.int64)
            yield batch(xs[:, 0], xs[:, 1], [None] * len(xs), [None] * len(xs))

    return run


def _links_of(keyed: DataFrame, limit: int | None, budget: tuple[int, ...]) -> DataFrame:
    return (keyed.repartition("start", "key").sortWithinPartitions("start", "key").select("fp", "start", "key")
            .mapInArrow(_bucket_links(limit, budget), "a bigint, b bigint, start int, key bigint"))


def links(fps: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): spanning links between different fingerprints at Hamming distance 3 or less."""
    first = stored(_links_of(_chain_keys(fps.select("fp").distinct()), bucket_rows, CHAIN_BUDGET), "simhash-links")
    crowded = _links_of(_longer_keys(first.filter("b is null").select(F.col("a").alias("fp"), "start", "key")), None,
                        CHAIN_BUDGET)
    return first.filter("b is not null").select("a", "b").unionByName(crowded.select("a", "b"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: id, fingerprint (hex), component_id, component_root (a fingerprint of the component)."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = rows.groupBy("fp").agg(F.min("id").alias("rep"))
    labels = components(links(classes, bucket_rows)).withColumnRenamed("node", "fp")
    rooted = classes.join(labels, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = rooted.select("fp", "root").join(smallest, "root")
    return rows.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", F.lower(F.lpad(F.hex("root"), 16, "0")).alias("component_root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one document per component: the one with the smallest id.

    Rows that repeat an id and its text count as one document, whose row is
    the one of smallest hash, the same in every run.  Of a component with
    null ids only, one row with a null id per different text remains.
    """
    kept = (simhash_components(docs, id_col, text_col, shingle)
            .filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_kept")).distinct())
    same = Window.partitionBy(id_col, text_col).orderBy(F.xxhash64(*docs.columns))
    return (docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept")), "left_semi")
            .withColumn("_nth", F.row_number().over(same)).filter("_nth = 1").select(*docs.columns))
