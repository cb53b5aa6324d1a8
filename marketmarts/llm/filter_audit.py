"""Filter interaction audit: what five filters remove, in every order they can be applied.

A document fails a filter if it has under 100 words (A), 100 * distinct words
< 80 * words (B), 100 * capitals A-Z > 10 * code points (C), one of
``#$%&*|`` (D), or the text of a document with a smaller id (E).

1. One scan of the texts leaves a digest, the bits A to D and the part of each
   row; equal (digest, part, id) are counted before anything is joined.
2. E without a group per text: the smallest id of each digest is an aggregate
   that combines before its shuffle, and rows meet it on (digest, id), so the
   copies of one text are spread by their ids.
3. Rows are counted per part and combination of the five bits: 32 cells each
   of all, of good and of toxic documents.
4. Contingency tensor contractions: the cells of a part are reshaped to
   2x2x2x2x2, and one ``einsum`` with a vector per axis - pass (1, 0), fail
   (0, 1) or all (1, 1) - reads every step of every order off them.

Only the 32 cells of a part come together in one task.

Nulls and ties: a null text counts as empty, a null part as the empty string;
a null id has no smaller one, is none, and has no labels; rows that repeat an
id with the same text are counted as often as they stand and do not make each
other fail E; an id with several label rows is good or toxic if any of them
says so; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
MARKS = "#$%&*|"
SPACES = "\t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

_OUT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
        "good_lost bigint, toxic_lost bigint, shapley bigint")


def text_bits(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``bits``: the filters A to D (1, 2, 4, 8) that column ``text`` fails."""
    words = F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")
    n, different = F.size("_words"), F.size(F.array_distinct("_words"))
    capitals = F.char_length(text) - F.char_length(F.translate(text, CAPITALS, ""))
    fails = [n < MIN_WORDS, 100 * different < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * F.char_length(text),
             F.col(text).rlike(f"[{MARKS}]")]
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    # the words are a projection of their own: each text is split once
    return docs.withColumn("_words", words).withColumn("bits", bits).drop("_words")


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, cell, n, good, toxic): documents per part and combination of failed filters (A = 1 ... E = 16)."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(text_bits(texts, "text").withColumn("digest", F.unhex(F.sha2("text", 256)))
                  .groupBy("digest", "part", "id", "bits").agg(F.count("*").alias("n")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    # null ids meet no label; as keys of their own they do not gather in one task
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("null "), F.hex("digest")))
    marks = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("string").alias("key"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    marked = rows.join(first, ["digest", "id"], "left").withColumn("key", key).join(marks, "key", "left")
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    count = lambda where: F.sum(F.when(where, F.col("n")).otherwise(0))
    return marked.groupBy("part", (F.col("bits") + F.when(copy, 16).otherwise(0)).alias("cell")).agg(
        F.sum("n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def selectors() -> dict[str, np.ndarray]:
    """Per measure one vector per (order, step) and axis: shape (orders * steps, 5, 2)."""
    def each(choose) -> np.ndarray:
        return np.array([[choose(order, order.index(f), k) for f in FILTERS]
                         for order in ORDERS for k in range(len(FILTERS))], np.int64)

    return {"kept": each(lambda order, at, k: PASS if at <= k else ALL),
            "removed": each(lambda order, at, k: PASS if at < k else FAIL if at == k else ALL),
            "failing": each(lambda order, at, k: FAIL if at == k else ALL),
            "unique_fails": each(lambda order, at, k: FAIL if at == k else PASS)}


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(measures, 2, 2, 2, 2, 2) and (rows, 5, 2) -> (measures, rows): the cells that each row selects, summed."""
    return np.einsum("mabcde,ra,rb,rc,rd,re->mr", tensor, *(chosen[:, k] for k in range(len(FILTERS))))


def _steps(table: pa.Table) -> pa.Table:
    """Cells of one part -> its row for every order and step."""
    cell = np.array(table.column("cell").to_pylist(), np.int64)
    tensor = np.zeros((3, 2, 2, 2, 2, 2), np.int64)
    for m, name in enumerate(("n", "good", "toxic")):
        tensor[(m, *((cell >> k) & 1 for k in range(len(FILTERS))))] = table.column(name).to_numpy()
    by = {k: contract(tensor, v) for k, v in selectors().items()}
    removed = by["removed"][0]
    steps = len(FILTERS)
    filter_at = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    total = np.zeros(steps, np.int64)
    np.add.at(total, filter_at, removed)
    return pa.table({
        "part": pa.array([table.column("part")[0].as_py()] * len(filter_at), pa.string()),
        "filter_order": [order for order in ORDERS for _ in range(steps)],
        "step": pa.array([k + 1 for _ in ORDERS for k in range(steps)], pa.int32()),
        "kept": by["kept"][0], "removed": removed, "redundant": by["failing"][0] - removed,
        "unique_fails": by["unique_fails"][0], "good_lost": by["removed"][1], "toxic_lost": by["removed"][2],
        "shapley": total[filter_at]})


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; ``shapley`` sums a filter's removed over all orders."""
    return cells(docs, labels, id_col, text_col, part_col).groupBy("part").applyInArrow(_steps, _OUT)


def oracle() -> str:
    """DuckDB SQL for ``audit``: the first failed filter of each cell in each order."""
    orders = ", ".join(f"('{o}')" for o in ORDERS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS m FROM d),
f AS (SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
  || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN m < doc_id THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
o AS (SELECT filter_order, step, filter_order[step] AS letter FROM (VALUES {orders}) v(filter_order), range(1, 6) s(step)),
x AS (SELECT c.*, o.*, contains(fails, letter) AS bad,
  coalesce(list_min([instr(filter_order, u) FOR u IN string_split(fails, '') IF u <> '']), 6) AS first_at FROM c, o),
s AS (SELECT part, filter_order, step, letter, sum(n) FILTER (first_at > step) AS kept, sum(n) FILTER (first_at = step) AS removed,
  sum(n) FILTER (bad AND first_at < step) AS redundant, sum(n) FILTER (fails = letter) AS unique_fails,
  sum(good) FILTER (first_at = step) AS good_lost, sum(toxic) FILTER (first_at = step) AS toxic_lost
  FROM x GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley FROM s"""
