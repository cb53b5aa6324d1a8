"""Licence scan: named phrases, and blocks of text that contain a licence template.

Base labels come from fixed phrases whose words stand consecutively.  The
method is an exact set-similarity join of text blocks with licence templates:
a block contains a template if it holds at least a share ``threshold`` of the
template's different words.  For a template of w words the blocks are all
windows of 2 w words.  Moved on to its first template word a window loses none
of them, so windows that start at a template word hold every best share, and
only these are tried.

The words of the templates are put in the order of their frequency over all
documents, rarest first.  A template of s different words that needs o of
them must share one of its first s - o + 1 words with the block (prefix
filter).  Templates are rows, one per prefix word with its place in the order;
texts give one row per place where some prefix word stands, with the words
around it, and the two are equi-joined on the word.  Of a pair, the windows
that hold the place are tried: one needs o template words, repeats counted
(length filter), and o of the template's words from the prefix word's place in
the order on (positional filter: the pair stands for the windows whose rarest
shared word it is); what is left is compared.  Every text with a block that
meets the threshold is found, wherever the block stands.

One scan counts the templates' words (that bounded list is all that reaches
the driver), one finds phrases and places.  Texts are not shuffled, only the
rows of places that meet the threshold.  The templates, a parameter of bounded
size, are broadcast.  All DataFrame code.

Nulls and ties: a null text counts as empty (no words, no labels, score 0);
null ids and repeated rows are carried as they stand; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmarts.llm.common import stored, text_or_empty

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ on a text whose A-Z are lower-cased already: the class stated by what it holds.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]++"
THRESHOLD = 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Customary licence notices, as (label, text).
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
)


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def needed(template: str, threshold: float) -> int:
    return math.ceil(round(threshold * len(set(template.split())), 9))


def word_counts(docs: DataFrame, text_col: str, templates) -> dict[str, int]:
    """Occurrences over all documents of the templates' words (a bounded list)."""
    wanted = sorted({w for _, t in templates for w in t.split()})
    mine = F.filter(words_of(text_or_empty(text_col)), lambda w: w.isin(wanted))
    rows = (docs.select(F.explode(mine).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect())
    return {r["word"]: r["n"] for r in rows}


def prefixes(templates, threshold: float, counts: dict[str, int]) -> list[list[str]]:
    """Per template its rarest words, as many as the prefix filter needs."""
    out = []
    for _, t in templates:
        order = sorted(set(t.split()), key=lambda w: (counts.get(w, 0), w))
        out.append(order[:len(order) - needed(t, threshold) + 1])
    return out


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase's words standing consecutively."""
    parts = phrase.split()
    n = F.size(words) - len(parts) + 1

    def here(i: Column) -> Column:
        ok = F.get(words, i) == parts[0]
        for k, w in enumerate(parts[1:], 1):
            ok = ok & (F.get(words, i + k) == w)
        return ok

    return F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), here)).otherwise(F.array().cast("array<int>"))


def template_rows(spark: SparkSession, templates, threshold: float, counts: dict[str, int]) -> DataFrame:
    """One row per template and prefix word: word, place (in the order), kinds (in the order), wide, need, label."""
    rows = []
    for (label, t), prefix in zip(templates, prefixes(templates, threshold, counts)):
        order = sorted(set(t.split()), key=lambda w: (counts.get(w, 0), w))
        rows += [(w, k, order, len(t.split()), needed(t, threshold), label) for k, w in enumerate(prefix)]
    return spark.createDataFrame(rows, "word string, place int, kinds array<string>, wide int, need int, label string")


def _spots(words: Column, rare: list[str], reach: int) -> Column:
    """Places of prefix words: array<struct<at, from, word, near>>; ``near`` are the words less than ``reach`` away, from word ``from``."""
    def spot(i: Column) -> Column:
        first = F.greatest(F.lit(0), i - reach + 1)
        return F.struct(i.alias("at"), first.alias("from"), F.get(words, i).alias("word"),
                        F.slice(words, first + 1, i - first + reach).alias("near"))

    return F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(rare)), spot)


def _blocks_of(spots: DataFrame, templates: DataFrame) -> DataFrame:
    """(id, text_hash, start, label, containment) of every block that meets its template's threshold."""
    pairs = spots.join(F.broadcast(templates), "word")
    at = F.col("at") - F.col("from")  # the prefix word's place in ``near``
    own = lambda i: F.array_contains("kinds", F.get("near", i))
    starts = F.filter(F.sequence(F.greatest(F.lit(0), at - 2 * F.col("wide") + 1), at), own)
    window = lambda i: F.slice("near", i + 1, 2 * F.col("wide"))
    rest = F.slice("kinds", F.col("place") + 1, F.size("kinds"))
    tried = pairs.select("id", "text_hash", "label", "kinds", "need", F.col("from").alias("first"), rest.alias("rest"),
                         F.explode(F.transform(starts, lambda i: F.struct(i.alias("i"), window(i).alias("block")))).alias("b"))
    long_enough = F.size(F.filter("b.block", lambda w: F.array_contains("kinds", w))) >= F.col("need")
    well_placed = F.size(F.array_intersect("b.block", "rest")) >= F.col("need")
    met = tried.filter(long_enough).filter(well_placed)
    shared = F.size(F.array_intersect("b.block", "kinds"))
    return met.select("id", "text_hash", (F.col("first") + F.col("b.i")).alias("start"), "label",
                      (shared / F.size("kinds")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
         templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, n_words, places (array of start and label of the phrases), blocks (array of start, label, containment)."""
    spark = docs.sparkSession
    phrases = PHRASES if phrases is None else phrases
    counts = word_counts(docs, text_col, templates) if templates else {}
    rare = sorted({w for p in prefixes(templates, threshold, counts) for w in p})
    reach = 2 * max((len(t.split()) for _, t in templates), default=1)
    place_type, block_type = "array<struct<start:int,label:string>>", "array<struct<start:int,label:string,containment:double>>"
    spot_type = "array<struct<at:int,from:int,word:string,near:array<string>>>"
    lasts = sorted({p.split()[-1] for p in phrases})

    def labelled(label: str):
        return lambda i: F.struct(i.cast("int").alias("start"), F.lit(label).alias("label"))

    def all_places(words: Column) -> Column:
        return F.array_sort(F.concat(*[F.transform(_places(words, p), labelled(label)) for p, label in phrases.items()]))

    def found(words: Column) -> Column:
        has = lambda some: F.arrays_overlap(words, F.array(*map(F.lit, some))) if some else F.lit(False)
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.coalesce(F.when(has(lasts), all_places(words)), F.array().cast(place_type)).alias("places"),
            F.when(has(rare), _spots(words, rare, reach)).cast(spot_type).alias("spots"))

    # binding by a lambda splits each text into words once
    text = text_or_empty(text_col)
    rows = stored(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                              F.transform(F.array(words_of(text)), found)[0].alias("x"))
                  .select("id", "text_hash", "x.n_words", "x.places", "x.spots"), "licence-spots")
    spots = rows.select("id", "text_hash", F.explode("spots").alias("s")).select("id", "text_hash", "s.*")
    met = _blocks_of(spots, template_rows(spark, templates, threshold, counts)).groupBy(
        "id", "text_hash", "start", "label").agg(F.max("containment").alias("containment"))
    blocks = met.groupBy("id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "label", "containment"))).alias("blocks"))
    blocks = blocks.withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    return (rows.join(blocks, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
            .select(F.col("id").alias(id_col), "n_words", "places", F.coalesce("blocks", F.array().cast(block_type)).alias("blocks")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Counts, labels and a score per row: 1 with a base place, else the highest containment found."""
    labels = lambda *cols: F.array_join(F.array_sort(F.array_distinct(F.concat(*cols))), ",")
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("blocks", lambda b: b["label"])
    return scan(docs, id_col, text_col, **how).select(
        id_col, "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"), labels(base, more).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))).alias("score"))


def oracle(table: str = "documents", templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``report``: the window at every word of a text that holds enough of a template's words at all."""
    parts = []
    for p in PHRASES:
        ws = p.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(ws))
        parts.append((f"list_filter(range(0, len(w) - {len(ws) - 1}), lambda i: {test})", PHRASES[p]))
    blocks = []
    for label, t in templates:
        kinds, wide = sorted(set(t.split())), len(t.split())
        ts = "[" + ", ".join(f"'{k}'" for k in kinds) + "]"
        blocks.append((f"CASE WHEN len(list_intersect(w, {ts})) >= {needed(t, threshold)} THEN list_max(list_transform(range(0, len(w)), "
                       f"lambda b: len(list_intersect(w[b + 1 : b + {2 * wide}], {ts})))) END", needed(t, threshold), len(kinds), label))
    places = ", ".join(f"{e} AS p{k}" for k, (e, _) in enumerate(parts))
    shares = ", ".join(f"coalesce({e}, 0) AS s{k}" for k, (e, _, _, _) in enumerate(blocks))
    every = " || ".join(f"p{k}" for k in range(len(parts)))
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(parts))
    more = ", ".join(f"CASE WHEN s{k} >= {o} THEN '{label}' END" for k, (_, o, _, label) in enumerate(blocks))
    best = ", ".join(f"CASE WHEN s{k} >= {o} THEN s{k}::DOUBLE / {s} ELSE 0.0 END" for k, (_, o, s, _) in enumerate(blocks))
    names = lambda xs: (f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{xs}], lambda x: x IS NOT NULL))), ','), '')")
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}') AS w FROM {table}),
f AS (SELECT doc_id, len(w) AS n_words, {places}, {shares} FROM d),
g AS (SELECT *, {every} AS p FROM f)
SELECT doc_id, n_words, len(p) AS n_base, list_min(p) AS first_word, list_max(p) AS last_word,
  {names(base)} AS base_labels, {names(base + ', ' + more)} AS labels,
  CASE WHEN len(p) > 0 THEN 1.0 ELSE greatest({best}) END AS score
FROM g"""
