"""Skill extraction against the fixed taxonomy.

Two passes, unioned into a sorted distinct array:

* hints: each hint is stripped, lower-cased and looked up exactly;
* text:  the text is normalised (``word_haystack``) and each surface is
  tested with ``contains``.  The default ``match="substring"`` reproduces
  plain substring hits ("java" inside "javascript"); ``match="token"``
  pads and normalises each surface the same way so it must stand as a
  whole run of words.

The taxonomy has a fixed size (48 skills, 82 surfaces), so the text pass is
one code-generated expression per row: no join, no shuffle, no UDF.

For a taxonomy of thousands of surfaces, ``join_surfaces`` reads each text once
instead of once per surface: the short pieces of the text that some surface
begins with are equi-joined with the surfaces, and each pair is then verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed_values import SKILL_TAXONOMY
from .text import strip_ws, word_haystack, word_haystack_py

MATCH_MODES = ("substring", "token")


def surface_rows() -> list[tuple[str, str, int]]:
    """(skill, surface, surface_len) of every surface, lower-case."""
    return [(skill, surface.lower(), len(surface)) for skill, surfaces in SKILL_TAXONOMY.items() for surface in surfaces]


def surface_index() -> dict[str, str]:
    """surface (lower-case) -> canonical skill."""
    return {surface: skill for skill, surface, _ in surface_rows()}


def _surface_pattern(surface: str, match: str) -> str:
    if match == "substring":
        return surface.lower()
    if match == "token":
        return word_haystack_py(surface)
    raise ValueError(f"match must be one of {MATCH_MODES}, got {match!r}")


def taxonomy_frame(spark: SparkSession) -> DataFrame:
    """(skill, surface, surface_len) rows of the taxonomy, longest surface first."""
    schema = T.StructType(
        [
            T.StructField("skill", T.StringType(), False),
            T.StructField("surface", T.StringType(), False),
            T.StructField("surface_len", T.IntegerType(), False),
        ]
    )
    return spark.createDataFrame(surface_rows(), schema).orderBy(F.desc("surface_len"), "surface")


def skills_from_hints(hints: Column) -> Column:
    """ARRAY<STRING> of canonical skills named by exact (stripped, lower) hints."""
    kv = []
    for surface, canonical in surface_index().items():
        kv += [F.lit(surface), F.lit(canonical)]
    lookup = F.create_map(*kv)
    found = F.transform(
        F.coalesce(hints, F.array().cast("array<string>")),
        lambda h: F.try_element_at(lookup, F.lower(strip_ws(h))),
    )
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def matched_surfaces(haystack: Column, match: str = "substring") -> Column:
    """ARRAY<STRUCT<skill, surface>> of taxonomy surfaces found in a normalised haystack."""
    hits = []
    for canonical in sorted(SKILL_TAXONOMY):
        for s in SKILL_TAXONOMY[canonical]:
            pat = _surface_pattern(s, match)
            hits.append(
                F.when(
                    haystack.contains(F.lit(pat)),
                    F.struct(F.lit(canonical).alias("skill"), F.lit(s.lower()).alias("surface")),
                )
            )
    return F.array_compact(F.array(*hits))


def with_haystack(df: DataFrame, text: Column, name: str = "_hay") -> DataFrame:
    """Adds the normalised text once as its own column.

    The surface tests all read this column; because the alias is used many
    times and is not cheap, Catalyst keeps it in its own projection instead
    of re-inlining the regex into each of the 82 tests.
    """
    return df.withColumn(name, word_haystack(text))


def _telling(patterns: list[str]) -> list[str]:
    """Patterns of one skill that decide it: one that contains another is found only where that one is."""
    return [p for p in dict.fromkeys(patterns) if not any(o != p and o in p for o in patterns)]


def skills_in_haystack(hay: Column, match: str = "substring") -> Column:
    """ARRAY<STRING> of canonical skills whose surface occurs in a normalised haystack, sorted."""
    hits = []
    for canonical in sorted(SKILL_TAXONOMY):
        conds = [hay.contains(F.lit(p)) for p in _telling([_surface_pattern(s, match) for s in SKILL_TAXONOMY[canonical]])]
        cond = conds[0]
        for c in conds[1:]:
            cond = cond | c
        hits.append(F.when(cond, F.lit(canonical)))
    return F.array_compact(F.array(*hits))


def skills_from_text(text: Column, match: str = "substring") -> Column:
    """ARRAY<STRING> of canonical skills whose surface occurs in the text, sorted.

    For many rows prefer ``with_haystack`` + ``skills_in_haystack``.
    """
    return skills_in_haystack(word_haystack(text), match)


def extraction_text(role_raw: Column, description: Column) -> Column:
    """Text fed to the text pass: title + ' ' + description, NULLs as ''."""
    return F.concat_ws(" ", F.coalesce(role_raw, F.lit("")), F.coalesce(description, F.lit("")))


def extract(hay: Column, hints: Column, match: str = "substring") -> Column:
    """Sorted distinct union of the hint pass and the text pass (on a normalised haystack)."""
    return F.array_sort(F.array_union(skills_from_hints(hints), skills_in_haystack(hay, match)))


KEY_CHARS = 3


def _key(pattern: Column, match: str) -> Column:
    """What a surface begins with: its first word, or its first characters."""
    return F.substring_index(F.trim(pattern), " ", 1) if match == "token" else F.substring(pattern, 1, KEY_CHARS)


def _run(keys: list[str]) -> str:
    """Pattern of the runs of characters that can be one of ``keys``, all of one length, place by place."""
    return "".join("[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(set(place))) + "]" for place in zip(*keys))


def _pieces(hay: Column, match: str, keys: list[str]) -> Column:
    """Different pieces of a normalised text that can be a key: its words, or runs of as many characters as a key has."""
    if match == "token":
        return F.array_distinct(F.split(F.trim(hay), " "))
    runs = [_run([k for k in keys if len(k) == n]) for n in sorted({len(k) for k in keys})]
    # a look-ahead finds the run at every position without consuming it
    return F.flatten(F.array(*[F.array_distinct(F.regexp_extract_all(hay, F.lit(f"(?=({r}))"), F.lit(1))) for r in runs]))


def join_surfaces(texts: DataFrame, surfaces: DataFrame, id_col: str, text_col: str, match: str = "substring") -> DataFrame:
    """(id, skill, surface) for every row of ``surfaces`` (skill, surface) that occurs in a text.

    Same result as testing every surface on every text.  Surfaces without a
    character or, as tokens, without a word occur nowhere.  The keys of the
    surfaces reach the plan as a literal set, so a taxonomy may have some ten
    thousand surfaces, whatever the number of texts.
    """
    if match not in MATCH_MODES:
        raise ValueError(f"match must be one of {MATCH_MODES}, got {match!r}")
    lower = F.lower("surface")
    pattern = word_haystack(F.col("surface")) if match == "token" else lower
    table = surfaces.select("skill", lower.alias("surface"), pattern.alias("_pattern")).distinct()
    table = table.withColumn("_key", _key(F.col("_pattern"), match)).filter(F.col("_key") != "")
    keys = sorted(r[0] for r in table.select("_key").distinct().collect())
    if not keys:
        return texts.select(id_col, F.lit("").alias("skill"), F.lit("").alias("surface")).limit(0)
    pieces = _pieces(F.col("_hay"), match, keys)
    hay = with_haystack(texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), F.col("_text")).select("_id", "_hay")
    near = hay.select("_id", "_hay", F.explode(F.filter(pieces, lambda p: p.isin(keys))).alias("_key"))
    return (near.join(table, "_key").filter(F.col("_hay").contains(F.col("_pattern")))
            .select(F.col("_id").alias(id_col), "skill", "surface"))
