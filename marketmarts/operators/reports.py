"""Trend and dashboard reports over staged postings and the salary mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import FAMILY_LABELS, ROLE_LABELS, TOP_SKILLS_PER_FAMILY
from ..functions.salary import week_ending_sunday
from .percentile import grouped_percentiles, quantile_col

FAMILIES = tuple(FAMILY_LABELS)  # fixed set of role families (pivot columns)


def weekly_volume(postings_df: DataFrame, ts_col: str = "fetched_at", family_col: str = "role_family") -> DataFrame:
    """Postings per (week ending Sunday, family); rows without a time are dropped."""
    return (
        postings_df.filter(F.col(ts_col).isNotNull())
        .groupBy(week_ending_sunday(F.col(ts_col)).alias("week_ending"), F.col(family_col).alias("role_family"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weekly_pivot(weekly: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """Families as columns, missing weeks/families as 0, and ``unlisted`` for all families not given.

    The pivot values are given, so Spark needs no extra job to find them.
    """
    listed = F.coalesce(F.col("role_family").isin(list(families)), F.lit(False))
    named = weekly.withColumn("role_family", F.when(listed, F.col("role_family")).otherwise("unlisted"))
    return named.groupBy("week_ending").pivot("role_family", [*families, "unlisted"]).agg(F.sum("n")).na.fill(0)


def disclosure_rate(postings_df: DataFrame) -> DataFrame:
    """Share of postings with a disclosed salary and posting count per family."""
    return postings_df.groupBy("role_family").agg(
        F.avg(F.col("salary_disclosed").cast("int")).alias("disclosed_share"),
        F.count(F.lit(1)).alias("n"),
    )


def skill_counts(postings_df: DataFrame) -> DataFrame:
    """(role_family, skill, n): postings per family mentioning each skill."""
    from .marts import skill_counts as _counts

    return _counts(postings_df).select("role_family", "skill", F.col("n_postings").alias("n"))


def top_skills_per_family(postings_df: DataFrame, k: int = TOP_SKILLS_PER_FAMILY) -> DataFrame:
    """The k most mentioned skills of each family (ties by skill name).

    The window sees one row per (family, skill); both are fixed small
    sets, so no window partition grows with the data.
    """
    w = Window.partitionBy("role_family").orderBy(F.desc("n"), F.asc("skill"))
    return skill_counts(postings_df).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def salary_kpis(cells: DataFrame, by: Sequence[str] = ("role_canonical",)) -> DataFrame:
    """KPI row per group of salary cells: totals, disclosure rate, median p50/p75 (truncated).

    One pass: each cell is unpivoted into a p50 row and a p75 row (the
    cell counts ride on the p50 row only), and one grouped percentile over
    (group, metric) yields both medians and the totals.
    """
    by = list(by)
    first = F.col("metric") == "p50"
    stacked = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.lit("p50").alias("metric"), F.col("p50_monthly").alias("v")),
                F.struct(F.lit("p75").alias("metric"), F.col("p75_monthly").alias("v")),
            )
        ).alias("m"),
        "n_postings",
        "n_disclosed",
    ).select(
        *by,
        "m.metric",
        "m.v",
        F.when(F.col("m.metric") == "p50", F.col("n_postings")).otherwise(0).alias("n_postings"),
        F.when(F.col("m.metric") == "p50", F.col("n_disclosed")).otherwise(0).alias("n_disclosed"),
    )
    pct = grouped_percentiles(stacked, by + ["metric"], "v", [0.5], count_rows=False,
                              extra_sums=["n_postings", "n_disclosed"])
    med = F.col(quantile_col(0.5))
    out = pct.groupBy(*by).agg(
        F.sum("n_postings").alias("total_postings"),
        F.sum("n_disclosed").alias("total_disclosed"),
        F.max(F.when(first, med)).alias("m50"),
        F.max(F.when(~first, med)).alias("m75"),
    )
    return out.select(
        *by,
        F.col("total_postings").cast("long").alias("total_postings"),
        F.col("total_disclosed").cast("long").alias("total_disclosed"),
        F.when(F.col("total_postings") > 0, F.col("total_disclosed") / F.col("total_postings"))
        .otherwise(F.lit(0.0))
        .alias("disclosure_rate"),
        F.col("m50").cast("int").alias("median_p50"),
        F.col("m75").cast("int").alias("median_p75"),
    )


def salary_box(cells: DataFrame, by: Sequence[str] = ("role_canonical", "headcount_band", "seniority")) -> DataFrame:
    """Five-number summary of cell medians (cells with a published p50 only), one pass."""
    by = list(by)
    base = cells.filter(F.col("p50_monthly").isNotNull()).select(*by, "p50_monthly")
    pct = grouped_percentiles(base, by, "p50_monthly", [0.25, 0.5, 0.75], count_rows=False, extremes=True)
    return pct.select(
        *by,
        F.col("n_values").alias("n_cells"),
        F.col("min_value").alias("min_p50"),
        F.col(quantile_col(0.25)).alias("q1_p50"),
        F.col(quantile_col(0.5)).alias("median_p50"),
        F.col(quantile_col(0.75)).alias("q3_p50"),
        F.col("max_value").alias("max_p50"),
    )


def filter_values(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Sorted distinct (dimension, value) pairs offered as filters."""
    parts = [
        df.select(F.lit(dim).alias("dimension"), F.col(col).cast("string").alias("value")).distinct()
        for dim, (df, col) in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("value").isNotNull()).orderBy("dimension", "value")


def _label(mapping: dict[str, str], key) -> F.Column:
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), key), key)


def role_label(key) -> F.Column:
    return _label(ROLE_LABELS, key)


def family_label(key) -> F.Column:
    return _label(FAMILY_LABELS, key)
