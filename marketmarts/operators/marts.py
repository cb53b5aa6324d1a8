"""The three marts: salary cells, skill demand, company activity.

Each mart is one lazy DataFrame; ``snapshot_date`` is an argument so a
rerun for the same day produces the same slice (see ``plans.sinks``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    DATA_AI_FAMILIES,
    MIN_DISCLOSED_PER_CELL,
    SALARY_QUANTILES,
    UNKNOWN_DIMENSION,
)
from ..functions.salary import disclosed_midpoint, midpoint
from .percentile import grouped_percentiles, quantile_col, truncate_int

CELL_KEYS = ["role_canonical", "seniority", "headcount_band", "city"]
PCT_COLS = ["p25_monthly", "p50_monthly", "p75_monthly", "p90_monthly"]
METHODS = ("exact", "approx")
APPROX_ACCURACY = 10_000


def _snapshot(snapshot_date) -> F.Column:
    if snapshot_date is None:
        snapshot_date = dt.date.today()
    if isinstance(snapshot_date, str):
        snapshot_date = dt.date.fromisoformat(snapshot_date)
    return F.lit(snapshot_date).cast("date")


def salary_cells(enriched: DataFrame, snapshot_date=None, method: str = "exact",
                 min_disclosed: int = MIN_DISCLOSED_PER_CELL) -> DataFrame:
    """Salary percentiles per (role, seniority, company band, city).

    exact:  n_disclosed counts disclosed rows with both bounds; percentiles
            are exact, linear, truncated to INT; NULL dimensions become
            'unknown' before grouping.
    approx: n_disclosed counts the disclosed flag; one mergeable sketch per
            cell answers all quantiles within 1/``APPROX_ACCURACY`` of the
            cell's rows in rank; not truncated; NULL dimensions stay NULL.
    Cells with fewer than ``min_disclosed`` disclosures get NULL percentiles.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    snap = _snapshot(snapshot_date)
    mid = disclosed_midpoint(F.col("salary_disclosed"), F.col("salary_monthly_low"), F.col("salary_monthly_high"))
    if method == "exact":
        base = enriched.select(
            "role_canonical",
            "seniority",
            F.coalesce("headcount_band", F.lit(UNKNOWN_DIMENSION)).alias("headcount_band"),
            F.coalesce("city", F.lit(UNKNOWN_DIMENSION)).alias("city"),
            mid.alias("mid"),
        )
        pct = grouped_percentiles(base, CELL_KEYS, "mid", SALARY_QUANTILES)
        n_disc = F.col("n_values")
        guard = n_disc >= min_disclosed
        return pct.select(
            snap.alias("snapshot_date"),
            *CELL_KEYS,
            F.col("n_rows").cast("int").alias("n_postings"),
            n_disc.cast("int").alias("n_disclosed"),
            *[
                F.when(guard, truncate_int(F.col(quantile_col(q)))).alias(name)
                for q, name in zip(SALARY_QUANTILES, PCT_COLS)
            ],
        )
    cells = enriched.select(*CELL_KEYS, "salary_disclosed", mid.alias("mid")).groupBy(*CELL_KEYS).agg(
        F.percentile_approx("mid", list(SALARY_QUANTILES), APPROX_ACCURACY).alias("sketched"),
        F.count_if("salary_disclosed").cast("int").alias("n_disclosed"),
        F.count(F.lit(1)).cast("int").alias("n_postings"),
    )
    published = F.when(F.col("n_disclosed") >= min_disclosed, F.col("sketched"))
    return cells.select(snap.alias("snapshot_date"), *CELL_KEYS, "n_postings", "n_disclosed",
                        *[published[i].alias(name) for i, name in enumerate(PCT_COLS)])


def skill_counts(postings_df: DataFrame) -> DataFrame:
    """(role_family, skill, n_postings, n_total) for every skill mentioned in a family, listed or not.

    A null skill stands for the posting itself, so one aggregation counts the
    family's postings and its skills; it is partial before the shuffle, and
    the totals are spread over its small result.
    """
    each = postings_df.select("role_family", F.explode(F.concat(
        F.array(F.lit(None).cast("string")), F.array_distinct(F.array_compact(F.coalesce("skills_canonical", F.array().cast("array<string>"))))
    )).alias("skill"))
    counts = each.groupBy("role_family", "skill").agg(F.count(F.lit(1)).alias("n_postings"))
    total = F.max(F.when(F.col("skill").isNull(), F.col("n_postings"))).over(Window.partitionBy("role_family"))
    return counts.withColumn("n_total", total).filter(F.col("skill").isNotNull())


def skill_demand(postings_df: DataFrame, snapshot_date=None) -> DataFrame:
    """Postings mentioning each skill per family and their share (4 decimals, rounded as numpy does).

    The share's denominator counts every posting of the family, including
    postings without skills.
    """
    snap = _snapshot(snapshot_date)
    return skill_counts(postings_df).select(
        snap.alias("snapshot_date"),
        "role_family",
        "skill",
        F.col("n_postings").cast("int").alias("n_postings"),
        (F.rint(F.col("n_postings") / F.col("n_total") * 10000) / 10000).alias("share_of_postings"),
    )


def company_activity(postings_df: DataFrame, snapshot_date=None, min_disclosed: int | None = None) -> DataFrame:
    """Per company: postings, data/AI postings and the median salary midpoint.

    The median uses every posting with both bounds (the disclosed flag is
    not consulted) and is rounded half-even.  ``min_disclosed`` optionally
    applies the small-cell guard to the median as well.
    """
    snap = _snapshot(snapshot_date)
    base = postings_df.filter(F.col("company_id").isNotNull()).select(
        "company_id",
        F.col("role_family").isin(*DATA_AI_FAMILIES).cast("int").alias("is_data_ai"),
        midpoint(F.col("salary_monthly_low"), F.col("salary_monthly_high")).alias("mid"),
    )
    out = grouped_percentiles(base, ["company_id"], "mid", [0.5], extra_sums=["is_data_ai"])
    median = F.bround(F.col(quantile_col(0.5)), 0).cast("int")
    if min_disclosed is not None:
        median = F.when(F.col("n_values") >= min_disclosed, median)
    return out.select(
        snap.alias("snapshot_date"),
        "company_id",
        F.col("n_rows").cast("int").alias("n_postings"),
        F.col("is_data_ai").cast("int").alias("n_data_ai"),
        median.alias("median_monthly"),
    )
