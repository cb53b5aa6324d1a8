"""Read API as DataFrame functions (filters applied before any limit).

Every limit is a top-k with a unique tie-break, so results are
deterministic; Spark plans ``orderBy().limit()`` as TakeOrderedAndProject
(a per-partition top-k then a merge), never a full sort.  Where the sort key
stands on one side of a join, the top-k is taken before the join.  Out-of-range
arguments raise ``ValueError``.

Marts are given as frames: one snapshot of a stored mart (``sinks.read_mart``,
a partition filter known before the scan), or any frame of several snapshots,
of which the newest is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    COMPANY_TOP,
    READ_COMPANIES_LIMIT,
    READ_POSTINGS_LIMIT,
    READ_SALARY_LIMIT,
    READ_SKILLS_TOP_N,
    SEARCH_LIMIT,
    SKILLS_TOP_N_SLIDER,
)
from .staging import LARGE


def _bounded(name: str, value: int, lo: int, hi: int) -> int:
    if not isinstance(value, int) or value < lo or value > hi:
        raise ValueError(f"{name} must be an integer in [{lo}, {hi}], got {value!r}")
    return value


def _snapshot_filter(df: DataFrame, snapshot_date) -> DataFrame:
    """One snapshot: the given one, else the latest present.

    The latest date is a scalar subquery, so on a table partitioned by
    ``snapshot_date`` only that partition is scanned.
    """
    if snapshot_date is not None:
        return df.filter(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
    latest = df.agg(F.max("snapshot_date")).scalar()
    return df.filter(F.col("snapshot_date") == latest)


def read_salary(salary: DataFrame, role_canonical=None, seniority=None, headcount_band=None, city=None,
                snapshot_date=None, limit: int | None = None) -> DataFrame:
    """Salary cells matching the optional equality filters (Q1); all of them unless a ``limit`` is given."""
    if limit is not None:
        _bounded("limit", limit, 1, READ_SALARY_LIMIT)
    df = _snapshot_filter(salary, snapshot_date)
    for col, val in (("role_canonical", role_canonical), ("seniority", seniority),
                     ("headcount_band", headcount_band), ("city", city)):
        if val:
            df = df.filter(F.col(col) == val)
    keys = ["snapshot_date", "role_canonical", "seniority", "headcount_band", "city"]
    df = df.orderBy(F.desc("snapshot_date"), *keys[1:])
    return df if limit is None else df.limit(limit)


def read_skills(skills: DataFrame, role_family=None, top_n: int = READ_SKILLS_TOP_N[0], snapshot_date=None) -> DataFrame:
    """Top skills by postings, optionally in one family (Q2)."""
    _bounded("top_n", top_n, READ_SKILLS_TOP_N[1], READ_SKILLS_TOP_N[2])
    df = _snapshot_filter(skills, snapshot_date)
    if role_family:
        df = df.filter(F.col("role_family") == role_family)
    return df.orderBy(F.desc("n_postings"), "role_family", "skill").limit(top_n)


def skills_top_n(skills: DataFrame, role_family: str, top_n: int = SKILLS_TOP_N_SLIDER[0], snapshot_date=None) -> DataFrame:
    """Top n skills of one family (dashboard slider bounds)."""
    _bounded("top_n", top_n, SKILLS_TOP_N_SLIDER[1], SKILLS_TOP_N_SLIDER[2])
    df = _snapshot_filter(skills, snapshot_date).filter(F.col("role_family") == role_family)
    return df.orderBy(F.desc("n_postings"), "skill").limit(top_n)


def company_activity_named(activity: DataFrame, companies: DataFrame, how: str = "inner") -> DataFrame:
    """Activity rows with the company's name, band and industry (J3 inner / J4 left)."""
    c = companies.select("company_id", "name_canonical", "headcount_band", "industry").hint(LARGE)
    return activity.join(c, "company_id", how)


def read_company_activity(activity: DataFrame, companies: DataFrame, limit: int = READ_COMPANIES_LIMIT[0],
                          snapshot_date=None) -> DataFrame:
    """Most active data/AI hiring companies (Q3)."""
    _bounded("limit", limit, READ_COMPANIES_LIMIT[1], READ_COMPANIES_LIMIT[2])
    df = company_activity_named(_snapshot_filter(activity, snapshot_date), companies)
    return df.orderBy(F.desc("n_data_ai"), "name_canonical").limit(limit)


def _top(activity: DataFrame, n: int) -> DataFrame:
    """Rows that can be among the n most active: at least as many data/AI postings as the n-th.

    The names that break ties stand on the other side of the join, so all
    ties of the n-th row go on.
    """
    nth = activity.select("n_data_ai").orderBy(F.desc("n_data_ai")).limit(n).agg(F.min("n_data_ai")).scalar()
    return activity.filter(F.col("n_data_ai") >= nth)


def company_top(activity: DataFrame, companies: DataFrame, n: int = COMPANY_TOP, snapshot_date=None) -> DataFrame:
    """Top n companies by data/AI postings (dashboard chart)."""
    df = company_activity_named(_top(_snapshot_filter(activity, snapshot_date), n), companies, "left")
    return df.orderBy(F.desc("n_data_ai"), "name_canonical", "company_id").limit(n)


def read_postings(postings: DataFrame, role_canonical=None, limit: int = READ_POSTINGS_LIMIT[0]) -> DataFrame:
    """Newest postings, optionally of one role (Q4)."""
    _bounded("limit", limit, READ_POSTINGS_LIMIT[1], READ_POSTINGS_LIMIT[2])
    df = postings
    if role_canonical:
        df = df.filter(F.col("role_canonical") == role_canonical)
    return df.orderBy(F.desc("fetched_at"), "posting_id").limit(limit)


def search_postings(postings: DataFrame, title_term: str = "", skill_term: str = "",
                    limit: int = SEARCH_LIMIT, companies: DataFrame | None = None) -> DataFrame:
    """Title regex (case-insensitive) and skill substring search, newest first (Q5).

    Filters and sort key are the posting's own, so with ``companies`` only
    the ``limit`` rows found are joined with them (band and industry).
    """
    df = postings
    if title_term:
        df = df.filter(F.coalesce(F.col("role_raw").rlike("(?iU)" + title_term), F.lit(False)))
    if skill_term:
        term = skill_term.lower()
        df = df.filter(F.exists("skills_canonical", lambda s: s.contains(term)))
    found = df.orderBy(F.desc("fetched_at"), "posting_id").limit(limit)
    if companies is None:
        return found
    c = companies.select("company_id", "headcount_band", "industry")
    return found.join(c, "company_id", "left").orderBy(F.desc("fetched_at"), "posting_id")


def salary_filtered(salary: DataFrame, role_canonical: str, seniorities: Sequence[str] | None = None,
                    bands: Sequence[str] | None = None, snapshot_date=None) -> DataFrame:
    """Cells of one role in the chosen seniorities and bands, sorted for display."""
    df = _snapshot_filter(salary, snapshot_date).filter(F.col("role_canonical") == role_canonical)
    if seniorities is not None:
        df = df.filter(F.col("seniority").isin(list(seniorities)))
    if bands is not None:
        df = df.filter(F.col("headcount_band").isin(list(bands)))
    return df.orderBy("headcount_band", "seniority", "city")
