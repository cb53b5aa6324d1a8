"""Title classification and company conforming as Catalyst expressions.

Ordered rule tables become one ``CASE WHEN`` chain, so the first matching
rule wins exactly as in a Python loop, and the whole thing stays in
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import (
    COMPANY_LEGAL_SUFFIX,
    COMPANY_OVERRIDES,
    COMPANY_STRIP_CHARS,
    COMPANY_UNKNOWN,
    ROLE_FALLBACK,
    ROLE_RULES,
    SENIORITY_BY_YEARS,
    SENIORITY_RULES,
    SENIORITY_YEARS_BELOW,
    SENIORITY_YEARS_NULL,
)
from .text import strip_ws, upat


def _title(title: Column) -> Column:
    return F.lower(F.coalesce(title, F.lit("")))


def role(title: Column) -> Column:
    """STRUCT<role_canonical, role_family> for a raw title (first rule wins)."""
    t = _title(title)

    def pair(role_name: str, family: str) -> Column:
        return F.struct(F.lit(role_name).alias("role_canonical"), F.lit(family).alias("role_family"))

    expr = None
    for pattern, role_name, family in ROLE_RULES:
        cond = t.rlike(upat(pattern))
        expr = F.when(cond, pair(role_name, family)) if expr is None else expr.when(cond, pair(role_name, family))
    return expr.otherwise(pair(*ROLE_FALLBACK))


def seniority(title: Column, years_min: Column) -> Column:
    """Title hints first, then experience years; NULL years -> 'mid'."""
    t = _title(title)
    expr = None
    for pattern, level in SENIORITY_RULES:
        cond = t.rlike(upat(pattern))
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    expr = expr.when(years_min.isNull(), F.lit(SENIORITY_YEARS_NULL))
    for floor_years, level in SENIORITY_BY_YEARS:
        expr = expr.when(years_min >= floor_years, F.lit(level))
    return expr.otherwise(F.lit(SENIORITY_YEARS_BELOW))


def _override_map() -> Column:
    kv = []
    for k, v in COMPANY_OVERRIDES.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def canonical_company(name: Column) -> Column:
    """Conform a company name: override table, else legal suffixes removed."""
    trimmed = strip_ws(name)
    override = F.try_element_at(_override_map(), F.lower(trimmed))
    cleaned = F.btrim(
        F.regexp_replace(name, upat(COMPANY_LEGAL_SUFFIX, ignore_case=True), ""),
        F.lit(COMPANY_STRIP_CHARS),
    )
    return (
        F.when(name.isNull() | (name == ""), F.lit(COMPANY_UNKNOWN))
        .when(override.isNotNull(), override)
        .otherwise(F.coalesce(F.nullif(cleaned, F.lit("")), trimmed))
    )
