import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from marketmarts.functions.salary import annual_to_monthly, week_ending_sunday
from marketmarts.operators import marts
from marketmarts.operators.percentile import grouped_percentiles, quantile_col


def _cells(spark, mids, disclosed=True):
    rows = [("data_engineer", "mid", None, "Taipei", disclosed, int(2 * m) - 0, 0) for m in mids]
    # low + high = 2 * mid with high = 0 keeps the midpoint exact
    df = spark.createDataFrame(
        rows,
        "role_canonical string, seniority string, headcount_band string, city string, "
        "salary_disclosed boolean, salary_monthly_low int, salary_monthly_high int",
    )
    return marts.salary_cells(df, "2026-01-01").collect()


def test_salary_cell_percentiles_truncated(spark):
    (row,) = _cells(spark, [10, 20, 30, 45, 70])
    assert (row.p25_monthly, row.p50_monthly, row.p75_monthly, row.p90_monthly) == (20, 30, 45, 60)
    assert row.headcount_band == "unknown" and row.n_postings == 5 and row.n_disclosed == 5


def test_small_cells_are_blanked(spark):
    (row,) = _cells(spark, [10, 20, 30, 45])
    assert row.n_disclosed == 4 and row.n_postings == 4
    assert (row.p25_monthly, row.p50_monthly, row.p75_monthly, row.p90_monthly) == (None, None, None, None)


def test_undisclosed_rows_count_as_postings_only(spark):
    (row,) = _cells(spark, [10, 20, 30, 45, 70], disclosed=False)
    assert row.n_postings == 5 and row.n_disclosed == 0 and row.p50_monthly is None


def test_percentiles_equal_numpy_with_a_hot_group(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(12):
        n = 3000 if g == 0 else int(rng.integers(1, 40))  # group 0 holds most rows
        vals = rng.integers(20000, 200000, size=n) / 2.0
        rows += [(g, float(v)) for v in vals]
        rows += [(g, None)] * (g % 3)
    df = spark.createDataFrame(rows, "g int, v double")
    qs = [0.25, 0.5, 0.75, 0.9, 0.1, 1.0, 0.0]
    got = {r.g: r for r in grouped_percentiles(df, ["g"], "v", qs).collect()}
    for g in range(12):
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        for q in qs:
            assert got[g][quantile_col(q)] == np.percentile(vals, q * 100), (g, q)
        assert got[g].n_values == len(vals)
        assert got[g].n_rows == len(vals) + g % 3


def test_company_median_half_even_and_share_rounding(spark):
    df = spark.createDataFrame(
        [("c1", "data_engineering", 100, 100), ("c1", "other", 101, 101), ("c1", "other", None, 5)],
        "company_id string, role_family string, salary_monthly_low int, salary_monthly_high int",
    ).withColumn("company_id", F.xxhash64("company_id"))
    row = marts.company_activity(df, "2026-01-01").first()
    assert (row.n_postings, row.n_data_ai, row.median_monthly) == (3, 1, 100)
    p = spark.createDataFrame(
        [("data_engineering", ["python"] if i == 0 else []) for i in range(32)],
        "role_family string, skills_canonical array<string>",
    )
    sd = marts.skill_demand(p, "2026-01-01").collect()
    assert [(r.skill, r.n_postings, r.share_of_postings) for r in sd] == [("python", 1, 0.0312)]


def test_annual_to_monthly(spark):
    df = spark.createDataFrame([(120,), (80000,), (0,), (None,), (25000,), (25001,)], "v int")
    assert [r[0] for r in df.select(annual_to_monthly(F.col("v"))).collect()] == [
        100000, 80000, None, None, 20833333, 25001,
    ]


def test_week_ending_sunday(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 1, 4, 10, 0),), (dt.datetime(2026, 1, 5, 0, 0),), (dt.datetime(2026, 1, 10, 23, 59),)],
        "ts timestamp_ntz",
    )
    assert [r[0] for r in df.select(week_ending_sunday(F.col("ts"))).collect()] == [
        dt.date(2026, 1, 4), dt.date(2026, 1, 11), dt.date(2026, 1, 11),
    ]


def test_company_median_optional_small_cell_guard(spark):
    df = spark.createDataFrame(
        [("c1", "data_engineering", 100, 100), ("c1", "other", 101, 101),
         ("c2", "analytics", 10, 20), ("c2", "analytics", 30, 40), ("c2", "other", 50, 60)],
        "company_id string, role_family string, salary_monthly_low int, salary_monthly_high int",
    ).withColumn("company_id", F.xxhash64("company_id"))
    out = {r.n_postings: r for r in marts.company_activity(df, "2026-01-01", min_disclosed=3).collect()}
    assert out[2].median_monthly is None  # two midpoints: guarded
    assert (out[3].median_monthly, out[3].n_data_ai) == (35, 2)
    plain = {r.n_postings: r.median_monthly for r in marts.company_activity(df, "2026-01-01").collect()}
    assert plain == {2: 100, 3: 35}


def test_approx_method_counts_flag_and_keeps_null_dimensions(spark):
    rows = [("de", "mid", None, None, True, 2 * m, 0) for m in (10, 20, 30, 45, 70)]
    rows.append(("de", "mid", None, None, True, 100, None))  # flagged, one bound missing
    df = spark.createDataFrame(
        rows,
        "role_canonical string, seniority string, headcount_band string, city string, "
        "salary_disclosed boolean, salary_monthly_low int, salary_monthly_high int",
    )
    (row,) = marts.salary_cells(df, "2026-01-01", method="approx").collect()
    assert row.headcount_band is None and row.city is None
    assert (row.n_postings, row.n_disclosed) == (6, 6)
    assert row.p50_monthly == 30.0  # an actual midpoint, not truncated or interpolated
    (exact,) = marts.salary_cells(df, "2026-01-01").collect()
    assert (exact.n_disclosed, exact.headcount_band) == (5, "unknown")
