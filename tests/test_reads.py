import pytest
from pyspark.sql import functions as F

from marketmarts.operators import reads


@pytest.fixture(scope="module")
def skills_mart(spark):
    rows = [("2026-01-01", "de", f"s{i}", i, 0.1) for i in range(30)] + [("2025-12-31", "de", "old", 99, 0.9)]
    return spark.createDataFrame(
        rows, "snapshot_date string, role_family string, skill string, n_postings int, share_of_postings double"
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))


@pytest.mark.parametrize("top_n", [0, 101, -1, 2.5])
def test_read_skills_bounds(skills_mart, top_n):
    with pytest.raises(ValueError):
        reads.read_skills(skills_mart, top_n=top_n)


def test_read_skills_latest_snapshot_top_n(skills_mart):
    out = reads.read_skills(skills_mart, top_n=3).collect()
    assert [r.skill for r in out] == ["s29", "s28", "s27"]  # the older snapshot's 99 is not mixed in
    assert [r.skill for r in reads.read_skills(skills_mart, top_n=1, snapshot_date="2025-12-31").collect()] == ["old"]


def test_slider_and_limits(skills_mart, spark):
    with pytest.raises(ValueError):
        reads.skills_top_n(skills_mart, "de", top_n=4)
    assert reads.skills_top_n(skills_mart, "de", top_n=5).count() == 5
    postings = spark.createDataFrame([("P-1", "r", None)], "posting_id string, role_canonical string, fetched_at timestamp_ntz")
    with pytest.raises(ValueError):
        reads.read_postings(postings, limit=501)
    with pytest.raises(ValueError):
        reads.read_company_activity(postings, postings, limit=0)


def test_read_salary_filters_before_limit(spark):
    rows = [("2026-01-01", "de", "mid", "b", f"c{i:03d}", 1, 0, None, None, None, None) for i in range(600)]
    rows.append(("2026-01-01", "de", "senior", "b", "zzz", 1, 0, None, None, None, None))
    df = spark.createDataFrame(
        rows,
        "snapshot_date string, role_canonical string, seniority string, headcount_band string, city string, "
        "n_postings int, n_disclosed int, p25_monthly int, p50_monthly int, p75_monthly int, p90_monthly int",
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))
    # the one senior cell sorts after 600 others, yet the seniority filter still finds it
    assert [r.city for r in reads.read_salary(df, role_canonical="de", seniority="senior").collect()] == ["zzz"]
    assert reads.read_salary(df).count() == df.count()  # no silent cut
    assert reads.read_salary(df, limit=500).count() == 500
