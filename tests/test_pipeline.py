import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketmarts.operators import checks, staging
from marketmarts.plans import pipeline, sinks
from marketmarts.plans import queries as Q
from marketmarts.session import scratch_path
from marketmarts.sources.conform import conform_feed
from marketmarts.sources.feed import posting_feed


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_builds_layers_and_rerun_is_idempotent(spark):
    feed = posting_feed(spark, SF_SMALL)
    root = scratch_path(spark, "wh-test")
    first = pipeline.run(spark, feed, root, snapshot_date="2026-01-01")
    c = first["counts"]
    assert c["salary_by_role"] > 0 and c["skill_demand"] > 0 and c["company_activity"] > 0
    snap1 = {t: _rows(pipeline.table(spark, first, t)) for t in first["paths"]}
    with pytest.raises(ValueError):
        pipeline.run(spark, feed, root, snapshot_date="2026-01-01")  # stored tables are never overwritten
    second = pipeline.run(spark, feed, scratch_path(spark, "wh-test"), snapshot_date="2026-01-01", previous=first)
    snap2 = {t: _rows(pipeline.table(spark, second, t)) for t in second["paths"]}
    assert snap1 == snap2 and second["counts"] == first["counts"]
    assert c == {t: len(rows) for t, rows in snap1.items()} | {"postings_with_skills": c["postings_with_skills"]}
    b = second["batch"]
    assert (b["raw_new"], b["raw_skipped"], b["companies_new"], b["postings_new"]) == (0, c["raw_postings"], 0, 0)
    assert b["postings_updated"] == c["postings"] and b["companies_updated"] == c["companies"]
    # privacy guard: no published percentile under five disclosures, none missing at five or more
    sal = spark.read.parquet(first["paths"]["salary_by_role"])
    assert sal.filter((F.col("n_disclosed") < 5) & F.col("p50_monthly").isNotNull()).count() == 0
    assert sal.filter((F.col("n_disclosed") >= 5) & F.col("p50_monthly").isNull()).count() == 0
    tables = {t: pipeline.table(spark, first, t) for t in first["paths"]}
    assert all(r.n_nulls == 0 for r in checks.not_null_violations(tables).collect())
    assert all(r.n_duplicate_keys == 0 for r in checks.key_violations(tables).collect())
    assert all(r.n_orphans == 0 for r in checks.orphan_counts(tables).collect())


def test_two_days_equal_one_run_and_unlisted_skills_count(spark):
    feed = posting_feed(spark, SF_SMALL).withColumn("skills_raw", F.when(F.col("seq") % 2 == 0, F.col("skills_raw")))
    whole = pipeline.run(spark, feed, scratch_path(spark, "one"), snapshot_date="2026-01-02")
    day1 = pipeline.run(spark, feed.filter("seq <= 750"), scratch_path(spark, "day1"), snapshot_date="2026-01-01")
    day2 = pipeline.run(spark, feed.filter("seq > 750"), scratch_path(spark, "day2"), snapshot_date="2026-01-02", previous=day1)
    assert day1["counts"]["raw_postings"] < whole["counts"]["raw_postings"]
    for t in whole["paths"]:
        assert _rows(pipeline.table(spark, day2, t)) == _rows(pipeline.table(spark, whole, t)), t
    assert day2["counts"] == whole["counts"]
    assert sinks.snapshots(spark, day2["paths"]["salary_by_role"]) == [dt.date(2026, 1, 1), dt.date(2026, 1, 2)]

    from marketmarts.operators import marts

    df = spark.createDataFrame([("de", ["python", "ros"]), ("de", None), ("de", [])], "role_family string, skills_canonical array<string>")
    got = {r.skill: (r.n_postings, r.n_total) for r in marts.skill_counts(df).collect()}
    assert got == {"python": (1, 3), "ros": (1, 3)}


def test_mart_slices_are_replaced_and_kept(spark):
    path = scratch_path(spark, "mart-test")
    df = spark.createDataFrame(
        [("2026-01-01", "de", "python", 3, 0.5), ("2026-01-02", "de", "sql", 1, 0.25)],
        "snapshot_date string, role_family string, skill string, n_postings int, share_of_postings double",
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))
    sinks.write_mart(spark, df, path, "skill_demand")
    sinks.write_mart(spark, df.filter(F.col("skill") == "sql").withColumn("n_postings", F.lit(9)), path, "skill_demand")
    sinks.write_mart(spark, df.limit(0), path, "skill_demand")  # empty frame keeps every slice
    out = sorted((str(r.snapshot_date), r.skill, r.n_postings) for r in sinks.read_all_snapshots(spark, path, "skill_demand").collect())
    assert out == [("2026-01-01", "python", 3), ("2026-01-02", "sql", 9)]
    assert [r.skill for r in sinks.read_mart(spark, path, "skill_demand").collect()] == ["sql"]
    assert [r.skill for r in sinks.read_mart(spark, path, "skill_demand", "2026-01-01").collect()] == ["python"]
    assert sinks.read_mart(spark, scratch_path(spark, "none"), "skill_demand").count() == 0


def test_company_dimension_first_row_fixes_attributes(spark):
    import datetime as dt

    rows = [
        (1, "P-1", "s", dt.datetime(2026, 1, 5), ("Foo Inc.", "small", None, None)),
        (2, "P-2", "s", dt.datetime(2026, 1, 1), ("Foo", "large", None, None)),
        (3, "P-3", "s", dt.datetime(2026, 1, 3), (None, None, None, None)),
    ]
    df = spark.createDataFrame(
        rows, "seq long, posting_id string, source string, fetched_at timestamp_ntz, "
              "company struct<name string, headcount_band string, headcount_est int, industry string>")
    ingest = {r.name_canonical: r for r in staging.companies(df).collect()}
    assert ingest["Foo"].name_raw == "Foo Inc." and ingest["Foo"].headcount_band == "small"
    assert ingest["Foo"].first_seen_at == dt.datetime(2026, 1, 5)
    assert ingest["Foo"].last_seen_at == dt.datetime(2026, 1, 1)  # last processed, even if older
    assert ingest["unknown"].name_raw == "unknown"
    event = {r.name_canonical: r for r in staging.companies(df, order="event_time").collect()}
    assert event["Foo"].last_seen_at == dt.datetime(2026, 1, 5)


def test_last_row_wins_and_hints_come_from_newest_fetch(spark):
    import datetime as dt

    rows = [
        (1, "P-1", "s", dt.datetime(2026, 1, 9), "Data Engineer", ["kafka"], "old text"),
        (2, "P-1", "s", dt.datetime(2026, 1, 2), "Data Analyst", ["tableau"], "new text"),
        (3, "P-1", "s", dt.datetime(2026, 1, 9), "Data Analyst", ["looker"], None),
    ]
    df = spark.createDataFrame(
        rows, "seq long, posting_id string, source string, fetched_at timestamp_ntz, role_raw string, "
              "skills_raw array<string>, description_excerpt string")
    df = conform_feed(df.withColumn("company", F.struct(F.lit("Foo").alias("name"))))
    (p,) = staging.postings(df).collect()
    assert p.role_canonical == "data_analyst" and p.fetched_at == dt.datetime(2026, 1, 9)
    assert p.description_excerpt is None
    # newest fetch is 2026-01-09; of its two copies the first stored one (seq 1) holds the hints
    assert p.skills_canonical == ["kafka"]
    raw = staging.raw_postings(df).orderBy("fetched_at").collect()
    assert [(r.raw_id, r.n_fetches) for r in raw] == [(2, 1), (1, 2)]


def test_empty_input_flows_through_as_empty_typed_frames(spark):
    from marketmarts.operators import marts
    from marketmarts.schemas import POSTING_FEED

    feed = spark.createDataFrame([], POSTING_FEED).withColumn("seq", F.lit(0).cast("long"))
    raw, companies, postings = staging.stage(feed)
    enriched = staging.with_company(postings, companies)
    for df in (raw, companies, postings, marts.salary_cells(enriched, "2026-01-01"),
               marts.skill_demand(postings, "2026-01-01"), marts.company_activity(postings, "2026-01-01")):
        assert df.count() == 0
    assert dict(marts.salary_cells(enriched, "2026-01-01").dtypes)["p50_monthly"] == "int"


def test_staging_from_landing_files_orders_by_file_then_line(spark):
    import json
    import os

    from marketmarts.sources import jsonl

    root = scratch_path(spark, "landing-stage")
    os.makedirs(root, exist_ok=True)
    rec = lambda pid, t, title, hints: json.dumps({"posting_id": pid, "source": "s", "fetched_at": t,
                                                    "role_raw": title, "skills_raw": hints,
                                                    "company": {"name": "Foo Inc."}})
    with open(os.path.join(root, "a.jsonl"), "w") as fh:
        fh.write(rec("P-1", "2026-01-09T00:00:00", "Data Engineer", ["kafka"]) + "\n")
        fh.write(rec("P-1", "2026-01-02T00:00:00", "Data Analyst", ["tableau"]) + "\n")
    with open(os.path.join(root, "b.jsonl"), "w") as fh:
        fh.write(rec("P-1", "2026-01-09T00:00:00", "Data Scientist", ["looker"]) + "\n")
    feed = jsonl.read_postings_jsonl(spark, root)
    raw, companies, postings = staging.stage(feed)
    (p,) = postings.collect()
    assert p.role_canonical == "data_scientist"  # last line of the last file wins
    assert p.skills_canonical == ["kafka"]  # newest fetch, first arrival
    assert sorted(r.n_fetches for r in raw.collect()) == [1, 2]
    assert companies.first().name_canonical == "Foo"
    sinks.write_table(raw, scratch_path(spark, "raw-typed"), "raw_postings")  # raw_id fits BIGINT


def test_unreadable_times_stay_and_are_older_than_all_others(spark):
    rows = [(1, "P-1", "s", "garbled", ["kafka"]), (2, "P-1", "s", "2026-01-01", ["sql"]), (3, "P-2", "s", "soon", ["dbt"]),
            (4, "P-3", "s", "", ["dbt"]), (5, "P-3", "s", None, ["dbt"]), (6, "P-2", "s", "later", ["looker"]), (7, "P-2", "s", "soon", None)]
    feed = conform_feed(spark.createDataFrame(rows, "seq long, posting_id string, source string, fetched_at string, skills_raw array<string>"))
    raw, companies, postings = staging.stage(feed)
    assert sorted((r.source_post_id, r.fetched_at_text or "", r.n_fetches) for r in raw.collect()) == [
        ("P-1", "", 1), ("P-1", "garbled", 1), ("P-2", "later", 1), ("P-2", "soon", 2)]
    got = {r.posting_id: (r.fetched_at, r.skills_canonical) for r in postings.collect()}
    assert got == {"P-1": (dt.datetime(2026, 1, 1), ["sql"]), "P-2": (None, ["dbt"])}
    assert companies.count() == 1


def test_staging_aggregates_positions_without_sorting_rows(spark):
    valid = staging.required_fields(posting_feed(spark, SF_SMALL))
    for df in (staging.raw_postings(valid), staging.companies(valid), staging.postings(valid)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    latest = staging.latest_postings(Q._written(valid, "valid"))
    latest.collect()
    assert "ReusedExchange" in latest._jdf.queryExecution().executedPlan().toString()  # positions are found once
