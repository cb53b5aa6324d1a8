"""Findings of round 3: counts of repeated fetches, checked times, bounded memory."""

from __future__ import annotations

import datetime as dt

from marketmarts.operators import merge
from marketmarts.plans import oracle, pipeline

DAY = dt.datetime(2024, 1, 2)
RAW = "raw_id bigint, source string, source_post_id string, fetched_at timestamp_ntz, fetched_at_text string, payload string, n_fetches bigint"


def test_stored_raw_table_counts_repeated_fetches(spark, tmp_path):
    table = pipeline.counted_raw_table(spark, str(tmp_path), 4)
    table.append(spark.createDataFrame([
        (1, "a", "p1", DAY, None, "first", 1), (2, "a", "p1", None, "garbled", "unread", 2), (3, "b", "p2", DAY, None, "alone", 1)], RAW))
    done = merge.upsert_raw_counted(table, spark.createDataFrame([
        (7, "a", "p1", DAY, None, "later", 3), (7, "a", "p1", DAY, None, "later", 3),  # one position, twice
        (8, "a", "p1", None, "garbled", "later", 1), (9, "a", "p1", None, "other", "new", 1), (10, "b", "p3", DAY, None, "new", 5)], RAW))
    assert done["new"] == 2 and done["updated"] == 2
    got = sorted((r["raw_id"], r["payload"], r["n_fetches"]) for r in table.read().collect())
    assert got == [(1, "first", 4), (2, "unread", 3), (3, "alone", 1), (9, "new", 1), (10, "new", 5)]


def test_raw_merge_returns_the_counts():
    sql = oracle.oracle_sql()
    assert sql["raw_merge"] == sql["raw_dedup"] and "n_fetches" in sql["raw_merge"]


def test_position_joins_are_never_broadcast(spark, tmp_path):
    """Written layers look small to the planner: 20,000 equal rows are some kilobytes of files."""
    from marketmarts.operators import staging
    from marketmarts.sources.conform import conform_feed

    rows = spark.range(20_000).selectExpr(
        "id as seq", "concat('p', id % 15000) as posting_id", "'104' as source", "timestamp_ntz'2024-01-01 00:00:00' as fetched_at",
        "'Data Engineer' as role_raw", "named_struct('name', concat('Firm ', id % 900)) as company", "array('sql') as skills_raw")
    conform_feed(rows).write.parquet(str(tmp_path / "valid"))
    valid = spark.read.parquet(str(tmp_path / "valid"))
    raw, companies, postings = staging.stage(valid)
    older = staging.postings(valid, stored_raw=raw)
    for df, n in ((raw, 15_000), (companies, 900), (postings, 15_000), (older, 15_000), (staging.with_company(postings, companies), 15_000)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == n


def test_not_null_check_counts_unread_times(spark):
    from marketmarts.operators import checks

    tables = {
        "raw_postings": spark.createDataFrame([(1, "a", "p", None, "garbled", "{}", 1), (2, "a", "q", DAY, None, "{}", 1)], RAW).drop("n_fetches"),
        "companies": spark.createDataFrame([(1, "firm", "Firm", None, DAY)], "company_id bigint, name_canonical string, "
                                           "name_raw string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"),
        "postings": spark.createDataFrame([("p", None), ("q", None)], "posting_id string, fetched_at timestamp_ntz"),
    }
    got = {(r["table_name"], r["column_name"]): r["n_nulls"] for r in checks.not_null_violations(tables).collect()}
    times = {k: n for k, n in got.items() if k[1].endswith("_at")}
    assert times == {("raw_postings", "fetched_at"): 1, ("companies", "first_seen_at"): 1, ("companies", "last_seen_at"): 0,
                     ("postings", "fetched_at"): 2}
    assert oracle.oracle_sql()["check_not_null"].count("count_if(") == 36


def test_surface_join_cuts_pieces_without_a_list_of_all_characters(spark):
    """Same hits as contains(), also around characters beyond the basic plane and at odd surfaces."""
    from pyspark.sql import functions as F

    from marketmarts.functions import skills

    surfaces = [("a", "c++"), ("b", "go"), ("c", "r"), ("d", "😀x"), ("e", "]-^"), ("f", "java script"), ("g", "ééé")]
    texts = ["Go and C++", "x😀x go", "]-^ [java script]", None, "", "r", "éééé JAVA  script", "o😀rgo", "g" * 5000 + "o"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    tax = spark.createDataFrame(surfaces, "skill string, surface string")
    joined = skills.join_surfaces(docs, tax, "id", "text")
    assert "transform(" not in joined._jdf.queryExecution().optimizedPlan().toString()
    hay = skills.with_haystack(docs, F.col("text"))
    want = {(r["id"], r["skill"], r["surface"]) for r in hay.join(tax, F.col("_hay").contains(F.col("surface"))).collect()}
    got = [tuple(r) for r in joined.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 5


def test_a_bucket_does_not_grow_with_the_first_batch(spark, tmp_path, monkeypatch):
    from marketmarts.sources.conform import conform_feed

    assert pipeline.buckets_for(10) == pipeline.BUCKETS and pipeline.buckets_for(26_500_001) == 266
    monkeypatch.setattr(pipeline, "BUCKET_ROWS", 10)
    feed = conform_feed(spark.range(400).selectExpr(
        "id as seq", "concat('p', id % 300) as posting_id", "'104' as source", "timestamp_ntz'2024-01-01 00:00:00' as fetched_at",
        "'Data Engineer' as role_raw", "named_struct('name', concat('Firm ', id % 9)) as company", "array('sql') as skills_raw"))
    day1 = pipeline.run(spark, feed.filter("seq < 200"), str(tmp_path / "a"))
    day2 = pipeline.run(spark, feed.filter("seq >= 200"), str(tmp_path / "b"), previous=day1)
    assert day1["buckets"] == day2["buckets"] == 20
    assert pipeline.table(spark, day2, "postings").count() == day2["counts"]["postings"] == 300
    assert day2["batch"]["postings_updated"] == 100 and day2["batch"]["companies_new"] == 0


def test_each_bucket_is_appended_by_a_task_of_its_own(spark, tmp_path):
    import os

    table = pipeline.counted_raw_table(spark, str(tmp_path), 32)
    table.append(spark.createDataFrame([(i, "a", f"p{i}", DAY, None, "{}", 1) for i in range(2000)], RAW))
    files = [f for d, _, fs in os.walk(table.path) for f in fs if f.startswith("part-")]
    assert len(files) == len({f.split("-")[1] for f in files}) == 32  # the task's number stands in the file's name


def test_text_pass_tests_no_surface_that_another_one_of_its_skill_decides(spark):
    from pyspark.sql import functions as F

    from marketmarts.functions import skills

    assert skills._telling(["sql", "ansi sql", "rust", "mysql", "sql"]) == ["sql", "rust"]
    texts = [a + s + b for _, s, _ in skills.surface_rows() for a, b in (("", ""), ("x", "y"), ("in ", " and kafka"))] + ["", "資深 go"]
    hay = skills.with_haystack(spark.createDataFrame([(t,) for t in texts], "t string"), F.col("t"))
    for match in skills.MATCH_MODES:
        patterns = [(k, skills._surface_pattern(s, match)) for k, s, _ in skills.surface_rows()]
        for r in hay.select("_hay", skills.skills_in_haystack(F.col("_hay"), match).alias("got")).collect():
            assert r["got"] == sorted({k for k, p in patterns if p in r["_hay"]})


def test_companies_are_never_broadcast_to_their_activity(spark, tmp_path):
    from marketmarts.operators import reads

    spark.range(9000).selectExpr("id as company_id", "1 as n_postings", "date'2026-01-01' as snapshot_date", "1 as n_data_ai",
                                 "1 as median_monthly").write.parquet(str(tmp_path / "a"))
    spark.range(9000).selectExpr("id as company_id", "concat('Firm ', id) as name_canonical", "'' as headcount_band",
                                 "'' as industry").write.parquet(str(tmp_path / "c"))
    activity, companies = (spark.read.parquet(str(tmp_path / n)) for n in "ac")
    found = reads.read_company_activity(activity, companies, limit=50, snapshot_date="2026-01-01")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 50
