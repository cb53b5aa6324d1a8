"""Stored keyed tables: a batch reads and rewrites its buckets only, and reads serve one partition."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketmarts.operators import merge, reads, staging
from marketmarts.plans import pipeline, sinks
from marketmarts.plans import queries as Q
from marketmarts.plans.stored import StoredTable
from marketmarts.schemas import table_schema
from marketmarts.session import scratch_path
from marketmarts.sources.feed import posting_feed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _files(table) -> dict[int, set[str]]:
    """Data files per bucket."""
    out = {}
    for d in sorted(os.listdir(table.path)):
        if d.startswith("bucket="):
            out[int(d[7:])] = {f for f in os.listdir(os.path.join(table.path, d)) if f.startswith("part-")}
    return out


@pytest.fixture()
def day_one(spark):
    valid = staging.required_fields(posting_feed(spark, SF_SMALL))
    rows = Q._written(sinks.typed(staging.postings(valid), "postings"), "day")
    table = pipeline.stored_table(spark, scratch_path(spark, "stored"), "postings", 32)
    table.append(rows)
    return table, rows


def test_a_small_batch_rewrites_only_its_buckets(spark, day_one):
    table, rows = day_one
    before = _files(table)
    assert set(before) == set(range(32)) and all(len(f) == 1 for f in before.values())
    ids = [r[0] for r in rows.select("posting_id").orderBy("posting_id").limit(12).collect()]  # about 1 %
    batch = rows.filter(F.col("posting_id").isin(ids)).withColumn("city", F.lit("Tainan"))
    batch = batch.unionByName(batch.limit(1).withColumn("posting_id", F.lit("new-1")))
    batch = Q._written(batch, "batch")
    touched = table.touched(batch)
    assert 0 < len(touched) < 14
    assert merge.upsert_postings(table, batch)["buckets"] == len(touched)
    after = _files(table)
    assert {b for b in after if after[b] != before[b]} == set(touched)
    want = {str(r) for r in rows.filter(~F.col("posting_id").isin(ids)).collect()} | {str(r) for r in batch.collect()}
    got = table.read().collect()
    assert len(got) == len(want) and {str(r) for r in got} == want
    # the table is declared again over its folder
    again = StoredTable(spark, os.path.dirname(table.path), "postings", table_schema("postings"), ["posting_id"], 32)
    assert again.read().count() == len(want)


def test_stored_side_of_a_merge_has_no_exchange_and_is_pruned(spark, day_one):
    table, rows = day_one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = merge._paired(table.slice([1, 5]), rows.limit(20), table.key)
        pairs.collect()
        plan = _plan(pairs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("Initial Plan")[0]
    scan = next(line for line in final.splitlines() if "FileScan" in line and "stored_" in line)
    assert "bucket IN (1,5)" in scan.replace("bucket#", "bucket").replace("[", "") or "PartitionFilters: [" in scan
    assert "SelectedBucketsCount" in scan or "Bucketed: true" in scan
    # between the stored scan and the join there is no shuffle
    lines = final.splitlines()
    at = lines.index(scan)
    above = []
    depth = len(scan) - len(scan.lstrip(" :+-*("))
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-*("))
        if d < depth:
            above.append(line)
            depth = d
        if "SortMergeJoin" in line:
            break
    assert any("SortMergeJoin" in x for x in above) and not any("Exchange" in x for x in above)


def test_raw_fetches_are_only_appended(spark):
    valid = Q._written(staging.required_fields(posting_feed(spark, SF_SMALL)), "valid")
    raw = lambda df: Q._written(sinks.typed(staging.raw_postings(df), "raw_postings"), "raw")
    table = pipeline.stored_table(spark, scratch_path(spark, "stored"), "raw_postings", 8)
    first = raw(valid.filter("seq <= 900"))
    table.append(first)
    before = _files(table)
    assert merge.upsert_raw(table, first) == {"new": 0}
    assert _files(table) == before
    merge.upsert_raw(table, raw(valid.filter("seq > 800")))
    after = _files(table)
    assert all(before[b] <= after[b] for b in before)
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(map(tuple, raw(valid).collect()), key=str)


def test_empty_batches_and_odd_bucket_numbers(spark, day_one):
    table, rows = day_one
    n = table.read().count()
    assert merge.upsert_postings(table, rows.limit(0))["buckets"] == 0 and table.read().count() == n
    assert table.touched(rows.limit(0)) == []
    with pytest.raises(ValueError):
        StoredTable(spark, scratch_path(spark, "x"), "t", rows.schema, ["posting_id"], 0)


def _metric(df, name: str) -> int:
    """A metric of the (only) file scan of a frame that has run."""
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if "FileSourceScan" in node.getClass().getSimpleName():
            return node.metrics().get(name).get().value()
        kids = node.children()
        stack += [kids.apply(i) for i in range(kids.size())]
        if "AdaptiveSparkPlan" in node.getClass().getSimpleName():
            stack.append(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            stack.append(node.plan())
    raise AssertionError("no scan")


def test_mart_reads_scan_one_of_two_snapshots_and_write_nothing(spark):
    done = Q.two_day_run(spark, SF_SMALL)
    for name in sinks.MARTS:
        assert len(sinks.snapshots(spark, done["paths"][name])) == 2
        df = pipeline.table(spark, done, name)
        assert "PartitionFilters: [isnotnull(snapshot_date" in _plan(df) and "2026-01-01" in _plan(df)
        assert df.collect()
        assert _metric(df, "numPartitions") == 1
    scratch = os.path.dirname(os.path.dirname(done["root"]))
    listing = lambda: sorted(os.path.join(d, f) for d, _, fs in os.walk(scratch) for f in fs)
    before = listing()
    for q in ("read_salary", "salary_filtered", "read_skills", "skills_top_n", "read_company_activity", "company_top30",
              "read_postings", "posting_search", "stage_counts"):
        assert Q.QUERIES[q](spark, SF_SMALL).collect(), q
    assert listing() == before


def test_searches_take_their_rows_before_the_join(spark):
    done = Q.two_day_run(spark, SF_SMALL)
    df = reads.search_postings(pipeline.table(spark, done, "postings"), "engineer", "py", companies=pipeline.table(spark, done, "companies"))
    plan = _plan(df)
    join = min(plan.index(x) for x in ("Join",) if x in plan)
    assert plan.index("TakeOrderedAndProject") and "TakeOrderedAndProject" in plan[join:]


def test_company_top_keeps_ties_for_the_names_to_break(spark):
    activity = spark.createDataFrame([(i, 5 if i < 6 else 1) for i in range(9)], "company_id long, n_data_ai int").withColumn(
        "snapshot_date", F.lit("2026-01-01").cast("date"))
    companies = spark.createDataFrame([(i, f"n{9 - i}", None, None) for i in range(9)],
                                      "company_id long, name_canonical string, headcount_band string, industry string")
    assert [r.company_id for r in reads.company_top(activity, companies, n=3).collect()] == [5, 4, 3]
    assert reads.company_top(activity.limit(0), companies, n=3).count() == 0


def test_scratch_tables_go_with_their_scope(spark):
    from marketmarts.session import path_exists, scratch_path, scratch_scope

    with scratch_scope(spark):
        inside, kept = scratch_path(spark, "scope"), scratch_path(spark, "scope", keep=True)
        for p in (inside, kept):
            spark.range(3).write.parquet(p)
        assert Q.q_postings_scan(spark, SF_SMALL).count() > 0
    assert not path_exists(spark, inside) and path_exists(spark, kept)


def test_merging_frames_equals_one_run(spark):
    valid = Q._written(staging.required_fields(posting_feed(spark, SF_SMALL)), "valid")
    a, b = valid.filter("seq <= 700"), valid.filter("seq > 700")
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert rows(merge.merge_raw(staging.raw_postings(a), staging.raw_postings(b))) == rows(staging.raw_postings(valid))
    for order in staging.ORDERS:
        old, new = staging.companies(a, order), staging.companies(b, order)
        assert rows(merge.merge_companies(old, new, order)) == rows(staging.companies(valid, order))
    assert merge.new_companies(old, new).count() == staging.companies(valid).count() - old.count()
    later = staging.postings(b, stored_raw=staging.raw_postings(a))
    assert rows(merge.merge_postings(staging.postings(a), later)) == rows(staging.postings(valid))
    with pytest.raises(ValueError):
        merge.merge_companies(old, new, "newest")
