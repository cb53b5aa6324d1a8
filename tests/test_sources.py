import json
import os

from pyspark.sql import functions as F

from marketmarts.session import scratch_path
from marketmarts.operators import reports, staging
from marketmarts.sources import boards, jsonl, union
from marketmarts.sources.conform import conform_feed


def test_jsonl_skips_blank_and_bad_lines_and_keeps_file_order(spark):
    root = scratch_path(spark, "jsonl-test")
    os.makedirs(os.path.join(root, "b"), exist_ok=True)
    with open(os.path.join(root, "a.jsonl"), "w") as fh:
        fh.write(json.dumps({"posting_id": "P-1", "source": "s", "fetched_at": "2026-01-01T10:00:00"}) + "\n")
        fh.write("\n   \n{bad\n[1, 2]\n")
        fh.write(json.dumps({"posting_id": "P-2", "fetched_at": "not a time", "skills_raw": ["x"]}) + "\n")
    with open(os.path.join(root, "b", "c.jsonl"), "w") as fh:
        fh.write(json.dumps({"posting_id": "P-1", "source": "s", "fetched_at": "2026-01-02T10:00:00"}) + "\n")
    with open(os.path.join(root, "ignored.txt"), "w") as fh:
        fh.write(json.dumps({"posting_id": "P-9"}) + "\n")
    lines = jsonl.scan_lines(spark, root)
    assert lines.count() == 5  # blank lines dropped at scan
    assert jsonl.bad_line_count(lines).first().bad_lines == 2
    rows = jsonl.parse_postings(lines).orderBy("seq").collect()
    assert [r.posting_id for r in rows] == ["P-1", "P-2", "P-1"]
    assert rows[1].fetched_at is None and rows[1].fetched_at_text == "not a time" and rows[1].skills_raw == ["x"]
    kept = staging.required_fields(jsonl.parse_postings(lines))
    assert kept.count() == 3  # a time that cannot be read is a time
    assert rows[0].seq < rows[1].seq < rows[2].seq


def test_jsonl_writer_counts_rows(spark):
    df = spark.createDataFrame([("104", "a"), ("104", "b"), ("yourator", "c")], "source string, posting_id string")
    path = scratch_path(spark, "jsonl-out")
    assert jsonl.write_jsonl(df, path) == 3
    assert sorted(d for d in os.listdir(path) if d.startswith("source=")) == ["source=104", "source=yourator"]


def _pages(spark, payloads):
    return spark.createDataFrame([(p, None) for p in payloads], "payload string, fetched_at timestamp_ntz")


def test_board_a_mapping(spark):
    page = {"data": {"list": [
        {"jobName": "Data Engineer", "custName": "Foo", "jobNo": "", "jobId": "77", "salaryLow": "50000",
         "salaryHigh": "60000", "jobAddrNoDesc": "", "jobAddress": "Taipei", "description": "x" * 700,
         "link": {"job": "/job/77"}},
        {"jobName": "No company"},
        {"custName": "No title"},
        {"jobName": "Zero high", "custName": None, "salaryLow": "1", "salaryHigh": "0"},
    ]}}
    out = boards.map_board_a(_pages(spark, [json.dumps(page), "{bad", json.dumps({"data": None})])).collect()
    assert len(out) == 2
    a, b = out
    assert a.posting_id == "104-77" and a.city == "Taipei" and a.salary_disclosed
    assert (a.salary_monthly_low, a.salary_monthly_high) == (50000, 60000)
    assert len(a.description_excerpt) == 600 and a.url == "https://www.104.com.tw/job/77"
    assert a.description == "x" * 700  # the whole text stands beside the excerpt
    assert len(b.posting_id) == 20 and not b.salary_disclosed and b.salary_monthly_low is None
    assert b.company.name is None and b.url == "https://www.104.com.tw"


def test_board_b_mapping(spark):
    page = {"jobs": [
        {"id": 5, "name": "ML Engineer", "company": {"name": "Bar", "size": "51-200", "slug": "bar"},
         "salary_min": 120, "salary_max": 80000, "remote_friendly": True,
         "tags": [{"name": "Python"}, {"name": ""}, {}], "description": "d"},
        {"id": 6, "name": "No company"},
        {"id": 7, "name": "Zero", "company": {"name": "Baz"}, "salary_min": 0, "salary_max": 10},
    ]}
    out = boards.map_board_b(_pages(spark, [json.dumps(page), "not json"])).orderBy("posting_id").collect()
    assert [r.posting_id for r in out] == ["yourator-5", "yourator-7"]
    a, b = out
    assert (a.salary_monthly_low, a.salary_monthly_high, a.salary_disclosed) == (100000, 80000, True)
    assert a.skills_raw == ["Python"] and a.is_remote and a.company.headcount_band == "51-200"
    assert a.url == "https://www.yourator.co/companies/bar/jobs/5"
    assert not b.salary_disclosed and b.salary_monthly_low is None and b.is_remote is False


def test_rows_per_source_counts_missing_sources_as_zero(spark):
    df = spark.createDataFrame([("104",), ("104",), ("sample",)], "source string")
    out = {r.source: r.n_rows for r in union.rows_per_source(spark, df, ["104", "yourator", "sample"]).collect()}
    assert out == {"104": 2, "yourator": 0, "sample": 1}


def test_union_tolerates_missing_fields(spark):
    a = spark.createDataFrame([("P-1", "104")], "posting_id string, source string")
    b = spark.createDataFrame([("P-2", "2026-01-01T00:00:00")], "posting_id string, fetched_at string")
    out = union.union_sources([a, b]).orderBy("posting_id").collect()
    assert [(r.posting_id, r.source) for r in out] == [("P-1", "104"), ("P-2", None)]
    assert out[1].fetched_at is not None and "company" in out[0].asDict()


def test_read_postings_jsonl_discovers_files_recursively(spark):
    root = scratch_path(spark, "jsonl-discover")
    os.makedirs(os.path.join(root, "104"), exist_ok=True)
    os.makedirs(os.path.join(root, "yourator"), exist_ok=True)
    with open(os.path.join(root, "104", "p1.jsonl"), "w") as fh:
        fh.write(json.dumps({"posting_id": "104-1", "source": "104", "fetched_at": "2026-01-01T00:00:00",
                             "company": {"name": "Foo"}}) + "\n")
    with open(os.path.join(root, "yourator", "p2.jsonl"), "w") as fh:
        fh.write(json.dumps({"posting_id": "yourator-2", "source": "yourator",
                             "fetched_at": "2026-01-02T00:00:00"}) + "\n")
    rows = jsonl.read_postings_jsonl(spark, root).orderBy("seq").collect()
    assert [r.posting_id for r in rows] == ["104-1", "yourator-2"]
    assert rows[0].company.name == "Foo" and rows[0].company.headcount_band is None


def test_no_landing_files_is_an_error(spark):
    import pytest

    root = scratch_path(spark, "jsonl-empty")
    os.makedirs(root, exist_ok=True)
    with pytest.raises(FileNotFoundError):
        jsonl.read_postings_jsonl(spark, root)


def test_board_a_number_zero_and_null_values(spark):
    page = {"data": {"list": [
        {"jobName": "A", "custName": "Foo", "jobNo": 1, "salaryLow": 0, "salaryHigh": 60000},
        {"jobName": "B", "custName": "Foo", "jobNo": "2", "salaryLow": "0", "salaryHigh": "60000"},
        {"jobName": None, "custName": "Foo", "jobNo": "3"},
    ]}}
    out = boards.map_board_a(_pages(spark, [json.dumps(page)])).orderBy("posting_id").collect()
    assert [(r.posting_id, r.salary_disclosed, r.salary_monthly_low) for r in out] == [
        ("104-1", False, None), ("104-2", True, 0), ("104-3", False, None)]


def test_board_b_text_ids_null_company_and_decimals(spark):
    page = {"jobs": [
        {"id": "a1", "name": "A", "company": {"name": None}, "salary_min": 60.5, "salary_max": 80000.0},
        {"id": "a2", "name": "B", "company": {"name": "Foo"}},
        {"id": "a3", "name": "C", "company": None},
        {"id": "a4", "name": "D", "company": {"size": "1"}},
    ]}
    out = boards.map_board_b(_pages(spark, [json.dumps(page)])).orderBy("posting_id").collect()
    assert [(r.posting_id, r.company.name, r.salary_monthly_low, r.salary_monthly_high) for r in out] == [
        ("yourator-a1", None, 50416, 80000), ("yourator-a2", "Foo", None, None)]


def test_zoned_times_become_utc(spark):
    rows = [("1", "2026-01-01T00:00:00+08:00"), ("2", "2026-01-01T00:00:00Z"), ("3", "2026-01-01T00:00:00"), ("4", "soon"),
            ("5", "2026-01-01")]
    out = conform_feed(spark.createDataFrame(rows, "posting_id string, fetched_at string")).orderBy("posting_id")
    assert [r.fetched_at and r.fetched_at.isoformat() for r in out.collect()] == [
        "2025-12-31T16:00:00", "2026-01-01T00:00:00", "2026-01-01T00:00:00", None, "2026-01-01T00:00:00"]


def test_lines_keep_decimal_numbers_and_skip_blank_ones(spark):
    root = scratch_path(spark, "jsonl-numbers")
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "p.jsonl"), "w") as fh:
        fh.write('{"posting_id": "1", "salary_monthly_low": 50000.0, "salary_monthly_high": 60000}\n\t\n')
    lines = jsonl.scan_lines(spark, root)
    assert jsonl.bad_line_count(lines).first().bad_lines == 0
    r = jsonl.parse_postings(lines).first()
    assert (r.salary_monthly_low, r.salary_monthly_high) == (50000, 60000)


def test_union_goes_on_to_staging(spark):
    page = {"jobs": [{"id": 1, "name": "Data Engineer", "company": {"name": "Foo"}}]}
    later = spark.createDataFrame([(1, "yourator-1", "2026-01-02T00:00:00", "ML Engineer")],
                                  "seq long, posting_id string, fetched_at string, role_raw string")
    u = union.union_sources([boards.map_board_b(_pages(spark, [json.dumps(page)])), later])
    out = staging.postings(staging.required_fields(u)).collect()
    assert [(r.posting_id, r.role_raw) for r in out] == [("yourator-1", "ML Engineer")]


def test_pivot_keeps_unlisted_families(spark):
    weekly = spark.createDataFrame([("w", "analytics", 2), ("w", "robotics", 5), ("w", None, 1)],
                                   "week_ending string, role_family string, n long")
    r = reports.weekly_pivot(weekly).first()
    assert (r.analytics, r.unlisted) == (2, 6)


def test_jobs_without_an_id_are_not_merged(spark):
    a = {"data": {"list": [{"jobName": "A", "custName": "Foo"}, {"jobName": "B", "custName": "Foo"}, {"jobName": "A", "custName": "Foo"}]}}
    ids = [r.posting_id for r in boards.map_board_a(_pages(spark, [json.dumps(a)])).collect()]
    assert ids[0] == ids[2] != ids[1] and all(i.startswith("104-") and len(i) == 20 for i in ids)
    b = {"jobs": [{"name": "A", "company": {"name": "Foo"}}, {"name": "B", "company": {"name": "Foo"}}]}
    ids = [r.posting_id for r in boards.map_board_b(_pages(spark, [json.dumps(b)])).collect()]
    assert len(set(ids)) == 2 and all(i.startswith("yourator-") for i in ids)


def test_skills_are_found_past_the_excerpt(spark):
    page = {"data": {"list": [{"jobName": "Data Engineer", "custName": "Foo", "jobNo": "1", "description": "x " * 400 + "Airflow"}]}}
    feed = union.union_sources([boards.map_board_a(
        spark.createDataFrame([(json.dumps(page), "2026-01-01T00:00:00")], "payload string, fetched_at string"))])
    (p,) = staging.postings(staging.required_fields(feed)).collect()
    assert "airflow" in p.skills_canonical and len(p.description_excerpt) == 600


def _lines(spark, *lines):
    root = scratch_path(spark, "lines")
    os.makedirs(root)
    with open(os.path.join(root, "p.jsonl"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return jsonl.scan_lines(spark, root)


def test_lines_are_read_as_a_json_reader_does(spark):
    lines = ['{"posting_id": "1", "posting_id": "2"}', '{"posting_id": "3", "salary_monthly_low": NaN, "salary_monthly_high": 7}',
             '{"posting_id": "4", "salary_monthly_low": "50000", "is_remote": "x", "company": [1], "skills_raw": "sql"}',
             '{"posting_id": "5", "company": {"name": 5, "headcount_est": 20.0}, "skills_raw": ["a", 1, null]}', '{"posting_id": 6, "city": {"a": 1}}',
             "{}", "null", "7", "[1]", "[]", '"x"', '{"posting_id": "T"} x', '{"posting_id": "T"}, {"posting_id": "U"}', "{'posting_id': 1}",
             '{"posting_id": "C']
    scanned = _lines(spark, *lines)
    rows = {r.posting_id: r for r in jsonl.parse_postings(scanned).collect()}
    assert set(rows) == {"2", "3", "4", "5", "6", None}  # {} is an object without an id
    assert rows["3"].salary_monthly_low is None and rows["3"].salary_monthly_high == 7
    assert rows["4"].salary_monthly_low == 50000 and rows["4"].is_remote is None and rows["4"].company.name is None
    assert rows["4"].skills_raw is None and rows["5"].skills_raw == ["a", "1", None]
    assert (rows["5"].company.name, rows["5"].company.headcount_est) == ("5", 20) and rows["6"].city == '{"a":1}'
    assert jsonl.bad_line_count(scanned).first().bad_lines == 9


def test_legacy_file_comes_first_and_paths_are_compared_by_part(spark):
    root = scratch_path(spark, "order")
    for name in ("z_legacy.jsonl", "raw/a-b/1.jsonl", "raw/a/2.jsonl"):
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "w") as fh:
            fh.write(json.dumps({"posting_id": name}) + "\n")
    legacy = os.path.join(root, "z_legacy.jsonl")
    rows = jsonl.read_postings_jsonl(spark, os.path.join(root, "raw"), legacy=legacy).orderBy("seq").collect()
    assert [r.posting_id for r in rows] == ["z_legacy.jsonl", "raw/a/2.jsonl", "raw/a-b/1.jsonl"]
    rows = jsonl.read_postings_jsonl(spark, os.path.join(root, "raw"), legacy=legacy + ".gone").collect()
    assert len(rows) == 2
