"""Batch run: feed -> raw/companies/postings tables -> three marts.

The parsed, filtered feed and the batch's staging rows are written before
they are read again.  That cuts the lineage (an executor lost late in the run
recomputes from the last written layer, not from the raw input) and parses the
raw input once.  Raw fetches, companies and postings are keyed stored tables
(``plans.stored``); a run after an earlier one appends its new fetches,
rewrites only the buckets of companies and postings that its batch touches,
and adds its snapshot's slice to the marts.  On a cluster the root must be on
shared storage: by default it is taken from ``spark.checkpoint.dir``.

Row counts are observed during the writes; no table is scanned for them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import marts, merge, staging
from ..schemas import table_schema
from ..session import list_subdirs, observed, scratch_path
from . import sinks
from .stored import StoredTable

#: Keys by which stored tables are bucketed.  All fetches of a posting share a bucket.
STORED_KEYS = {"raw_postings": ["source", "source_post_id"], "companies": ["name_canonical"], "postings": ["posting_id"]}
BUCKETS = 16

#: Rows of the first batch for which new tables get one more bucket: a bucket is read, joined and written by one task.
BUCKET_ROWS = 100_000


def buckets_for(rows: int) -> int:
    """Buckets of new tables whose first batch has ``rows`` rows: a bucket's work does not grow with the batch."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def stored_table(spark: SparkSession, root: str, table: str, buckets: int = BUCKETS) -> StoredTable:
    return StoredTable(spark, root, table, table_schema(table), STORED_KEYS[table], buckets)


def counted_raw_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> StoredTable:
    """The raw table with ``n_fetches``, how many copies of a fetch have arrived."""
    schema = T.StructType([*table_schema("raw_postings").fields, T.StructField("n_fetches", T.LongType())])
    return StoredTable(spark, root, "raw_postings_counted", schema, STORED_KEYS["raw_postings"], buckets)


def _written(df: DataFrame, path: str, **counts) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written as a table and read back, with counts observed on the way."""
    seen = Observation()
    sinks.write_table(df.observe(seen, *[c.alias(k) for k, c in counts.items()]), path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed(seen, *counts)


def run(spark: SparkSession, feed: DataFrame, root: str | None = None, snapshot_date=None,
        match: str = "substring", order: str = "ingest", previous: dict | None = None, buckets: int | None = None) -> dict:
    """Run one batch; returns root, paths, ``counts`` (rows of every table) and ``batch`` (what this batch did).

    ``previous`` is what an earlier run returned: its tables take this batch
    in, and ``root`` only gets the batch's own layers.  Without it a root that
    already holds tables is refused.  ``buckets`` is the number of buckets of
    new stored tables, by default as many as the batch's rows ask for.
    """
    root = root or scratch_path(spark, "warehouse", keep=True)
    home = previous["root"] if previous else root
    if previous is None and any(d.startswith("raw_postings-") for d in list_subdirs(spark, root)):
        raise ValueError(f"{root} already holds tables: give a new root, or the earlier run as previous")

    one = F.count(F.lit(1))
    seen = Observation()
    feed_path = os.path.join(root, "_feed")
    valid, kept = _written(staging.required_fields(feed.observe(seen, one.alias("feed_rows"))), feed_path, valid_rows=one)
    buckets = previous["buckets"] if previous else buckets or buckets_for(kept["valid_rows"])
    tables = {t: stored_table(spark, home, t, buckets) for t in STORED_KEYS}
    paths = {t: x.path for t, x in tables.items()} | {t: os.path.join(home, t) for t in sinks.MARTS}

    layer = lambda df, t, **c: _written(sinks.typed(df, t), os.path.join(root, f"_{t}"), rows=one, **c)
    raw, raw_rows = layer(staging.raw_postings(valid).drop("n_fetches"), "raw_postings")
    dim, dim_rows = layer(staging.companies(valid, order), "companies")
    stored_raw = tables["raw_postings"].slice(tables["raw_postings"].touched(raw)) if previous else None
    rows, post_rows = layer(staging.postings(valid, match, stored_raw), "postings",
                            skilled=F.count_if(F.size("skills_canonical") > 0))

    if previous is None:
        for t, df in (("raw_postings", raw), ("companies", dim), ("postings", rows)):
            tables[t].append(df)
        new_raw, companies = {"new": raw_rows["rows"]}, {"new": dim_rows["rows"], "updated": 0, "buckets": buckets}
        postings = {"new": post_rows["rows"], "updated": 0, "skilled_in": post_rows["skilled"], "skilled_out": 0, "buckets": buckets}
    else:
        new_raw = merge.upsert_raw(tables["raw_postings"], raw)
        companies = merge.upsert_companies(tables["companies"], dim, order)
        postings = merge.upsert_postings(tables["postings"], rows)
    before = previous["counts"] if previous else {}
    had = lambda k: before.get(k, 0)
    counts = {"raw_postings": had("raw_postings") + new_raw["new"], "companies": had("companies") + companies["new"],
              "postings": had("postings") + postings["new"],
              "postings_with_skills": had("postings_with_skills") + postings["skilled_in"] - postings["skilled_out"]}

    all_postings = tables["postings"].read()
    enriched = staging.with_company(all_postings, tables["companies"].read())
    for t, df in (("salary_by_role", marts.salary_cells(enriched, snapshot_date)),
                  ("skill_demand", marts.skill_demand(all_postings, snapshot_date)),
                  ("company_activity", marts.company_activity(all_postings, snapshot_date))):
        rows_seen = Observation()
        sinks.write_mart(spark, df.observe(rows_seen, one.alias("n")), paths[t], t)
        counts[t] = observed(rows_seen, "n")["n"]
    batch = {**observed(seen, "feed_rows"), **kept, "raw_rows": raw_rows["rows"], "raw_new": new_raw["new"],
             "raw_skipped": raw_rows["rows"] - new_raw["new"], "companies_new": companies["new"],
             "companies_updated": companies["updated"], "postings_new": postings["new"], "postings_updated": postings["updated"],
             "company_buckets": companies["buckets"], "posting_buckets": postings["buckets"]}
    return {"root": home, "paths": paths, "feed": feed_path, "counts": counts, "batch": batch, "buckets": buckets,
            "snapshot_date": snapshot_date}


def table(spark: SparkSession, done: dict, name: str) -> DataFrame:
    """A table of a finished run: a keyed table whole, a mart in its newest snapshot."""
    if name in STORED_KEYS:
        return stored_table(spark, done["root"], name, done["buckets"]).read()
    return sinks.read_mart(spark, done["paths"][name], name)


def mart_slices(spark: SparkSession, paths: dict) -> DataFrame:
    """(table_name, snapshot_date, n_rows) for every stored mart slice."""
    out = None
    for t in sinks.MARTS:
        df = spark.read.parquet(paths[t]).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"))
        df = df.select(F.lit(t).alias("table_name"), "snapshot_date", "n_rows")
        out = df if out is None else out.unionByName(df)
    return out
