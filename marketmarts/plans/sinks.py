"""Table sinks: typed Parquet tables and snapshot-partitioned marts.

Mart slices are replaced with dynamic partition overwrite: only the
``snapshot_date`` partitions present in the written frame are replaced, so
a rerun for the same day is idempotent, older snapshots stay, and an empty
frame leaves the existing slice alone.  The mode is an option of the write,
so queries of one session do not see each other's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLE_RULES, table_schema
from ..session import list_subdirs

MARTS = ("salary_by_role", "skill_demand", "company_activity")
SNAPSHOT_DATE = "snapshot_date"


def typed(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in declared order and types (extra columns dropped)."""
    cols = TABLE_RULES[table]["columns"]
    return df.select(*[F.col(c).cast(t).alias(c) for c, (t, _) in cols.items()])


def write_table(df: DataFrame, path: str, table: str | None = None, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table (typed when ``table`` names a declared table)."""
    out = typed(df, table) if table else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_mart(spark: SparkSession, df: DataFrame, path: str, table: str) -> None:
    """Replace the snapshot slices present in ``df``; other snapshots are kept."""
    if table not in MARTS:
        raise ValueError(f"unknown mart {table!r}")
    (typed(df, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(SNAPSHOT_DATE).parquet(path))


def snapshots(spark: SparkSession, path: str) -> list[dt.date]:
    """Snapshot dates of a mart, oldest first, from the listing of its folder; no file is opened."""
    lead = f"{SNAPSHOT_DATE}="
    return sorted(dt.date.fromisoformat(d.removeprefix(lead)) for d in list_subdirs(spark, path) if d.startswith(lead))


def read_mart(spark: SparkSession, path: str, table: str, snapshot_date: str | dt.date | None = None) -> DataFrame:
    """One snapshot of a mart, its newest unless one is named, with the declared columns.

    The date is known before the scan is planned and becomes a partition
    filter on a literal: other snapshots are neither listed nor read.  A
    mart without snapshots is an empty frame of its columns.
    """
    if table not in MARTS:
        raise ValueError(f"unknown mart {table!r}")
    schema = table_schema(table)
    if snapshot_date is None:
        found = snapshots(spark, path)
        if not found:
            return spark.createDataFrame([], schema)
        snapshot_date = found[-1]
    day = snapshot_date if isinstance(snapshot_date, dt.date) else dt.date.fromisoformat(snapshot_date)
    stored = spark.read.schema(schema).parquet(path).filter(F.col(SNAPSHOT_DATE) == F.lit(day))
    return stored.select(*schema.names)


def read_all_snapshots(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Every snapshot of a mart with its declared columns."""
    schema = table_schema(table)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
