"""Stored keyed tables: Parquet in hash buckets, of which a batch rewrites only those it touches.

A table is partitioned by ``bucket`` (Spark's own bucket number of the key)
and, within it, declared as clustered by the same key into the same number of
buckets.  The first lets a batch prune the scan to the buckets that hold one of
its keys and replace just those by dynamic partition overwrite; the second
lets Spark join and aggregate the stored rows by key without an Exchange, so
only the batch is shuffled.

Dynamic overwrite writes the new files beside the table and moves them in when
the job commits, so the slice being replaced may be read by the same job and a
lost executor costs its own tasks.  If the driver dies between two moves, some
buckets hold the batch and some do not: every merge here gives the same rows
when it is run again, so the batch is simply repeated.

The session catalog names a table for as long as the session lasts; the files
are self-contained and ``StoredTable`` declares them again in another session.
The number of buckets is part of the folder's name.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import list_subdirs, remove

BUCKET = "bucket"


class StoredTable:
    """One keyed table under ``root``; ``schema`` are its columns without the bucket."""

    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType, key: Sequence[str], buckets: int):
        if buckets < 1:
            raise ValueError("a table has at least one bucket")
        self.spark, self.schema, self.key, self.buckets = spark, schema, list(key), buckets
        self.path = os.path.join(root, f"{name}-{buckets}")
        #: the same folder has the same name in every session
        self.name = "stored_" + re.sub(r"\W", "_", self.path)
        columns = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + [T.StructField(BUCKET, T.IntegerType())])
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({declared}) USING parquet "
                  f"OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY ({BUCKET}) "
                  f"CLUSTERED BY ({', '.join(self.key)}) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def bucket_of(self) -> Column:
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        """All rows."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).drop(BUCKET)

    def typed(self, rows: DataFrame) -> DataFrame:
        """The table's columns in its types, on which a key's bucket depends."""
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets that hold a key of the batch: at most ``buckets`` numbers on the driver."""
        return sorted(r[0] for r in self.typed(batch).select(self.bucket_of()).distinct().collect())

    def slice(self, touched: Sequence[int]) -> DataFrame:
        """The rows of some buckets; the others are not listed or read."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).filter(F.col(BUCKET).isin(list(touched))).drop(BUCKET)

    def replace(self, rows: DataFrame) -> None:
        """The buckets of these rows hold them and no others.

        ``rows`` come from a join by key with a slice of the table and so lie
        in its buckets already: each is written by one task, without another
        Exchange.  A bucket without a row among them keeps what it held.
        """
        self.typed(rows).withColumn(BUCKET, self.bucket_of()).write.insertInto(self.name, overwrite=True)

    def append(self, rows: DataFrame) -> None:
        """``rows`` are added, one file per bucket; no stored file is read or rewritten.

        Dealt out by the key and not by the bucket's number: each task then
        holds just one bucket, where hashed numbers would give one task
        several and others none.
        """
        out = self.typed(rows).repartition(self.buckets, *self.key).withColumn(BUCKET, self.bucket_of())
        out.write.insertInto(self.name)

    def clear(self, buckets: Sequence[int]) -> None:
        """Buckets that hold nothing any more: their folders are removed."""
        for b in buckets:
            remove(self.spark, os.path.join(self.path, f"{BUCKET}={b}"))

    def stored_buckets(self) -> list[int]:
        """Buckets that hold files, from the folder's listing."""
        return sorted(int(d.split("=")[1]) for d in list_subdirs(self.spark, self.path) if d.startswith(f"{BUCKET}="))
