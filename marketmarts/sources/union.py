"""All sources in one shape, and rows per configured source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conform import conform_feed


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate posting-shaped frames by name; fields a source lacks become NULL.

    ``seq`` becomes STRUCT<source_no, file_path, pos>: the place of the frame
    in ``frames``, then the frame's own ingest order (a number, a scan's file
    and position, or the row order of a frame without one), so staging takes
    the result as it is.
    """
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn("seq", _position(df, i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return conform_feed(out)


def _position(df: DataFrame, source_no: int) -> Column:
    path, pos = F.lit(""), F.monotonically_increasing_id()
    if "seq" in df.columns:
        own = F.col("seq")
        path, pos = (own["file_path"], own["pos"]) if isinstance(df.schema["seq"].dataType, T.StructType) else (path, own)
    return F.struct(F.lit(source_no).alias("source_no"), path.alias("file_path"), pos.cast("bigint").alias("pos"))


def rows_per_source(spark: SparkSession, postings: DataFrame, configured: Sequence[str]) -> DataFrame:
    """(source, n_rows) for every configured source; a source with no rows counts 0.

    The data side is aggregated before the join; how the two small sides
    meet is left to the planner, which knows their sizes.
    """
    cfg = spark.createDataFrame([(s,) for s in configured], T.StructType([T.StructField("source", T.StringType())]))
    counts = postings.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    return cfg.join(counts, "source", "left").select(
        "source", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")
    )
