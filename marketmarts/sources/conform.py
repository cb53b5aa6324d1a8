"""Bring any posting-shaped frame to the one feed schema (missing fields tolerated)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..schemas import POSTING_FEED


def _fit(col, src_type, dst_type):
    """Cast ``col`` to ``dst_type``; struct fields missing in the source become NULL."""
    if isinstance(dst_type, T.StructType) and isinstance(src_type, T.StructType):
        have = {f.name: f.dataType for f in src_type.fields}
        parts = [
            (_fit(col.getField(f.name), have[f.name], f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in dst_type.fields
        ]
        return F.when(col.isNull(), F.lit(None).cast(dst_type)).otherwise(F.struct(*parts))
    if isinstance(src_type, T.StringType) and isinstance(dst_type, T.IntegerType):
        return col.try_cast("double").try_cast(dst_type)  # "2.0" is 2
    lenient = isinstance(src_type, (T.DoubleType, T.StringType)) and not isinstance(dst_type, T.StringType)
    return col.try_cast(dst_type) if lenient else col.cast(dst_type)


def _utc(name: str):
    """Naive UTC time of ISO text, with or without a zone."""
    zoned = F.expr(f"convert_timezone(current_timezone(), 'UTC', CAST(try_cast({name} AS TIMESTAMP) AS TIMESTAMP_NTZ))")
    has_zone = F.col(name).rlike(r"\d\s*(Z|[+-]\d{1,2}(:?\d{2})?)\s*$") & F.col(name).contains(":")
    return F.when(has_zone, zoned).otherwise(F.expr(f"try_cast({name} AS TIMESTAMP_NTZ)"))


def conform_feed(df: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Select POSTING_FEED columns in order, typed; absent columns become NULL.

    ``fetched_at`` given as text is parsed (ISO-8601): naive text is UTC, text
    with a zone is converted to UTC; text that does not parse becomes NULL and
    is kept in ``fetched_at_text``, so the row stays.  Numbers that do not fit
    their type become NULL.
    """
    cols = []
    present = {f.name: f.dataType for f in df.schema.fields}
    for f in POSTING_FEED.fields:
        if f.name == "fetched_at_text" and f.name not in present and isinstance(present.get("fetched_at"), T.StringType):
            cols.append(F.when(_utc("fetched_at").isNull(), F.col("fetched_at")).alias(f.name))
        elif f.name in present:
            c = F.col(f.name)
            if f.name == "fetched_at" and isinstance(present[f.name], T.StringType):
                cols.append(_utc("fetched_at").alias(f.name))
                continue
            cols.append(_fit(c, present[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [F.col(k) for k in keep if k in present]
    return df.select(*extra, *cols)
