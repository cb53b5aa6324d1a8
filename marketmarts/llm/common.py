"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.session import load, scratch_path

__all__ = ["at", "field_type", "load", "sequence_to", "stored", "text_or_empty"]


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once under the cluster's shared folder and read it back.

    Cuts the lineage: later steps read finished files, so a lost executor
    costs only its own running tasks, and work with several readers runs once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def sequence_to(n: Column) -> Column:
    """0 .. n-1 as an array (empty for n <= 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def at(xs: Column, i: Column) -> Column:
    """Element i (from 0) of an array; null outside it."""
    return F.get(xs, i)
