"""What the two vector searches share: clean vectors, distinct vectors with their ids, packed blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """Not null, not empty and without null or non-finite components."""
    big = F.lit(1.7976931348623157e308)
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= big))


def distinct_vectors(rows: DataFrame, keep_ids: int) -> DataFrame:
    """(vec, ids): every different vector of (id, vec) with its ``keep_ids`` smallest ids, ascending.

    Equal vectors score alike and ties go to smaller ids, so no other id can
    reach a result of fewer than ``keep_ids`` places.  The rank is cut in each
    task before the shuffle, so a vector with a third of all rows is no group.
    """
    nth = Window.partitionBy("vec").orderBy("id")
    few = rows.select("id", "vec").distinct().withColumn("_n", F.row_number().over(nth)).filter(F.col("_n") <= keep_ids)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def packed(rows: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Rows (keys, vec, ids) as one row per key group: n, width, vecs (matrix bytes), ids (list of lists)."""
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    types = [rows.schema[k].dataType.simpleString() for k in keys]

    def run(table: pa.Table) -> pa.Table:
        flat = table.column("vec").combine_chunks()
        m = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), kind)
        out = {k: pa.array([table.column(k)[0].as_py()], pa.int32() if t == "int" else pa.int64()) for k, t in zip(keys, types)}
        out |= {"n": pa.array([len(table)], pa.int32()), "width": pa.array([len(m) // len(table)], pa.int32()),
                "vecs": pa.array([m.tobytes()], pa.binary()),
                "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))}
        return pa.table(out)

    return rows.select(*keys, "vec", "ids").groupBy(*keys).applyInArrow(
        run, schema + ", n int, width int, vecs binary, ids array<array<bigint>>")


def ranked(found: DataFrame, by: list[str], first: Column, places: int) -> DataFrame:
    """The best ``places`` rows per key with their rank; ties to the smaller vec_id."""
    order = Window.partitionBy(*by).orderBy(first, "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= places)


Batches = Iterator[pa.RecordBatch]
