"""Exact, skew-safe grouped percentiles.

Spark's ``percentile`` keeps a value->count map per group and merges the
maps of every map task for a group in one reducer, so a hot group (a third
of all rows) sends one map per map task to a single task.  Here the work is
split by value instead:

1. ``groupBy(keys, value).count()`` -- a histogram; partial aggregation
   first, then a shuffle on (keys, value), so a hot group is spread over
   many reducers by its values.
2. A running sum over the histogram of each group gives each distinct
   value its rank interval.  A group now holds at most one row per
   *distinct* value, whatever its row count.
3. One more aggregation over the same partitioning (no new exchange) picks
   the values at the two ranks around each quantile and interpolates.

Interpolation is linear between the closest ranks, computed in the same
floating-point steps as numpy's default ("linear") method:
``index = (n - 1) * q``; ``lo + (hi - lo) * g`` when ``g < 0.5`` and
``hi - (hi - lo) * (1 - g)`` otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _name(q: float) -> str:
    return str(q).replace(".", "_")


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Sequence[float],
    count_rows: bool = True,
    extra_sums: Sequence[str] = (),
    extremes: bool = False,
) -> DataFrame:
    """keys + n_rows + n_values + ``q_<q>`` (DOUBLE, NULL when no values) per group.

    ``n_rows`` counts every row of the group, ``n_values`` the non-NULL
    values; NULL values are ignored by the quantiles.  ``extra_sums`` are
    numeric columns summed per group in the same pass (no second
    aggregation and join needed for side counts); ``extremes`` adds
    ``min_value``/``max_value``.
    """
    keys = list(keys)
    v = F.col(value)
    hist = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in extra_sums]
    )
    vc = F.when(v.isNotNull(), F.col("_rows")).otherwise(F.lit(0))
    w_run = (
        Window.partitionBy(*keys)
        .orderBy(v.asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    w_all = Window.partitionBy(*keys)
    hist = hist.withColumn("_cum", F.sum(vc).over(w_run)).withColumn("_n", F.sum(vc).over(w_all))
    start = F.col("_cum") - vc  # this value holds 0-based ranks [start, _cum)
    n = F.col("_n").cast("double")

    aggs = [F.max("_n").alias("n_values")] + [F.sum(c).alias(c) for c in extra_sums]
    if extremes:
        aggs += [F.min(v).alias("min_value"), F.max(v).alias("max_value")]
    if count_rows:
        aggs.insert(0, F.sum("_rows").alias("n_rows"))
    for q in quantiles:
        idx = (n - F.lit(1.0)) * F.lit(float(q))
        lo = F.floor(idx)
        hi = F.ceil(idx)
        at = lambda r: F.when(v.isNotNull() & (start <= r) & (r < F.col("_cum")), v)
        aggs += [
            F.max(at(lo)).alias(f"_lo_{_name(q)}"),
            F.max(at(hi)).alias(f"_hi_{_name(q)}"),
            F.max(idx - lo).alias(f"_g_{_name(q)}"),
        ]
    res = hist.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys] + ([F.col("n_rows")] if count_rows else []) + [F.col("n_values")]
    out += [F.col(c) for c in extra_sums]
    if extremes:
        out += [F.col("min_value"), F.col("max_value")]
    for q in quantiles:
        lo_v = F.col(f"_lo_{_name(q)}").cast("double")
        hi_v = F.col(f"_hi_{_name(q)}").cast("double")
        g = F.col(f"_g_{_name(q)}")
        diff = hi_v - lo_v
        interp = F.when(g >= 0.5, hi_v - diff * (F.lit(1.0) - g)).otherwise(lo_v + diff * g)
        out.append(F.when(F.col("n_values") > 0, interp).alias(f"q_{_name(q)}"))
    return res.select(*out)


def quantile_col(q: float) -> str:
    return f"q_{_name(q)}"


def truncate_int(c: Column) -> Column:
    """Python ``int(x)`` on a float: truncation toward zero."""
    return c.cast("int")
