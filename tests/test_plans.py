"""Physical-plan invariants of every driver query (checked on the smallest tables).

No query may fall back to a cartesian product or a nested-loop join, and
none may run Python per row: everything stays in JVM operators.
"""

import pytest

from conftest import SF_SMALL
from marketmarts.plans import queries

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cartesian_nested_loop_or_python(spark, name):
    plan = _plan(queries.QUERIES[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} uses {op}"


def test_skill_counts_aggregate_before_the_shuffle(spark):
    from marketmarts.plans import queries as Q

    df = Q.q_skill_demand(spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(role_family" in line and "skill" in line)
    assert "HashAggregate" in lines[shuffle + 1] and "partial_count" in lines[shuffle + 1]


def test_stored_scan_pushes_filters_and_prunes_columns(spark):
    from pyspark.sql import functions as F

    from marketmarts.plans import queries as Q, sinks
    from marketmarts.session import scratch_path

    path = scratch_path(spark, "plan-scan")
    sinks.write_table(Q.Chain(spark, SF_SMALL).postings, path, "postings")
    df = spark.read.parquet(path).filter(F.col("role_family") == "data_engineering").select("posting_id")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(role_family), EqualTo(role_family,data_engineering)]" in plan
    assert "ReadSchema: struct<posting_id:string,role_family:string>" in plan
