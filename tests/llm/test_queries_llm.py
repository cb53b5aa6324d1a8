"""Registered queries with SQL against DuckDB; the others have brute-force tests in this folder."""

import duckdb
import pytest

from conftest import SF_SMALL
from marketmarts.llm.queries import ORACLE_SQL, QUERIES
from marketmarts.session import TABLES
from tools.compare import rows_key


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_key([tuple(r) for r in df.collect()], df.columns) == rows_key(cur.fetchall(), cols)


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = docs
    for name, stage in P.STAGES:
        out = P.stored(stage(spark, out, SF_SMALL), f"test-{name}")
        if name != "tokens":
            assert out.columns == docs.columns
    assert [n for n, _ in P.STAGES] == ["quality", "dedup", "pii", "mix", "tokens"]
    assert out.count() > 0 and "ids_sha256" in out.columns
