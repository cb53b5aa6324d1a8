import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketmarts.llm import ann, topk

ODD = "vec_id long, embedding array<float>, vec string, ids string"


def odd_vectors(spark, n=60):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.integers(-3, 4, 4).astype(float).tolist(), "clash", None) for i in range(n)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 0.5], None, None) for i in range(40)]
    rows += [(500, None, None, None), (501, [1.0, None, 1.0, 1.0], None, None), (502, [float("nan")] * 4, None, None),
             (503, [float("inf"), 0.0, 0.0, 0.0], None, None), (504, [], None, None), (None, [1.0] * 4, None, None), (0, rows[0][1], "x", "y")]
    return rows, spark.createDataFrame(rows, ODD)


def usable(rows):
    return sorted({(i, tuple(v)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all()})


def test_top_k_with_ties_and_odd_rows(spark):
    rows, df = odd_vectors(spark)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 20, block_rows=16, query_rows=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    pool = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in usable(rows)]
    for q, x in pool:
        if q % 20 == 0:
            want = sorted((-int(x @ y), i) for i, y in pool if i != q)[:20]
            assert sorted(got.pop(q)) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert not got
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_sorted_lists_stop_early_and_stay_exact():
    rnd = np.random.default_rng(1)
    x = np.concatenate((rnd.integers(-9, 10, (3000, 8)), rnd.integers(60, 90, (60, 8))))
    lists = topk.SortedLists(x)
    queries = rnd.integers(1, 9, (20, 8))
    for q, (rows, scores) in zip(queries, lists.top(queries, 21)):
        assert len(rows) <= topk.FEW
        assert sorted(scores)[-21:] == sorted(x @ q)[-21:]


def test_nearest_recall_and_odd_rows(spark):
    rows, df = odd_vectors(spark)
    pool = [(i, np.array(v)) for i, v in usable(rows) if any(v)]
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, 10, list_rows=8).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, x in pool:
        if q % 20 == 0:
            assert len(got[q]) == 10 and q not in {v for _, v, _ in got[q]}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0, 10).count() == 0
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    p = e.toPandas()
    x = np.array(p.embedding.tolist(), float)
    hit = n = 0
    for r in ann.nearest(e, F.col("vec_id") % 100 == 0, 10, list_rows=16, least=4).groupBy("query_id").agg(
            F.collect_set("vec_id").alias("v")).collect():
        d = ((x - x[p.vec_id == r.query_id]) ** 2).sum(axis=1)
        best = p.vec_id[np.argsort(d, kind="stable")[1:11]]
        hit, n = hit + len(set(best) & set(r.v)), n + 10
    assert hit / n >= 0.9


def test_every_length_is_indexed_and_asked(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, rnd.normal(size=5).tolist()) for i in range(200)]
    rows += [(2000, [1.0]), (2001, [2.0]), (2100, [1.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0, 10, sample_rows=120, list_rows=16, least=40).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 1000, 1100, 2000}  # 2100 has no other vector of its length
    for q, found in got.items():
        x = np.array(dict(rows)[q])
        want = sorted((float(np.sqrt(((np.array(v) - x) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(x))[:10]
        assert [(k, i) for k, i, _ in sorted(found)] == [(k + 1, i) for k, (_, i) in enumerate(want)]


def test_tasks_are_sent_arrays_only():
    import pickle

    centroids = ann.balanced_centroids(np.random.default_rng(1).normal(size=(200, 6)), 16)
    sent = pickle.dumps({6: (centroids, ann.centroid_links(centroids))})
    assert b"marketmarts" not in sent  # nothing an executor would have to import


def test_recall_at_the_settings_of_the_query(spark):
    from marketmarts.llm.queries import op7_ann

    p = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x = np.array(p.embedding.tolist(), float)
    got = {}
    for r in op7_ann(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q, found in got.items():
        d = ((x - x[p.vec_id == q]) ** 2).sum(axis=1)
        hit += len(set(p.vec_id[np.argsort(d, kind="stable")[1:11]]) & found)
    assert len(got) == (p.vec_id % 100 == 0).sum() and hit / (10 * len(got)) >= 0.9


def test_top_k_of_large_components_is_exact_or_fails(spark):
    import pytest

    e = "vec_id long, embedding array<double>"
    big = spark.createDataFrame([(20, [3e7, 1.0]), (6, [2.9e7, 3e7]), (9, [3e7, -3e7])], e)
    got = [(r.vec_id, r.score) for r in topk.top_k(big, F.col("vec_id") == 20, 2).orderBy("rank").collect()]
    a, b = 64 * 30_000_000, 64 * 29_000_000
    assert got == [(9, a * a - 64 * a), (6, a * b + 64 * a)]
    for x in (1e15, 1e18):
        with pytest.raises(Exception):
            topk.top_k(spark.createDataFrame([(20, [x, x]), (6, [x, x])], e), F.col("vec_id") == 20, 2).collect()
