"""Exact kNN kernel against numpy brute force; ties, zero vectors, native single-query path."""

import numpy as np
import pytest

from quarry.functions.vectors import np_distances
from quarry.operators import knn as knn_mod
from quarry.operators.knn import knn_join, knn, knn_single, vector_rejects


def brute(corpus, queries, k, metric):
    ids = np.array([c[0] for c in corpus])
    mat = np.array([c[1] for c in corpus], dtype=np.float64)
    out = {}
    for qid, qv in queries:
        d = np_distances(np.array([qv], dtype=np.float64), mat, metric)[0]
        keys = np.floor(d * 1e12 + 0.5)
        ok = ~np.isnan(d)
        order = sorted([(keys[i], ids[i]) for i in range(len(ids)) if ok[i]])[:k]
        out[qid] = [int(i) for _, i in order]
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_knn_matches_brute_force(spark, metric):
    rng = np.random.default_rng(7)
    corpus = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    corpus += [(300 + i, corpus[5][1]) for i in range(40)]  # a block of exact copies (ties)
    corpus.append((999, [0.0] * 8))  # zero vector: undefined cosine
    queries = [(q, rng.normal(size=8).tolist()) for q in range(6)] + [(6, corpus[5][1])]
    cdf = spark.createDataFrame(corpus, "id long, embedding array<float>").repartition(5)
    qdf = spark.createDataFrame(queries, "query_id long, query_vector array<double>")
    got = knn(cdf, qdf, 7, metric).collect()
    by_q = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_q.setdefault(r["query_id"], []).append(r["id"])
    assert by_q == brute(corpus, queries, 7, metric)
    if metric == "cosine":
        assert 999 not in {r["id"] for r in got}
        # the copies tie with id 5: the smallest ids win the tie
        assert by_q[6][:7] == [5, 300, 301, 302, 303, 304, 305]


def test_knn_single_equals_batch(spark):
    rng = np.random.default_rng(3)
    corpus = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(100)]
    q = rng.normal(size=4).tolist()
    cdf = spark.createDataFrame(corpus, "id long, embedding array<float>")
    single = [(r["id"], r["rank"]) for r in knn_single(cdf, q, 5).collect()]
    batch = [(r["id"], r["rank"]) for r in knn(cdf, spark.createDataFrame([(0, q)], "query_id long, query_vector array<double>"), 5).collect()]
    assert sorted(single, key=lambda x: x[1]) == sorted(batch, key=lambda x: x[1])


def test_knn_pre_filter_and_dimension_check(spark):
    corpus = [(i, [float(i), 1.0], "a" if i % 2 else "b") for i in range(20)] + [(50, [1.0, 1.0, 1.0], "a")]
    cdf = spark.createDataFrame(corpus, "id long, embedding array<float>, g string")
    qdf = spark.createDataFrame([(0, [1.0, 1.0])], "query_id long, query_vector array<double>")
    from pyspark.sql import functions as F

    got = knn(cdf, qdf, 3, "l2", where=F.col("g") == "a", dim=2).collect()
    assert sorted(r["id"] for r in got) == [1, 3, 5]


def test_hashed_tf_embedding_matches_native_buckets(spark):
    from pyspark.sql import functions as F

    from quarry.functions.tokens import tokenize
    from quarry.functions.vectors import hashed_tf_embedding, token_buckets

    rows = [("the cat the hat",), ("",), (None,), ("Ünïcode wörds wörds 42",)]
    df = spark.createDataFrame(rows, "t string").select(tokenize(F.col("t")).alias("tok"))
    got = df.select(hashed_tf_embedding(F.col("tok"), 16).alias("v"), token_buckets(F.col("tok"), 16).alias("b")).collect()
    for r in got:
        if r["b"] is None:
            assert r["v"] is None
            continue
        counts = np.bincount(np.asarray(r["b"], dtype=np.int64), minlength=16).astype(np.float64)
        n = np.sqrt((counts * counts).sum())
        expect = (counts / n if n > 0 else counts).astype(np.float32)
        assert np.array_equal(np.asarray(r["v"], dtype=np.float32), expect)


def test_exact_match_ranks_before_a_near_tie(spark):
    base = [1.0, 2.0, 3.0]
    rows = [(1, [1.0, 2.0, 3.003]), (2, base)]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>")
    q = spark.createDataFrame([(0, base)], "query_id long, query_vector array<double>")
    for metric in ("cosine", "l2"):
        assert [r["id"] for r in knn(corpus, q, 2, metric).orderBy("rank").collect()] == [2, 1]


def test_rejected_vectors_are_counted_or_fail(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [0.0, 0.0])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, query_vector array<double>")
    assert [r["id"] for r in knn(corpus, q, 5).collect()] == [1]
    assert tuple(vector_rejects(corpus, 2).first()) == (4, 1, 1, 1)
    with pytest.raises(Exception, match="2 dimensions"):
        knn(corpus, q, 5, on_reject="error").collect()


def test_block_join_equals_broadcast(spark, monkeypatch):
    """Several slices and groups, repeated and rejected vectors on both sides, a third of the corpus alike."""
    rng = np.random.default_rng(6)
    corpus = [(i, [1.0, 1.0, 2.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(400)] + [(900, None), (901, [1.0]), (902, [0.0, 0.0, 0.0])]
    queries = [(f"q{i}", corpus[i][1]) for i in range(40)]
    cdf = spark.createDataFrame(corpus, "id long, embedding array<double>")
    qdf = spark.createDataFrame(queries, "query_id string, query_vector array<double>")
    odd = qdf.union(spark.createDataFrame([("none", None), ("short", [1.0])], "query_id string, query_vector array<double>"))
    for metric in ("cosine", "l2", "ip"):
        want = sorted(map(tuple, knn(cdf, qdf, 7, metric).collect()))
        monkeypatch.setattr(knn_mod, "QUERY_BLOCK", 9)
        monkeypatch.setattr(knn_mod, "CORPUS_BLOCK", 50)
        assert sorted(map(tuple, knn_join(cdf, odd, 7, metric).collect())) == want
    assert tuple(vector_rejects(odd, 3, "query_vector").first()) == (42, 1, 1, 0)
    with pytest.raises(Exception, match="null or not of 3"):
        knn_join(cdf, odd, 7, on_reject="error").collect()
    with pytest.raises(ValueError, match="no vector"):
        knn(cdf, odd, 7, on_reject="error")
    monkeypatch.setattr(knn_mod, "MAX_QUERIES_PER_PASS", 5)
    assert sorted(map(tuple, knn(cdf, qdf, 7, "l2").collect())) == sorted(map(tuple, knn_join(cdf, qdf, 7, "l2").collect()))
