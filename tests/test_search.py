"""BM25, hybrid fusion and the metamorphic checks of SURVEY §5."""

import math

import pytest

from pyspark.sql import functions as F

from quarry.operators import fulltext as ft
from quarry.operators import hybrid as hy
from quarry.operators.knn import knn


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame(
        [(1, "apple apple pie"), (2, "apple tart"), (3, "cherry pie"), (4, "nothing here")], "id long, document string"
    )
    q = spark.createDataFrame([(0, "apple pie")], "query_id long, query_text string")
    got = {r["id"]: r["score"] for r in ft.bm25_topk(docs, q, 10).collect()}
    n, avgdl = 4, (3 + 2 + 2 + 2) / 4

    def idf(df):
        return math.log(1 + (n - df + 0.5) / (df + 0.5))

    def term(tf, dl, df):
        return idf(df) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))

    expect = {1: term(2, 3, 2) + term(1, 3, 2), 2: term(1, 2, 2), 3: term(1, 2, 2)}
    assert set(got) == set(expect)
    for k, v in expect.items():
        assert abs(got[k] - round(v, 6)) < 1e-6


def test_rrf_values(spark):
    t = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "query_id long, id long, text_rank long")
    v = spark.createDataFrame([(0, 2, 1), (0, 3, 2)], "query_id long, id long, vector_rank long")
    got = {r["id"]: (r["rrf"], r["rrf_rank"]) for r in hy.fuse_rrf([t, v], ["text_rank", "vector_rank"], 10).collect()}
    assert got[2][0] == 1 / 62 + 1 / 61 and got[2][1] == 1
    assert got[1][0] == 1 / 61 and got[3][0] == 1 / 62
    assert got[1][1] == 2 and got[3][1] == 3


def test_hybrid_with_empty_text_leg_is_vector_order(spark):
    """H8: no query term occurs in the corpus -> fused order = vector order."""
    rows = [(i, f"word{i} filler", [float(i % 7), 1.0, float(i % 3)]) for i in range(30)]
    docs = spark.createDataFrame(rows, "id long, document string, embedding array<float>")
    q = spark.createDataFrame([(0, "zzzz qqqq", [1.0, 1.0, 0.0])], "query_id long, query_text string, query_vector array<double>")
    res = hy.hybrid_search(docs, q, k=5)
    fused = [r["id"] for r in sorted(res.collect(), key=lambda r: r["rrf_rank"])]
    vec = [r["id"] for r in sorted(knn(docs, q, 5).collect(), key=lambda r: r["rank"])]
    assert fused == vec
    assert all(r["text_rank"] is None for r in res.collect())


def test_display_order_nulls_last(spark):
    fused = spark.createDataFrame(
        [(0, 1, 0.3, 1), (0, 2, None, 2), (0, 3, 0.1, 3)], "query_id long, id long, distance double, rrf_rank long"
    )
    got = [r["id"] for r in sorted(hy.display_order(fused).collect(), key=lambda r: r["distance_rank"])]
    assert got == [3, 1, 2]


def test_substring_get_limit_is_exact(spark):
    docs = spark.createDataFrame([(i, "x the y" if i % 3 else "none") for i in range(200)], "id long, document string")
    docs = docs.repartition(7)
    q = spark.createDataFrame([(0, "the"), (1, "none"), (2, "absent")], "query_id long, query_text string")
    got = ft.fulltext_get(docs, q, 5).collect()
    by_q = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_q.setdefault(r["query_id"], []).append(r["id"])
    assert by_q[0] == [1, 2, 4, 5, 7]
    assert by_q[1] == [0, 3, 6, 9, 12]
    assert 2 not in by_q


def test_multi_pass_equals_single_pass(spark, monkeypatch):
    """Query batches split into several broadcast passes give the same rows."""
    import numpy as np

    from quarry.operators import knn as knn_mod

    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    docs = spark.createDataFrame(
        [(i, " ".join(rng.choice(words, size=6)), rng.normal(size=4).astype(np.float32).tolist()) for i in range(120)],
        "id long, document string, embedding array<float>",
    ).repartition(3)
    q = spark.createDataFrame(
        [(j, " ".join(rng.choice(words, size=2)), rng.normal(size=4).tolist()) for j in range(9)],
        "query_id long, query_text string, query_vector array<double>",
    )

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    one_text = rows(ft.bm25_topk(docs, q, 4))
    one_vec = rows(knn(docs, q, 4))
    monkeypatch.setattr(ft, "MAX_QUERIES_PER_PASS", 2)
    monkeypatch.setattr(ft, "MAX_STATS_VOCAB", 1)  # statistics per pass as well
    monkeypatch.setattr(knn_mod, "MAX_QUERIES_PER_PASS", 2)
    assert rows(ft.bm25_topk(docs, q, 4)) == one_text
    assert rows(knn(docs, q, 4)) == one_vec


def test_matches_are_held_in_bounded_blocks():
    import tracemalloc

    import numpy as np
    from quarry.operators import fulltext as ft

    n_terms, n_rows = 50, 500
    index = ft.TermIndex([np.arange(n_terms)] * 100, n_terms)
    row, term = np.repeat(np.arange(n_rows), n_terms), np.tile(np.arange(n_terms), n_rows)
    weight = np.random.default_rng(0).random(len(row))
    tracemalloc.start()
    seen, total = 0, 0.0
    for r, q, s in ft.query_sums(index, row, term, weight):
        seen += len(r)
        total += s.sum()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n_rows * 100 and abs(total - 100 * weight.sum()) < 1e-6
    assert peak < 60e6


def test_few_and_many_matches_give_the_same_sums():
    import numpy as np
    from quarry.operators import fulltext as ft

    rng = np.random.default_rng(1)
    for n_queries, per in ((3, 20), (4000, 2)):
        asked = [np.unique(rng.integers(0, 300, per)) for _ in range(n_queries)]
        pairs = np.unique(rng.integers(0, 40, 600) * 300 + rng.integers(0, 300, 600))
        weight = rng.random(len(pairs))
        want = {}
        for p, w in zip(pairs.tolist(), weight):
            for q, terms in enumerate(asked):
                if p % 300 in terms:
                    want[p // 300, q] = want.get((p // 300, q), 0.0) + w
        got = {(int(a), int(b)): c for r, q, s in ft.query_sums(ft.TermIndex(asked, 300), pairs // 300, pairs % 300, weight) for a, b, c in zip(r, q, s)}
        assert got == want


def test_stream_files_follow_the_tasks(spark, monkeypatch):
    from quarry.plans import scenarios

    seen = {}

    def look(spark, files, glob, schema, prepare, location, checkpoint, per_batch, **options):
        seen.update(files=len(spark.read.parquet(files).inputFiles()), per_batch=per_batch)
        raise RuntimeError("seen")

    monkeypatch.setattr(scenarios.ingest, "ingest_collection", look)
    with pytest.raises(RuntimeError, match="seen"):
        scenarios.stream_search(spark, "/root/testdata/sf0.001")
    assert seen["per_batch"] == 2 and seen["files"] > 3
