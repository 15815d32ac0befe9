"""Metamorphic checks: IVF with every cell probed = exact kNN; streaming ingest = batch preparation."""

import os

import numpy as np

from quarry.operators import ivf
from quarry.operators.knn import knn
from quarry.operators.prepare import prepare_records
from quarry.session import shared_dir
from quarry.sources.raw import books_from_part, read_table
from quarry.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_ivf_all_cells_is_exact(spark):
    rng = np.random.default_rng(11)
    corpus = spark.createDataFrame([(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(400)],
                                   "id long, embedding array<float>")
    q = spark.createDataFrame([(j, rng.normal(size=6).tolist()) for j in range(5)], "query_id long, query_vector array<double>")
    loc = ivf.build_ivf(corpus, shared_dir(spark, "test-ivf"), 6)
    approx = {(r["query_id"], r["id"], r["rank"]) for r in ivf.ivf_knn(spark, loc, q, 8, 6).collect()}
    exact = {(r["query_id"], r["id"], r["rank"]) for r in knn(corpus, q, 8).collect()}
    assert approx == exact
    rec = ivf.recall_at_k(ivf.ivf_knn(spark, loc, q, 8, 1), knn(corpus, q, 8), 8).first()
    assert rec["n_queries"] == 5 and 0.0 <= rec["recall"] <= 1.0


def test_appended_vectors_are_found(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    corpus = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = spark.createDataFrame([(j, rows[200 + j][1]) for j in range(5)], "query_id long, query_vector array<float>")
    loc = ivf.build_ivf(corpus.where("id < 150"), shared_dir(spark, "test-ivf-append"))
    ivf.ivf_append(corpus.where("id >= 150"), loc)
    got = ivf.ivf_knn(spark, loc, q, 1, 1).collect()
    assert {r["query_id"]: r["id"] for r in got} == {j: 200 + j for j in range(5)}  # each in the cell it probes
    exact = {tuple(r) for r in knn(corpus, q, 4).select("query_id", "id", "rank").collect()}
    assert {tuple(r) for r in ivf.ivf_knn(spark, loc, q, 4, ivf.n_cells(spark, loc)).select("query_id", "id", "rank").collect()} == exact


def test_cells_stay_bounded(spark):
    """Appends around one point, a third of them equal, then others: no cell grows over its bound, every row is found."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) + 5 * (i % 2)).tolist()) for i in range(200)]
    make = lambda r: spark.createDataFrame(r, "id long, embedding array<double>")
    loc = ivf.build_ivf(make(rows), shared_dir(spark, "test-ivf-grow"), 4, cell_rows=60)
    for n in range(2):
        more = [(1000 * (n + 1) + i, [1.0, 2.0, 3.0, 4.0] if i % 3 else (rng.normal(size=4)).tolist()) for i in range(240)]
        ivf.ivf_append(make(more), loc, cell_rows=60)
        rows += more
    sizes = [r["count"] for r in ivf.live_vectors(spark, loc).groupBy("cell").count().collect()]
    assert max(sizes) <= 60 and sum(sizes) == len(rows)
    q = spark.createDataFrame([(j, rows[j * 7][1]) for j in range(6)], "query_id long, query_vector array<double>")
    exact = {tuple(r) for r in knn(make(rows), q, 9).select("query_id", "id", "rank").collect()}
    assert {tuple(r) for r in ivf.ivf_knn(spark, loc, q, 9, ivf.n_cells(spark, loc)).select("query_id", "id", "rank").collect()} == exact


def test_recall_curve_is_the_recall_of_every_level(spark):
    rng = np.random.default_rng(8)
    corpus = spark.createDataFrame([(i, rng.normal(size=5).tolist()) for i in range(300)], "id long, embedding array<double>")
    q = corpus.where("id % 30 = 0").select(corpus["id"].alias("query_id"), corpus["embedding"].alias("query_vector"))
    loc = ivf.build_ivf(corpus, shared_dir(spark, "test-ivf-recall"), 9)
    level = ivf.calibrate(spark, loc, q, 8)
    curve = {r["nprobe"]: r for r in spark.read.parquet(f"{loc}/recall").collect()}
    exact = knn(corpus, q, 8)
    for n in (2, max(curve)):
        got = ivf.recall_at_k(ivf.ivf_knn(spark, loc, q, 8, n), exact, 8).first()
        assert got["n_queries"] == curve[n]["n_queries"] == 10 and abs(got["recall"] - curve[n]["recall"]) < 1e-9
    assert curve[max(curve)]["recall"] == 1.0 and curve[level]["lower"] >= 0.9
    assert ivf.wrong_distances(ivf.ivf_knn(spark, loc, q, 8), corpus, q).first()[0] == 0


def test_stream_ingest_equals_batch(spark):
    part = read_table(spark, SF, "part")
    target = shared_dir(spark, "test-stream")
    streamed = ingest.ingest_files(
        spark, SF, "part.parquet", part.schema,
        lambda s: prepare_records(books_from_part(s), id_col="row_key"), target, key="id",
    )
    batch = prepare_records(books_from_part(part), id_col="row_key")
    cols = sorted(batch.columns)
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())
    # running again over the same files and target appends nothing (idempotent)
    again = ingest.ingest_files(
        spark, SF, "part.parquet", part.schema,
        lambda s: prepare_records(books_from_part(s), id_col="row_key"), target, key="id",
    )
    assert again.count() == batch.count()


def test_late_files_lose_nothing(spark):
    """Files in reverse time order, one per micro-batch, with repeated keys and rows: every row is kept or counted."""
    events = read_table(spark, SF, "events")
    src = shared_dir(spark, "test-late-src")
    events.repartitionByRange(3, events["ts"].desc()).write.parquet(src)
    events.limit(50).coalesce(1).write.mode("append").parquet(src)
    target = shared_dir(spark, "test-late")
    out = ingest.dedupe_events(spark, src, "*.parquet", events.schema, "event_id", "ts", target, max_files_per_trigger=1)
    assert sorted(out.collect()) == sorted(events.collect())
    assert ingest.duplicates(spark, target, "event_id").count() == 50


def test_stream_many_files_many_micro_batches(spark):
    """Several source files -> several micro-batches; result equals the batch plan."""
    from pyspark.sql import functions as F

    part = read_table(spark, SF, "part")
    src = shared_dir(spark, "test-stream-src")
    # three files, written by Spark (ids interleaved across files)
    part.repartitionByRange(3, F.col("p_partkey")).write.parquet(src)
    n_files = len([f for f in os.listdir(src) if f.endswith(".parquet")])
    target = shared_dir(spark, "test-stream-multi")
    progress = []

    streamed = ingest.ingest_files(
        spark, src, "*.parquet", part.schema,
        lambda s: prepare_records(books_from_part(s), id_col="row_key"), target, key="id",
        max_files_per_trigger=1, on_progress=progress.append,
    )
    batch = prepare_records(books_from_part(part), id_col="row_key")
    cols = sorted(batch.columns)
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())
    assert n_files == 3 and len(progress) == n_files  # one micro-batch per file
    assert sum(p["n_input"] for p in progress) == part.count()


def test_hot_duplicate_ids_first_wins(spark):
    from pyspark.sql import functions as F

    from quarry.sources import collection as coll

    loc = shared_dir(spark, "test-dups")
    coll.create_collection(spark, loc, "dups", id_type="bigint", recreate=True)
    n = 300
    rows = [((7 if i % 3 == 0 else i), f"doc {i}", "{}", i) for i in range(n)]  # id 7 holds a third of the rows
    df = spark.createDataFrame(rows, "id long, document string, metadata string, _pos long").repartition(4)
    out = coll.add_records(spark, loc, df)
    stored = {r["id"]: r["document"] for r in coll.get_collection(spark, loc).collect()}
    assert stored[7] == "doc 0"  # lowest position wins
    assert len(stored) == 1 + (n - n // 3) - (1 if 7 % 3 else 0)
    dup = {r["id"]: r["n"] for r in out["duplicates_in_batch"].collect()}
    assert dup[7] == n // 3 - (0 if 7 % 3 else 1)
    assert "_pos" not in coll.get_collection(spark, loc).columns
    assert F  # imported for readability of the test data
