"""Stored collections: create, append with rejects, duplicates, info, indexed BM25 = on-the-fly BM25."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import fulltext as ft
from quarry.session import shared_dir
from quarry.sources import collection as coll
from quarry.sources import keys


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "id long, document string, metadata string")


def test_create_append_info(spark):
    loc = shared_dir(spark, "test-coll")
    info = coll.collection_info(spark, loc, "missing").first()
    assert info["n_records"] == 0 and "not found" in info["error"]
    coll.create_collection(spark, loc, "books", id_type="bigint", recreate=True)
    rows = [(1, "apple pie", '{"genre": "Food", "year": 2020}'), (2, "cherry tart", '{"genre": "Food", "year": 2019}'),
            (3, "x", None)]
    out = coll.add_records(spark, loc, docs_df(spark, rows), typed_fields=["genre", "year"])
    assert sorted(r["id"] for r in out["stored"].collect()) == [1, 2]
    assert [r["reject_reason"] for r in out["rejected"].collect()] == ["not_storable"]
    # re-append: existing ids are rejected as duplicates, new ones stored
    out2 = coll.add_records(spark, loc, docs_df(spark, [(2, "again", "{}"), (4, "new pie", "{}")]), typed_fields=["genre"])
    assert sorted(r["id"] for r in out2["stored"].collect()) == [4]
    assert [r["reject_reason"] for r in out2["rejected"].collect()] == ["duplicate_id"]
    q = coll._read(spark, loc, "quarantine")
    assert sorted(r["reject_reason"] for r in q.collect()) == ["duplicate_id", "not_storable"]
    info = coll.collection_info(spark, loc).first()
    assert info["name"] == "books" and info["n_records"] == 3 and info["error"] is None
    recs = coll.get_collection(spark, loc)
    assert recs.where(F.col("gen_year") == 2020).count() == 1
    st = coll.stored_stats(spark, loc).first()
    assert st["n_docs"] == 3 and abs(st["avgdl"] - (2 + 2 + 2) / 3) < 1e-12


def test_indexed_bm25_equals_scan(spark):
    loc = shared_dir(spark, "test-bm25")
    coll.create_collection(spark, loc, "d", id_type="bigint", recreate=True)
    rows = [(i, f"w{i % 5} common w{i % 3} tail{i}", "{}") for i in range(60)]
    coll.add_records(spark, loc, docs_df(spark, rows[:30]))
    coll.add_records(spark, loc, docs_df(spark, rows[30:]))
    q = spark.createDataFrame([(0, "w1 common"), (1, "w2 tail7")], "query_id long, query_text string")
    a = {(r["query_id"], r["id"], r["rank"], r["score"]) for r in coll.bm25_indexed(spark, loc, q, 5).collect()}
    b = {(r["query_id"], r["id"], r["rank"], r["score"]) for r in ft.bm25_topk(docs_df(spark, rows), q, 5).collect()}
    assert a == b


def test_progress_observation(spark):
    loc = shared_dir(spark, "test-progress")
    coll.create_collection(spark, loc, "p", id_type="bigint", recreate=True)
    out = coll.add_records(spark, loc, docs_df(spark, [(1, "a b c", "{}"), (2, "d", "{}")]))
    assert out["progress"] == {"n_stored": 2, "n_tokens": 4}


def test_every_row_is_stored_or_quarantined(spark):
    loc = shared_dir(spark, "test-all")
    coll.create_collection(spark, loc, "a", id_type="bigint", recreate=True)
    rows = [(1, "x\x07  y", "{}"), (1, "x", "{}"), (1, "x", "{}"), (None, "n", "{}"), (2, "b", "{bad")]
    out = coll.add_records(spark, loc, docs_df(spark, rows))
    assert out["stored"].count() + out["rejected"].count() == len(rows)
    assert sorted(r["reject_reason"] for r in out["rejected"].collect()) == ["duplicate_in_batch"] * 2 + ["missing_id", "not_storable"]
    coll.create_collection(spark, loc, "a", id_type="bigint", recreate=True)
    assert coll.get_collection(spark, loc).count() == 0 and coll._read(spark, loc, "quarantine").count() == 0


def test_metadata_structs_are_cleaned(spark):
    loc = shared_dir(spark, "test-clean")
    coll.create_collection(spark, loc, "c", id_type="bigint", recreate=True)
    meta = F.struct(F.lit("x\x07  y").alias("genre"), F.lit(float("nan")).alias("score"))
    df = spark.range(1).select(F.lit(1).cast("long").alias("id"), F.lit('a "b"').alias("document"), meta.alias("metadata"))
    coll.add_records(spark, loc, df, typed_fields=["genre"])
    r = coll.get_collection(spark, loc).first()
    assert r["document"] == "a 'b'" and r["gen_genre"] == "x y" and "NaN" not in r["metadata"]


def test_a_half_written_append_is_not_read(spark):
    loc = shared_dir(spark, "test-half")
    coll.create_collection(spark, loc, "h", id_type="bigint", recreate=True)
    coll.add_records(spark, loc, docs_df(spark, [(1, "a", "{}")]))
    broken = coll.get_collection(spark, loc).drop("ingest_batch").withColumn("id", F.lit(2).cast("long"))
    broken.write.parquet(f"{loc}/records/ingest_batch=broken")
    assert [r["id"] for r in coll.get_collection(spark, loc).collect()] == [1]


def test_stored_ids_are_found_by_filters(spark):
    """Four appends: each finds exactly the ids that earlier ones stored; no append reads all stored ids."""
    loc = shared_dir(spark, "test-keys")
    coll.create_collection(spark, loc, "k", recreate=True)
    for n in range(4):
        ids = [f"id-{i}" for i in range(n * 50, n * 50 + 55)]  # the last five come again in the next append
        out = coll.add_records(spark, loc, docs_df(spark, [(0, "a", "{}")]).crossJoin(spark.createDataFrame([(i,) for i in ids], "key string")).select(F.col("key").alias("id"), "document", "metadata"))
        assert out["stored"].count() == (55 if n == 0 else 50)
        assert sorted(r.id for r in out["rejected"].collect()) == ([] if n == 0 else sorted(ids[:5]))
    assert coll.get_collection(spark, loc).count() == 205
    live = coll._live(spark, loc)
    new = keys.key_pieces(spark.createDataFrame([("id-7",), ("other",)], "id string"))
    plan = keys.possible(new, coll._stored_keys(spark, loc, live))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("ids" not in line.split("ReadSchema")[1] for line in scans)
    assert not coll._path_exists(spark, f"{loc}/staging/{live[0].ingest_batch}-maybe") and not coll._path_exists(spark, f"{loc}/staging/{live[0].ingest_batch}-losers")


def test_filters_lose_no_id(spark):
    ids = spark.range(20_000).select((F.col("id") * 7919).alias("id"))
    stored = keys.key_pieces(ids.where("id % 2 = 0")).withColumn("ingest_batch", F.lit("x"))
    maybe = keys.possible(keys.key_pieces(ids), stored)
    assert {r.id for r in keys.confirmed(maybe, stored).collect()} == {r.id for r in ids.where("id % 2 = 0").collect()}
    assert maybe.count() < 10_000 + 100  # few others pass


def test_compaction_changes_no_result(spark):
    loc = shared_dir(spark, "test-compact")
    coll.create_collection(spark, loc, "c", id_type="bigint", recreate=True)
    rows = [(i, f"w{i % 5} common w{i % 3} tail{i}", '{"genre": "g"}') for i in range(60)]
    coll.add_records(spark, loc, docs_df(spark, rows[:30]), typed_fields=["genre"])
    coll.add_records(spark, loc, docs_df(spark, rows[20:40] + [(None, "n", "{}")]), typed_fields=["year"], epoch=("run", 3))
    coll.add_records(spark, loc, docs_df(spark, rows[40:]))
    q = spark.createDataFrame([(0, "w1 common"), (1, "w2 tail7")], "query_id long, query_text string")
    state = lambda: (sorted(map(tuple, coll.get_collection(spark, loc).select("id", "document", "gen_genre", "gen_year", "dl").collect()), key=repr), sorted(map(tuple, coll.bm25_indexed(spark, loc, q, 5).collect())), sorted(map(tuple, coll._read(spark, loc, "quarantine").select("id", "reject_reason").collect()), key=repr))
    before, old = state(), coll._live(spark, loc)
    coll.compact(spark, loc)
    assert state() == before and len(coll._live(spark, loc)) == 1
    assert not any(coll._path_exists(spark, f"{loc}/{k}/ingest_batch={r.ingest_batch}") for r in old for k in coll.DATASETS)
    # the folded epoch and the folded ids are still known
    assert coll.add_records(spark, loc, docs_df(spark, [(900, "z", "{}")]), epoch=("run", 3))["replayed"]
    assert coll.add_records(spark, loc, docs_df(spark, rows[:3] + [(901, "z", "{}")]))["progress"]["n_stored"] == 1


def test_a_broken_epoch_is_written_once(spark):
    loc = shared_dir(spark, "test-epoch")
    coll.create_collection(spark, loc, "e", id_type="bigint", recreate=True)
    first, other = docs_df(spark, [(1, "a b", "{}"), (1, "c", "{}")]), docs_df(spark, [(2, "a", "{}")])

    def stop(stage):
        if stage == "postings":
            raise RuntimeError("killed")

    try:
        coll.add_records(spark, loc, first, epoch=("r", 0), on_stage=stop)
        raise AssertionError("not stopped")
    except RuntimeError:
        pass
    assert coll.get_collection(spark, loc).count() == 0
    for _ in range(2):
        out = coll.add_records(spark, loc, first, epoch=("r", 0))
    assert out["replayed"] and [r.id for r in out["stored"].collect()] == [1] and out["rejected"].count() == 1
    coll.add_records(spark, loc, other, epoch=("r", 1))
    assert coll.document_frequencies(spark, loc, ["a", "b", "c"]) in ({"a": 2, "b": 1}, {"a": 1, "c": 1})


def test_appends_must_agree_on_types(spark):
    loc = shared_dir(spark, "test-types")
    coll.create_collection(spark, loc, "t", id_type="bigint", recreate=True)
    coll.add_records(spark, loc, docs_df(spark, [(1, "a", "{}")]), typed_fields={"x": "string"})
    coll.add_records(spark, loc, docs_df(spark, [(2, "a", "{}")]), typed_fields={"x": "bigint"})
    with pytest.raises(ValueError, match="gen_x"):
        coll.get_collection(spark, loc)


def test_only_the_winners_files_are_read(spark):
    loc = shared_dir(spark, "test-hydrate")
    coll.create_collection(spark, loc, "h", id_type="bigint", recreate=True)
    for a, b in ((0, 300), (290, 600)):  # ten duplicates: the second append is written again without them
        coll.add_records(spark, loc, docs_df(spark, [(i, f"text {i}", "{}") for i in range(a, b)]).repartitionByRange(3, "id"))
    winners = spark.createDataFrame([(3, "x"), (295, "y"), (599, "z")], "id long, mark string")
    for n_files in (3, 1):
        got = coll.hydrate_stored(spark, loc, winners, ["document"])
        assert sorted(map(tuple, got.collect())) == [(3, "x", "text 3"), (295, "y", "text 295"), (599, "z", "text 599")]
        live = coll._live(spark, loc)
        assert len(coll.files_of(spark, loc, winners.select("id"), live)) == n_files
        assert len(coll.files_of(spark, loc, winners.where("id = 3").select("id"), live)) == 1
        coll.compact(spark, loc, files=1)
    assert coll.hydrate_stored(spark, loc, winners.where("id < 0"), ["document"]).count() == 0


def test_clustered_files_have_narrow_ranges(spark):
    """After clustering, a range on either field touches few files; without it, all."""
    loc = shared_dir(spark, "test-layout")
    coll.create_collection(spark, loc, "z", id_type="bigint", recreate=True)
    rows = [(i, f"t{i}", f'{{"year": {1900 + i * 37 % 101}, "price": {i * 53 % 97}.5, "genre": "g{i % 3}"}}') for i in range(2000)]
    coll.add_records(spark, loc, docs_df(spark, rows).repartition(4), typed_fields=["year", "price", "genre"])
    before = sorted(map(tuple, coll.get_collection(spark, loc).select("id", "gen_year", "gen_price").collect()))

    def touched(field, lo, hi):
        spans = coll.get_collection(spark, loc).groupBy(F.input_file_name()).agg(F.min(field).alias("a"), F.max(field).alias("b"))
        return spans.where((F.col("a") <= hi) & (F.col("b") >= lo)).count(), spans.count()

    coll.compact(spark, loc, cluster_by=["gen_year", "gen_price"], files=16)
    for field, lo, hi in (("gen_year", 1910, 1915), ("gen_price", 20.0, 25.0)):
        some, every = touched(field, lo, hi)
        assert every == 16 and some <= 8
    assert sorted(map(tuple, coll.get_collection(spark, loc).select("id", "gen_year", "gen_price").collect())) == before
    coll.compact(spark, loc, cluster_by=["gen_genre", "gen_year"], files=4)
    assert coll.get_collection(spark, loc).count() == 2000


def test_postings_are_made_from_small_batches(spark, monkeypatch):
    made = coll.postings_of_tokens

    def watched(tokens):
        def small(batches):
            for batch in batches:
                assert batch.num_rows <= 512
                yield batch

        return made(tokens.mapInArrow(small, tokens.schema))

    monkeypatch.setattr(coll, "postings_of_tokens", watched)
    location, rows = shared_dir(spark, "small-batches"), spark.conf.get(coll.ARROW_ROWS)
    coll.create_collection(spark, location, "small", id_type="bigint")
    docs = spark.range(1500).coalesce(1).select("id", F.lit("one two two").alias("document"), F.lit("{}").alias("metadata"))
    coll.add_records(spark, location, docs, clean=False)
    assert coll._read(spark, location, "postings").groupBy("term").agg(F.sum("tf")).orderBy("term").collect() == [("one", 1500), ("two", 3000)]
    assert spark.conf.get(coll.ARROW_ROWS) == rows


def test_an_append_finds_tokens_once_for_length_and_vector(spark, monkeypatch):
    calls, tokenize = [], coll.tokenize
    monkeypatch.setattr(coll, "tokenize", lambda *a: calls.append(a) or tokenize(*a))
    location = shared_dir(spark, "tokens-once")
    coll.create_collection(spark, location, "once", dimension=16, id_type="bigint")
    docs = spark.createDataFrame([(1, "one two two"), (2, None), (3, "")], "id long, document string").withColumn("metadata", F.lit("{}"))
    coll.add_records(spark, location, docs, clean=False)
    assert len(calls) == 2  # for the records and for the postings
    stored = {r.id: r for r in coll.get_collection(spark, location).collect()}
    assert stored[1].dl == 3 and sum(x * x for x in stored[1].embedding) == pytest.approx(1) and "_tokens" not in stored[1]
