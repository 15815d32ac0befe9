"""Registered scenarios: each ``(spark, sf_dir) -> DataFrame`` over whole tables.

Names map to SURVEY §2 operator ids in the docstrings.  The DuckDB twins
with identical column names are in ``quarry.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numeric import similarity_4, similarity_percent_text
from quarry.functions.text import json_safe, json_safe_value, sanitize, snippet, thousands
from quarry.functions.tokens import tokenize
from quarry.functions.vectors import hashed_tf_embedding
from quarry.operators import compare as cmp
from quarry.operators import fulltext as ft
from quarry.operators import hybrid as hy
from quarry.operators import ivf
from quarry.operators import prepare as prep
from quarry.operators.filters import build_filter
from quarry.operators.knn import knn, knn_join, knn_single, vector_rejects
from quarry.plans import inputs
from quarry.session import shared_dir
from quarry.sources import collection as coll
from quarry.sources.raw import BOOK_SCHEMA, books_from_part, profile, read_csv, read_table
from quarry.streaming import ingest

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ vector search


def _knn(spark: SparkSession, sf_dir: str, metric: str, k: int, where=None) -> DataFrame:
    coll = inputs.vectors_only(spark, sf_dir) if where is None else inputs.vector_collection(spark, sf_dir)
    queries = inputs.centroid_queries(spark, sf_dir)
    return knn(coll, queries, k, metric=metric, where=where)


@register
def vector_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: all vectors plus injected null, short and zero ones, counted by what is wrong with them."""
    v = inputs.vectors_only(spark, sf_dir)
    short = v.where("id % 10 = 0").select("id", F.slice("embedding", 1, 3).alias("embedding"))
    null = v.where("id % 20 = 0").select("id", F.lit(None).cast("array<float>").alias("embedding"))
    zero = v.where("id % 25 = 0").select("id", F.transform("embedding", lambda x: x * F.lit(0).cast("float")).alias("embedding"))
    return vector_rejects(v.union(short).union(null).union(zero), 64)


@register
def knn_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 + V7: cosine top-5 for every label centroid."""
    return _knn(spark, sf_dir, "cosine", 5)


@register
def knn_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 + V7: Euclidean top-5."""
    return _knn(spark, sf_dir, "l2", 5)


@register
def knn_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 + V7: inner-product top-5 (distance = -dot)."""
    return _knn(spark, sf_dir, "ip", 5)


@register
def knn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: cosine top-10 for every vector whose id is divisible by 100 against all rows, both sides in blocks."""
    return knn_join(inputs.vectors_only(spark, sf_dir), inputs.vector_queries(spark, sf_dir), 10)


@register
def knn_all_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: the same queries by Euclidean distance against the vectors of German documents."""
    return knn_join(inputs.vector_collection(spark, sf_dir), inputs.vector_queries(spark, sf_dir), 10, "l2", where=build_filter({"lang": "de"}))


@register
def query_vector_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 for queries: the query set with null and short vectors among them, counted; the good ones are answered."""
    q = inputs.vector_queries(spark, sf_dir)
    null = q.select((-1 - F.col("query_id")).alias("query_id"), F.lit(None).cast("array<float>").alias("query_vector"))
    short = q.where("query_id % 200 = 0").select((F.col("query_id") + 1).alias("query_id"), F.slice("query_vector", 1, 5).alias("query_vector"))
    asked = q.union(null).union(short)
    answered = knn_join(inputs.vectors_only(spark, sf_dir), asked, 1, dim=64).agg(F.count(F.lit(1)).alias("n_answered"))
    return vector_rejects(asked, 64, "query_vector").crossJoin(answered)  # one row each


@register
def knn_included(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 + P18: cosine top-5 for every label centroid with chosen fields of the winners."""
    return knn(inputs.vector_collection(spark, sf_dir), inputs.centroid_queries(spark, sf_dir), 5, include=["lang", "n_chars"])


@register
def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 + F1: pre-filtered kNN, ``lang = 'en'`` (genre stand-in), top-10."""
    return _knn(spark, sf_dir, "cosine", 10, where=build_filter({"lang": "en"}))


# ------------------------------------------------------------------ record preparation


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_books(spark, sf_dir)
    return prep.prepare_records(raw, id_col="row_key")


@register
def prepare_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row -> cleaned, validated, defaulted record + metadata JSON."""
    return books(spark, sf_dir)


@register
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per first-failure reason (null = valid)."""
    return prep.validation_summary(books(spark, sf_dir))


@register
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total records and validation error count."""
    return prep.validation_error_count(books(spark, sf_dir))


@register
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count, column count, column names of the raw source."""
    return profile(inputs.raw_books(spark, sf_dir))


@register
def sanitize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sanitize and JSON-clean every document, plus a 100-char snippet."""
    d = read_table(spark, sf_dir, "documents")
    clean = sanitize("text")
    return d.select(
        F.col("doc_id").alias("id"),
        clean.alias("clean_text"),
        json_safe("text").alias("json_text"),
        F.length(clean).cast("long").alias("clean_chars"),
        snippet("text", 100).alias("snippet"),
    )


# ------------------------------------------------------------------ full text


# The keyword stand-ins present in the test corpus (FIXTURES §3).
KEYWORDS = ["the", "that", "thon"]


def keyword_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, kw) for i, kw in enumerate(KEYWORDS)], "query_id long, query_text string"
    )


@register
def tokenize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document under the three analyzer modes."""
    d = inputs.text_collection(spark, sf_dir)
    return d.select(
        "id",
        F.size(tokenize("document", "basic")).cast("long").alias("n_basic"),
        F.size(tokenize("document", "smart")).cast("long").alias("n_smart"),
        F.size(tokenize("document", "max_word")).cast("long").alias("n_max_word"),
        F.size(F.array_distinct(tokenize("document", "basic"))).cast("long").alias("n_distinct"),
    )


@register
def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings table (term, id, tf, dl) of the whole corpus."""
    return ft.build_postings(inputs.text_collection(spark, sf_dir))


@register
def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document and collection frequency per term."""
    return ft.term_stats(ft.build_postings(inputs.text_collection(spark, sf_dir)))


@register
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N, avgdl and total term count of the corpus."""
    return ft.corpus_stats(inputs.text_collection(spark, sf_dir))


@register
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 top-10 for every benchmark passage as a query."""
    return ft.bm25_topk(inputs.text_collection(spark, sf_dir), inputs.benchmark_queries(spark, sf_dir), 10)


@register
def bm25_included(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + P18: BM25 top-10 with chosen fields of the winners."""
    return ft.bm25_topk(inputs.text_collection(spark, sf_dir), inputs.benchmark_queries(spark, sf_dir), 10, include=["lang", "source"])


@register
def bm25_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + F2: BM25 top-5, candidates ``n_chars >= 2000`` (reviews stand-in), whole-corpus statistics."""
    return ft.bm25_topk(
        inputs.text_collection(spark, sf_dir),
        inputs.benchmark_queries(spark, sf_dir),
        5,
        where=build_filter({"n_chars": {"$gte": 2000}}),
    )


@register
def fulltext_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unranked ``$contains`` get, first 10 ids per benchmark passage."""
    return ft.fulltext_get(inputs.text_collection(spark, sf_dir), inputs.benchmark_queries(spark, sf_dir), 10)


@register
def keyword_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's get-with-limit for the keyword stand-ins (limit 5)."""
    return ft.fulltext_get(inputs.text_collection(spark, sf_dir), keyword_queries(spark), 5)


@register
def keyword_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 vs F8: per keyword, documents matched as substring and as token."""
    docs = inputs.text_collection(spark, sf_dir)
    q = keyword_queries(spark)
    sub = ft.substring_matches(docs, q).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_substring"))
    tok = ft.token_matches(docs, q).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_token"))
    return q.join(sub, "query_id", "left").join(tok, "query_id", "left").select(
        "query_id",
        "query_text",
        F.coalesce("n_substring", F.lit(0)).cast("long").alias("n_substring"),
        F.coalesce("n_token", F.lit(0)).cast("long").alias("n_token"),
    )


@register
def token_match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 (all tokens): documents holding every token of a benchmark passage."""
    return ft.token_matches(
        inputs.text_collection(spark, sf_dir), inputs.benchmark_queries(spark, sf_dir), require_all=True
    )


# ------------------------------------------------------------------ hybrid search


# The collection's embedding function for text collections (V1): hashed term
# counts of the basic analyzer, 64 dimensions (the width of the given vectors).
EMBED_DIM = 64
HYBRID_COLUMNS = [
    "query_id", "id", "rrf", "rrf_rank", "distance_rank", "text_rank", "vector_rank", "score", "distance",
]


def embed_text(c):
    return hashed_tf_embedding(tokenize(c, "basic"), EMBED_DIM)


def _hybrid(spark: SparkSession, sf_dir: str, k: int, **kw) -> DataFrame:
    coll = inputs.text_collection(spark, sf_dir)
    q = inputs.benchmark_queries(spark, sf_dir)
    res = hy.hybrid_search(coll, q, k=k, embed=embed_text, payload=["lang", "source", "n_chars"], **kw)
    return res.select(*HYBRID_COLUMNS, "lang", "source", "n_chars")


@register
def hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H3, H5-H7: BM25 leg + vector leg (10 each) fused by RRF, top-10, payload attached."""
    return _hybrid(spark, sf_dir, 10)


@register
def hybrid_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + F4/F5/F6/F7: one metadata filter shared by both legs plus a ``$contains`` text filter."""
    where = {"$and": [{"lang": "en"}, {"n_chars": {"$gte": 500}}, {"n_chars": {"$lte": 5000}}]}
    return _hybrid(spark, sf_dir, 5, where=where, where_document={"$contains": "the"})


@register
def hybrid_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 on a stored collection: postings, statistics and vectors written at import, all settings from its properties."""
    location = build_document_collection(spark, sf_dir, dimension=64)
    fields = ["gen_lang", "gen_source", "gen_n_chars"]
    res = coll.hybrid_stored(spark, location, inputs.benchmark_queries(spark, sf_dir), 10, payload=fields)
    return res.select(*HYBRID_COLUMNS, *[F.col(f).alias(f[4:]) for f in fields])


@register
def hybrid_no_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 + H8: unknown words (text leg empty), empty texts (both legs empty, no rows) and ordinary queries in one batch."""
    n = F.col("query_id") % 3
    text = F.when(n == 0, F.concat(F.lit("zqxj"), F.col("query_id").cast("string"))).when(n == 1, F.lit("")).otherwise(F.col("query_text"))
    q = inputs.benchmark_queries(spark, sf_dir).withColumn("query_text", text)
    res = hy.hybrid_search(inputs.text_collection(spark, sf_dir), q, k=10, embed=embed_text, payload=["lang", "source", "n_chars"])
    return res.select(*HYBRID_COLUMNS, "lang", "source", "n_chars")


@register
def hybrid_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + H5: one batch of five scenarios with filters of their own and two texts per query (keywords, whole passage)."""
    q = inputs.benchmark_queries(spark, sf_dir)
    words = F.array_join(F.slice(F.split("query_text", " "), 1, 5), " ")
    q = q.select("query_id", words.alias("keyword_text"), F.col("query_text").alias("vector_text"))
    conditions = [
        {},
        {"where": {"lang": "en"}},
        {"where": {"n_chars": {"$gte": 2000}}, "keyword_where": {"lang": "de"}},
        {"where": {"$or": [{"lang": "fr"}, {"lang": "es"}]}, "where_document": {"$contains": "en"}},
        {"where": {"$and": [{"n_chars": {"$gte": 500}}, {"n_chars": {"$lte": 5000}}, {"lang": {"$ne": "de"}}]}},
    ]
    groups = [hy.SearchGroup(q.where(F.col("query_id") % 5 == i), n_text=10, n_vector=10, **c) for i, c in enumerate(conditions)]
    res = hy.search_groups(inputs.text_collection(spark, sf_dir), groups, 5, embed_text, payload=["lang", "source", "n_chars"])
    return res.select(*HYBRID_COLUMNS, "lang", "source", "n_chars")


@register
def get_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + F2/F8 + P18: unranked get by all tokens of three words, under a filter, with chosen fields."""
    words = F.array_join(F.slice(F.split("query_text", " "), 1, 3), " ")
    q = inputs.benchmark_queries(spark, sf_dir).withColumn("query_text", words)
    docs = inputs.text_collection(spark, sf_dir)
    return ft.fulltext_get(docs, q, 7, where=build_filter({"n_chars": {"$gte": 1000}}, docs.columns), token_mode="all", include=["lang", "source"])


@register
def display_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 + P22: 150-character snippet (always with dots) and a count text that stays text when it is no number."""
    count = F.when(F.col("id") % 3 == 0, F.concat(F.lit("n/a "), "lang")).otherwise(F.col("n_chars").cast("string"))
    return inputs.text_collection(spark, sf_dir).select("id", snippet("document", 150, always_ellipsis=True).alias("snippet"), thousands(count).alias("count_text"))


# Fixed value: Han text, an e-mail address, an IPv4 address and a host name for the analyzers.
HAN_SAMPLE = "全文检索 PySpark3.5 混合搜索测试 mail@example.com 192.168.0.1 www.example.org 中"


@register
def tokenize_han(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens themselves under the three analyzers, on every document's beginning joined with Han text."""
    text = F.concat(F.substring("document", 1, 40), F.lit(f" {HAN_SAMPLE} "), F.col("lang"))
    d = inputs.text_collection(spark, sf_dir).select("id", text.alias("document"))
    return d.select("id", *[tokenize("document", m).alias(m) for m in ("basic", "smart", "max_word")])


@register
def hybrid_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6 + P19/P20/P21: results presented by distance with similarity, percent text and defaults."""
    res = _hybrid(spark, sf_dir, 5, n_text=10, n_vector=10)
    return res.select(
        "query_id",
        "id",
        "distance_rank",
        similarity_4(F.col("distance")).alias("similarity"),
        similarity_percent_text(F.col("distance")).alias("similarity_pct"),
        F.coalesce(F.col("source"), F.lit("Unknown")).alias("author"),
        thousands("n_chars").alias("reviews_text"),
    )


# ------------------------------------------------------------------ comparison and roll-ups


def _ft_and_hybrid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    q = inputs.benchmark_queries(spark, sf_dir)
    docs = inputs.text_collection(spark, sf_dir)
    got = ft.fulltext_get(docs, q, 10)
    hyb = hy.hybrid_search(docs, q, k=10, embed=embed_text)
    return q, got, hyb


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, got, hyb = _ft_and_hybrid(spark, sf_dir)
    return cmp.compare_results(got, hyb, q)


@register
def compare_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per benchmark query, full-text get (limit 10) vs hybrid top-10 overlap report."""
    return _comparison(spark, sf_dir)


@register
def compare_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all queries and the micro-averaged overlap."""
    q, got, hyb = _ft_and_hybrid(spark, sf_dir)
    return cmp.comparison_rollup(cmp.compare_results(got, hyb, q))


@register
def compare_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in both results and in one only, labelled, from one join."""
    _, got, hyb = _ft_and_hybrid(spark, sf_dir)
    return cmp.membership(got, hyb, ("full_text_only", "hybrid_only"))


@register
def report_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 + P21: first five results of each method per query with an 80-character snippet."""
    _, got, hyb = _ft_and_hybrid(spark, sf_dir)
    docs = inputs.text_collection(spark, sf_dir).select("id", "document")
    a = got.where(F.col("rank") <= 5).select("query_id", "id", "rank", F.lit("full_text").alias("method"))
    b = hyb.where(F.col("rrf_rank") <= 5).select(
        "query_id", "id", F.col("rrf_rank").alias("rank"), F.lit("hybrid").alias("method")
    )
    top = a.unionByName(b)
    return hy.hydrate(top, docs, ["document"]).select(
        "query_id", "method", "rank", "id", snippet("document", 80).alias("snippet")
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings stand-in from ``events``: query = user_id, method = event_type, seconds = value."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("query"), F.col("event_type").alias("method"), F.col("value").alias("seconds")
    )


@register
def timing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: avg/min/max/total/count per query and method."""
    return cmp.measure_stats(timings(spark, sf_dir), ["query", "method"])


@register
def timing_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2-A4: two methods per query, relative difference and the faster one."""
    return cmp.side_by_side(timings(spark, sf_dir), "query", "method", "click", "view")


@register
def timing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro average of per-query averages, grand totals, mean per query."""
    return cmp.overall_summary(cmp.measure_stats(timings(spark, sf_dir), ["query", "method"]), "method")


@register
def import_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + S4/P14: per import batch of 100 rows: rows, storable rows, validation errors."""
    recs = books(spark, sf_dir)
    return recs.groupBy(prep.batch_id(F.col("id").cast("long")).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(prep.storable()).alias("n_stored"),
        F.count_if(F.col("invalid_reason").isNotNull()).alias("n_invalid"),
    )


@register
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record count and number of batches of 100."""
    recs = books(spark, sf_dir)
    return recs.agg(F.count(F.lit(1)).alias("n_records")).select(
        "n_records", prep.batch_numbers(F.col("n_records")).alias("n_batches")
    )


# ------------------------------------------------------------------ stored collections, typed metadata, filters


DOC_FIELDS = {"lang": "string", "source": "string", "n_chars": "bigint"}


def build_document_collection(spark: SparkSession, sf_dir: str, dimension: int | None = None) -> str:
    """S3 + S4: a stored collection of every document (metadata JSON + typed columns + postings, vectors with ``dimension``)."""
    location = shared_dir(spark, "collection-documents")
    coll.create_collection(spark, location, "documents", dimension=dimension, id_type="bigint", recreate=True)
    docs = inputs.text_collection(spark, sf_dir).select(
        "id", "document", F.to_json(F.struct("lang", "source", "n_chars")).alias("metadata")
    )
    coll.add_records(spark, location, docs, typed_fields=DOC_FIELDS, clean=False)  # texts as given
    return location


@register
def collection_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, append, read back and describe a stored collection."""
    return coll.collection_info(spark, build_document_collection(spark, sf_dir))


@register
def ingest_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + P14: two appends with repeated ids, missing ids, unparsable metadata and dirty texts; all rows by outcome."""
    location = shared_dir(spark, "collection-duplicates")
    coll.create_collection(spark, location, "duplicates", id_type="bigint", recreate=True)
    docs = inputs.text_collection(spark, sf_dir)
    every = lambda n: F.col("id") % n == 0
    meta = F.to_json(F.struct("lang"))
    first = docs.select("id", F.concat(F.lit("\x07a  "), "lang").alias("document"), meta.alias("metadata"), F.lit(0).alias("_pos"))
    copies = docs.where(every(3)).select("id", F.lit("copy").alias("document"), meta.alias("metadata"), F.lit(1).alias("_pos"))
    broken = docs.where(every(5)).select((-1 - F.col("id")).alias("id"), "lang", F.lit("{not json").alias("metadata"), F.lit(0).alias("_pos"))
    nameless = docs.where(every(7)).select(F.lit(None).cast("long").alias("id"), "lang", meta.alias("metadata"), F.lit(0).alias("_pos"))
    one = coll.add_records(spark, location, first.union(copies).union(broken).union(nameless), typed_fields={"lang": "string"})
    two = coll.add_records(spark, location, docs.where(every(2)).select("id", F.lit("again").alias("document"), meta.alias("metadata")), typed_fields={"lang": "string"})
    rows = [coll.get_collection(spark, location).select("id", "document", F.lit("stored").alias("outcome"))]
    rows += [r["rejected"].select("id", "document", F.col("reject_reason").alias("outcome")) for r in (one, two)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register
def collection_vector_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 with vectors + V2 + S5 + V7: store records with 64-dim vectors, then kNN from storage."""
    location = shared_dir(spark, "collection-vectors")
    coll.create_collection(spark, location, "vectors", dimension=64, id_type="bigint", recreate=True)
    recs = inputs.vector_collection(spark, sf_dir).select(
        "id", "document", F.to_json(F.struct("lang", "source", "n_chars")).alias("metadata"), "embedding"
    )
    coll.add_records(spark, location, recs, typed_fields=DOC_FIELDS, clean=False)
    return coll.knn_stored(spark, location, inputs.centroid_queries(spark, sf_dir), 5)


@register
def collection_typed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + P16 + F2/F4: a filter on stored typed columns (``gen_*``), pushed into the scan."""
    location = build_document_collection(spark, sf_dir)
    recs = coll.get_collection(spark, location)
    where = {"$and": [{"lang": "de"}, {"n_chars": {"$gte": 1000}}]}
    return recs.where(build_filter(where, recs.columns)).select("id", "gen_lang", "gen_source", "gen_n_chars")


@register
def collection_clustered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P17 + S5 + F2/F4: records laid out along a Z-order curve of two typed columns, then filtered on both (files are skipped by their statistics)."""
    location = build_document_collection(spark, sf_dir)
    coll.compact(spark, location, cluster_by=["gen_lang", "gen_n_chars"])
    recs = coll.get_collection(spark, location)
    where = {"$and": [{"lang": "de"}, {"n_chars": {"$gte": 1000}}]}
    return recs.where(build_filter(where, recs.columns)).select("id", "gen_lang", "gen_source", "gen_n_chars")


@register
def bm25_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2/T3/T5 materialised: BM25 top-10 over the stored, term-bucketed postings (partition-pruned)."""
    location = build_document_collection(spark, sf_dir)
    return coll.bm25_indexed(spark, location, inputs.benchmark_queries(spark, sf_dir), 10)


@register
def collection_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S5: every stored column of every record, from a collection made by two appends."""
    location = shared_dir(spark, "collection-contents")
    coll.create_collection(spark, location, "contents", id_type="bigint", recreate=True)
    docs = inputs.text_collection(spark, sf_dir).select("id", "document", F.to_json(F.struct("lang", "source")).alias("metadata"))
    for part in (0, 1):
        coll.add_records(spark, location, docs.where(F.col("id") % 2 == part), typed_fields={"lang": "string", "source": "string"}, clean=False)
    return coll.get_collection(spark, location).select("id", "document", "gen_lang", "gen_source", "dl")


@register
def collection_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 stored: the postings that a collection holds."""
    return coll._read(spark, build_document_collection(spark, sf_dir), "postings")


@register
def collection_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 stored: df and cf summed over the partial counts of two appends, the second with rows that are rejected."""
    location = shared_dir(spark, "collection-terms")
    coll.create_collection(spark, location, "terms", id_type="bigint", recreate=True)
    docs = inputs.text_collection(spark, sf_dir).select("id", "document", F.lit("{}").alias("metadata"))
    coll.add_records(spark, location, docs.where("id % 3 > 0"), clean=False)
    coll.add_records(spark, location, docs, clean=False)
    return coll._read(spark, location, "terms").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


@register
def stream_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + T5: documents streamed into a collection; a micro-batch breaks off before its commit, the run goes on from its
    checkpoint, a committed epoch is sent again, the appends are compacted; then BM25 top-10 from storage."""
    docs = inputs.text_collection(spark, sf_dir).select("id", "document", "lang")
    files, location, checkpoint = (shared_dir(spark, f"stream-collection-{n}") for n in ("files", "records", "checkpoint"))
    # three micro-batches whatever the size: the files of each are as many as the tasks that a shuffle has
    per_batch = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 3))
    docs.repartitionByRange(3 * per_batch, "id").write.parquet(files)
    coll.create_collection(spark, location, "streamed", id_type="bigint", recreate=True)

    def prepare(stream: DataFrame) -> DataFrame:
        return stream.select("id", "document", F.to_json(F.struct("lang")).alias("metadata"))

    def stream(**options) -> None:
        ingest.ingest_collection(spark, files, "*.parquet", docs.schema, prepare, location, checkpoint, per_batch, clean=False, typed_fields={"lang": "string"}, **options)

    appended: list[str] = []

    def kill(stage: str) -> None:
        appended.append(stage)
        if appended.count("postings") == 2:  # the second micro-batch, written but not committed
            raise InterruptedError("append killed before its commit")

    try:
        stream(on_stage=kill)
    except Exception as stopped:
        if "append killed" not in str(stopped):
            raise
    stream()
    coll.add_records(spark, location, prepare(docs.limit(5)), clean=False, epoch=(ingest.run_of(checkpoint), 0))
    coll.compact(spark, location)
    return coll.bm25_indexed(spark, location, inputs.benchmark_queries(spark, sf_dir), 10)


@register
def typed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns from the metadata JSON (the import's six fields + an unknown one)."""
    recs = books(spark, sf_dir)
    fields = ["genre", "year", "user_rating", "author", "reviews", "price", "edition"]
    return coll.add_typed_columns(recs, fields).select("id", *[f"gen_{f}" for f in fields])


# The reference's five metadata filters, thresholds mapped onto the ``part``
# stand-in ranges (rating = p_size / 9, year = 1880 + 5 p_size, reviews =
# p_partkey, price = p_retailprice 900-999.9, genre = p_type).
BOOK_FILTERS = {
    "rating_gte": {"user_rating": {"$gte": 4.5}},
    "genre_eq": {"genre": "ECONOMY"},
    "genre_year_rating": {"$and": [{"year": {"$gte": 2015}}, {"user_rating": {"$gte": 4.0}}, {"genre": "PROMO"}]},
    "reviews_gte": {"reviews": {"$gte": 1000}},
    "price_range_rating": {"$and": [{"price": {"$gte": 950}}, {"price": {"$lte": 960}}, {"user_rating": {"$gte": 4.5}}]},
}


@register
def metadata_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filter dictionaries over typed columns, one labelled row per match."""
    recs = coll.add_typed_columns(books(spark, sf_dir), ["genre", "year", "user_rating", "reviews", "price"])
    recs = recs.select("id", *[c for c in recs.columns if c.startswith("gen_")])
    pred = {name: build_filter(w, recs.columns) for name, w in BOOK_FILTERS.items()}
    # one scan: an array of matching filter names per row, exploded
    names = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in pred.items()]))
    return recs.select("id", F.explode(names).alias("filter"))


# ------------------------------------------------------------------ approximate search


def _ivf_index(spark: SparkSession, sf_dir: str) -> str:
    """Cells of all vectors: trained on those of even ids, the others appended to them."""
    location = shared_dir(spark, "ivf")
    vectors = inputs.vectors_only(spark, sf_dir)
    ivf.build_ivf(vectors.where("id % 2 = 0"), location)
    ivf.ivf_append(vectors.where("id % 2 <> 0"), location)
    return location


@register
def ivf_knn_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9 with nprobe = all cells: must equal exact cosine kNN (V7) row for row."""
    location = _ivf_index(spark, sf_dir)
    every = ivf.n_cells(spark, location)
    return ivf.ivf_knn(spark, location, inputs.centroid_queries(spark, sf_dir), 5, every, "cosine").select("query_id", "id", "distance", "rank")


@register
def ivf_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: approximate cosine top-10 of every id divisible by 100 at the level that was measured to reach a recall of 0.9."""
    location = _ivf_index(spark, sf_dir)
    q = inputs.vector_queries(spark, sf_dir)
    ivf.calibrate(spark, location, q, 10)
    return ivf.ivf_knn(spark, location, q, 10)


@register
def ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recall@10 and its lower confidence bound by probe level, for every id divisible by 100."""
    return ivf.recall_curve(spark, _ivf_index(spark, sf_dir), inputs.vector_queries(spark, sf_dir), 10)


@register
def ivf_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9 + V10: the search at the calibrated level against exact search: wrong distances (none), recall of at least 0.9,
    rows indexed, recall when all cells are probed."""
    location = _ivf_index(spark, sf_dir)
    vectors, q = inputs.vectors_only(spark, sf_dir), inputs.vector_queries(spark, sf_dir)
    exact = knn_join(vectors, q, 10)
    level = ivf.calibrate(spark, location, q, 10)
    found = ivf.ivf_knn(spark, location, q, 10, level)
    whole = ivf.ivf_knn(spark, location, q, 10, ivf.n_cells(spark, location))
    rows = [
        ivf.recall_at_k(found, exact, 10).select("n_queries", (F.col("recall") >= 0.9).alias("recall_reached")),
        ivf.wrong_distances(found, vectors, q),
        ivf.recall_at_k(whole, exact, 10).select(F.col("recall").alias("recall_all_cells")),
        ivf.live_vectors(spark, location).agg(F.count(F.lit(1)).alias("n_indexed")),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.crossJoin(row)  # one row each
    return out


# ------------------------------------------------------------------ streaming ingest


@register
def stream_ingest_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw book files streamed through the preparation plan into an idempotent append target."""
    schema = read_table(spark, sf_dir, "part").schema
    target = shared_dir(spark, "stream-books")
    return ingest.ingest_files(
        spark,
        sf_dir,
        "part.parquet",
        schema,
        lambda s: prep.prepare_records(books_from_part(s), id_col="row_key"),
        target,
        key="id",
    )


def _events_backwards(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """``events`` rewritten as one file per user bucket, and again with late dates first: each event twice, out of order."""
    events = read_table(spark, sf_dir, "events")
    path = shared_dir(spark, "events-files")
    late_first = events.repartitionByRange(4, F.col("ts").desc())
    late_first.write.parquet(path)
    events.repartition(3, "event_id").write.mode("append").parquet(path)
    return events, path


@register
def stream_dedupe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 for events: seven files in no time order, every event twice, one file per micro-batch; one row per event_id."""
    events, path = _events_backwards(spark, sf_dir)
    target = shared_dir(spark, "stream-events")
    out = ingest.dedupe_events(spark, path, "*.parquet", events.schema, "event_id", "ts", target, max_files_per_trigger=1)
    # the wall-clock text does not depend on the session time zone
    return out.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"), "user_id", "event_type", "value"
    )


@register
def stream_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + U2: rows taken in, rows kept and copies set aside by the streamed ingest of repeated events."""
    events, path = _events_backwards(spark, sf_dir)
    target = shared_dir(spark, "stream-copies")
    progress: list[dict] = []
    kept = ingest.ingest_files(spark, path, "*.parquet", events.schema, lambda s: s, target, "event_id", "ts", 1, on_progress=progress.append)
    copies = ingest.duplicates(spark, target, "event_id")
    counted = kept.agg(F.count(F.lit(1)).alias("n_kept")).crossJoin(copies.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n_copies")))  # one row each
    return counted.select(F.lit(sum(p["n_input"] for p in progress)).cast("long").alias("n_input"), "n_kept", "n_copies")


# ------------------------------------------------------------------ single-query semantic search, extra legs


# Fixed value: the reference's post-import smoke query (U+2011 hyphen kept).
SMOKE_QUERY = "Self‑Improvement and Personal Development"


@register
def semantic_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 + V1 + P19: one query text embedded by the collection's function, native top-3 over every document."""
    docs = inputs.text_collection(spark, sf_dir).withColumn("embedding", embed_text(F.col("document")))
    qvec = spark.range(1).select(embed_text(F.lit(SMOKE_QUERY)).alias("v")).first()["v"]
    res = knn_single(docs, list(qvec), 3)
    return res.select(
        "id",
        "distance",
        "rank",
        similarity_percent_text(F.col("distance")).alias("similarity_pct"),
    )


def _vector_leg(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    docs = inputs.text_collection(spark, sf_dir).withColumn("embedding", embed_text(F.col("document")))
    q = inputs.benchmark_queries(spark, sf_dir).withColumn("query_vector", embed_text(F.col("query_text")))
    return knn(docs, q, n)


@register
def hybrid_scalar_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4 + F9: a metadata-only leg (``lang = 'es'``, ranked by id) fused with the vector leg."""
    docs = inputs.text_collection(spark, sf_dir)
    q = inputs.benchmark_queries(spark, sf_dir)
    scalar = hy.scalar_leg(docs, q, {"lang": "es"}, 10).withColumnRenamed("rank", "scalar_rank")
    vec = _vector_leg(spark, sf_dir, 10).withColumnRenamed("rank", "vector_rank")
    fused = hy.fuse_rrf([scalar, vec], ["scalar_rank", "vector_rank"], 10)
    return fused.select("query_id", "id", "rrf", "rrf_rank", "scalar_rank", "vector_rank")


@register
def rrf_three_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 n-leg form: BM25, vector and metadata-only legs fused by ``unionByName`` + ``groupBy``."""
    docs = inputs.text_collection(spark, sf_dir)
    q = inputs.benchmark_queries(spark, sf_dir)
    text = ft.bm25_topk(docs, q, 10)
    vec = _vector_leg(spark, sf_dir, 10)
    scalar = hy.scalar_leg(docs, q, {"lang": "es"}, 10)
    return hy.fuse_rrf_union([text, vec, scalar], 10).select("query_id", "id", "rrf", "rrf_rank")


# ------------------------------------------------------------------ nested JSON-safe values, CSV source


@register
def json_safe_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive JSON-safe cleaning of a nested value built from every document."""
    d = read_table(spark, sf_dir, "documents", spread_by="doc_id")
    ratio = (
        F.when(F.col("n_chars") % 3 == 0, F.lit(float("inf")))
        .when(F.col("n_chars") % 3 == 1, F.lit(float("nan")))
        .otherwise(F.col("n_chars") / F.lit(7.0))
    )
    nested = F.struct(
        F.col("text").alias("text"),
        F.array("lang", "source", F.substring("text", 1, 40)).alias("tags"),
        ratio.alias("ratio"),
        F.col("n_chars").alias("n"),
    )
    dtype = d.select(nested.alias("v")).schema["v"].dataType
    clean = json_safe_value(nested, dtype)
    return d.select(F.col("doc_id").alias("id"), clean.alias("v")).select(
        "id", F.col("v.text").alias("text"), F.col("v.tags").alias("tags"), F.col("v.ratio").alias("ratio"),
        F.col("v.n").alias("n"),
    )


@register
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P15: raw rows written as header CSV (RFC 4180 quoting), scanned back with an explicit schema, prepared."""
    path = shared_dir(spark, "books-csv")
    schema = BOOK_SCHEMA.add("row_key", "long")
    raw = inputs.raw_books(spark, sf_dir).select(*[f"`{f.name}`" for f in schema.fields])
    raw.write.option("header", True).option("escape", '"').csv(path)
    back = read_csv(spark, path, schema=schema)
    return prep.prepare_records(back, id_col="row_key")


@register
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1: good and malformed CSV rows in one folder; all kept, malformed ones with their text, positions without gaps."""
    path = shared_dir(spark, "books-malformed")
    raw = inputs.raw_books(spark, sf_dir).select(*[f"`{f.name}`" for f in BOOK_SCHEMA.fields])
    raw.write.option("header", True).option("escape", '"').csv(path)
    broken = raw.where(F.col("Reviews") % 50 == 0).withColumn("Price", F.lit("no price"))
    broken.write.mode("append").option("header", True).option("escape", '"').csv(path)
    back = prep.with_row_ids(read_csv(spark, path, corrupt_column="_corrupt"), "position")
    return back.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_corrupt").isNotNull()).alias("n_malformed"),
        F.count_if(F.col("_corrupt").contains("no price") & F.col("Price").isNull()).alias("n_kept_text"),
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"),
        F.countDistinct("position").alias("n_positions"),
    )
