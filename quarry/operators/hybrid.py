"""Hybrid search (H1-H8): a BM25 leg and a vector leg fused with Reciprocal Rank Fusion.

Plan per batch of queries:

    text leg    bm25_topk(where & where_document)   -> (qid, id, score, text_rank)   <= n_text per query
    vector leg  knn(where)                          -> (qid, id, distance, vector_rank) <= n_vector per query
    fuse        full outer join on (qid, id)        -> rrf = sum 1/(c + rank)
    limit       top-k by (rrf desc, id asc)         -> rrf_rank
    present     distance asc (missing last), rrf_rank -> distance_rank
    hydrate     join the winners back to the collection payload

Both legs are already limited per query, so the fusion join, the final
window and the hydration join only ever see ``queries x (n_text + n_vector)``
rows; the collection itself is only scanned by the legs and by the
hydration join (whose build side is that small winner set).

A query whose text leg is empty (no term in the corpus) still gets the
vector leg's ranking through the outer join (H8 data-level fallback).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.filters import build_filter, document_filter
from quarry.operators.fulltext import MAX_GROUPS, bm25_topk
from quarry.operators.knn import knn
from quarry.operators.topk import number_rows, top_k, top_k_per_group

# Fixed value: RRF constant (Cormack, Clarke & Buettcher, SIGIR 2009).
RRF_K = 60
# Resolution of summed RRF scores (n-leg form).
RRF_SCALE = 1e12


def rrf_term(rank: Column, c: int = RRF_K) -> Column:
    return F.coalesce(F.lit(1.0) / (F.lit(c) + rank), F.lit(0.0))


def fuse_rrf(
    legs: list[DataFrame],
    rank_cols: list[str],
    k: int,
    qid_col: str = "query_id",
    id_col: str = "id",
    c: int = RRF_K,
) -> DataFrame:
    """H2 (two or more legs) — full outer join of ranked legs and RRF top-k.

    Each leg is ``(qid, id, <rank_col>, ...)``; the result carries every
    leg's columns (null where the leg missed the id), ``rrf`` and ``rrf_rank``.
    """
    fused = legs[0]
    for leg in legs[1:]:
        fused = fused.join(leg, [qid_col, id_col], "full_outer")
    rrf = None
    for rc in rank_cols:
        t = rrf_term(F.col(rc), c)
        rrf = t if rrf is None else rrf + t
    fused = fused.withColumn("rrf", rrf)
    return top_k_per_group(fused, [qid_col], [F.col("rrf").desc(), F.col(id_col).asc()], k, "rrf_rank")


def fuse_rrf_union(
    legs: list[DataFrame], k: int, qid_col: str = "query_id", id_col: str = "id", c: int = RRF_K
) -> DataFrame:
    """H2, n-leg form — ``unionByName`` of ``(qid, id, rank)`` legs, ``groupBy`` sum.

    A sum of three or more terms depends on the summation order in its last
    bit, so ranking uses the sum quantised to 1e-12 (``rrf`` reports that value).
    """
    u = legs[0].select(qid_col, id_col, "rank")
    for leg in legs[1:]:
        u = u.unionByName(leg.select(qid_col, id_col, "rank"))
    s = u.groupBy(qid_col, id_col).agg(F.sum(F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("_rrf"))
    s = s.withColumn("rrf_key", F.floor(F.col("_rrf") * F.lit(RRF_SCALE) + F.lit(0.5)).cast("long"))
    s = s.withColumn("rrf", F.col("rrf_key").cast("double") / F.lit(RRF_SCALE)).drop("_rrf")
    return top_k_per_group(s, [qid_col], [F.col("rrf_key").desc(), F.col(id_col).asc()], k, "rrf_rank").drop(
        "rrf_key"
    )


def display_order(fused: DataFrame, qid_col: str = "query_id", rank_col: str = "distance_rank") -> DataFrame:
    """H6 — rank by distance ascending, missing distance last, stable on ``rrf_rank``."""
    return number_rows(fused, [qid_col], [F.col("distance").asc_nulls_last(), F.col("rrf_rank").asc()], rank_col)


def hydrate(results: DataFrame, collection: DataFrame, payload: list[str], id_col: str = "id") -> DataFrame:
    """H7 — attach payload columns to the (small) winner set.

    The winners come from the collection, so an inner join loses nothing; Spark
    broadcasts the winners when their measured size is small.
    """
    return results.join(collection.select(id_col, *payload), id_col)


def hybrid_search(
    collection: DataFrame,
    queries: DataFrame,
    k: int = 10,
    n_text: int | None = None,
    n_vector: int | None = None,
    where: dict[str, Any] | None = None,
    where_document: dict[str, Any] | None = None,
    embed: Callable[[Column], Column] | None = None,
    metric: str = "cosine",
    id_col: str = "id",
    text_col: str = "document",
    vec_col: str = "embedding",
    qid_col: str = "query_id",
    qtext_col: str = "query_text",
    qvec_col: str = "query_vector",
    payload: list[str] | None = None,
    c: int = RRF_K,
) -> DataFrame:
    """H1 — fused top-k per query.

    ``embed`` turns text into vectors (the collection's embedding function,
    V1/U1); it is applied to the collection when ``vec_col`` is absent and
    to the queries when ``qvec_col`` is absent.
    """
    n_text = n_text or k
    n_vector = n_vector or k
    pred = build_filter(where, collection.columns)
    text_pred = pred & document_filter(where_document, text_col)
    text_leg = bm25_topk(collection, queries, n_text, id_col, text_col, qid_col, qtext_col, where=text_pred)
    text_leg = text_leg.withColumnRenamed("rank", "text_rank")

    corpus = collection
    if vec_col not in corpus.columns:
        if embed is None:
            raise ValueError("collection has no vector column and no embedding function was given")
        corpus = corpus.withColumn(vec_col, embed(F.col(text_col)))
    qs = queries
    if qvec_col not in qs.columns:
        if embed is None:
            raise ValueError("queries have no vector column and no embedding function was given")
        qs = qs.withColumn(qvec_col, embed(F.col(qtext_col)))
    vec_leg = knn(corpus, qs, n_vector, metric, id_col, vec_col, qid_col, qvec_col, where=pred)
    vec_leg = vec_leg.withColumnRenamed("rank", "vector_rank")

    fused = fuse_rrf([text_leg, vec_leg], ["text_rank", "vector_rank"], k, qid_col, id_col, c)
    shown = display_order(fused, qid_col)
    if payload:
        shown = hydrate(shown, collection, payload, id_col)
    return shown


@dataclass(frozen=True)
class SearchGroup:
    """Queries that share their conditions; each has a text for either leg.

    ``queries``: query_id, keyword_text, vector_text.  ``where`` filters the vector
    leg, ``keyword_where`` the text leg (default: ``where``), ``where_document``
    the documents of the text leg.
    """

    queries: DataFrame
    where: dict[str, Any] | None = None
    keyword_where: dict[str, Any] | None = None
    where_document: dict[str, Any] | None = None
    n_text: int | None = None
    n_vector: int | None = None


def search_groups(
    collection: DataFrame,
    groups: list[SearchGroup],
    k: int,
    embed: Callable[[Column], Column],
    metric: str = "cosine",
    id_col: str = "id",
    text_col: str = "document",
    vec_col: str = "embedding",
    payload: list[str] | None = None,
    c: int = RRF_K,
) -> DataFrame:
    """H1/H5 — one batch of queries with their own texts, filters and sizes per leg, fused together.

    All groups share one scan per leg: every row carries the set of group filters it
    passes (``MAX_GROUPS`` groups a scan).  Fusion, display order and hydration happen once for all.
    """
    corpus = collection if vec_col in collection.columns else collection.withColumn(vec_col, embed(F.col(text_col)))
    legs: list[list[DataFrame]] = [[], []]
    for first in range(0, len(groups), MAX_GROUPS):
        some = groups[first : first + MAX_GROUPS]
        keyword = [build_filter(g.where if g.keyword_where is None else g.keyword_where, collection.columns) & document_filter(g.where_document, text_col) for g in some]
        vector = [build_filter(g.where, collection.columns) for g in some]
        asked = None
        for i, g in enumerate(some):
            q = g.queries.select("query_id", "keyword_text", "vector_text", F.lit(i).alias("group"), F.lit(g.n_text or k).alias("_n_text"), F.lit(g.n_vector or k).alias("_n_vector"))
            asked = q if asked is None else asked.unionByName(q)
        text = bm25_topk(collection, asked, max(g.n_text or k for g in some), id_col, text_col, "query_id", "keyword_text", groups=keyword)
        qs = asked.select("query_id", "group", embed(F.col("vector_text")).alias("query_vector"))
        near = knn(corpus, qs, max(g.n_vector or k for g in some), metric, id_col, vec_col, groups=vector)
        for leg, found, size in ((0, text, "_n_text"), (1, near, "_n_vector")):
            if len({(g.n_text, g.n_vector) for g in some}) > 1:  # sizes of their own
                found = found.join(asked.select("query_id", size), "query_id").where(F.col("rank") <= F.col(size)).drop(size)
            legs[leg].append(found)
    texts, vectors = ([part.withColumnRenamed("rank", name) for part in leg] for leg, name in zip(legs, ("text_rank", "vector_rank")))
    for more in texts[1:]:
        texts[0] = texts[0].unionByName(more)
    for more in vectors[1:]:
        vectors[0] = vectors[0].unionByName(more)
    shown = display_order(fuse_rrf([texts[0], vectors[0]], ["text_rank", "vector_rank"], k, "query_id", id_col, c))
    return hydrate(shown, collection, payload, id_col) if payload else shown


def scalar_leg(
    collection: DataFrame,
    queries: DataFrame,
    where: dict[str, Any],
    n: int,
    id_col: str = "id",
    qid_col: str = "query_id",
) -> DataFrame:
    """F9/H4 — a leg with only a metadata filter, ranked by id: ``(qid, id, rank)``.

    The leg is the same for every query: its top-``n`` ids (a bounded,
    ``TakeOrderedAndProject`` result) are attached to each query as an array
    literal and exploded — no join and no per-query copy of the corpus.
    """
    matched = top_k(collection.where(build_filter(where, collection.columns)).select(id_col), [F.col(id_col)], n)
    ids = [r[0] for r in matched.collect()]
    id_type = collection.schema[id_col].dataType
    arr = F.array(*[F.lit(v).cast(id_type) for v in ids]) if ids else F.array().cast(f"array<{id_type.simpleString()}>")
    return queries.select(qid_col, F.posexplode(arr).alias("_pos", id_col)).select(
        qid_col, id_col, (F.col("_pos") + 1).cast("long").alias("rank")
    )
