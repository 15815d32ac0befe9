"""Exact k-nearest-neighbour search (V2, V6, V7, V8).

Batch kernel (V7): the query batch is small and its size is checked; it is
shipped to executors as a broadcast variable (never joined as a cross
product).  Each corpus partition is scanned once by ``mapInArrow``: the value
buffer of a batch of vectors is a numpy matrix as it is, distances to every
query come from one matrix product, and only the running top-k per query
survives the partition.  Two windows with ``WindowGroupLimit`` merge the
per-partition winners (at most ``k`` rows per query per partition cross the
shuffle, and no task receives all of a query's).

Vectors that are null or of another length than the queries are not ranked, nor
are such queries (V2); ``vector_rejects`` counts them by reason on either side, and
``on_reject="error"`` fails on the first one.

Query sets that grow with the data go through ``knn_join``: both sides are dealt
into blocks, every task meets one block of each, nothing reaches the driver.

Ordering is ``(rank_key(distance), id)`` everywhere, so partial and final
top-k agree exactly and ties are broken by id.  Rows whose distance is
undefined (zero-norm vector under cosine) are never ranked.

Single query (V6): ``knn_single`` stays fully native (higher-order-function
distance, ``TakeOrderedAndProject``), no Python worker at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.vectors import distance as distance_expr
from quarry.functions.vectors import from_key, norm, np_distances, np_rank_key, rank_key
from quarry.operators.topk import NO_KEY, RunningTopK, merge_top_k, top_k

# Query vectors of a broadcast, bounded in bytes (float64 x dim) and in count;
# bigger batches are joined by blocks.
MAX_QUERY_BYTES = 64 * 1024 * 1024
MAX_QUERIES_PER_PASS = 131_072
# Cells of the (queries x corpus rows) distance block inside a task.
DIST_CELLS = 1_000_000
# Queries and corpus rows that meet in one task of the block join.
QUERY_BLOCK = 16_384
CORPUS_BLOCK = 262_144


def _matrix(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix) of the vectors of length ``dim``; null vectors and elements leave a row out."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    flat = pc.list_flatten(vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows)))
    mat = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    if flat.null_count:
        full = ~np.isnan(mat).any(axis=1)
        rows, mat = rows[full], mat[full]
    return rows, mat


def _kernel_factory(bq, k: int, metric: str, qid_name: str, id_name: str, qid_type, id_type, on_reject: str):
    """Per-partition function for ``mapInArrow`` over (id, vector[, mask])."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, qmat, group = bq.value
        best = RunningTopK(len(qids), k)
        step = max(1, DIST_CELLS // len(qids))
        for batch in batches:
            rows, mat = _matrix(batch.column(1), qmat.shape[1])
            if on_reject == "error" and len(rows) < batch.num_rows:
                raise ValueError(f"{batch.num_rows - len(rows)} vectors of a batch are null or not of {qmat.shape[1]} dimensions")
            ids = batch.column(0).to_numpy(zero_copy_only=False)[rows]
            mask = None if group is None else batch.column(2).to_numpy()[rows]
            for start in range(0, len(mat), step):
                dist = np_distances(qmat, mat[start : start + step], metric)
                if mask is not None:  # a query sees the rows of its group only
                    dist[(mask[None, start : start + step] >> group[:, None]) & 1 == 0] = np.nan
                keys = np.where(np.isnan(dist), NO_KEY, np_rank_key(np.nan_to_num(dist, nan=0.0)))
                best.offer_block(keys, ids[start : start + step])
        out_q, out_id, out_k = best.rows(qids)
        if out_q:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_q, type=qid_type), pa.array(out_id, type=id_type), pa.array(out_k, type=pa.float64())], names=[qid_name, id_name, "dist_key"]
            )

    return kernel


def vector_rejects(corpus: DataFrame, dim: int, vec_col: str = "embedding") -> DataFrame:
    """V2 — one row: vectors in all, null, of another length than ``dim``, and without direction (zero norm)."""
    v = F.col(vec_col)
    right = F.size(v) == dim
    return corpus.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.count_if(v.isNull()).alias("n_null"),
        F.count_if(v.isNotNull() & ~right).alias("n_wrong_size"),
        F.count_if(right & (norm(v) == 0)).alias("n_zero"),
    )


def collect_queries(queries: DataFrame, qid_col: str, qvec_col: str, on_reject: str = "skip", group_col: str | None = None) -> tuple[list, np.ndarray, np.ndarray] | None:
    """The query batch as (ids, matrix, groups), or None if it is larger than a broadcast may be."""
    ids: list = []
    vecs: list = []
    groups: list[int] = []
    group = F.col(group_col) if group_col else F.lit(0)
    for row in queries.select(qid_col, qvec_col, group).toLocalIterator(prefetchPartitions=True):
        if row[1] is None:
            if on_reject == "error":
                raise ValueError(f"query {row[0]} has no vector")
            continue
        ids.append(row[0])
        groups.append(row[2])
        vecs.append(np.asarray(row[1], dtype=np.float64))
        if len(ids) > min(MAX_QUERIES_PER_PASS, max(1, MAX_QUERY_BYTES // (8 * max(len(vecs[0]), 1)))):
            return None
    return ids, np.stack(vecs) if vecs else np.zeros((0, 0)), np.array(groups, dtype=np.int64)


def _block_kernel(k: int, metric: str, dim: int, on_reject: str, names: list[str], kinds: list[pa.DataType]):
    """Over (group, slice, side, qid, id, vector) with a block's queries before its corpus rows."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, qids, mats, best, qmat = None, [], [], None, None

        def finished() -> Iterator[pa.RecordBatch]:
            if best is not None:
                out = best.rows(qids)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], names=names)

        for batch in batches:
            where = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            cuts = np.flatnonzero(np.r_[True, (where[:, 1:] != where[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                part = batch.slice(a, b - a)
                if key != tuple(where[:2, a]):
                    yield from finished()
                    key, qids, mats, best, qmat = tuple(where[:2, a]), [], [], None, None
                rows, mat = _matrix(part.column(5), dim)
                if on_reject == "error" and len(rows) < part.num_rows:
                    raise ValueError(f"{part.num_rows - len(rows)} vectors of a block are null or not of {dim} dimensions")
                if where[2, a] == 0:
                    qids += part.column(3).take(pa.array(rows)).to_pylist()
                    mats.append(mat)
                elif qids:
                    if best is None:
                        best, qmat = RunningTopK(len(qids), k), np.concatenate(mats)
                    own = part.column(4).to_numpy(zero_copy_only=False)[rows]
                    step = max(1, DIST_CELLS // len(qids))
                    for at in range(0, len(mat), step):
                        dist = np_distances(qmat, mat[at : at + step], metric)
                        best.offer_block(np.where(np.isnan(dist), NO_KEY, np_rank_key(np.nan_to_num(dist, nan=0.0))), own[at : at + step])
        yield from finished()

    return kernel


def knn_join(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
    qid_col: str = "query_id",
    qvec_col: str = "query_vector",
    where: Column | None = None,
    dim: int | None = None,
    on_reject: str = "skip",
) -> DataFrame:
    """V7/V8 for any number of queries — exact top-k per query: ``(query_id, id, distance, rank)``.

    Queries are dealt into slices of about ``QUERY_BLOCK``, corpus rows into groups of
    about ``CORPUS_BLOCK`` (fewer if that leaves tasks idle).  A task gets one group and
    one slice, holds the slice and streams the group; at most k rows per query
    leave it, and two ``WindowGroupLimit`` windows merge them.  Neither side is collected.
    """
    spark = corpus.sparkSession
    src = corpus if where is None else corpus.where(where)
    asked = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(qvec_col)).alias("dim")).first()
    dim = dim or asked["dim"] or 0
    n_slices = max(1, -(-asked["n"] // QUERY_BLOCK))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups = max(-(-src.count() // CORPUS_BLOCK), -(-tasks // n_slices))
    id_type, qid_type = src.schema[id_col].dataType, queries.schema[qid_col].dataType
    narrow = all(df.schema[c].dataType == T.ArrayType(T.FloatType()) for df, c in ((src, vec_col), (queries, qvec_col)))
    vector_type = "array<float>" if narrow else "array<double>"

    def dealt(df: DataFrame, side: int, key: str, own: int, other: int) -> list[Column]:
        block = F.pmod(F.xxhash64(F.col(key)), F.lit(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long")))
        group, part = (every, block) if side == 0 else (block, every)
        ids = [F.col(key), F.lit(None).cast(id_type)] if side == 0 else [F.lit(None).cast(qid_type), F.col(key)]
        return [group.alias("group"), part.alias("slice"), F.lit(side).alias("side"), ids[0].alias("qid"), ids[1].alias("id")]

    left = queries.select(*dealt(queries, 0, qid_col, n_slices, n_groups), F.col(qvec_col).cast(vector_type).alias("v"))
    right = src.select(*dealt(src, 1, id_col, n_groups, n_slices), F.col(vec_col).cast(vector_type).alias("v"))
    met = left.unionByName(right).repartition("group", "slice").sortWithinPartitions("group", "slice", "side")
    schema = T.StructType([T.StructField(qid_col, qid_type), T.StructField(id_col, id_type), T.StructField("dist_key", T.DoubleType())])
    kernel = _block_kernel(k, metric, dim, on_reject, schema.names, [to_arrow_type(f.dataType) for f in schema])
    return _merged(met.mapInArrow(kernel, schema), k, id_col, qid_col)


def _merged(found: DataFrame, k: int, id_col: str, qid_col: str) -> DataFrame:
    ranked = merge_top_k(found, [qid_col], [F.col("dist_key").asc(), F.col(id_col).asc()], id_col, k)
    return ranked.select(qid_col, id_col, from_key(F.col("dist_key")).alias("distance"), "rank")


def knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
    qid_col: str = "query_id",
    qvec_col: str = "query_vector",
    where: Column | None = None,
    dim: int | None = None,
    on_reject: str = "skip",
    groups: list[Column] | None = None,
    group_col: str = "group",
    include: list[str] | None = None,
) -> DataFrame:
    """V7/V8 — exact top-k per query: ``(query_id, id, distance, rank[, included fields])``.

    ``where`` is applied to the corpus *before* ranking (pre-filter, pushed
    to the scan).  ``dim`` adds the V2 shape check of the queries.  A batch that is
    too large to broadcast goes through ``knn_join``.  ``groups`` and ``group_col``:
    filters of their own for groups of queries in one scan, as in ``bm25_topk``;
    ``include`` adds fields of the winners (P18).
    """
    from quarry.operators.fulltext import row_mask, with_fields

    spark = corpus.sparkSession
    src = corpus if where is None else corpus.where(where)
    qid_type, id_type = queries.schema[qid_col].dataType, corpus.schema[id_col].dataType
    schema = T.StructType([T.StructField(qid_col, qid_type), T.StructField(id_col, id_type), T.StructField("dist_key", T.DoubleType())])
    batch = collect_queries(queries, qid_col, qvec_col, on_reject, group_col if groups else None)
    if batch is None:
        each = [(src, queries)] if not groups else [(src.where(g), queries.where(F.col(group_col) == i)) for i, g in enumerate(groups)]
        parts = [knn_join(c, q, k, metric, id_col, vec_col, qid_col, qvec_col, dim=dim, on_reject=on_reject) for c, q in each]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return with_fields(out, src, id_col, include)
    qids, qmat, of_group = batch
    if not qids:
        return with_fields(_merged(spark.createDataFrame([], schema), k, id_col, qid_col), src, id_col, include)
    if dim is not None and qmat.shape[1] != dim:
        raise ValueError(f"query vectors have {qmat.shape[1]} dimensions, the collection {dim}")
    shipped = spark.sparkContext.broadcast((qids, qmat, of_group if groups else None))
    kernel = _kernel_factory(shipped, k, metric, qid_col, id_col, to_arrow_type(qid_type), to_arrow_type(id_type), on_reject)
    rows = src.select(id_col, vec_col, *([row_mask(groups).alias("_mask")] if groups else []))
    rows = rows.where("_mask <> 0") if groups else rows
    return with_fields(_merged(rows.mapInArrow(kernel, schema), k, id_col, qid_col), src, id_col, include)


def knn_single(
    corpus: DataFrame,
    query_vector: list[float],
    k: int,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """V6 — one query, fully native: ``(id, distance, rank)``."""
    src = corpus if where is None else corpus.where(where)
    qv = F.array(*[F.lit(float(x)) for x in query_vector])
    d = distance_expr(F.col(vec_col), qv, metric)
    scored = src.select(id_col, rank_key(d).alias("dist_key")).where(F.col("dist_key").isNotNull())
    best = top_k(scored, [F.col("dist_key").asc(), F.col(id_col).asc()], k)
    # ``best`` holds at most k rows: an unpartitioned window over it is safe.
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy("dist_key", id_col)).cast("long"))
    return ranked.select(id_col, from_key(F.col("dist_key")).alias("distance"), "rank")


def label_centroids(
    vectors: DataFrame, label_col: str, vec_col: str, qid_name: str = "query_id", qvec_name: str = "query_vector"
) -> DataFrame:
    """Query batch derived from the data: the mean vector of every label.

    MLlib's ``Summarizer`` combines map-side: a hot label costs one partial
    vector per partition.
    """
    mean = Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>")))
    means = vectors.where(F.col(vec_col).isNotNull()).groupBy(label_col).agg(mean.alias("m"))
    return means.select(F.col(label_col).cast("long").alias(qid_name), vector_to_array("m").alias(qvec_name))
