"""Full-text retrieval (T1-T6, F7/F8 for query batches).

Postings (T2) are ``(term, id, tf, dl)``.  All tokens of a document live in
one row, so they are counted inside the row and nothing is shuffled.

Ranked retrieval (T5/T6) scores a *batch* of queries in one plan with BM25:

    idf(t)   = ln(1 + (N - df + 0.5) / (df + 0.5))
    score    = sum over distinct query terms t of
               idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))

``N``, ``avgdl`` and ``df`` describe the whole collection (not the filtered
candidates).  ``N``/``avgdl`` are scalar subqueries (computed once, no cross
join); the query vocabulary is a small, size-checked broadcast that turns
the corpus scan into a semi join, so only postings of query terms are
counted and shuffled.  A hot term (a stop word in a third of the corpus) is
a hot *term* key only for the df count, which is combined map-side.

Unranked substring retrieval for keyword batches (T4 / F7) is in ``substring``: one
scan for all keywords.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.tokens import tokenize
from quarry.functions.vectors import from_key, np_rank_key
from quarry.operators.substring import substring_matches
from quarry.operators.topk import NO_KEY, RunningTopK, merge_top_k, top_k_per_group

# Fixed values (BM25 parameters, Robertson & Zaragoza).
K1 = 1.2
B = 0.75
# Ranked text search: queries and vocabulary per pass, and the size of the
# blocks of matches inside a task.
MAX_QUERIES_PER_PASS = 2048
MAX_VOCAB_PER_PASS = 50_000
MAX_TERMS_PER_PASS = 200_000
# Terms whose document frequencies are counted by one scan (more terms: more scans).
MAX_STATS_VOCAB = 500_000
# (document, query, term) matches held at once inside a task, and documents of a batch looked at together.
MATCHES = 500_000
DOC_ROWS = 512
# Fixed value: resolution of BM25 ranking keys.
SCORE_SCALE = 1e9


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, DOC_ROWS):
            yield batch.slice(start, DOC_ROWS)


def doc_tokens(docs: DataFrame, id_col: str = "id", text_col: str = "document", analyzer: str = "basic") -> DataFrame:
    """T1 — ``(id, tokens)``."""
    return docs.select(id_col, tokenize(F.col(text_col), analyzer).alias("tokens"))


def build_postings(
    docs: DataFrame, id_col: str = "id", text_col: str = "document", analyzer: str = "basic"
) -> DataFrame:
    """T2 — ``(term, id, tf, dl)`` for the whole collection."""
    return postings_of_tokens(doc_tokens(docs, id_col, text_col, analyzer), id_col)


def postings_of_tokens(toks: DataFrame, id_col: str = "id") -> DataFrame:
    """T2 from ``(id, tokens)`` — all tokens of a document are in one row, so they are counted there: no shuffle."""
    id_type = toks.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("term", T.StringType()), T.StructField(id_col, id_type), T.StructField("dl", T.LongType()), T.StructField("tf", T.LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            tokens = part.column(1)
            lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            enc = pc.dictionary_encode(pc.list_flatten(tokens))
            rows = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            nv = max(1, len(enc.dictionary))
            pairs, tf = np.unique(rows * nv + enc.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row = pa.array(pairs // nv)
            yield pa.RecordBatch.from_arrays(
                [enc.dictionary.take(pa.array(pairs % nv)), part.column(0).take(row), pa.array(lengths[pairs // nv]), pa.array(tf.astype(np.int64))],
                names=["term", id_col, "dl", "tf"],
            )

    return toks.select(id_col, "tokens").mapInArrow(count, schema)


def corpus_stats(docs: DataFrame, text_col: str = "document", analyzer: str = "basic") -> DataFrame:
    """T3 — one row: ``n_docs``, ``avgdl``, ``total_terms``."""
    dl = F.size(tokenize(F.col(text_col), analyzer))
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.avg(dl).alias("avgdl"),
        F.sum(dl).cast("long").alias("total_terms"),
    )


def term_stats(postings: DataFrame, id_col: str = "id") -> DataFrame:
    """T3 — per term: document frequency and collection frequency."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf")
    )


def query_terms(queries: DataFrame, qid_col: str = "query_id", qtext_col: str = "query_text", analyzer: str = "basic"):
    """Distinct analyzed terms of every query: ``(query_id, term)``."""
    return queries.select(
        qid_col, F.explode(F.array_distinct(tokenize(F.col(qtext_col), analyzer))).alias("term")
    )


def _arrow_type(dt: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(dt)


def _query_term_passes(
    queries: DataFrame, qid_col: str, qtext_col: str, analyzer: str, group_col: str | None = None
) -> Iterator[list[tuple]]:
    """Stream ``(query_id, distinct terms[, group])`` to the driver in bounded passes."""
    columns = [F.col(qid_col), F.array_distinct(tokenize(F.col(qtext_col), analyzer)).alias("terms"), *([F.col(group_col)] if group_col else [])]
    rows = queries.select(*columns).toLocalIterator(prefetchPartitions=True)
    chunk: list[tuple] = []
    vocab: set = set()
    n_terms = 0
    for qid, terms, *group in rows:
        if not terms:
            continue  # a query without terms matches nothing
        grown = vocab | set(terms)
        n_terms += len(terms)
        if chunk and (len(chunk) >= MAX_QUERIES_PER_PASS or len(grown) > MAX_VOCAB_PER_PASS or n_terms > MAX_TERMS_PER_PASS):
            yield chunk
            chunk, grown, n_terms = [], set(terms), len(terms)
        chunk.append((qid, list(terms), *group))
        vocab = grown
    if chunk:
        yield chunk


def _term_codes(tokens: pa.ListArray, vocab: pa.Array):
    """Vectorised term lookup of a batch of token lists (Arrow compute, no Python per token).

    Returns ``(row, code)`` int64 arrays for the tokens found in ``vocab``
    and the per-row token counts.
    """
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(tokens)
    parents = pc.list_parent_indices(tokens)
    codes = pc.index_in(flat, value_set=vocab)
    found = pc.is_valid(codes)
    rows = pc.filter(parents, found).to_numpy(zero_copy_only=False).astype(np.int64)
    cols = pc.filter(codes, found).to_numpy(zero_copy_only=False).astype(np.int64)
    return rows, cols, lengths


def _stats_kernel(bvocab):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pa.array(bvocab.value, type=pa.string())
        nv = len(vocab)
        dfc = np.zeros(nv, dtype=np.int64)
        n_docs = 0
        total = 0
        for rb in _slices(batches):
            rows, cols, lengths = _term_codes(rb.column(0), vocab)
            n_docs += rb.num_rows
            total += int(lengths.sum())
            if len(rows):
                pairs = np.unique(rows * nv + cols)  # each (document, term) once
                dfc += np.bincount(pairs % nv, minlength=nv)
        nz = np.nonzero(dfc)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], nz]).astype(np.int64)),
             pa.array(np.concatenate([[n_docs], dfc[nz]]).astype(np.int64)),
             pa.array(np.concatenate([[total], np.zeros(len(nz), dtype=np.int64)]))],
            names=["code", "df", "total"],
        )

    return kernel


def vocabulary_stats(docs: DataFrame, text_col: str, analyzer: str, vocab: list[str]) -> tuple[int, float, dict]:
    """T3 for a query vocabulary in one scan: ``(N, avgdl, {term: df})``.

    Each task counts, with Arrow compute, in how many of its documents each
    vocabulary term occurs, plus its document count and token total; the
    per-task vectors (at most ``|vocab| + 1`` rows each) are summed by a
    tiny aggregate.  A stop word present in a third of the corpus costs one
    counter per task.  The vocabulary travels as a broadcast variable, not
    as a literal list in the plan.
    """
    toks = docs.select(tokenize(F.col(text_col), analyzer).alias("_t"))
    n_docs, total, dfs = 0, 0, {}
    for start in range(0, max(1, len(vocab)), MAX_STATS_VOCAB):
        part = vocab[start : start + MAX_STATS_VOCAB]
        bvocab = docs.sparkSession.sparkContext.broadcast(part)
        per_task = toks.mapInArrow(_stats_kernel(bvocab), "code long, df long, total long")
        for row in per_task.groupBy("code").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).collect():
            if row["code"] < 0:
                n_docs, total = row["df"], row["total"]
            else:
                dfs[part[row["code"]]] = row["df"]
        bvocab.unpersist()
    return n_docs, (total / n_docs if n_docs else 0.0), dfs


class TermIndex:
    """The queries of a pass by term: which queries hold each vocabulary term."""

    def __init__(self, qterm_idx: list[np.ndarray], n_terms: int):
        term = np.concatenate(qterm_idx) if qterm_idx else np.zeros(0, np.int64)
        query = np.repeat(np.arange(len(qterm_idx)), [len(t) for t in qterm_idx])
        order = np.argsort(term, kind="stable")
        self.query = query[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.n_queries = len(qterm_idx)


def query_sums(index: TermIndex, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, query, sum of weights) of all pairs that share a term, in blocks of whole rows.

    ``row`` (ascending), ``term``, ``weight``: each (document, term) once.  Only
    pairs with a common term are ever formed, ``MATCHES`` of them at a time.  Blocks with
    many matches for their (row, query) cells are summed cell by cell, others are sorted first.
    """
    reach = index.start[term + 1] - index.start[term]
    done = np.cumsum(reach)
    at = 0
    while at < len(row):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + MATCHES, side="right")))
        end = int(np.searchsorted(row, row[end - 1], side="right"))  # whole rows
        n = reach[at:end]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        query = index.query[np.repeat(index.start[term[at:end]], n) + inner]
        weights = np.repeat(weight[at:end], n)
        cells = (int(row[end - 1]) - int(row[at]) + 1) * index.n_queries
        pair = np.repeat(row[at:end] - row[at], n) * index.n_queries + query
        if cells <= 8 * len(pair):
            sums = np.bincount(pair, weights=weights, minlength=cells)
            each = np.flatnonzero(np.bincount(pair, minlength=cells))
            sums = sums[each]
        else:
            each, of = np.unique(pair, return_inverse=True)
            sums = np.bincount(of, weights=weights, minlength=len(each))
        yield each // index.n_queries + row[at], each % index.n_queries, sums
        at = end


def bm25_weights(idf: np.ndarray, tf: np.ndarray, dl: np.ndarray, avgdl: float, k1: float, b: float) -> np.ndarray:
    return idf * (tf * (k1 + 1.0)) / (tf + k1 * (1.0 - b + b * dl / avgdl))


def score_schema(qid_col: str, id_col: str, queries: DataFrame, docs: DataFrame) -> T.StructType:
    return T.StructType(
        [T.StructField(qid_col, queries.schema[qid_col].dataType), T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score_key", T.DoubleType())]
    )


def offer_scores(
    best: RunningTopK, index: TermIndex, row: np.ndarray, term: np.ndarray, weight: np.ndarray, ids: np.ndarray, mask: np.ndarray | None = None, group: np.ndarray | None = None
) -> None:
    """Scores of all matching (document, query) pairs into the running top-k; ``ids`` by row.

    With ``mask`` (by row, a bit per group) and ``group`` (by query) a query sees the rows of its group only.
    """
    for r, q, score in query_sums(index, row, term, weight):
        good = score > 0 if mask is None else (score > 0) & ((mask[r] >> group[q]) & 1 == 1)
        best.offer(q, np.where(good, -np_rank_key(score, SCORE_SCALE), NO_KEY), ids[r])


def winners(best: RunningTopK, qids: list, qid_col: str, id_col: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out_q, out_id, out_k = best.rows(qids)
    if out_q:
        yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip((out_q, out_id, [-x for x in out_k]), schema)], names=[qid_col, id_col, "score_key"])


def _bm25_kernel(bc, k: int, id_col: str, qid_col: str, kinds: list[pa.DataType]):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab_list, idf, qids, qterm_idx, avgdl, k1, b, group = bc.value
        vocab = pa.array(vocab_list, type=pa.string())
        nv = len(vocab_list)
        index = TermIndex(qterm_idx, nv)
        best = RunningTopK(len(qids), k)
        for rb in _slices(batches):
            rows, cols, lengths = _term_codes(rb.column(1), vocab)
            if len(rows):
                pairs, tf = np.unique(rows * nv + cols, return_counts=True)
                r, v = pairs // nv, pairs % nv  # sorted by row
                w = bm25_weights(idf[v], tf, lengths[r].astype(np.float64), avgdl, k1, b)
                mask = None if group is None else rb.column(2).to_numpy()
                offer_scores(best, index, r, v, w, rb.column(0).to_numpy(zero_copy_only=False), mask, group)
        yield from winners(best, qids, qid_col, id_col, kinds)

    return kernel


def bm25_topk(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "id",
    text_col: str = "document",
    qid_col: str = "query_id",
    qtext_col: str = "query_text",
    where: Column | None = None,
    analyzer: str = "basic",
    k1: float = K1,
    b: float = B,
    groups: list[Column] | None = None,
    group_col: str = "group",
    include: list[str] | None = None,
) -> DataFrame:
    """T5/T6 — top-k per query by BM25: ``(query_id, id, score, rank[, included fields])`` (score desc, id asc).

    Per pass of at most ``MAX_QUERIES_PER_PASS`` queries:
    1. one aggregate gives N, avgdl and df of the pass vocabulary (whole corpus);
    2. one scan of the candidates (``where`` pushed down) feeds ``mapInArrow``:
       the weights of matched (document, term) pairs are summed per query
       through a term -> queries index; pairs without a common term are
       never formed and only the running top-k per query leaves the partition;
    3. two ``WindowGroupLimit`` windows merge the partition winners.
    No (query, document) pair is ever shuffled.

    ``groups``: filters of their own for groups of queries, all answered by the same scan.
    A row carries one bit per filter it passes (``row_mask``); ``group_col`` of a query
    is the position of its filter.  ``include`` adds fields of the winners (P18).
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    schema = score_schema(qid_col, id_col, queries, docs)
    kinds = [_arrow_type(f.dataType) for f in schema]
    cand = docs if where is None else docs.where(where)
    parts = []
    for chunk in _query_term_passes(queries, qid_col, qtext_col, analyzer, group_col if groups else None):
        vocab = sorted({t for _, terms, *_ in chunk for t in terms})
        n_docs, avgdl, dfs = vocabulary_stats(docs, text_col, analyzer, vocab)
        if n_docs == 0:
            continue
        pos = {t: i for i, t in enumerate(vocab)}
        idf = np.array([math.log(1.0 + (n_docs - dfs.get(t, 0) + 0.5) / (dfs.get(t, 0) + 0.5)) for t in vocab])
        qids = [q for q, *_ in chunk]
        qterm_idx = [np.array([pos[t] for t in terms], dtype=np.int64) for _, terms, *_ in chunk]
        of_group = np.array([g for *_, g in chunk], dtype=np.int64) if groups else None
        bc = sc.broadcast((vocab, idf, qids, qterm_idx, avgdl, k1, b, of_group))
        src = cand.select(id_col, tokenize(F.col(text_col), analyzer).alias("_t"), *([row_mask(groups).alias("_mask")] if groups else []))
        src = src.where("_mask <> 0") if groups else src
        parts.append(src.mapInArrow(_bm25_kernel(bc, k, id_col, qid_col, kinds), schema))
    if not parts:
        empty = spark.createDataFrame([], schema)
        none = empty.select(qid_col, id_col, F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("rank"))
        return with_fields(none, docs, id_col, include)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ranked = merge_top_k(out, [qid_col], [F.col("score_key").desc(), F.col(id_col).asc()], id_col, k)
    ranked = ranked.select(qid_col, id_col, from_key(F.col("score_key"), SCORE_SCALE).alias("score"), "rank")
    return with_fields(ranked, docs, id_col, include)


def with_fields(winners: DataFrame, docs: DataFrame, id_col: str, include: list[str] | None) -> DataFrame:
    """P18 — chosen fields of the winners."""
    return winners.join(docs.select(id_col, *include), id_col).select(*winners.columns, *include) if include else winners


#: Filters that one row mask holds.
MAX_GROUPS = 60


def row_mask(groups: list[Column]) -> Column:
    """A bit for every filter the row passes."""
    mask = F.lit(0).cast("long")
    for i, passes in enumerate(groups):
        mask = mask.bitwiseOR(F.when(passes, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return mask


def _match_kernel(bc, id_col: str, qid_col: str, require_all: bool, qid_type: pa.DataType, id_type: pa.DataType):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab_list, qids, qterm_idx = bc.value
        vocab = pa.array(vocab_list, type=pa.string())
        nv = len(vocab_list)
        index = TermIndex(qterm_idx, nv)
        need = np.array([len(t) for t in qterm_idx])
        for rb in _slices(batches):
            rows, cols, _ = _term_codes(rb.column(1), vocab)
            pairs = np.unique(rows * nv + cols)
            for r, q, found in query_sums(index, pairs // nv, pairs % nv, np.ones(len(pairs))):
                hit = found >= (need[q] if require_all else 1)
                if hit.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([qids[i] for i in q[hit].tolist()], type=qid_type), rb.column(0).take(pa.array(r[hit])).cast(id_type)], names=[qid_col, id_col]
                    )

    return kernel


def token_matches(
    docs: DataFrame,
    queries: DataFrame,
    require_all: bool = False,
    id_col: str = "id",
    text_col: str = "document",
    qid_col: str = "query_id",
    qtext_col: str = "query_text",
    analyzer: str = "basic",
) -> DataFrame:
    """F8 for a batch — documents holding any (or all) analyzed query tokens: ``(query_id, id)``.

    One scan; each Arrow batch of token arrays is matched against the pass
    vocabulary (``index_in``) and the distinct query terms found per
    document are counted through the term -> queries index.  Matching pairs
    are emitted directly: no join, no aggregate, no shuffle.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [T.StructField(qid_col, queries.schema[qid_col].dataType), T.StructField(id_col, docs.schema[id_col].dataType)]
    )
    src = docs.select(id_col, tokenize(F.col(text_col), analyzer).alias("_t"))
    parts = []
    for chunk in _query_term_passes(queries, qid_col, qtext_col, analyzer):
        vocab = sorted({t for _, terms in chunk for t in terms})
        pos = {t: i for i, t in enumerate(vocab)}
        qids = [q for q, _ in chunk]
        qterm_idx = [np.array([pos[t] for t in terms], dtype=np.int64) for _, terms in chunk]
        bc = spark.sparkContext.broadcast((vocab, qids, qterm_idx))
        kernel = _match_kernel(
            bc, id_col, qid_col, require_all, _arrow_type(schema[qid_col].dataType), _arrow_type(schema[id_col].dataType)
        )
        parts.append(src.mapInArrow(kernel, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def fulltext_get(
    docs: DataFrame,
    queries: DataFrame,
    limit: int = 10,
    id_col: str = "id",
    text_col: str = "document",
    qid_col: str = "query_id",
    qtext_col: str = "query_text",
    where: Column | None = None,
    token_mode: str | None = None,
    include: list[str] | None = None,
    analyzer: str = "basic",
) -> DataFrame:
    """T4 — unranked get, first ``limit`` ids per query: ``(query_id, id, rank[, included fields])``.

    Matches by substring (``$contains``) or, with ``token_mode`` ``"any"`` / ``"all"``, by analyzed
    tokens; ``where`` filters the candidates first (pushed to the scan), ``include`` adds
    stored fields of the winners (P18).
    """
    cand = docs if where is None else docs.where(where)
    if token_mode is None:
        m = substring_matches(cand, queries, id_col, text_col, qid_col, qtext_col)
    else:
        m = token_matches(cand, queries, token_mode == "all", id_col, text_col, qid_col, qtext_col, analyzer)
    got = top_k_per_group(m, [qid_col], [F.col(id_col).asc()], limit)
    return with_fields(got.select(qid_col, id_col, "rank"), docs, id_col, include)
