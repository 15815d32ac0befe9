"""DuckDB twins of the registered scenarios (same column names and types).

Conventions shared with the Spark side:
* distances rank by ``floor(x * 1e12 + 0.5)``, BM25 scores by ``floor(x * 1e9 + 0.5)``, ties by id;
  both are reported to 6 decimals;
* ranks are BIGINT ``row_number()`` from 1;
* Unicode whitespace for trims is ``[\\s\\p{Z}]`` (RE2 has no Unicode ``\\s``;
  U+0085 and U+001C..U+001F are removed before any trim).
"""

from __future__ import annotations

# ------------------------------------------------------------------ shared pieces

CENTROIDS = """
centroids AS (
  SELECT label::BIGINT AS query_id, list(m ORDER BY pos) AS qv
  FROM (
    SELECT label, pos, avg(v::DOUBLE) AS m
    FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos
  )
  GROUP BY label
)"""

VCOLL = """
vcoll AS (
  SELECT d.doc_id AS id, d.lang, d.source, d.n_chars, e.embedding::DOUBLE[] AS v
  FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id
)"""

_DIST = {
    "cosine": "1 - list_dot_product(q.qv, c.v) / (sqrt(list_dot_product(q.qv, q.qv)) * sqrt(list_dot_product(c.v, c.v)))",
    "l2": "sqrt(list_sum(list_transform(list_zip(q.qv, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))",
    "ip": "-list_dot_product(q.qv, c.v)",
}


VONLY = """
vcoll AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)"""


#: Every vector whose id is divisible by 100 as a query.
ID_QUERIES = "id_queries AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id % 100 = 0)"


def _knn_sql(metric: str, k: int, where: str = "TRUE", vectors: str = VONLY, queries: str = "centroids") -> str:
    return f"""
WITH {CENTROIDS}, {ID_QUERIES}, {vectors},
scored AS (
  SELECT q.query_id, c.id, floor(({_DIST[metric]}) * 1e12 + 0.5) AS dist_key
  FROM {queries} q, vcoll c
  WHERE {where}
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist_key, id) AS rank
  FROM scored WHERE dist_key IS NOT NULL
)
SELECT query_id, id, floor(dist_key / 1e6 + 0.5) / 1e6 AS distance, rank::BIGINT AS rank FROM ranked WHERE rank <= {k}
"""


SQL: dict[str, str] = {
    "knn_cosine": _knn_sql("cosine", 5),
    "knn_l2": _knn_sql("l2", 5),
    "knn_ip": _knn_sql("ip", 5),
    "knn_filtered": _knn_sql("cosine", 10, "c.lang = 'en'", VCOLL),
    "knn_all": _knn_sql("cosine", 10, queries="id_queries"),
    "knn_all_filtered": _knn_sql("l2", 10, "c.lang = 'de'", VCOLL, "id_queries"),
}


# ------------------------------------------------------------------ text cleaning twins
# RE2 spellings of the same fixed character classes as quarry.functions.text.

def sql_sanitize(x: str) -> str:
    s = f"regexp_replace(coalesce({x}, ''), '[\\x00-\\x08\\x0b-\\x0c\\x0e-\\x1f\\x7f-\\x9f]', '', 'g')"
    s = f"regexp_replace({s}, '[ \\t]+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\n[\\s\\p{{Z}}]*\\n', chr(10), 'g')"
    return sql_strip(s)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def sql_json_safe(x: str) -> str:
    s = f"regexp_replace({sql_sanitize(x)}, '[\\x00-\\x1f\\x7f-\\x9f]', '', 'g')"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE replace({s}, '\"', '''') END"


RAW_BOOKS = """
raw_books AS (
  SELECT p_partkey AS row_key,
         p_name || chr(7) || '  ' || p_brand AS "Name",
         p_brand AS "Author",
         p_size / 9.0e0 AS "User Rating",
         p_partkey AS "Reviews",
         p_retailprice AS "Price",
         (1880 + p_size * 5)::BIGINT AS "Year",
         p_type AS "Genre"
  FROM part
)"""


def _books_sql() -> str:
    fin = "CASE WHEN isnan({0}) OR isinf({0}) OR {0} IS NULL THEN 0.0 ELSE {0} END"
    stage1 = f"""
stage1 AS (
  SELECT row_key::VARCHAR AS id,
         {sql_json_safe(sql_strip(f"{sql_sanitize('"Name"')} || ' ' || {sql_sanitize('"Author"')}"))} AS document,
         {sql_sanitize('"Name"')} AS _name,
         {sql_sanitize('"Author"')} AS _author,
         {sql_sanitize('"Genre"')} AS _genre,
         {fin.format('"User Rating"')} AS _rating,
         {fin.format('"Price"')} AS _price,
         coalesce("Reviews", 0)::BIGINT AS _reviews,
         coalesce("Year", 0)::BIGINT AS _year
  FROM raw_books
)"""
    stage2 = """
stage2 AS (
  SELECT *, CASE WHEN _rating IS NULL OR NOT (_rating BETWEEN 0.0 AND 5.0) THEN 'user_rating'
                 WHEN _price IS NULL OR _price < 0.0 THEN 'price'
                 WHEN _reviews IS NULL OR _reviews < 0 THEN 'reviews'
                 WHEN _year IS NULL OR NOT (_year BETWEEN 1900 AND 2100) THEN 'year' END AS invalid_reason
  FROM stage1
)"""

    def twice(e: str) -> str:
        return sql_json_safe(sql_json_safe(e))

    def pick(cap: str, col: str) -> str:
        return f"CASE WHEN invalid_reason IS NULL THEN {cap} ELSE coalesce(nullif({col}, ''), 'Unknown') END"

    stage3 = f"""
books AS (
  SELECT id, document,
         {twice(pick("left(_name, 500)", "_name"))} AS name,
         {twice(pick("left(_author, 200)", "_author"))} AS author,
         CASE WHEN invalid_reason IS NULL THEN _rating ELSE 0.0 END AS user_rating,
         CASE WHEN invalid_reason IS NULL THEN _reviews ELSE 0 END::BIGINT AS reviews,
         CASE WHEN invalid_reason IS NULL THEN _price ELSE 0.0 END AS price,
         CASE WHEN invalid_reason IS NULL THEN _year ELSE 2000 END::BIGINT AS year,
         {twice(pick("_genre", "_genre"))} AS genre,
         invalid_reason
  FROM stage2
),
records AS (
  SELECT *, to_json(struct_pack(name := name, author := author, user_rating := user_rating,
                                reviews := reviews, price := price, year := year, genre := genre))::VARCHAR AS metadata
  FROM books
)"""
    return f"{RAW_BOOKS},{stage1},{stage2},{stage3}"


BOOKS = _books_sql()

SQL["prepare_books"] = f"WITH {BOOKS} SELECT * FROM records"
SQL["validation_summary"] = f"""
WITH {BOOKS}
SELECT invalid_reason, count(*) AS n_rows FROM records GROUP BY invalid_reason"""
SQL["validation_errors"] = f"""
WITH {BOOKS}
SELECT count(*) AS n_records, count(*) FILTER (WHERE invalid_reason IS NOT NULL) AS n_invalid FROM records"""
SQL["source_profile"] = f"""
WITH {RAW_BOOKS}
SELECT count(*) AS row_count, 8::BIGINT AS column_count,
       'row_key, Name, Author, User Rating, Reviews, Price, Year, Genre' AS column_names
FROM raw_books"""
SQL["sanitize_documents"] = f"""
SELECT doc_id AS id,
       {sql_sanitize('text')} AS clean_text,
       {sql_json_safe('text')} AS json_text,
       length({sql_sanitize('text')})::BIGINT AS clean_chars,
       CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS snippet
FROM documents"""


# ------------------------------------------------------------------ full text twins

TOKEN_RE = "[\\p{L}\\p{N}]+"
_W = "[^\\p{Han}\\P{L}]"
SMART_RE = (
    f"(?:{_W}|[\\p{{N}}._%+-])+@(?:{_W}|[\\p{{N}}-])+(?:\\.(?:{_W}|[\\p{{N}}-])+)+"
    "|(?:\\d{1,3}\\.){3}\\d{1,3}"
    f"|(?:(?:{_W}|[\\p{{N}}-])+\\.)+{_W}{{2,}}"
    "|\\p{Han}+"
    "|(?:[^\\p{Han}\\P{L}]|\\p{N})+"
)
NON_HAN_RE = "(?:[^\\p{Han}\\P{L}]|\\p{N})+"


def sql_tokens(x: str, pattern: str = TOKEN_RE) -> str:
    return f"regexp_extract_all(lower({x}), '{pattern}')"


def sql_max_word(x: str) -> str:
    han = "regexp_full_match(t, '\\p{Han}+')"
    bigrams = "CASE WHEN length(t) <= 1 THEN [t] ELSE list_transform(range(1, length(t)), lambda i: substring(t, i, 2)) END"
    pieces = f"regexp_extract_all(t, '{NON_HAN_RE}')"
    other = f"list_concat([t], CASE WHEN len({pieces}) > 1 THEN {pieces} ELSE []::VARCHAR[] END)"
    return f"flatten(list_transform({sql_tokens(x, SMART_RE)}, lambda t: CASE WHEN {han} THEN {bigrams} ELSE {other} END))"


DOCS = "docs AS (SELECT doc_id AS id, text AS document, lang, source, n_chars FROM documents)"
BENCH_Q = "bq AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"
KEYWORD_Q = "kq AS (SELECT * FROM (VALUES (0::BIGINT, 'the'), (1::BIGINT, 'that'), (2::BIGINT, 'thon')) t(query_id, query_text))"


def _bm25_sql(queries: str, k: int, where: str = "TRUE") -> str:
    return f"""
WITH {DOCS}, {BENCH_Q}, {KEYWORD_Q},
toks AS (SELECT id, ({where}) AS keep, {sql_tokens('document')} AS tokens FROM docs),
stats AS (SELECT count(*) AS n_docs, avg(len(tokens)) AS avgdl FROM toks),
qt AS (SELECT DISTINCT query_id, unnest({sql_tokens('query_text')}) AS term FROM {queries}),
post AS (
  SELECT term, id, dl, keep, count(*) AS tf
  FROM (SELECT id, keep, len(tokens) AS dl, unnest(tokens) AS term FROM toks)
  WHERE term IN (SELECT term FROM qt)
  GROUP BY ALL
),
dfreq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
scored AS (
  SELECT qt.query_id, p.id,
         sum(ln(1.0e0 + (s.n_docs - d.df + 0.5e0) / (d.df + 0.5e0))
             * ((p.tf * 2.2e0) / (p.tf + 1.2e0 * (0.25e0 + 0.75e0 * p.dl / s.avgdl)))) AS score
  FROM post p JOIN dfreq d USING (term) JOIN qt USING (term) CROSS JOIN stats s
  WHERE p.keep
  GROUP BY ALL
),
ranked AS (
  SELECT query_id, id, floor(score * 1e9 + 0.5) AS score_key,
         row_number() OVER (PARTITION BY query_id ORDER BY floor(score * 1e9 + 0.5) DESC, id) AS rank
  FROM scored
)
SELECT query_id, id, floor(score_key / 1e3 + 0.5) / 1e6 AS score, rank::BIGINT AS rank FROM ranked WHERE rank <= {k}
"""


def _get_sql(queries: str, limit: int) -> str:
    return f"""
WITH {DOCS}, {BENCH_Q}, {KEYWORD_Q},
m AS (SELECT q.query_id, d.id FROM {queries} q JOIN docs d ON contains(d.document, q.query_text)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY id) AS rank FROM m)
SELECT query_id, id, rank::BIGINT AS rank FROM r WHERE rank <= {limit}
"""


SQL["tokenize_documents"] = f"""
WITH {DOCS}
SELECT id,
       len({sql_tokens('document')})::BIGINT AS n_basic,
       len({sql_tokens('document', SMART_RE)})::BIGINT AS n_smart,
       len({sql_max_word('document')})::BIGINT AS n_max_word,
       len(list_distinct({sql_tokens('document')}))::BIGINT AS n_distinct
FROM docs"""
SQL["postings"] = f"""
WITH {DOCS}
SELECT term, id, dl, count(*) AS tf
FROM (SELECT id, len(tokens)::BIGINT AS dl, unnest(tokens) AS term
      FROM (SELECT id, {sql_tokens('document')} AS tokens FROM docs))
GROUP BY ALL"""
SQL["term_stats"] = f"""
WITH {DOCS},
p AS (SELECT term, id, count(*) AS tf
      FROM (SELECT id, unnest({sql_tokens('document')}) AS term FROM docs) GROUP BY ALL)
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p GROUP BY term"""
SQL["corpus_stats"] = f"""
WITH {DOCS}
SELECT count(*) AS n_docs, avg(len({sql_tokens('document')})) AS avgdl,
       sum(len({sql_tokens('document')}))::BIGINT AS total_terms
FROM docs"""
SQL["bm25_topk"] = _bm25_sql("bq", 10)
SQL["bm25_filtered"] = _bm25_sql("bq", 5, "n_chars >= 2000")
SQL["fulltext_get"] = _get_sql("bq", 10)
SQL["keyword_get"] = _get_sql("kq", 5)
SQL["keyword_match_counts"] = f"""
WITH {DOCS}, {KEYWORD_Q},
sub AS (SELECT q.query_id, count(*) AS n FROM kq q JOIN docs d ON contains(d.document, q.query_text) GROUP BY ALL),
tok AS (SELECT q.query_id, count(*) AS n FROM kq q JOIN docs d
        ON list_has_any({sql_tokens('d.document')}, {sql_tokens('q.query_text')}) GROUP BY ALL)
SELECT q.query_id, q.query_text, coalesce(sub.n, 0)::BIGINT AS n_substring, coalesce(tok.n, 0)::BIGINT AS n_token
FROM kq q LEFT JOIN sub USING (query_id) LEFT JOIN tok USING (query_id)"""
SQL["token_match_all"] = f"""
WITH {DOCS}, {BENCH_Q},
qt AS (SELECT query_id, list_distinct({sql_tokens('query_text')}) AS terms FROM bq),
dt AS (SELECT id, list_distinct({sql_tokens('document')}) AS terms FROM docs)
SELECT qt.query_id, dt.id FROM qt JOIN dt ON len(qt.terms) > 0 AND list_has_all(dt.terms, qt.terms)"""


# ------------------------------------------------------------------ hybrid twins

EMBED_DIM = 64


def _embed_ctes(prefix: str, source: str, id_col: str, text_col: str, dim: int = EMBED_DIM) -> str:
    return f"""
{prefix}_tok AS (SELECT {id_col} AS id, unnest({sql_tokens(text_col)}) AS t FROM {source}),
{prefix}_cnt AS (SELECT id, ((('0x' || substr(md5(t), 1, 8))::BIGINT) % {dim}) AS b, count(*) AS c
                 FROM {prefix}_tok GROUP BY ALL),
{prefix}_vec AS (SELECT id, b, (c / sqrt(sum(c * c) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS v FROM {prefix}_cnt),
{prefix}_norm AS (SELECT id, sqrt(sum(v * v)) AS n FROM {prefix}_vec GROUP BY id)"""


def _hybrid_sql(
    k: int,
    n_text: int,
    n_vector: int,
    where: str = "TRUE",
    doc_where: str = "TRUE",
    keyword_where: str | None = None,
    queries: str = BENCH_Q,
    keyword_q: str = "bq",
    vector_q: str = "bq",
) -> str:
    """``where`` filters the vector leg (and the text leg, unless ``keyword_where`` is given), ``doc_where`` the text leg."""
    return f"""
WITH {DOCS}, {queries},
toks AS (SELECT id, ({keyword_where or where}) AND ({doc_where}) AS keep, {sql_tokens('document')} AS tokens FROM docs),
stats AS (SELECT count(*) AS n_docs, avg(len(tokens)) AS avgdl FROM toks),
qt AS (SELECT DISTINCT query_id, unnest({sql_tokens('query_text')}) AS term FROM {keyword_q}),
post AS (
  SELECT term, id, dl, keep, count(*) AS tf
  FROM (SELECT id, keep, len(tokens) AS dl, unnest(tokens) AS term FROM toks)
  WHERE term IN (SELECT term FROM qt)
  GROUP BY ALL
),
dfreq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
tscored AS (
  SELECT qt.query_id, p.id,
         floor(sum(ln(1.0e0 + (s.n_docs - d.df + 0.5e0) / (d.df + 0.5e0))
             * ((p.tf * 2.2e0) / (p.tf + 1.2e0 * (0.25e0 + 0.75e0 * p.dl / s.avgdl)))) * 1e9 + 0.5) AS score_key
  FROM post p JOIN dfreq d USING (term) JOIN qt USING (term) CROSS JOIN stats s
  WHERE p.keep
  GROUP BY ALL
),
tleg AS (
  SELECT query_id, id, floor(score_key / 1e3 + 0.5) / 1e6 AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY score_key DESC, id) AS text_rank
  FROM tscored QUALIFY text_rank <= {n_text}
),
{_embed_ctes('d', f'(SELECT * FROM docs WHERE {where})', 'id', 'document')},
{_embed_ctes('q', vector_q, 'query_id', 'query_text')},
vdots AS (SELECT q.id AS query_id, d.id, sum(q.v * d.v) AS dot FROM q_vec q JOIN d_vec d USING (b) GROUP BY ALL),
vscored AS (
  SELECT qn.id AS query_id, dn.id,
         floor((1 - coalesce(v.dot, 0) / (qn.n * dn.n)) * 1e12 + 0.5) AS dist_key
  FROM q_norm qn CROSS JOIN d_norm dn
  LEFT JOIN vdots v ON v.query_id = qn.id AND v.id = dn.id
  WHERE qn.n > 0 AND dn.n > 0
),
vleg AS (
  SELECT query_id, id, floor(dist_key / 1e6 + 0.5) / 1e6 AS distance,
         row_number() OVER (PARTITION BY query_id ORDER BY dist_key, id) AS vector_rank
  FROM vscored QUALIFY vector_rank <= {n_vector}
),
fused AS (
  SELECT coalesce(t.query_id, v.query_id) AS query_id, coalesce(t.id, v.id) AS id,
         t.score, t.text_rank, v.distance, v.vector_rank,
         coalesce(1.0e0 / (60 + t.text_rank), 0.0e0) + coalesce(1.0e0 / (60 + v.vector_rank), 0.0e0) AS rrf
  FROM tleg t FULL OUTER JOIN vleg v ON t.query_id = v.query_id AND t.id = v.id
),
top AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, id) AS rrf_rank
  FROM fused QUALIFY rrf_rank <= {k}
),
shown AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance ASC NULLS LAST, rrf_rank) AS distance_rank
  FROM top
)
SELECT s.query_id, s.id, s.rrf, s.rrf_rank::BIGINT AS rrf_rank, s.distance_rank::BIGINT AS distance_rank,
       s.text_rank::BIGINT AS text_rank, s.vector_rank::BIGINT AS vector_rank, s.score, s.distance,
       d.lang, d.source, d.n_chars
FROM shown s JOIN docs d ON d.id = s.id
"""


SQL["hybrid_rrf"] = _hybrid_sql(10, 10, 10)
SQL["hybrid_filtered"] = _hybrid_sql(
    5, 5, 5, "lang = 'en' AND n_chars >= 500 AND n_chars <= 5000", "contains(document, 'the')"
)
SQL["hybrid_stored"] = SQL["hybrid_rrf"]
SQL["hybrid_no_match"] = _hybrid_sql(
    10, 10, 10, queries="bq AS (SELECT item_id AS query_id, CASE item_id % 3 WHEN 0 THEN 'zqxj' || item_id WHEN 1 THEN '' ELSE text END AS query_text FROM benchmark)"
)


def _scenario_sql(n: int, **kw: str) -> str:
    both = f"""bq AS (SELECT item_id AS query_id, text AS query_text FROM benchmark WHERE item_id % 5 = {n}),
kwq AS (SELECT query_id, array_to_string(string_split(query_text, ' ')[1:5], ' ') AS query_text FROM bq)"""
    return f"SELECT * FROM ({_hybrid_sql(5, 10, 10, queries=both, keyword_q='kwq', **kw)})"


SQL["hybrid_scenarios"] = " UNION ALL ".join(
    [
        _scenario_sql(0),
        _scenario_sql(1, where="lang = 'en'"),
        _scenario_sql(2, where="n_chars >= 2000", keyword_where="lang = 'de'"),
        _scenario_sql(3, where="lang = 'fr' OR lang = 'es'", doc_where="contains(document, 'en')"),
        _scenario_sql(4, where="n_chars >= 500 AND n_chars <= 5000 AND lang <> 'de'"),
    ]
)
SQL["get_filtered"] = f"""
WITH {DOCS}, {BENCH_Q},
qt AS (SELECT query_id, list_distinct({sql_tokens("array_to_string(string_split(query_text, ' ')[1:3], ' ')")}) AS terms FROM bq),
dt AS (SELECT id, lang, source, list_distinct({sql_tokens('document')}) AS terms FROM docs WHERE n_chars >= 1000)
SELECT query_id, id, rank::BIGINT AS rank, lang, source FROM (
  SELECT qt.query_id, dt.id, dt.lang, dt.source, row_number() OVER (PARTITION BY qt.query_id ORDER BY dt.id) AS rank
  FROM qt JOIN dt ON len(qt.terms) > 0 AND list_has_all(dt.terms, qt.terms)) WHERE rank <= 7"""
SQL["display_fields"] = """
SELECT doc_id AS id, left(text, 150) || '...' AS snippet,
       CASE WHEN doc_id % 3 = 0 THEN 'n/a ' || lang ELSE format('{:,}', n_chars) END AS count_text FROM documents"""
HAN = "全文检索 PySpark3.5 混合搜索测试 mail@example.com 192.168.0.1 www.example.org 中"
SQL["tokenize_han"] = f"""
WITH h AS (SELECT doc_id AS id, left(text, 40) || ' {HAN} ' || lang AS document FROM documents)
SELECT id, {sql_tokens('document')} AS basic, {sql_tokens('document', SMART_RE)} AS smart, {sql_max_word('document')} AS max_word FROM h"""
SQL["hybrid_display"] = f"""
WITH h AS ({_hybrid_sql(5, 10, 10)})
SELECT query_id, id, distance_rank,
       floor((1000000 - u + 50) / 100) / 10000.0e0 AS similarity,
       CASE WHEN distance IS NULL THEN 'N/A' ELSE
         (CASE WHEN p < 0 THEN '-' ELSE '' END) || (abs(p) // 100)::VARCHAR || '.' ||
         lpad((abs(p) % 100)::VARCHAR, 2, '0') || '%' END AS similarity_pct,
       coalesce(source, 'Unknown') AS author,
       format('{{:,}}', n_chars) AS reviews_text
FROM (SELECT *, floor((1000000 - u + 50) / 100)::BIGINT AS p
      FROM (SELECT *, floor(distance * 1000000.0e0 + 0.5)::BIGINT AS u FROM h))"""


# ------------------------------------------------------------------ comparison twins

GET_B10 = _get_sql("bq", 10)
HYB_10 = _hybrid_sql(10, 10, 10)

COMPARE_BASE = f"""
a AS (SELECT DISTINCT query_id, id FROM ({GET_B10})),
b AS (SELECT DISTINCT query_id, id FROM ({HYB_10})),
j AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.id, b.id) AS id,
             a.id IS NOT NULL AS in_a, b.id IS NOT NULL AS in_b
      FROM a FULL OUTER JOIN b ON a.query_id = b.query_id AND a.id = b.id),
g AS (SELECT query_id,
             count(*) FILTER (WHERE in_a) AS n_a, count(*) FILTER (WHERE in_b) AS n_b,
             count(*) FILTER (WHERE in_a AND in_b) AS n_common,
             count(*) FILTER (WHERE in_a AND NOT in_b) AS n_a_only,
             count(*) FILTER (WHERE in_b AND NOT in_a) AS n_b_only,
             list_sort(coalesce(list(id) FILTER (WHERE in_a AND in_b), [])) AS common_ids,
             list_sort(coalesce(list(id) FILTER (WHERE in_a AND NOT in_b), [])) AS a_only_ids,
             list_sort(coalesce(list(id) FILTER (WHERE in_b AND NOT in_a), [])) AS b_only_ids
      FROM j GROUP BY query_id),
rep AS (
  SELECT q.query_id,
         coalesce(n_a, 0)::BIGINT AS n_a, coalesce(n_b, 0)::BIGINT AS n_b, coalesce(n_common, 0)::BIGINT AS n_common,
         coalesce(n_a_only, 0)::BIGINT AS n_a_only, coalesce(n_b_only, 0)::BIGINT AS n_b_only,
         coalesce(common_ids, []::BIGINT[]) AS common_ids, coalesce(a_only_ids, []::BIGINT[]) AS a_only_ids,
         coalesce(b_only_ids, []::BIGINT[]) AS b_only_ids
  FROM (SELECT item_id AS query_id FROM benchmark) q LEFT JOIN g USING (query_id)
)"""

PCT = "CASE WHEN {1} > 0 THEN {0} / {1} * 100.0e0 ELSE 0.0e0 END"

SQL["compare_overlap"] = f"""
WITH {COMPARE_BASE}
SELECT query_id, n_a, n_b, n_common, n_a_only, n_b_only,
       {PCT.format('n_common', 'n_a')} AS overlap_pct_a,
       {PCT.format('n_common', 'n_b')} AS overlap_pct_b,
       common_ids, a_only_ids, b_only_ids
FROM rep"""
SQL["compare_rollup"] = f"""
WITH {COMPARE_BASE},
t AS (SELECT count(*) AS n_queries, sum(n_a)::BIGINT AS total_a, sum(n_b)::BIGINT AS total_b,
             sum(n_common)::BIGINT AS total_common FROM rep)
SELECT *, {PCT.format('total_common', 'total_a')} AS overlap_pct FROM t"""
SQL["compare_sets"] = f"""
WITH a AS (SELECT DISTINCT query_id, id FROM ({GET_B10})),
b AS (SELECT DISTINCT query_id, id FROM ({HYB_10}))
SELECT query_id, id, 'both' AS membership FROM a WHERE (query_id, id) IN (SELECT (query_id, id) FROM b)
UNION ALL
SELECT query_id, id, 'full_text_only' FROM a WHERE (query_id, id) NOT IN (SELECT (query_id, id) FROM b)
UNION ALL
SELECT query_id, id, 'hybrid_only' FROM b WHERE (query_id, id) NOT IN (SELECT (query_id, id) FROM a)"""
SQL["report_top5"] = f"""
WITH {DOCS},
a AS (SELECT query_id, id, rank, 'full_text' AS method FROM ({GET_B10}) WHERE rank <= 5),
b AS (SELECT query_id, id, rrf_rank AS rank, 'hybrid' AS method FROM ({HYB_10}) WHERE rrf_rank <= 5),
t AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT t.query_id, t.method, t.rank, t.id,
       CASE WHEN length(d.document) > 80 THEN left(d.document, 80) || '...' ELSE d.document END AS snippet
FROM t JOIN docs d ON d.id = t.id"""

TIMINGS = """
timings AS (SELECT user_id AS query, event_type AS method, value AS seconds
            FROM events)"""
STATS = """
stats AS (SELECT query, method, round(avg(seconds), 9) AS avg, min(seconds) AS min, max(seconds) AS max,
                 round(sum(seconds), 9) AS total, count(seconds) AS n FROM timings GROUP BY query, method)"""
SQL["timing_stats"] = f"WITH {TIMINGS}, {STATS} SELECT * FROM stats"
SQL["timing_side_by_side"] = f"""
WITH {TIMINGS},
p AS (SELECT query, round(avg(seconds) FILTER (WHERE method = 'click'), 9) AS base_avg,
             round(avg(seconds) FILTER (WHERE method = 'view'), 9) AS other_avg FROM timings
      WHERE method IN ('click', 'view') GROUP BY query),
d AS (SELECT *, round(coalesce(CASE WHEN base_avg > 0 THEN (other_avg - base_avg) / base_avg * 100.0e0 ELSE 0.0e0 END, 0.0e0), 9) AS diff_pct FROM p)
SELECT query, base_avg, other_avg, diff_pct, CASE WHEN diff_pct > 0 THEN 'click' ELSE 'view' END AS faster,
       abs(diff_pct) AS diff_abs_pct
FROM d"""
SQL["timing_summary"] = f"""
WITH {TIMINGS}, {STATS}
SELECT method, round(avg(avg), 9) AS macro_avg, round(sum(total), 9) AS grand_total, count(*) AS n_queries,
       round(round(sum(total), 9) / count(*), 9) AS mean_per_query
FROM stats GROUP BY method"""
SQL["import_batches"] = f"""
WITH {BOOKS}
SELECT floor(id::BIGINT / 100)::BIGINT AS batch_id, count(*) AS n_rows,
       count(*) FILTER (WHERE metadata IS NOT NULL AND document IS NOT NULL) AS n_stored,
       count(*) FILTER (WHERE invalid_reason IS NOT NULL) AS n_invalid
FROM records GROUP BY ALL"""
SQL["import_summary"] = f"""
WITH {BOOKS}
SELECT count(*) AS n_records, ceil(count(*) / 100)::BIGINT AS n_batches FROM records"""


# ------------------------------------------------------------------ collection and filter twins

SQL["collection_roundtrip"] = "SELECT 'documents' AS name, count(*) AS n_records, NULL::VARCHAR AS error FROM documents"
SQL["collection_typed_filter"] = """
SELECT doc_id AS id, lang AS gen_lang, source AS gen_source, n_chars AS gen_n_chars
FROM documents WHERE lang = 'de' AND n_chars >= 1000"""
SQL["collection_clustered_filter"] = SQL["collection_typed_filter"]
SQL["bm25_included"] = f"SELECT b.*, d.lang, d.source FROM ({SQL['bm25_topk']}) b JOIN documents d ON d.doc_id = b.id"
SQL["knn_included"] = f"SELECT b.*, d.lang, d.n_chars FROM ({_knn_sql('cosine', 5, vectors=VCOLL)}) b JOIN documents d ON d.doc_id = b.id"
SQL["bm25_indexed"] = _bm25_sql("bq", 10)
SQL["stream_search"] = _bm25_sql("bq", 10)
SQL["collection_postings"] = SQL["postings"]
SQL["collection_terms"] = SQL["term_stats"]
SQL["collection_documents"] = f"""
WITH {DOCS}
SELECT id, document, lang AS gen_lang, source AS gen_source, len({sql_tokens('document')})::BIGINT AS dl FROM docs"""
SQL["typed_metadata"] = f"""
WITH {BOOKS}
SELECT id,
       json_extract_string(metadata, '$.genre') AS gen_genre,
       TRY_CAST(json_extract_string(metadata, '$.year') AS BIGINT) AS gen_year,
       TRY_CAST(json_extract_string(metadata, '$.user_rating') AS DOUBLE) AS gen_user_rating,
       json_extract_string(metadata, '$.author') AS gen_author,
       TRY_CAST(json_extract_string(metadata, '$.reviews') AS BIGINT) AS gen_reviews,
       TRY_CAST(json_extract_string(metadata, '$.price') AS DOUBLE) AS gen_price,
       json_extract_string(metadata, '$.edition') AS gen_edition
FROM records"""
SQL["metadata_filters"] = f"""
WITH {BOOKS}
SELECT id, 'rating_gte' AS filter FROM records WHERE user_rating >= 4.5
UNION ALL SELECT id, 'genre_eq' FROM records WHERE genre = 'ECONOMY'
UNION ALL SELECT id, 'genre_year_rating' FROM records WHERE year >= 2015 AND user_rating >= 4.0 AND genre = 'PROMO'
UNION ALL SELECT id, 'reviews_gte' FROM records WHERE reviews >= 1000
UNION ALL SELECT id, 'price_range_rating' FROM records WHERE price >= 950 AND price <= 960 AND user_rating >= 4.5"""
SQL["ivf_knn_all_cells"] = SQL["knn_cosine"]
SQL["stream_ingest_books"] = SQL["prepare_books"]
SQL["csv_malformed"] = """
WITH b AS (SELECT count(*) AS n, count(*) FILTER (WHERE p_partkey % 50 = 0) AS bad FROM part)
SELECT n + bad AS n_rows, bad AS n_malformed, bad AS n_kept_text, 0::BIGINT AS first_position, n + bad - 1 AS last_position, n + bad AS n_positions FROM b"""
SQL["vector_checks"] = """
SELECT count(*) + count(*) FILTER (WHERE vec_id % 10 = 0) + count(*) FILTER (WHERE vec_id % 20 = 0) + count(*) FILTER (WHERE vec_id % 25 = 0) AS n_vectors,
       count(*) FILTER (WHERE vec_id % 20 = 0) AS n_null, count(*) FILTER (WHERE vec_id % 10 = 0) AS n_wrong_size, count(*) FILTER (WHERE vec_id % 25 = 0) AS n_zero FROM embeddings"""
SQL["ivf_checks"] = """
SELECT count(*) FILTER (WHERE vec_id % 100 = 0) AS n_queries, TRUE AS recall_reached, 0::BIGINT AS n_wrong, 1.0::DOUBLE AS recall_all_cells, count(*) AS n_indexed
FROM embeddings"""
SQL["query_vector_checks"] = """
WITH q AS (SELECT count(*) AS n, count(*) FILTER (WHERE vec_id % 200 = 0) AS n_short FROM embeddings WHERE vec_id % 100 = 0)
SELECT 2 * n + n_short AS n_vectors, n AS n_null, n_short AS n_wrong_size, 0::BIGINT AS n_zero, n AS n_answered FROM q"""
SQL["ingest_duplicates"] = """
SELECT doc_id AS id, 'a ' || lang AS document, 'stored' AS outcome FROM documents
UNION ALL SELECT doc_id, 'copy', 'duplicate_in_batch' FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT -1 - doc_id, lang, 'not_storable' FROM documents WHERE doc_id % 5 = 0
UNION ALL SELECT NULL, lang, 'missing_id' FROM documents WHERE doc_id % 7 = 0
UNION ALL SELECT doc_id, 'again', 'duplicate_id' FROM documents WHERE doc_id % 2 = 0"""
SQL["stream_duplicates"] = """
SELECT 2 * count(*) AS n_input, count(DISTINCT event_id) AS n_kept, 2 * count(*) - count(DISTINCT event_id) AS n_copies FROM events"""
SQL["stream_dedupe_events"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM events) WHERE rn = 1"""


def _vleg_ctes(n: int, queries: str = "bq", qid: str = "query_id", qtext: str = "query_text") -> str:
    return f"""
{_embed_ctes('d', 'docs', 'id', 'document')},
{_embed_ctes('q', queries, qid, qtext)},
vdots AS (SELECT q.id AS query_id, d.id, sum(q.v * d.v) AS dot FROM q_vec q JOIN d_vec d USING (b) GROUP BY ALL),
vscored AS (
  SELECT qn.id AS query_id, dn.id,
         floor((1 - coalesce(v.dot, 0) / (qn.n * dn.n)) * 1e12 + 0.5) AS dist_key
  FROM q_norm qn CROSS JOIN d_norm dn
  LEFT JOIN vdots v ON v.query_id = qn.id AND v.id = dn.id
  WHERE qn.n > 0 AND dn.n > 0
),
vleg AS (
  SELECT query_id, id, floor(dist_key / 1e6 + 0.5) / 1e6 AS distance,
         row_number() OVER (PARTITION BY query_id ORDER BY dist_key, id) AS rank
  FROM vscored QUALIFY rank <= {n}
)"""


SCALAR_ES = """
sleg AS (
  SELECT q.query_id, s.id, s.rank
  FROM bq q CROSS JOIN (SELECT id, row_number() OVER (ORDER BY id) AS rank FROM docs WHERE lang = 'es' QUALIFY rank <= 10) s
)"""

SQL["semantic_single"] = f"""
WITH {DOCS}, sq AS (SELECT 0 AS query_id, 'Self‑Improvement and Personal Development' AS query_text),
{_vleg_ctes(3, 'sq')}
SELECT id, distance, rank, CASE WHEN distance IS NULL THEN 'N/A' ELSE
         (CASE WHEN p < 0 THEN '-' ELSE '' END) || (abs(p) // 100)::VARCHAR || '.' ||
         lpad((abs(p) % 100)::VARCHAR, 2, '0') || '%' END AS similarity_pct
FROM (SELECT id, distance, rank::BIGINT AS rank,
             floor((1000000 - floor(distance * 1000000.0e0 + 0.5)::BIGINT + 50) / 100)::BIGINT AS p FROM vleg)"""

SQL["hybrid_scalar_leg"] = f"""
WITH {DOCS}, {BENCH_Q}, {_vleg_ctes(10)}, {SCALAR_ES},
fused AS (
  SELECT coalesce(s.query_id, v.query_id) AS query_id, coalesce(s.id, v.id) AS id,
         s.rank AS scalar_rank, v.rank AS vector_rank,
         coalesce(1.0e0 / (60 + s.rank), 0.0e0) + coalesce(1.0e0 / (60 + v.rank), 0.0e0) AS rrf
  FROM sleg s FULL OUTER JOIN vleg v ON s.query_id = v.query_id AND s.id = v.id
)
SELECT query_id, id, rrf, rrf_rank::BIGINT AS rrf_rank, scalar_rank::BIGINT AS scalar_rank,
       vector_rank::BIGINT AS vector_rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, id) AS rrf_rank FROM fused)
WHERE rrf_rank <= 10"""

SQL["rrf_three_legs"] = f"""
WITH tl AS ({_bm25_sql('bq', 10)}),
{DOCS}, {BENCH_Q}, {_vleg_ctes(10)}, {SCALAR_ES},
u AS (SELECT query_id, id, rank FROM tl UNION ALL SELECT query_id, id, rank FROM vleg
      UNION ALL SELECT query_id, id, rank FROM sleg),
s AS (SELECT query_id, id, floor(sum(1.0e0 / (60 + rank)) * 1e12 + 0.5)::BIGINT AS rrf_key FROM u GROUP BY ALL)
SELECT query_id, id, rrf_key / 1e12 AS rrf, rrf_rank::BIGINT AS rrf_rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_key DESC, id) AS rrf_rank FROM s)
WHERE rrf_rank <= 10"""


def _list_json_safe(x: str) -> str:
    return f"list_transform({x}, lambda e: {sql_json_safe('e')})"


SQL["json_safe_nested"] = f"""
SELECT doc_id AS id,
       {sql_json_safe('text')} AS text,
       {_list_json_safe('[lang, source, left(text, 40)]')} AS tags,
       CASE WHEN n_chars % 3 = 0 OR n_chars % 3 = 1 THEN 0.0e0 ELSE n_chars / 7.0e0 END AS ratio,
       n_chars AS n
FROM documents"""
SQL["csv_roundtrip"] = SQL["prepare_books"]
SQL["collection_vector_knn"] = _knn_sql("cosine", 5, "TRUE", VCOLL)
