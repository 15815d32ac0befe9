"""Operator 2 — quality rules by cross-document line frequency.

Lines are normalised (words joined by one space, A-Z lower-cased) and hashed;
per host (``source``) Spark counts the distinct documents of every line hash.
A line above both limits (``MAX_DOCS`` documents and ``MAX_SHARE`` of the
host's documents) is removed from all documents of the host; a document that
loses more than ``MAX_LOST`` of its words is depleted and rejected, as is one
that fails the base rules (fewer than 50 words, or over half of its words in
repeated 3-word windows).

One pass over the texts writes the per-row figures and the distinct line
hashes of each row (numpy kernels); counting and the join with the frequent
lines are DataFrame operations on hashes.  A second pass brings every text
together with the hashes of its frequent lines and returns it without them
(``cleaned``); the words it lost are counted there.  A line in a third of all rows is one partial count per task, and the
join that brings frequent lines back has plain shuffled sides that Spark
splits when skewed.

Defined results: null text counts as a text without words (base_failed); rows
without a source form one host; rows that repeat a doc_id are one document in
line counts and get a row each in the result; a null doc_id is one document.
A removed line goes with its line break, all other bytes stay; a null text
stays null, and a text that loses all of its lines is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.shared import line_spans, repeated, sequence_hashes, span_hashes, table, text_chunks, word_spans, written

MIN_WORDS = 50
MAX_DOCS = 10  # a line in more documents of a host ...
MAX_SHARE = 0.005  # ... and in more than this share of them is removed
MAX_LOST = 0.5

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _figures(data: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; and (row, hash, words) of distinct lines with words."""
    rows = len(offs) - 1
    starts, ends, bounds = word_spans(data, offs)
    n_words = np.diff(bounds)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[offs[1:]] - total[offs[:-1]]

    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    word_chars = per_row(~space & ((data & 0xC0) != 0x80))
    n_symbols = per_row(_SYMBOL[data])

    line_start, line_end, line_row = line_spans(data, offs)
    word_a, word_b = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    full = word_b > word_a
    line_row, word_a, word_b = line_row[full], word_a[full], word_b[full]
    raw = span_hashes(data, line_start[full], line_end[full])
    n_dup = np.bincount(line_row, weights=repeated(line_row, raw)[1], minlength=rows).astype(np.int64)

    word_row = np.repeat(np.arange(rows), n_words)
    exact = span_hashes(data, starts, ends)
    begin = np.arange(len(exact))[np.repeat(bounds[1:], n_words) - np.arange(len(exact)) >= 3]
    twice = begin[repeated(word_row[begin], sequence_hashes(exact, begin, begin + 3))[0] >= 2]
    marked = np.zeros(len(exact), dtype=bool)
    for j in range(3):
        marked[twice + j] = True
    n_repeat = np.bincount(word_row, weights=marked, minlength=rows).astype(np.int64)

    norm = sequence_hashes(span_hashes(data, starts, ends, lower=True), word_a, word_b)
    seen, words = repeated(line_row, norm)[1] == 0, word_b - word_a
    copies = repeated(line_row, norm)[0]
    return [n_words, word_chars, n_symbols, n_dup, n_repeat], line_row[seen], norm[seen].view(np.int64), (words * copies)[seen]


def _text_key() -> Column:
    """Digest of (source, text); what a row loses follows from them alone."""
    source = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    return F.unhex(F.md5(F.concat(source, F.lit("\0"), F.coalesce("text", F.lit(""))).cast("binary")))


def line_table(df: DataFrame) -> DataFrame:
    """Scratch table of (doc_id, source, key, figures, lines array<struct<hash, words>>) per input row; key: ``_text_key``."""
    fields = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<hash:bigint,words:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offs in text_chunks(batch.column(0)):
                figures, row, hashes, words = _figures(data, offs)
                n = len(offs) - 1
                bounds = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                lines = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(hashes), pa.array(words.astype(np.int64))], names=["hash", "words"]))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, n).columns[1:], *[pa.array(f) for f in figures], lines], names=[*batch.schema.names[1:], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])

    slim = df.select("text", "doc_id", "source", _text_key().alias("key"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    out = slim.mapInArrow(run, f"doc_id {kinds['doc_id']}, source {kinds['source']}, key binary, {fields}")
    return written(out, "op2-lines")


def _without(texts: pa.Array, gone: pa.Array) -> tuple[list[str | None], np.ndarray]:
    """Per row: the text without the lines whose hashes ``gone`` lists, and the words it lost."""
    out, lost, rows = texts.to_pylist(), np.zeros(len(texts), dtype=np.int64), gone.to_pylist()
    for first, data, offs in text_chunks(texts):
        starts, ends, _ = word_spans(data, offs)
        line_start, line_end, line_row = line_spans(data, offs)
        word_a, word_b = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
        norm = sequence_hashes(span_hashes(data, starts, ends, lower=True), word_a, word_b).view(np.int64)
        bounds = np.searchsorted(line_row, np.arange(len(offs)))
        for row in range(len(offs) - 1):
            if rows[first + row]:
                at = slice(bounds[row], bounds[row + 1])
                goes = np.isin(norm[at], np.array(rows[first + row], dtype=np.int64)) & (word_b[at] > word_a[at])
                lost[first + row] = (word_b[at] - word_a[at])[goes].sum()
                out[first + row] = b"\n".join(data[a:b].tobytes() for a, b in zip(line_start[at][~goes], line_end[at][~goes])).decode()
    return out, lost


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def cleaned(df: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, max_lost: float = MAX_LOST) -> DataFrame:
    """One row per input row: doc_id, figures, removed_words, base_failed, depleted, kept, and the text without its frequent lines."""
    rows = line_table(df)
    lines = rows.select("key", "doc_id", "source", F.explode("lines.hash").alias("hash"))
    hosts = rows.select("source", "doc_id").distinct().groupBy("source").agg(F.count("*").alias("host_docs"))
    counts = lines.select("source", "hash", "doc_id").distinct().groupBy("source", "hash").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs)
    frequent = counts.alias("c").join(hosts.alias("h"), F.col("c.source").eqNullSafe(F.col("h.source")))
    frequent = written(frequent.where(F.col("docs") > max_share * F.col("host_docs")).select("c.source", "hash"), "op2-frequent")
    hit = lines.alias("l").join(frequent.alias("f"), (F.col("l.hash") == F.col("f.hash")) & F.col("l.source").eqNullSafe(F.col("f.source")), "left_semi")
    gone = written(hit.groupBy("key").agg(F.collect_set("hash").alias("gone")), "op2-removed")
    known = rows.groupBy("key").agg(*[F.max(c).alias(c) for c in FIGURES]).join(gone, "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = _without(batch.column(0), batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(lost), pa.array(texts, pa.string())], names=[*batch.schema.names[2:], "removed_words", "text"])

    texts = df.select("text", "doc_id", _text_key().alias("key"))
    joined = texts.join(written(known, "op2-known").hint("shuffle_hash"), "key").select("text", "gone", "doc_id", *FIGURES)
    kind = joined.schema["doc_id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in FIGURES)}, removed_words long, text string")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("removed_words") > max_lost * F.col("n_words")
    return out.select("doc_id", *FIGURES, "removed_words", base.alias("base_failed"), depleted.alias("depleted"), (~base & ~depleted).alias("kept"), "text")


def apply_rules(df: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, max_lost: float = MAX_LOST) -> DataFrame:
    """``cleaned`` without the texts."""
    return cleaned(df, max_docs, max_share, max_lost).drop("text")


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
wp AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
tri AS (SELECT r, p, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM wp WINDOW o AS (PARTITION BY r ORDER BY p)),
rep AS (SELECT r, p FROM tri WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, a, b, c) >= 2),
marked AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY r),
l AS (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT r, doc_id, source, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM l),
ln AS (SELECT r, doc_id, source, line, len(ws) AS words, array_to_string(ws, ' ') AS norm FROM lw WHERE len(ws) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY r),
host AS (SELECT source, count(*) AS host_docs FROM (SELECT DISTINCT source, doc_id FROM d) GROUP BY source),
freq AS (SELECT x.source, norm FROM (SELECT source, norm, count(*) AS docs FROM (SELECT DISTINCT source, norm, doc_id FROM ln) GROUP BY source, norm) x
         JOIN host ON x.source IS NOT DISTINCT FROM host.source WHERE docs > {MAX_DOCS} AND docs > {MAX_SHARE} * host_docs),
lost AS (SELECT r, sum(words) AS n FROM ln JOIN freq ON ln.norm = freq.norm AND ln.source IS NOT DISTINCT FROM freq.source GROUP BY r),
f AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
      coalesce(marked.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS removed_words
      FROM d JOIN w USING (r) LEFT JOIN marked USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)),
g AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, removed_words > {MAX_LOST} * n_words AS depleted FROM f)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM g
"""
