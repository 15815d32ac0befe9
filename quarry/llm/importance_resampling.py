"""Operator 11 — target-distribution importance resampling (hashed n-gram features).

Raw texts are weighted by how much likelier their features are in a *target*
set than in the raw set, and a share of them is drawn without replacement by
adding Gumbel noise to the weights:

1. words: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` (Arrow kernels);
2. features: runs of 1..n consecutive words.  Words are dictionary-encoded, a
   longer run is a pair (code of the run without its last word, last word) of
   *shifted dictionary indices*; only distinct pairs get a CRC, continued from
   the CRC of the shorter run;
3. both sets are counted by bucket (CRC modulo ``buckets``): every task sends
   at most ``buckets`` counters, whatever it read;
4. the gains (one per bucket, the only thing broadcast) are taken per feature
   and summed per text by segments;
5. the draw needs no global sort of all texts: scores are whole numbers, so a
   histogram (as many rows as distinct scores: the range of the noise plus that
   of the weights, whatever the size of the input) gives the lowest score drawn,
   and only rows from there up are range-partitioned and numbered by partition
   offsets.

Defined cases: a null or wordless text has no feature, weight 0; a row without id
is weighted but has no score and is neither counted nor drawn; repeated rows are
rows of their own (equal scores and ids in any order among themselves); an empty
target or raw table counts as zeros; columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.shared import CRC_TABLE_SQL, crc32_sql, table, written

#: Fixed value: everything that is no word character once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text whose words are encoded together (a longer single text is taken whole).
SLICE_BYTES = 8 << 20
BUCKETS = 10_000
NGRAM = 1
SHARE = (10, 100)
MIN_WORDS = 20
SEED = "2024"
#: Row numbers of ``monotonically_increasing_id``: the partition is above these bits.
ROW_BITS = 33


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of rows of about ``SLICE_BYTES``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def _crcs(values: pa.Array, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of every text, or of ``<earlier text> <text>`` where ``before`` has the CRC of the earlier one."""
    texts = values.cast(pa.binary()).to_pylist()
    if before is None:
        return np.fromiter(map(zlib.crc32, texts), np.int64, len(texts))
    return np.fromiter((zlib.crc32(b" " + t, b) for t, b in zip(texts, before.tolist())), np.int64, len(texts))


def features(texts: pa.Array, ngram: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words by row, row of every feature, bucket of every feature) by slices of the texts."""
    for first, part in _slices(texts):
        lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(part, "")), pattern=SEPARATORS)
        flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(flat), 0)  # a text that begins or ends with separators has empty ends
        words = flat.filter(real).dictionary_encode()
        row = row.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        crc = _crcs(words.dictionary)
        rows, found = [row], [(crc % buckets)[code]]
        run, run_crc = code, crc
        for n in range(2, ngram + 1):
            end = np.flatnonzero(row[n - 1 :] == row[: len(row) - n + 1]) if len(row) >= n else np.zeros(0, np.int64)
            pair, run_of = np.unique(run[end] * max(1, len(crc)) + code[end + n - 1], return_inverse=True)
            head, tail = pair // max(1, len(crc)), pair % max(1, len(crc))
            run_crc = _crcs(words.dictionary.take(pa.array(tail)), run_crc[head])
            rows.append(row[end])
            found.append((run_crc % buckets)[run_of])
            run = np.zeros(max(0, len(row) - n + 1), np.int64)
            run[end] = run_of
        yield first, np.bincount(row, minlength=len(part)), np.concatenate(rows), np.concatenate(found)


def bucket_counts(texts: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: features of a one-column table of texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in features(batch.column(0), ngram, buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln of the smoothed likelihood ratio) by bucket; ``buckets`` rows of either table come to the driver."""
    counts = np.zeros((2, buckets), np.int64)
    for which, df in enumerate((raw, target)):
        for r in df.collect():
            counts[which, r["bucket"]] = r["n"]
    s, t = counts.astype(np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, ngram: int = NGRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)
    id_type = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_type)
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shipped.value
        for batch in batches:
            for first, n_words, row, found in features(batch.column(1), ngram, len(gain)):
                n = np.bincount(row, minlength=len(n_words))
                sums = np.zeros(len(n_words), np.int64)
                np.add.at(sums, row, gain[found])
                weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
                ids = batch.column(0).slice(first, len(n_words)).cast(id_arrow)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(x.astype(np.int64)) for x in (n_words, n, weight)]], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """floor(1000 x Gumbel noise) from the first 32 bits of sha256(``seed:id``); null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rank`` from 1 in ``order`` over all rows: range partitions, each sorted, then offset by the sizes of those before it."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_at", F.monotonically_increasing_id())  # so that a crowd of equal keys can be split
    order = [*order, F.col("_at").asc()]
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = written(laid.withColumn("_seq", F.monotonically_increasing_id()), "op11-drawn")
    part = F.shiftright("_seq", ROW_BITS)
    sizes = sorted((r["part"], r["n"]) for r in laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part long, _before long")
    within = F.col("_seq").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    out = laid.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # one row per partition
    return out.withColumn("rank", F.col("_before") + within + 1).drop("_part", "_before", "_seq", "_at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    ngram: int = NGRAM,
    buckets: int = BUCKETS,
    share: tuple[int, int] = SHARE,
    min_words: int = MIN_WORDS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Every row's ``(doc_id, n_features, weight, score, rank)``; undrawn rows have no rank.

    Of the N rows with an id and at least ``min_words`` words, floor(share x N) are
    drawn: the highest scores, ties to the smaller id.
    """
    gain = gains(bucket_counts(docs.select(text_col), ngram, buckets), bucket_counts(target.select(target_col), ngram, buckets), buckets)
    scored = weighted(docs, gain, ngram, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(scored, "op11-scored")
    able = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    histogram = sorted(((r["score"], r["n"]) for r in scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    n_drawn = share[0] * sum(n for _, n in histogram) // share[1]
    cut, reached = None, 0
    for score, n in histogram:
        if reached >= n_drawn:
            break
        cut, reached = score, reached + n
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*columns, none)
    high = able & (F.col("score") >= cut)
    front = numbered(scored.where(high).select(*columns), [F.col("score").desc(), F.col("doc_id").asc()])
    front = front.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    return front.select(*columns, "rank").unionByName(scored.where(~F.coalesce(high, F.lit(False))).select(*columns, none))


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows themselves, whole, with their ``rank`` (rows that share an id come together or not at all)."""
    ranks = resample(docs, target, id_col=id_col, **options).where("rank is not null").groupBy("doc_id").agg(F.min("rank").alias("_rank"))
    rows = docs.select(F.col(id_col).alias("_id"), F.struct("*").alias("_row"))
    return rows.join(ranks, F.col("_id") == F.col("doc_id")).select("_row.*", F.col("_rank").alias("sample_rank"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
split AS (SELECT side, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM texts),
used AS (SELECT side, doc_id, unnest(words) AS word FROM split),
vocabulary AS (SELECT DISTINCT word FROM used),
coded AS (SELECT word, {crc32_sql("word")} % {BUCKETS} AS bucket
  FROM vocabulary, crc_table),
counted AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM used JOIN coded USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS g FROM counted),
sums AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM used JOIN coded USING (word) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
weighted AS (SELECT doc_id, len(words) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(g::DOUBLE / n), 0)::BIGINT AS weight,
    ('0x' || sha256('{SEED}:' || doc_id)[:8])::BIGINT AS h
  FROM split LEFT JOIN sums USING (doc_id) WHERE side = 'd'),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM weighted),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {SHARE[0]} * n // {SHARE[1]} THEN place END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
