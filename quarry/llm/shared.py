"""Helpers shared by the operators: tables, scratch storage, word spans and hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir

#: ASCII white space of the contracts, ``[\x20\x09-\x0D]``.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled at once by the numpy kernels (a longer single text is one chunk).
CHUNK_BYTES = 1 << 19

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (a folder per value of ``by``) and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write are of no further use, so Spark is asked to remove them when it ends.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove the folders that ``written`` made for ``tables``; nothing may read them any more."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` equals ``remainder`` (a null id is in no fold)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


#: CTEs with the 256 entries of the CRC-32 table, which its polynomial 0xEDB88320 gives; for the SQL twins.
CRC_TABLE_SQL = """crc_steps AS (SELECT n, n::BIGINT AS x, 0 AS i FROM range(256) r(n)
  UNION ALL SELECT n, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i + 1 FROM crc_steps WHERE i < 8),
crc_table AS (SELECT list(x ORDER BY n) AS crc_entries FROM crc_steps WHERE i = 8)"""


def crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a SQL text expression, as an expression over ``crc_table``."""
    code = f"hex(encode({text}))"
    byte_list = f"list_transform(range(1, length({code}) // 2 + 1), lambda i: ('0x' || substr({code}, (2 * i - 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte_list}), lambda c, b: xor(c >> 8, crc_entries[(xor(c, b) & 255) + 1])), 4294967295)"


def revived(kind: type, state: dict) -> object:
    """An object of ``kind`` from its broadcast ``vars()``: broadcasts hold plain data, classes travel in closures."""
    out = object.__new__(kind)
    out.__dict__.update(state)
    return out


# --- texts as flat byte arrays ------------------------------------------------------------


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive rows with about ``limit`` bytes together; null is empty."""
    col = column.cast(pa.large_string()).fill_null("") if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        end = min(end, n)
        yield at, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row boundaries in words) of all words of the chunk; words never cross rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("p")
    if have is None or len(have) < n + 1:
        size = (n // (1 << 16) + 1) << 16  # a worker keeps both tables: no longer than the longest chunk asks
        for name, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            table_of = np.full(size, base, dtype=np.uint64)
            table_of[0] = 1
            _powers[name] = np.multiply.accumulate(table_of, out=table_of)
    return _powers["p"], _powers["q"]


def byte_codes(lower: bool) -> np.ndarray:
    """A random 64-bit code per byte value; with ``lower``, A-Z share the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every byte span: polynomial over byte codes by prefix sums, then mixed with the length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, q = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(byte_codes(lower)[data] * p[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * q[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``size``-word shingle; a row of 1 to size-1 words is one shingle of all its words."""
    counts = np.diff(bounds)
    rows = np.repeat(np.arange(len(counts)), counts)
    mult = np.uint64(0xFF51AFD7ED558CCD)
    at = np.arange(len(words))
    left = bounds[1:][rows] - at if len(words) else at
    full = at[left >= size]
    h = words[full].copy()
    for j in range(1, size):
        h = h * mult + words[full + j]
    short = np.flatnonzero((counts > 0) & (counts < size))
    first = bounds[:-1][short]
    g = words[first].copy()
    for j in range(1, size - 1):
        more = counts[short] > j
        g = np.where(more, g * mult + words[np.where(more, first + j, first)], g)
    g = g ^ np.uint64(0xA5A5A5A5A5A5A5A5)
    out = mix(np.concatenate([h, g]))
    row = np.concatenate([rows[full], short])
    order = np.argsort(row, kind="stable")
    return out[order], row[order]


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""(starts, ends, row) of the lines between ``\n``; every row has at least one line."""
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    rows = np.concatenate([np.arange(len(offsets) - 1), owner])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    last = np.r_[rows[1:] != rows[:-1], True] if len(rows) else np.zeros(0, bool)
    ends = np.where(last, offsets[1:][rows], np.r_[starts[1:] - 1, 0] if len(rows) else starts)
    return starts, ends, rows


def sequence_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every run ``values[begin:end]`` of 64-bit values, in order."""
    p, q = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * p[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * q[begin] ^ ((end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def repeated(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each element: how many elements of the same row have its value, and whether an earlier one has."""
    order = np.lexsort((np.arange(len(rows)), values, rows))
    r, v = rows[order], values[order]
    first = np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])] if len(r) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    size = np.bincount(group) if len(r) else np.zeros(0, int)
    out = np.zeros((2, len(rows)), dtype=np.int64)
    out[0, order] = size[group] if len(r) else 0
    out[1, order] = ~first
    return out
