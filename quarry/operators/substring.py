"""Substring search for batches of keywords (F7, T4): a q-gram anchor index.

A keyword can only occur where one of its q-grams occurs.  Each keyword is
filed under a single q-gram of itself, its *anchor* (8 bytes wide, or 4, 2, 1
for shorter keywords).  A text is read once, whatever the number of keywords:

1. the q-gram at every byte position is a machine word of the text buffer; a
   bitmap of hashed anchors throws out nearly all positions;
2. what is left is looked up among the anchors, which gives the few (position,
   keyword) pairs where an occurrence is possible;
3. those pairs are compared in full, eight bytes at a time.

The anchor is the keyword's rarest q-gram in the first text a task reads, so a
common word or phrase is filed under its least common part.  The choice only
decides how many pairs step 3 sees, never the result.

Comparing UTF-8 bytes equals comparing characters: no character's encoding begins
inside another's.  Texts of any length are read in segments; keywords travel as a
broadcast of at most ``MAX_NEEDLE_BYTES``, larger batches take several scans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Keyword bytes of one broadcast, one scan each.
MAX_NEEDLE_BYTES = 64 << 20
#: Bytes of text looked at together; (position, keyword) pairs compared together.
SEGMENT = 1 << 20
PAIRS = 1 << 20
WIDTHS = (8, 4, 2, 1)
#: log2 of the bits of the anchor bitmap.
SLOT_BITS = 20


def windows(data: np.ndarray, n: int, width: int) -> np.ndarray:
    """The ``width`` bytes from every position 0..n-1 as an integer; ``data`` goes on for ``width`` bytes behind."""
    if width == 1:
        return data[:n].astype(np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for k in range(min(width, n)):
        count = (n - k + width - 1) // width
        out[k::width] = np.frombuffer(data, dtype=f"<u{width}", offset=k, count=count)
    return out


def _slots(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


class _Anchors:
    """The keywords of one width, filed by anchor."""

    def __init__(self, width: int, needles: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray, sample: np.ndarray):
        self.width = width
        grams = windows(flat, len(flat) - 8, width)
        seen = np.bincount(_slots(windows(sample, len(sample) - 8, width)), minlength=1 << SLOT_BITS)
        n = size[needles] - width + 1  # q-grams of each keyword
        owner = np.repeat(np.arange(len(needles)), n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = start[needles][owner] + inner
        slots = _slots(grams[at])
        shared = np.bincount(slots, minlength=1 << SLOT_BITS)
        order = np.lexsort((inner, shared[slots], seen[slots], owner))
        best = order[np.searchsorted(owner[order], np.arange(len(needles)))]
        values, offset = grams[at[best]], inner[best]
        by = np.argsort(values, kind="stable")
        self.values, first = np.unique(values[by], return_index=True)
        self.bounds = np.r_[first, len(by)]
        self.needles, self.offset = needles[by], offset[by]
        self.bitmap = np.zeros(1 << SLOT_BITS, dtype=bool)
        self.bitmap[_slots(self.values)] = True

    def pairs(self, segment: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(start of the possible occurrence, keyword) for anchors at the positions 0..n-1."""
        grams = windows(segment, n, self.width)
        at = np.flatnonzero(self.bitmap[_slots(grams)])
        which = np.minimum(np.searchsorted(self.values, grams[at]), len(self.values) - 1)
        real = self.values[which] == grams[at]
        at, which = at[real], which[real]
        n_each = self.bounds[which + 1] - self.bounds[which]
        done = np.cumsum(n_each)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + PAIRS, side="right")))
            each = n_each[a:b]
            filed = np.repeat(self.bounds[which[a:b]], each) + np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            yield np.repeat(at[a:b], each) - self.offset[filed], self.needles[filed]
            a = b


class Matcher:
    """All keywords of a scan; ``sample`` is some text to choose anchors by."""

    def __init__(self, needles: list[bytes], sample: np.ndarray):
        self.size = np.array([len(x) for x in needles], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = _padded(np.frombuffer(b"".join(needles), dtype=np.uint8))
        width = np.select([self.size >= w for w in WIDTHS], WIDTHS, 0)
        self.everywhere = np.flatnonzero(width == 0)  # the empty text is part of every text
        self.tiers = [_Anchors(w, np.flatnonzero(width == w), self.flat, self.start, self.size, _padded(sample)) for w in WIDTHS if (width == w).any()]

    def _equal(self, data: np.ndarray, at: np.ndarray, needle: np.ndarray) -> np.ndarray:
        """Whether the keyword stands at the position, for pairs that lie inside ``data``."""
        good = np.arange(len(at))
        size = self.size[needle]
        step = 0
        while len(good):
            begin = np.maximum(0, np.minimum(step, size[good] - 8))
            within = np.arange(8)[None, :] < size[good][:, None]
            text = data[np.minimum((at[good] + begin)[:, None] + np.arange(8), len(data) - 1)]
            word = self.flat[np.minimum((self.start[needle[good]] + begin)[:, None] + np.arange(8), len(self.flat) - 1)]
            same = ((text == word) | ~within).all(axis=1)
            done = size[good] <= step + 8
            if step == 0:
                found = np.zeros(len(at), dtype=bool)
            found[good[same & done]] = True
            good = good[same & ~done]
            step += 8
        return found if len(at) else np.zeros(0, dtype=bool)

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sorted distinct ``row * number of keywords + keyword`` of the texts ``data[offsets[i]:offsets[i + 1]]``."""
        n_needles = len(self.size)
        out = [np.zeros(0, np.int64)]
        for begin in range(0, len(data), SEGMENT):
            n = min(SEGMENT, len(data) - begin)
            segment = data[begin : begin + n + 8]
            segment = segment if len(segment) == n + 8 else _padded(segment)
            found = [np.zeros(0, np.int64)]
            for tier in self.tiers:
                for at, needle in tier.pairs(segment, n):
                    at = at + begin
                    row = np.searchsorted(offsets, np.maximum(at, 0), side="right") - 1
                    inside = (at >= 0) & (at + self.size[needle] <= offsets[np.minimum(row + 1, len(offsets) - 1)])
                    at, needle, row = at[inside], needle[inside], row[inside]
                    same = self._equal(data, at, needle)
                    found.append(np.unique(row[same] * n_needles + needle[same]))
            out.append(np.unique(np.concatenate(found)))
        return np.unique(np.concatenate(out))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null is empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _kernel(shipped, id_col: str, qid_col: str, qid_type: pa.DataType, id_type: pa.DataType):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, needles = shipped.value
        matcher = None
        names = pa.array(qids, type=qid_type)
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = text_buffer(batch.column(1))
            if matcher is None:
                matcher = Matcher(needles, data[:SEGMENT])
            hits = matcher.match(data, offsets)
            row, needle = hits // len(needles), hits % len(needles)
            if len(matcher.everywhere):
                known = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False))
                row = np.concatenate([row, np.repeat(known, len(matcher.everywhere))])
                needle = np.concatenate([needle, np.tile(matcher.everywhere, len(known))])
            for a in range(0, len(row), PAIRS):
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(needle[a : a + PAIRS])), batch.column(0).take(pa.array(row[a : a + PAIRS])).cast(id_type)], names=[qid_col, id_col]
                )

    return kernel


def _needle_blocks(queries: DataFrame, qid_col: str, qtext_col: str) -> Iterator[tuple[list, list[bytes]]]:
    qids, needles, size = [], [], 0
    for row in queries.select(qid_col, F.col(qtext_col).cast("binary")).where(F.col(qtext_col).isNotNull()).toLocalIterator(prefetchPartitions=True):
        if needles and size + len(row[1]) > MAX_NEEDLE_BYTES:
            yield qids, needles
            qids, needles, size = [], [], 0
        qids.append(row[0])
        needles.append(bytes(row[1]))
        size += len(row[1])
    if needles:
        yield qids, needles


def substring_matches(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "id",
    text_col: str = "document",
    qid_col: str = "query_id",
    qtext_col: str = "query_text",
    case_sensitive: bool = True,
) -> DataFrame:
    """F7 for a batch — ``(query_id, id)`` where the document contains the query text.

    One scan for ``MAX_NEEDLE_BYTES`` of keywords, no shuffle.  A null query or
    text matches nothing, the empty query every text.
    """
    spark = docs.sparkSession
    schema = T.StructType([T.StructField(qid_col, queries.schema[qid_col].dataType), T.StructField(id_col, docs.schema[id_col].dataType)])
    kinds = [to_arrow_type(f.dataType) for f in schema]
    if not case_sensitive:
        docs, queries = docs.withColumn(text_col, F.lower(text_col)), queries.withColumn(qtext_col, F.lower(qtext_col))
    out = None
    for block in _needle_blocks(queries, qid_col, qtext_col):
        found = docs.select(id_col, text_col).mapInArrow(_kernel(spark.sparkContext.broadcast(block), id_col, qid_col, *kinds), schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out
