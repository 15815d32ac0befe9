"""Operator 7 — benchmark decontamination by SimHash windows and verified shingle similarity.

Items get windows sized from their length: the largest size of a fixed ladder
that leaves room for ``STRIDE`` alignments inside half of the item (short items:
inside the whole item), at every offset.  Texts get windows of each ladder
size at every ``STRIDE``-th word.  A window's fingerprint is the 64-bit SimHash
of its words.  An intact half of a passage therefore holds a text window
equal to some item window, and windows that differ are still met up to
``RADIUS``: fingerprints are indexed by ``RADIUS + 1`` blocks, so two
fingerprints within the radius agree in at least one block (pigeonhole), and
the Hamming distance is checked in full.

Each hit aligns an item with a span of the text; the exact weighted-shingle
similarity (weighted Jaccard of 5-word shingle counts) of that item-sized span
must reach ``SIMILARITY``.  The best span per (document, item) is reported.

The benchmark is the small side by nature; its index is broadcast only up to
``MAX_ITEMS`` items and larger benchmarks are scanned in several passes of that
size (every pass covers all documents).

Defined results: null or wordless texts and items match nothing; items of fewer
than five words are one shingle and match their exact word sequence; rows
that repeat a doc_id or item_id are matched each and reported once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.shared import mix, revived, shingle_hashes, span_hashes, table, text_chunks, word_spans

WORDS = 5
SIMILARITY = 0.8
LADDER = (1, 2, 3, 5, 8, 12, 18, 26, 40, 64, 128)
STRIDE = 4
RADIUS = 3
MAX_ITEMS = 20_000
SEGMENT = 8192  # words whose votes are held at once; a multiple of STRIDE


def votes_before(words: np.ndarray) -> np.ndarray:
    """(words + 1, 64): how many of the words before each place vote for each bit."""
    out = np.zeros((len(words) + 1, 64), dtype=np.int16 if len(words) < 32000 else np.int32)
    np.cumsum(np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=out.dtype, out=out[1:])
    return out


def window_fingerprints(votes: np.ndarray, size: int, stride: int = 1) -> np.ndarray:
    """64-bit SimHash of the windows of ``size`` words that start at every ``stride``-th word; each word votes on every bit."""
    if len(votes) <= size:
        return np.zeros(0, np.uint64)
    ones = votes[size::stride] - votes[: len(votes) - size : stride]
    return np.packbits(ones > size // 2, axis=1).view(np.uint64).ravel()


def stride_of(size: int) -> int:
    return STRIDE if size >= 8 else 1


def window_size(n: int) -> int:
    """Window size for an item of ``n`` words: an intact half holds ``stride`` aligned windows; short items need an intact whole."""
    room = (n + 1) // 2
    fits = [s for s in LADDER if s >= 8 and s + stride_of(s) - 1 <= room]
    if fits:
        return max(fits)
    return max(s for s in LADDER if s + stride_of(s) - 1 <= n)


class ItemIndex:
    """Window fingerprints of a set of items under a multi-index of blocks, and the items' shingle bags."""

    def __init__(self, ids: list, texts: list[str], words: int = WORDS, radius: int = RADIUS):
        self.words, self.radius = words, radius
        col = pa.array(texts, pa.large_string())
        hashes, bags, sizes = [], [], []
        for _, data, offs in text_chunks(col, limit=1 << 40):
            starts, ends, bounds = word_spans(data, offs)
            h = span_hashes(data, starts, ends, lower=True)
            for a, b in zip(bounds[:-1], bounds[1:]):
                hashes.append(h[a:b])
                shingle, _ = shingle_hashes(h[a:b], np.array([0, b - a]), words)
                bags.append(np.unique(shingle, return_counts=True))
                sizes.append(int(b - a))
        self.ids = [i for i, n in zip(ids, sizes) if n]
        self.size = np.array([n for n in sizes if n], dtype=np.int64)
        self.bags = [b for b, n in zip(bags, sizes) if n]
        per_size: dict[int, list] = {}
        k = 0
        for h, n in zip(hashes, sizes):
            if not n:
                continue
            s = window_size(n)
            at = np.arange(n - s + 1)
            per_size.setdefault(s, []).append((window_fingerprints(votes_before(h), s), np.full(len(at), k), at))
            k += 1
        self.width = 64 // (radius + 1)
        self.tables = {}
        for s, parts in per_size.items():
            prints, item, offset = (np.concatenate(p) for p in zip(*parts))
            blocks = []
            for b in range(radius + 1):
                key = self._block(prints, b)
                order = np.argsort(key, kind="stable")
                bounds = np.searchsorted(key[order], np.arange((1 << self.width) + 1)).astype(np.int32)
                blocks.append((order.astype(np.int32), bounds, np.diff(bounds) > 0))
            self.tables[s] = (prints, item, offset, blocks)

    def _block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def near(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query position, item window) of all fingerprints within the radius."""
        own, _, _, blocks = self.tables[size]
        hits = []
        for b, (order, bounds, some_here) in enumerate(blocks):
            key = self._block(prints, b)
            some = np.flatnonzero(some_here[key])
            key = key[some]
            first, count = bounds[key], bounds[key + 1] - bounds[key]
            query = np.repeat(some, count)
            inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            window = order[np.repeat(first, count) + inner]
            close = np.bitwise_count(prints[query] ^ own[window]) <= self.radius
            hits.append((query[close], window[close]))
        query, window = (np.concatenate(h) for h in zip(*hits))
        pairs = np.unique(np.stack([query, window]), axis=1) if len(query) else np.zeros((2, 0), np.int64)
        return pairs[0], pairs[1]

    def search(self, h: np.ndarray, bounds: np.ndarray, similarity: float) -> list[tuple[int, int, int, float]]:
        """(row, item, first word, similarity) of the best verified span per row and item; ``h``: word hashes of the rows."""
        row_end = np.repeat(bounds[1:], np.diff(bounds))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        tested: set[tuple[int, int, int]] = set()
        longest = max(self.tables, default=0)
        for begin_at in range(0, len(h) if longest else 0, SEGMENT):
            stop = min(begin_at + SEGMENT, len(h))
            votes = votes_before(h[begin_at : stop + longest])
            for s, (_, item, offset, _) in self.tables.items():
                stride = stride_of(s)
                prints = window_fingerprints(votes[: stop - begin_at + s], s, stride)
                place = begin_at + stride * np.arange(len(prints))
                inside = row_end[place] - place >= s
                query, window = self.near(s, prints[inside])
                for q, w in zip(place[inside][query].tolist(), window.tolist()):
                    row, k = int(np.searchsorted(bounds, q, side="right")) - 1, int(item[w])
                    begin = max(q - int(offset[w]), int(bounds[row]))
                    end = min(begin + int(self.size[k]), int(bounds[row + 1]))
                    if (k, begin, end) in tested:
                        continue
                    tested.add((k, begin, end))
                    like = self._similarity(h[begin:end], k)
                    if like >= similarity and (-like, begin) < best.get((row, k), (0.0, 0)):
                        best[row, k] = (-like, begin)
        return [(row, k, begin - int(bounds[row]), -minus) for (row, k), (minus, begin) in best.items()]

    def _similarity(self, span: np.ndarray, k: int) -> float:
        shingle, _ = shingle_hashes(span, np.array([0, len(span)]), self.words)
        own, count = np.unique(shingle, return_counts=True)
        other, weight = self.bags[k]
        _, a, b = np.intersect1d(own, other, assume_unique=True, return_indices=True)
        low = np.minimum(count[a], weight[b]).sum()
        return float(low / (count.sum() + weight.sum() - low))


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, word_at, similarity): one row per document and item it holds.

    ``docs``: doc_id, text; ``items``: item_id, text.
    """
    spark = docs.sparkSession
    listed = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct().orderBy("item_id", "text")
    passes, found = listed.count(), None
    kinds = (docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())
    for at in range(0, max(passes, 1), MAX_ITEMS):
        part = listed.offset(at).limit(MAX_ITEMS).collect()  # at most MAX_ITEMS items
        index = ItemIndex([r.item_id for r in part], [r.text for r in part])
        shipped = spark.sparkContext.broadcast(vars(index))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            own = revived(ItemIndex, shipped.value)
            for batch in batches:
                id_kind = batch.schema.field(1).type
                ids = batch.column(1).to_pylist()
                for first, data, offs in text_chunks(batch.column(0)):
                    starts, ends, bounds = word_spans(data, offs)
                    hits = own.search(span_hashes(data, starts, ends, lower=True), bounds, similarity)
                    if hits:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([ids[first + r] for r, _, _, _ in hits], id_kind),
                                pa.array([own.ids[k] for _, k, _, _ in hits], pa.int64()),
                                pa.array([w for _, _, w, _ in hits], pa.int64()),
                                pa.array([s for _, _, _, s in hits], pa.float64()),
                            ],
                            names=["doc_id", "item_id", "word_at", "similarity"],
                        )

        out = docs.select("text", "doc_id").mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, word_at long, similarity double")
        found = out if found is None else found.unionByName(out)
    best = F.max(F.struct("similarity", -F.col("word_at"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("best.col2")).alias("word_at"), "best.similarity")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
