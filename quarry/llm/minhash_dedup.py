"""Operator 1 — near-duplicates by ProbMinHash, banding and verification.

1. One pass over the texts: words (A-Z lower-cased), 5-word shingles weighted
   by their count, and the ProbMinHash signature: each shingle is a Poisson
   process of rate its weight, each arrival falls on one of ``K`` registers,
   the earliest arrival names the register, and a shingle stops as soon as its
   next arrival is later than every register (early termination).  Two texts
   agree in a register with probability J_P, their probability Jaccard
   similarity.  Written: a node (128-bit digest of the text, so exact copies
   are one node), the band keys and 8 bits per register.
2. Each member of a band bucket is paired with the bucket's smallest node — a
   star, never all pairs — and the pairs are verified exactly: weighted
   Jaccard of the shingle bags at least ``SIMILARITY``.  Components follow.
3. Nothing may hide behind a star: buckets that still hold several components
   are compared in blocks by their signatures, and pairs of different
   components whose estimate reaches ``SIMILARITY`` less three standard errors
   are verified as well, inside the block: only links that join components
   leave it, never pairs inside a component.

Classes are the connected components of verified links and exact copies.

Defined results: texts without a word (and null) are a class of their own per
row, named by the row's doc_id; rows that repeat a doc_id are classed by their
texts; class_id is the smallest non-null doc_id of the class (null if none).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.shared import mix, shingle_hashes, span_hashes, table, text_chunks, word_spans, written

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 8
K = BANDS * ROWS
BLOCK = 512  # nodes of a mixed bucket that are compared at once


def shingle_bags(data: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count) of every text of a chunk, sorted by row and hash."""
    starts, ends, bounds = word_spans(data, offs)
    h, row = shingle_hashes(span_hashes(data, starts, ends, lower=True), bounds, words)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, int)
    return row[first], h[first], np.diff(np.r_[first, len(h)])


def prob_minhash(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, k: int = K) -> np.ndarray:
    """(rows, k): per register the shingle of the earliest arrival (0 for rows without shingles)."""
    time = np.full(rows * k, np.inf)
    name = np.zeros(rows * k, dtype=np.uint64)
    latest = np.full(rows, np.inf)
    pace = 1.0 / weight
    x = np.zeros(len(row))
    step = 0
    while len(row):
        step = (step + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        r = mix(shingle + np.uint64(step))
        x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * pace
        live = x < latest[row]
        row, shingle, pace, x, r = row[live], shingle[live], pace[live], x[live], r[live]
        cell = row * k + (mix(r) % np.uint64(k)).astype(np.int64)
        np.minimum.at(time, cell, x)
        won = time[cell] == x
        name[cell[won]] = shingle[won]
        latest = time.reshape(rows, k).max(axis=1)
        live = x < latest[row]
        row, shingle, pace, x = row[live], shingle[live], pace[live], x[live]
    return name.reshape(rows, k)


def signatures(df: DataFrame) -> DataFrame:
    """(node, doc_id, bands, sig) per row with words, stored."""
    slim = df.select("text", "doc_id", F.unhex(F.md5("text")).alias("node"))
    doc_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offs in text_chunks(batch.column(0)):
                n = len(offs) - 1
                row, shingle, count = shingle_bags(data, offs)
                names = prob_minhash(row, shingle, count.astype(float), n)
                some = np.unique(row)
                names = names[some]
                bands = np.zeros((len(some), BANDS), dtype=np.uint64)
                for j in range(ROWS):
                    bands = mix(bands * np.uint64(0xFF51AFD7ED558CCD) + names[:, j::ROWS] + np.arange(BANDS, dtype=np.uint64))
                sig = (mix(names) >> np.uint64(56)).astype(np.uint8)
                rest = batch.slice(at, n).take(pa.array(some))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([rest.column(2), rest.column(1), lists, pa.array([s.tobytes() for s in sig], pa.binary())], names=["node", "doc_id", "bands", "sig"])

    return written(slim.mapInArrow(run, f"node binary, doc_id {doc_type}, bands array<bigint>, sig binary"), "op1-signatures")


def bag_similarity(a: pa.Array, b: pa.Array, words: int = WORDS) -> np.ndarray:
    """Weighted Jaccard (sum of smaller over sum of larger counts) of the shingle bags of paired texts; 0 without shingles."""
    n = len(a)
    parts = []
    for side, col in enumerate((a, b)):
        for at, data, offs in text_chunks(col):
            row, h, count = shingle_bags(data, offs, words)
            both = np.zeros((len(row), 2))
            both[:, side] = count
            parts.append((row + at, h, both))
    if not parts:
        return np.zeros(n)
    row, h, both = (np.concatenate(p) for p in zip(*parts))
    if not len(row):
        return np.zeros(n)
    order = np.lexsort((h, row))
    row, h, both = row[order], h[order], both[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])])
    both = np.add.reduceat(both, first, axis=0)
    low = np.bincount(row[first], weights=both.min(axis=1), minlength=n)
    high = np.bincount(row[first], weights=both.max(axis=1), minlength=n)
    return np.divide(low, high, out=np.zeros(n), where=high > 0)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough, stored."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                near = np.flatnonzero(bag_similarity(part.column(2), part.column(3)) >= similarity)
                yield part.take(pa.array(near)).select([0, 1])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return written(joined.mapInArrow(run, "a binary, b binary"), "op1-links")


def texts_of(df: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``pairs``, one copy each, stored."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = members.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(wanted, "node", "left_semi")
    chosen = written(chosen, "op1-chosen").alias("c")
    docs = df.select("doc_id", "text", F.unhex(F.md5("text")).alias("node")).alias("d")
    # a hash join of the small side: the texts are shuffled once and not sorted
    found = docs.join(chosen.hint("shuffle_hash"), (F.col("d.node") == F.col("c.node")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), "left_semi")
    return written(found.dropDuplicates(["node"]).select("node", "text"), "op1-texts")


def cross_links(rows: DataFrame, similarity: float, margin: float) -> DataFrame:
    """Verified links (a, b) between different components of one bucket, enough of them to join all that belong together.

    ``rows``: key, m (bucket size), node, component, sig, text.  Buckets are cut into blocks of about
    ``BLOCK`` nodes and every two blocks meet once.  Pairs whose signature estimate reaches
    ``similarity - margin`` are verified exactly, best estimates first; pairs whose components the
    block has already joined are passed over.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    spread = rows.withColumn("blocks", blocks).withColumn("own", own)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "sig", "text")
    ordered = spread.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def candidates(i: int, j: int, own: np.ndarray, comp: np.ndarray, sig: np.ndarray) -> Iterator[tuple[int, int]]:
        left = np.flatnonzero(own == i)
        right = np.flatnonzero(own == j)
        found = []
        for at in range(0, len(left), 64):
            part = left[at : at + 64]
            estimate = ((sig[part][:, None, :] == sig[right][None, :, :]).mean(axis=2) * 256 - 1) / 255
            x, y = np.nonzero((estimate >= similarity - margin) & (comp[part][:, None] != comp[right][None, :]))
            keep = part[x] < right[y] if i == j else np.ones(len(x), dtype=bool)
            found.append((part[x][keep], right[y][keep], estimate[x, y][keep]))
        if found:
            a, b, e = (np.concatenate(f) for f in zip(*found))
            order = np.argsort(-e, kind="stable")
            yield from zip(a[order].tolist(), b[order].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links_of(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(group)
            nodes = t.column("node").combine_chunks()
            comp = np.unique(np.array(t.column("component").to_pylist(), dtype=object), return_inverse=True)[1]
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint8).reshape(t.num_rows, -1)
            up = list(range(t.num_rows))  # local components
            bags: list = []
            found = []

            def root(x: int) -> int:
                while up[x] != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x

            for a, b in candidates(t.column("i")[0].as_py(), t.column("j")[0].as_py(), t.column("own").to_numpy(), comp, sig):
                x, y = root(int(comp[a])), root(int(comp[b]))
                if x == y:
                    continue
                bags = bags or _bags(t.column("text"))
                if _similarity(bags[a], bags[b]) >= similarity:
                    up[x] = y
                    found.append((a, b))
            if found:
                left, right = zip(*found)
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(left)), nodes.take(pa.array(right))], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        held_key = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for begin, end in zip(cuts, np.r_[cuts[1:], batch.num_rows].astype(int)):
                key = tuple(keys[:, begin])
                if key != held_key and held:
                    yield from links_of(held)
                    held = []
                held_key = key
                held.append(batch.slice(int(begin), int(end - begin)))
        if held:
            yield from links_of(held)

    return ordered.mapInArrow(run, "a binary, b binary")


def _bags(texts: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted shingle hashes, counts) of each text."""
    out = []
    for _, data, offs in text_chunks(texts):
        row, h, count = shingle_bags(data, offs)
        cuts = np.searchsorted(row, np.arange(len(offs)))
        out += [(h[a:b], count[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def _similarity(a: tuple, b: tuple) -> float:
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][x], b[1][y]).sum())
    return low / max(1, int(a[1].sum() + b[1].sum()) - low)


def near_duplicates(df: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, class_id, stays) per row of ``df`` (columns doc_id, text).

    ``node`` is the text's digest (null without words); ``stays`` marks the class's row of
    smallest doc_id (null last), then node; rows that repeat both stay together.
    """
    members = signatures(df)
    nodes = members.select("node", "bands", "sig").dropDuplicates(["node"])
    entries = nodes.select("node", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("least")).where("m > 1")
    shared = written(shared, "op1-shared")
    buckets = written(entries.join(shared, "key").select("key", "m", "least", "node"), "op1-buckets")

    stars = written(buckets.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), "op1-pairs")
    texts = texts_of(df, members, buckets.select(F.col("node").alias("a"), F.col("node").alias("b")))
    links = verified(stars, texts, similarity)
    first = connected_components(links)

    # buckets that still hold several components
    placed = buckets.join(first, "node", "left").select("key", "m", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    mixed = written(mixed, "op1-mixed")
    rows = placed.join(mixed, "key", "left_semi")
    wanted = rows.select("node").distinct()
    about = members.select("node", "sig").dropDuplicates(["node"]).join(texts, "node").join(wanted, "node", "left_semi")
    rows = rows.join(written(about, "op1-about"), "node").select("key", "m", "node", "component", "sig", "text")
    margin = 3 * math.sqrt(similarity * (1 - similarity) / K)
    late = written(cross_links(rows, similarity, margin), "op1-links")
    to = first.select(F.col("node"), F.col("component"))
    between = late.join(to.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
    between = between.join(to.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    between = between.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    second = connected_components(between)
    # both components name their smallest node, so the second replaces the first
    final = first.join(second.select(F.col("node").alias("component"), F.col("component").alias("outer")), "component", "left")
    final = final.select("node", F.coalesce("outer", "component").alias("component"))
    alone = second.join(first, "node", "left_anti").select("node", "component")
    final = written(final.unionByName(alone), "op1-components")

    classed = members.select("node", "doc_id").join(final, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("component"))
    classed = written(classed, "op1-classed")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")
    named = written(classed.groupBy("component").agg(F.min(order).alias("first")), "op1-named")
    out = classed.join(named, "component").select("doc_id", "node", F.col("first.doc_id").alias("class_id"), (order == F.col("first")).alias("stays"))
    wordless = df.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return out.unionByName(wordless.select("doc_id", F.lit(None).cast("binary").alias("node"), F.col("doc_id").alias("class_id"), F.lit(True).alias("stays")))


def one_per_class(df: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that stay: one of each class (a repeated row once), and all rows without words."""
    keep = written(near_duplicates(df.select("doc_id", "text"), similarity).where("stays and node is not null").groupBy("doc_id", "node").agg(F.count("*").alias("n")), "op1-stays")
    rows = df.select(F.struct("*").alias("doc"), F.unhex(F.md5("text")).alias("digest"))

    def chosen(part: DataFrame) -> DataFrame:
        return rows.join(part, (F.col("digest") == F.col("node")) & F.col("doc.doc_id").eqNullSafe(F.col("doc_id")), "left_semi")

    again = chosen(keep.where("n > 1")).select("doc", "digest", F.col("doc.doc_id").alias("id")).dropDuplicates(["id", "digest"]).select("doc")
    wordless = rows.where(~F.coalesce(F.col("doc.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select("doc")
    return chosen(keep.where("n = 1")).select("doc").union(again).union(wordless).select("doc.*")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")
