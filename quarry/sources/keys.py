"""The ids of a stored collection (S4, H7): sorted pieces with Bloom filters.

Every append writes its distinct ids in *pieces*: a slot (the first bits of the
id's hash), the range of hashes in the piece, a Bloom filter of about two bytes an
id, the ids themselves and the records file that each is in.  Whether a new batch holds stored ids is answered from
the filters alone: both sides are dealt by slot, a task tests a slot's new ids
against the pieces whose range they fall in.  Only ids that pass a filter (all
stored ones, and about one in 1,700 others) are compared with real ids, and only
the pieces they point to are read for that.  The same lookup gives the files of any ids.

A piece is at most one Arrow batch of one slot, so nothing grows with the
collection but the number of pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOT_BITS = 12
BITS_PER_ID = 16
PROBES = 8


def _spread(h: np.ndarray) -> np.ndarray:
    """(ids, PROBES) 64-bit positions of every hash, to be taken modulo the filter's size."""
    a = h.astype(np.int64).view(np.uint64)
    b = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    b = (b ^ (b >> np.uint64(29))) | np.uint64(1)
    return a[:, None] + np.arange(PROBES, dtype=np.uint64)[None, :] * b[:, None]


def piece_schema(id_type: T.DataType) -> T.StructType:
    fields = [("slot", T.IntegerType()), ("lo", T.LongType()), ("hi", T.LongType()), ("copies", T.LongType()), ("bits", T.BinaryType()), ("ids", T.ArrayType(id_type)), ("files", T.ArrayType(T.StringType()))]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def key_pieces(ids: DataFrame) -> DataFrame:
    """Pieces of a table of ids (and of their ``file``, if it has one); ``copies`` counts repetitions (combined map-side, so a hot id is one row per task)."""
    h = F.xxhash64("id")
    file = F.col("file") if "file" in ids.columns else F.lit(None).cast("string")
    counted = ids.groupBy("id").agg((F.count(F.lit(1)) - 1).alias("copies"), F.min(file).alias("file"))
    laid = counted.select("id", h.alias("h"), F.shiftrightunsigned(h, 64 - SLOT_BITS).cast("int").alias("slot"), "copies", "file")
    laid = laid.repartition("slot").sortWithinPartitions("slot", "h").select("slot", "h", "copies", "id", "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, h, copies = (batch.column(i).to_numpy() for i in range(3))
            if not len(slot):
                continue
            first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
            n = np.diff(np.r_[first, len(slot)])
            size = -(-np.maximum(64, n * BITS_PER_ID) // 8) * 8  # bits of each filter, whole bytes
            begin = np.cumsum(size) - size
            piece = np.repeat(np.arange(len(first)), n)
            bits = np.zeros(int(size.sum()), dtype=np.uint8)
            bits[(begin[piece][:, None] + (_spread(h) % size[piece].astype(np.uint64)[:, None]).astype(np.int64)).ravel()] = 1
            packed = np.packbits(bits)
            filters = [packed[a // 8 : (a + s) // 8].tobytes() for a, s in zip(begin.tolist(), size.tolist())]
            ids, files = (pa.ListArray.from_arrays(pa.array(np.r_[first, len(slot)].astype(np.int32)), batch.column(i)) for i in (3, 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[first]), pa.array(h[first]), pa.array(h[first + n - 1]), pa.array(np.add.reduceat(copies, first)), pa.array(filters, pa.binary()), ids, files],
                names=["slot", "lo", "hi", "copies", "bits", "ids", "files"],
            )

    return laid.mapInArrow(run, piece_schema(ids.schema["id"].dataType))


def possible(new: DataFrame, stored: DataFrame) -> DataFrame:
    """``(id, ingest_batch, slot, lo)``: ids of the pieces ``new`` that pass a filter of ``stored`` (pieces with ``ingest_batch``); reads no stored id."""
    id_type = new.schema["ids"].dataType.elementType
    none = lambda t: F.lit(None).cast(t)
    asked = new.select("slot", F.explode("ids").alias("id"))
    asked = asked.select("slot", F.lit(0).alias("side"), F.xxhash64("id").alias("lo"), none("long").alias("hi"), none("binary").alias("bits"), none("string").alias("ingest_batch"), "id")
    filters = stored.select("slot", F.lit(1).alias("side"), "lo", "hi", "bits", "ingest_batch", none(id_type).alias("id"))
    both = asked.unionByName(filters).repartition("slot").sortWithinPartitions("slot", "side", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, hashes, ids = None, [], []
        for batch in batches:
            slots, side, lo = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.r_[True, (slots[1:] != slots[:-1]) | (side[1:] != side[:-1])]) if len(slots) else []
            for a, b in zip(cuts, [*cuts[1:], len(slots)]):
                if slots[a] != slot:
                    slot, hashes, ids = slots[a], [], []
                if side[a] == 0:
                    hashes.append(lo[a:b])
                    ids.append(batch.column(6).slice(a, b - a))
                    continue
                if not ids:
                    continue
                h = np.concatenate(hashes)
                for i in range(a, b):
                    x, y = np.searchsorted(h, lo[i], "left"), np.searchsorted(h, batch.column(3)[i].as_py(), "right")
                    if x == y:
                        continue
                    bits = np.frombuffer(batch.column(4)[i].as_py(), dtype=np.uint8)
                    at = (_spread(h[x:y]) % np.uint64(len(bits) * 8)).astype(np.int64)
                    passed = np.flatnonzero(((bits[at >> 3] >> (7 - (at & 7))) & 1).all(axis=1)) + x
                    if len(passed):
                        own = pa.concat_arrays(ids).take(pa.array(passed))
                        n = len(passed)
                        yield pa.RecordBatch.from_arrays(
                            [own, pa.array([batch.column(5)[i].as_py()] * n, pa.string()), pa.array(np.full(n, slot, np.int32)), pa.array(np.full(n, lo[i]))],
                            names=["id", "ingest_batch", "slot", "lo"],
                        )

    schema = T.StructType([T.StructField("id", id_type), T.StructField("ingest_batch", T.StringType()), T.StructField("slot", T.IntegerType()), T.StructField("lo", T.LongType())])
    return both.mapInArrow(run, schema)


def located(maybe: DataFrame, stored: DataFrame) -> DataFrame:
    """``(id, ingest_batch, file)``: those of ``maybe`` that are stored; only the pieces they point to are opened."""
    place = ["ingest_batch", "slot", "lo"]
    pointed = stored.join(maybe.select(*place).distinct(), place, "left_semi")
    real = pointed.select(*place, F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("files").alias("file"))))
    return maybe.join(real, [*place, "id"]).select("id", "ingest_batch", "file")


def confirmed(maybe: DataFrame, stored: DataFrame) -> DataFrame:
    """``(id)``: those of ``maybe`` that are stored."""
    return located(maybe, stored).select("id").distinct()
