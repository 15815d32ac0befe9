"""Operator 12 — prefix trie of rebuilt conversations by composable fingerprints.

A conversation ``c`` is rebuilt from a *head* (the first h turns of its base,
conversation ``c - c % 5``) and its own turns after its first h.  Its prefixes are the
nodes of a trie.  No rebuilt text is ever made:

* A sequence of turns has a fingerprint in a monoid: (n, sum of B^i v_i), with v_i
  two 64-bit lanes of the turn's SHA-256.  Fingerprints compose as
  (n, H) (m, G) = (n + m, H + B^n G), and B has an inverse, so the fingerprint of any
  rebuilt prefix is ``head + B^(h' - h) (own prefix - own first h)`` — arithmetic on
  numbers already known.
* **Own prefixes.**  Turns (digest and size, no text) are range-partitioned by
  (conversation, turn) and sorted; tasks make running fingerprints, and since these
  compose, a conversation that spans tasks needs only one carry per partition.  No
  conversation has to fit one task.
* **Nodes** are groups of equal (depth, fingerprint).  Every member refers to a
  stored turn; a group is accepted if all its turns have one digest (the half of
  it that is not in the fingerprint) and all parents are one, which by induction
  makes the sequences equal.  A collision would choose other bases and start again.
* **Subtree sums without walking the tree.**  Each node belongs to its smallest
  member; the nodes a conversation owns are the tail of its path.  So a node's
  sum is the total over its members of what they own, less what its owner owns
  above it: one grouped sum and one running sum (in two levels, by blocks of a path).
* The digest of a node's ends is a stream: tasks pack sorted ids into texts of
  bounded size, one reader hashes the packs in order.

Defined cases: turns are ordered by turn (null first), then role (null first), then
the digest of role and text; equal rows are turns of their own; null role or text is empty; rows
without conv_id take no part; a missing base gives no head; turnless rebuilt
conversations are members of the root; an empty table has no node; columns other
than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.shared import CRC_TABLE_SQL, crc32_sql, mix, table, written

FAMILY = 5
MAX_HEAD = 9
#: Positions of a path in one block of the two-level sums and joins (2^12).
BLOCK_BITS = 12
#: Characters of conversation ids in one pack.
PACK = 1 << 16
NONE = hashlib.sha256(b"").hexdigest()


class Bases:
    """Powers of two odd bases modulo 2^64, positive and negative exponents."""

    def __init__(self, seed: int):
        self.base = mix(np.array([2 * seed + 1, 2 * seed + 2], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.inverse = np.array([pow(int(b), -1, 1 << 64) for b in self.base], dtype=np.uint64)

    def power(self, exponents: np.ndarray) -> np.ndarray:
        """(2, n): both bases to every exponent, by repeated squaring."""
        out = np.ones((2, len(exponents)), dtype=np.uint64)
        square = np.where(exponents < 0, self.inverse[:, None], self.base[:, None])
        left = np.abs(exponents).astype(np.uint64)
        while left.any():
            out = np.where(left & np.uint64(1), out * square, out)
            square = square * square
            left = left >> np.uint64(1)
        return out


def _lanes(batch: pa.RecordBatch, *columns: int) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in columns])


def _int64(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _half(digest: Column, at: int) -> Column:
    """Eight bytes of a hex digest as a long (two's complement)."""
    first = F.conv(F.substring(digest, 16 * at + 1, 8), 16, 10).cast("long")
    second = F.conv(F.substring(digest, 16 * at + 9, 8), 16, 10).cast("long")
    return F.shiftleft(first, 32).bitwiseOR(second)


STORED = "conv_id long, part int, local long, f1 long, f2 long, v1 long, v2 long, c1 long, c2 long, bytes long"


def stored_turns(conversations: DataFrame, bases: Bases, parts: int) -> DataFrame:
    """Every turn with its running fingerprint since its conversation began in its partition (``local`` turns ago)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", "role", F.sha2(said.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("_at")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("digest"), F.col("_at")]
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = laid.select(F.col("conv_id").cast("long"), F.spark_partition_id().alias("part"), *[_half(F.col("digest"), i).alias(f"h{i}") for i in range(4)], "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, sums = None, 0, np.zeros(2, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            v = _lanes(batch, 2, 3)
            new = np.r_[conv[0] != last, conv[1:] != conv[:-1]]
            if new[0]:
                count, sums = 0, np.zeros(2, np.uint64)
            starts = np.unique(np.r_[0, np.flatnonzero(new)])
            segment = np.searchsorted(starts, np.arange(len(conv)), side="right") - 1
            local = np.arange(len(conv)) - starts[segment] + np.where(segment == 0, count, 0)
            run_sums = np.cumsum(v * bases.power(local), axis=1, dtype=np.uint64)
            before = np.concatenate([np.zeros((2, 1), np.uint64), run_sums], axis=1)[:, starts]
            before[:, 0] -= sums  # what the conversation had before this batch
            run_sums = run_sums - before[:, segment]
            last, count, sums = conv[-1], int(local[-1]) + 1, run_sums[:, -1].copy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(local + 1), _int64(run_sums[0]), _int64(run_sums[1]), *(batch.column(i) for i in (2, 3, 4, 5)), batch.column(6)],
                names=["conv_id", "part", "local", "f1", "f2", "v1", "v2", "c1", "c2", "bytes"],
            )

    return written(laid.mapInArrow(run, STORED), "op12-turns")


def _carries(turns: DataFrame, bases: Bases) -> DataFrame:
    """``(part, conv_id, n, g1, g2)``: what the first conversation of a partition had in the partitions before; one row per partition."""
    end = F.max(F.struct("conv_id", "local", "f1", "f2"))
    rows = sorted(turns.groupBy("part").agg(F.min("conv_id").alias("first"), end.alias("end")).collect(), key=lambda r: r["part"])
    out, conv, n, sums = [], None, 0, np.zeros(2, np.uint64)
    for r in rows:
        carried = conv == r["first"]
        if carried:
            out.append((r["part"], conv, n, *(int(x) for x in sums.view(np.int64))))
        e = r["end"]
        here = np.array([e["f1"], e["f2"]], dtype=np.int64).view(np.uint64)
        if carried and e["conv_id"] == conv:
            sums = sums + bases.power(np.array([n]))[:, 0] * here
            n += e["local"]
        else:
            n, sums = e["local"], here
        conv = e["conv_id"]
    return turns.sparkSession.createDataFrame(out, "part int, conv_id long, n long, g1 long, g2 long")


TURNS = "conv_id long, pos long, f1 long, f2 long, v1 long, v2 long, c1 long, c2 long, bytes long"


def with_prefixes(turns: DataFrame, bases: Bases) -> DataFrame:
    """``pos`` and the fingerprint of the whole own prefix: the partition's carry composed with the running fingerprint."""
    joined = turns.join(F.broadcast(_carries(turns, bases)), ["part", "conv_id"], "left")
    joined = joined.select("conv_id", "local", "f1", "f2", "v1", "v2", "c1", "c2", "bytes", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "g1", "g2")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(9).to_numpy()
            f = _lanes(batch, 10, 11) + bases.power(n) * _lanes(batch, 2, 3)
            pos = batch.column(1).to_numpy() + n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pos), _int64(f[0]), _int64(f[1]), *(batch.column(i) for i in range(4, 9))], names=["conv_id", "pos", "f1", "f2", "v1", "v2", "c1", "c2", "bytes"])

    return joined.mapInArrow(run, TURNS)


def block_of(position: str) -> Column:
    return F.shiftright(position, BLOCK_BITS)


def by_block(rows: DataFrame, last: str) -> DataFrame:
    """The rows once for every block of positions up to ``last``: partners of rows joined by (conv_id, block)."""
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), block_of(last))))


def families(turns: DataFrame) -> DataFrame:
    """One row per conversation: h, its base's head turns and what composing them needs."""
    fields = ["pos", "f1", "f2", "v1", "v2", "c1", "c2", "bytes"]
    first = F.collect_list(F.when(F.col("pos") < MAX_HEAD, F.struct(*fields)))  # under MAX_HEAD turns of each
    own = written(turns.groupBy("conv_id").agg(F.max("pos").alias("n_own"), F.sort_array(first).alias("head")), "op12-heads")
    base = own.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_HEAD).cast("int")
    rows = own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(base, "base", "left")
    head = F.coalesce(F.slice("base_head", F.lit(1), F.col("h")), F.expr("slice(head, 1, 0)"))
    rows = rows.withColumn("base_head", head).withColumn("h_base", F.size("base_head").cast("long"))
    at = lambda heads, n, f: F.coalesce(F.get(F.col(heads), F.col(n).cast("int") - 1)[f], F.lit(0).cast("long"))
    return rows.select(
        "conv_id", F.col("h").cast("long").alias("h"), "h_base", "base_head", "n_own",
        (F.col("h_base") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n_turns"),
        *[at("base_head", "h_base", f).alias(f"b{i}") for i, f in ((1, "f1"), (2, "f2"))],
        *[at("head", "h", f).alias(f"o{i}") for i, f in ((1, "f1"), (2, "f2"))],
    )


#: A member of a node: fingerprint f of the prefix, p of its parent's, c of its last turn (a reference to a stored turn), last: it ends here.
PATHS = "conv_id long, depth long, f1 long, f2 long, p1 long, p2 long, c1 long, c2 long, bytes long, last boolean"


def paths(turns: DataFrame, family: DataFrame, bases: Bases) -> DataFrame:
    """Every rebuilt conversation's prefixes, the root included."""
    zero = F.lit(0).cast("long")
    root = family.select("conv_id", *[zero.alias(c) for c in ("depth", "f1", "f2", "p1", "p2", "c1", "c2", "bytes")], (F.col("n_turns") == 0).alias("last"))
    heads = family.select("conv_id", "n_turns", "base_head", F.explode("base_head").alias("t"))
    up = lambda f: F.coalesce(F.get("base_head", F.col("t.pos").cast("int") - 2)[f], zero)
    heads = heads.select(
        "conv_id", F.col("t.pos").alias("depth"), F.col("t.f1").alias("f1"), F.col("t.f2").alias("f2"), up("f1").alias("p1"), up("f2").alias("p2"),
        F.col("t.c1").alias("c1"), F.col("t.c2").alias("c2"), F.col("t.bytes").alias("bytes"), (F.col("t.pos") == F.col("n_turns")).alias("last"),
    )
    facts = by_block(family.where("n_own > h").select("conv_id", "h", "h_base", "n_turns", "b1", "b2", "o1", "o2", "n_own"), "n_own")
    tails = turns.withColumn("block", block_of("pos")).join(facts, ["conv_id", "block"]).where("pos > h")
    tails = tails.select("conv_id", (F.col("h_base") + F.col("pos") - F.col("h")).alias("depth"), "f1", "f2", "v1", "v2", "b1", "b2", "o1", "o2", (F.col("h_base") - F.col("h")).alias("shift"), "c1", "c2", "bytes", "n_turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = batch.column(1).to_numpy()
            moved = bases.power(batch.column(10).to_numpy()) * (_lanes(batch, 2, 3) - _lanes(batch, 8, 9))
            f = _lanes(batch, 6, 7) + moved
            p = f - bases.power(depth - 1) * _lanes(batch, 4, 5)
            last = pa.array(depth == batch.column(14).to_numpy())
            columns = [batch.column(0), batch.column(1), *map(_int64, (*f, *p)), *(batch.column(i) for i in (11, 12, 13)), last]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "f1", "f2", "p1", "p2", "c1", "c2", "bytes", "last"])

    return written(root.unionByName(heads).unionByName(tails.mapInArrow(run, PATHS)), "op12-paths")


NODE = ["depth", "f1", "f2"]


def ends_digests(members: DataFrame, parts: int) -> DataFrame:
    """``(depth, f1, f2, ends_sha256)`` of the nodes at which conversations end: ids packed in order, then hashed as a stream."""
    key = [*NODE, "conv_id"]
    ends = members.where("last").select(*key).repartitionByRange(parts, *key).sortWithinPartitions(*key)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = np.stack([batch.column(i).to_numpy() for i in range(3)])
            ids = batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.r_[True, (where[:, 1:] != where[:, :-1]).any(axis=0)]) if len(ids) else np.zeros(0, int)
            step = PACK // 21  # characters of a 64-bit id and its comma
            spans = [(a, min(a + step, b)) for x, b in zip(cuts, np.r_[cuts[1:], len(ids)]) for a in range(x, b, step)]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in spans]
            at = np.array([a for a, _ in spans], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(w[at]) for w in where), pa.array(ids[at]), pa.array(texts, pa.string())], names=["depth", "f1", "f2", "first", "ids"])

    packs = ends.mapInArrow(pack, "depth long, f1 long, f2 long, first long, ids string")
    packs = packs.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def rows(done: list) -> pa.RecordBatch:
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=[*NODE, "ends_sha256"])

        for batch in batches:
            done = []
            for at, ids in zip(zip(*(batch.column(i).to_pylist() for i in range(3))), batch.column(4).to_pylist()):
                if at != node:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = at, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield rows(done)
        if node is not None:
            yield rows([(*node, sha.hexdigest())])

    return packs.mapInArrow(digest, "depth long, f1 long, f2 long, ends_sha256 string")


def owned_above(nodes: DataFrame) -> DataFrame:
    """Adds ``above``: what a node's owner owns above it; a running sum within blocks after one over blocks."""
    blocks = nodes.groupBy("conv_id", block_of("depth").alias("block")).agg(F.sum("worth").alias("worth"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("worth").over(earlier), F.lit(0)).alias("before"))
    above = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = nodes.withColumn("block", block_of("depth")).join(blocks, ["conv_id", "block"])
    return rows.withColumn("above", F.col("before") + F.coalesce(F.sum("worth").over(above), F.lit(0))).drop("block", "before")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for seed in range(8):
        bases = Bases(seed)
        turns = with_prefixes(stored_turns(conversations, bases, parts), bases)
        turns = written(turns, "op12-prefixes")
        family = written(families(turns), "op12-families")
        members = paths(turns, family, bases)
        same = lambda c: F.min(c) == F.max(c)
        nodes = members.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("bytes").alias("bytes"),
            (same("c1") & same("c2") & same("p1") & same("p2") & same("bytes")).alias("equal"),
        )
        nodes = written(nodes, "op12-nodes")
        if nodes.where("not equal").isEmpty():
            break
    else:
        raise RuntimeError("fingerprints collided under every pair of bases")

    worth = ((F.col("n_convs") - 1) * F.col("bytes")).alias("worth")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, NODE, "left").select("*", worth).withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(owned_above(nodes), "op12-sums")

    # what every conversation owns: the worth of its nodes, and a leaf if its path ends as one
    owned = nodes.groupBy("conv_id").agg(F.sum("worth").alias("owned"), F.count_if(F.col("n_children") == 0).alias("leaves")).where("owned > 0 or leaves > 0")
    owned = by_block(owned.join(family.select("conv_id", "n_turns"), "conv_id"), "n_turns").drop("n_turns")
    sums = members.select("conv_id", *NODE, block_of("depth").alias("block")).join(owned, ["conv_id", "block"])
    sums = sums.groupBy(*NODE).agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("n_leaves"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, NODE, "left").join(ends_digests(members, parts), NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("owned", F.lit(0)) - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
said AS (SELECT conv_id, turn, role AS given, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, given NULLS FIRST, digest) AS pos, digest, strlen(text) AS bytes FROM said),
c AS (SELECT conv_id, n, conv_id - conv_id % {FAMILY} AS base, {crc32_sql("conv_id::VARCHAR")} % {MAX_HEAD} AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id), crc_table),
rebuilt AS (SELECT c.conv_id, t.pos AS depth, t.digest, t.bytes FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.pos - c.h, t.digest, t.bytes
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN c AS b ON b.conv_id = c.base),
path AS (SELECT conv_id, depth, sha256(array_to_string(list(digest) OVER (PARTITION BY conv_id ORDER BY depth), ',')) AS node, bytes FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
lengths AS (SELECT conv_id, max(depth) AS n FROM path GROUP BY conv_id),
nodes AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM path JOIN lengths USING (conv_id) GROUP BY depth, node),
up AS (SELECT v.depth, v.node, p.node AS parent FROM nodes v JOIN path p ON p.conv_id = v.conv_id AND p.depth = v.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM up GROUP BY ALL),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, node)),
below AS (SELECT a.depth, a.node, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved_tokens
  FROM whole v JOIN path a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.depth, a.node)
SELECT v.conv_id::BIGINT AS conv_id, v.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
  v.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM whole v JOIN below USING (depth, node) LEFT JOIN up USING (depth, node) LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.node = up.parent
"""
