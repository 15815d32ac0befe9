"""Operator 4 — hierarchical Pitman-Yor language model with Chinese-restaurant seating.

Model.  Words follow a context: the previous word, and every previous word is a
restaurant of its own.  Those of the ``FREQUENT`` most frequent words have the word
restaurant as parent; each rarer one has the restaurant of its last two bytes (one of
``ENDINGS``) between itself and the word restaurant, whose base gives every
known word the same mass and the class of unknown words the Good-Turing share
``eta``.  A restaurant with customers c and tables t predicts
``(c_w - d t_w) / (theta + c) + (theta + d t) / (theta + c) * parent(w)``.

Rarer previous words lie in tables by home (a part of their hash), which the number of
words does not bound.  They are seated once, before the sweeps, with the words' training
shares as base; their tables are the customers of their ending's restaurant.

Sampling.  Only table counts matter to predictions.  A sweep re-seats every
(context, word) block of frequent words and endings given all others: customers sit down one by one (new
table with weight ``(theta + d t) parent(w)``; large blocks in windows),
``PROPOSALS`` times, and a Metropolis test on the seating's normaliser draws
the seating towards the block's conditional distribution.  The tables of all contexts are the customers of the word
restaurant, which is re-seated likewise.  Blocks of a sweep run in parallel
against the totals of the sweep before.  After ``BURN_IN`` sweeps the
predictions of ``SAMPLES`` sweeps are averaged.  The draws follow from the part
and the sweep alone, so a repeated task seats alike and no seating is stored.

On Spark.  (0) word counts; (1) counts of all (previous word, word) pairs, those of rarer
previous words dealt to their home and seated there; (2) types packed by word hash into parts of about
``PART_TOKENS`` tokens, with the pairs below them; each sweep is a pass over the types that sums tables
per context (``FREQUENT + ENDINGS`` numbers) and per frequent word; (3) scoring: frequent words after
frequent words (where hot keys lie) are scored in the map by a table of FREQUENT x FREQUENT numbers,
other tokens travel to the part of their word, pairs not seen in training on to the home of their previous
word, and partial sums return to the part of their document.  What is broadcast
or collected is bounded by the two parameters alone.

Defined results: a null text is empty and scores its end token; rows without a
doc_id are trained on (no remainder); repeated rows are rows; with nothing
to learn from, score and base_score are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.shared import discard, in_fold, mix, revived, span_hashes, table, text_chunks, word_spans, written

FREQUENT = 1024
ENDINGS = 256
CONTEXTS = FREQUENT + ENDINGS
BURN_IN, SAMPLES = 2, 2
PROPOSALS = 2
THETA_CONTEXT, THETA_WORD = 5.0, 1.0
PART_TOKENS = 500_000
END = np.uint64(0x5EED0E9D0C7E57A1)  # stands for the end of a text, and for what precedes its first word
STEP = np.uint64(0x9E3779B97F4A7C15)
SLICES = 3  # the documents are scored in so many slices
HELD_MERGE = 1_000_000  # types a counting task holds before it emits them
HELD_TOKENS = 500_000  # tokens a scoring task gathers before it deals them to the parts


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, ending class, row) of all tokens of the chunk; every row ends with ``END``."""
    starts, ends, bounds = word_spans(data, offs)
    h = span_hashes(data, starts, ends, lower=True)
    lower = data.copy()
    upper = (lower >= 65) & (lower <= 90)
    lower[upper] += 32
    last = lower[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, lower[ends - 2], 0).astype(np.uint64)
    ending = (mix(last * np.uint64(256) + before + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int32)
    rows = len(offs) - 1
    count = np.diff(bounds)
    row = np.repeat(np.arange(rows), count + 1)
    at_end = np.cumsum(count + 1) - 1
    word = np.full(len(row), END, dtype=np.uint64)
    klass = np.zeros(len(row), dtype=np.int32)
    real = np.ones(len(row), dtype=bool)
    real[at_end] = False
    word[real], klass[real] = h, ending
    return word, klass, row


class Frequent:
    """Numbers of the frequent words by hash (sorted)."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.sort(hashes.astype(np.uint64))

    def number(self, word: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for rarer words."""
        if not len(self.sorted):
            return np.full(len(word), -1)
        at = np.minimum(np.searchsorted(self.sorted, word), len(self.sorted) - 1)
        return np.where(self.sorted[at] == word, at, -1)

    def contexts(self, number: np.ndarray, klass: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Context of each token: its predecessor's number, or the shared restaurant of the predecessor's ending."""
        own = np.where(number >= 0, number, FREQUENT + klass)
        start = int(self.number(np.array([END]))[0])
        out = np.empty(len(own), dtype=np.int64)
        out[1:] = own[:-1]
        out[:1] = start if start >= 0 else FREQUENT
        return out  # what precedes a text is an END: the one of the row before


def part_of(word: np.ndarray, number: np.ndarray, context: np.ndarray, parts: int) -> np.ndarray:
    """Part of each type: by word, for frequent words by word and context."""
    key = np.where(number >= 0, word + (context.astype(np.uint64) + np.uint64(1)) * STEP, word)
    return (mix(key ^ np.uint64(0x7061727473)) % np.uint64(parts)).astype(np.int32)


def merged(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal keys summed, sorted by the keys in order."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    change = np.zeros(len(n), dtype=bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(change)
    return [k[first] for k in keys], np.add.reduceat(n[order], first) if len(n) else n


def word_counts(train: DataFrame) -> DataFrame:
    """(w, n): training count of every word hash, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, data, offs in text_chunks(batch.column(0)):
                w, n = np.unique(tokens(data, offs)[0], return_counts=True)
                held.append((w, n))
                size += len(w)
                if size > HELD_MERGE:
                    (w,), n = merged([np.concatenate([x[0] for x in held])], np.concatenate([x[1] for x in held]))
                    held, size = [(w, n)], len(w)
                    if size > HELD_MERGE // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["w", "n"])
                        held, size = [], 0
        if held:
            (w,), n = merged([np.concatenate([x[0] for x in held])], np.concatenate([x[1] for x in held]))
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["w", "n"])

    return written(train.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "op4-words")


COUNTS = "slot int, u array<bigint>, ctx array<smallint>, w array<bigint>, n array<bigint>"
DEALT = "part int, w array<bigint>, ctx array<smallint>, u array<bigint>, t array<bigint>, c array<int>, cu array<int>, tu array<int>"
TYPES = "part int, w array<bigint>, ctx array<smallint>, n array<bigint>, at array<int>, u array<bigint>, c array<int>, t array<int>, cu array<int>, tu array<int>"


def _packed(part: np.ndarray, columns: list[np.ndarray], names: list[str], by: str = "part") -> pa.RecordBatch | None:
    """One row per part with its elements of ``columns`` as lists."""
    if not len(part):
        return None
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    cuts = pa.array(np.r_[first, len(part)].astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(part[first]), *[pa.ListArray.from_arrays(cuts, pa.array(c[order])) for c in columns]], names=[by, *names])


def home_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Part of a document's sums or of a rarer previous word's totals."""
    return (mix(key.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)


def own_context(word: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """The previous word of each token whose previous word is rarer (it has a restaurant of its own), else 0."""
    u = np.empty_like(word)
    u[1:], u[:1] = word[:-1], END
    return np.where(ctx >= FREQUENT, u, np.uint64(0))


def _joined(group: pa.Table, names: tuple[str, ...]) -> list[np.ndarray]:
    return [np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in group.column(k).chunks]) for k in names]


def _record(part: int, schema: str, *columns: np.ndarray) -> pa.Table:
    """One row with its elements as lists."""
    names, kinds = zip(*[x.split() for x in schema.split(", ")])
    as_arrow = {"array<bigint>": pa.int64(), "array<smallint>": pa.int16(), "array<int>": pa.int32()}
    return pa.table([pa.array([part], pa.int32()), *[pa.array([c], pa.list_(as_arrow[k])) for c, k in zip(columns, kinds[1:])]], names=list(names))


def pair_counts(train: DataFrame, frequent: Frequent, parts: int) -> DataFrame:
    """Training counts of all (previous word, word) pairs, stored: by part of the word where the previous word is
    frequent (slots below ``parts``, u = 0), else by home of the previous word u (``parts`` + home)."""
    known = frequent.sorted

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Frequent(known)
        held: list[tuple] = []
        size = 0

        def emit() -> pa.RecordBatch | None:
            (u, ctx, w), n = merged([np.concatenate([x[i] for x in held]) for i in range(3)], np.concatenate([x[3] for x in held]))
            slot = np.where(u == 0, part_of(w, words.number(w), ctx, parts), home_of(u, parts) + parts).astype(np.int32)
            return _packed(slot, [u.view(np.int64), ctx.astype(np.int16), w.view(np.int64), n], ["u", "ctx", "w", "n"], "slot")

        for batch in batches:
            for _, data, offs in text_chunks(batch.column(0)):
                w, klass, _ = tokens(data, offs)
                ctx = words.contexts(words.number(w), klass, w)
                (u, ctx, w), n = merged([own_context(w, ctx), ctx, w], np.ones(len(w), dtype=np.int64))
                held.append((u, ctx, w, n))
                size += len(w)
                if size > HELD_MERGE:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()

    def join(group: pa.Table) -> pa.Table:
        u, ctx, w, n = _joined(group, ("u", "ctx", "w", "n"))
        (u, ctx, w), n = merged([u.view(np.uint64), ctx, w.view(np.uint64)], n)
        return _record(group.column("slot")[0].as_py(), COUNTS, u.view(np.int64), ctx, w.view(np.int64), n)

    packed = train.select("text").mapInArrow(count, COUNTS)
    return written(packed.groupBy("slot").applyInArrow(join, COUNTS), "op4-pairs")


def seat_own(u: np.ndarray, w: np.ndarray, n: np.ndarray, known: np.ndarray, shares: np.ndarray, rare_share: float, d: float) -> tuple[np.ndarray, ...]:
    """Tables of the pairs (u, w), sorted by u, and per previous word: first pair, customers, tables.

    Each previous word's restaurant is seated once, in order, with the words' training shares as the
    dishes' base (rarer words: their mean share).  The home and its pairs alone decide the draws.
    """
    first = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
    size = np.diff(np.r_[first, len(u)])
    number = Frequent(known).number(w)
    base = np.where(number >= 0, shares[np.maximum(number, 0)] if len(shares) else 0.0, rare_share)
    rng = np.random.default_rng([0, int(u[0]), len(u)])
    t = np.rint(tables(n, (THETA_CONTEXT + d * np.repeat(size, size)) * base, d, rng)).astype(np.int64)
    return t, first, np.add.reduceat(n, first), np.add.reduceat(t, first)


def word_types(pairs: DataFrame, parts: int, own: tuple) -> DataFrame:
    """Per part the sorted types (w, ctx) with customers n, and the pairs with a previous word of its own below each, stored.

    The customers of a type whose context is a shared ending are the tables of its pairs (``at``: their type; u;
    c customers, t tables; cu, tu: those of the whole restaurant of u).
    """
    known = own[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Frequent(known)
        for batch in batches:
            for k in range(batch.num_rows):
                slot = batch.column(0)[k].as_py()
                u, ctx, w, n = (batch.column(i)[k].values.to_numpy() for i in range(1, 5))
                if slot < parts:
                    zero = np.zeros(len(u), dtype=np.int64)
                    yield _record(slot, DEALT, w, ctx, u, n, zero, zero, zero).to_batches()[0]
                    continue
                t, first, cu, tu = seat_own(u.view(np.uint64), w.view(np.uint64), n, *own)
                size = np.diff(np.r_[first, len(u)])
                part = part_of(w.view(np.uint64), words.number(w.view(np.uint64)), ctx.astype(np.int64), parts)
                yield _packed(part, [w, ctx, u, t, *(x.astype(np.int32) for x in (n, np.repeat(cu, size), np.repeat(tu, size)))], ["w", "ctx", "u", "t", "c", "cu", "tu"])

    def join(group: pa.Table) -> pa.Table:
        w, ctx, u, t, c, cu, tu = _joined(group, ("w", "ctx", "u", "t", "c", "cu", "tu"))
        order = np.lexsort((u.view(np.uint64), ctx, w.view(np.uint64)))
        w, ctx, u, t, c, cu, tu = (x[order] for x in (w, ctx, u, t, c, cu, tu))
        first = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1])])
        at = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(w)]))
        below = np.flatnonzero(u != 0)
        return _record(group.column("part")[0].as_py(), TYPES, w[first], ctx[first], np.add.reduceat(t, first), at[below], *(x[below] for x in (u, c, t, cu, tu)))

    return written(pairs.mapInArrow(deal, DEALT).groupBy("part").applyInArrow(join, TYPES), "op4-types")


def own_totals(pairs: DataFrame, parts: int, own: tuple) -> DataFrame:
    """Per home the rarer previous words u with their customers and tables, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                u, _, w, n = (batch.column(i)[k].values.to_numpy() for i in range(1, 5))
                _, first, cu, tu = seat_own(u.view(np.uint64), w.view(np.uint64), n, *own)
                yield _record(batch.column(0)[k].as_py() - parts, "part int, u array<bigint>, cu array<bigint>, tu array<bigint>", u[first], cu, tu).to_batches()[0]

    return written(pairs.where(F.col("slot") >= parts).mapInArrow(run, "part int, u array<bigint>, cu array<bigint>, tu array<bigint>"), "op4-own")


def own_discount(pairs: DataFrame, parts: int) -> float:
    """The discount of the previous words' own restaurants, from the pairs seen once and twice."""
    seen = pairs.where(F.col("slot") >= parts).select(*[F.size(F.filter("n", lambda x, k=k: x == k)).alias(f"n{k}") for k in (1, 2)])
    got = seen.agg(F.coalesce(F.sum("n1"), F.lit(0)).alias("n1"), F.coalesce(F.sum("n2"), F.lit(0)).alias("n2")).first()
    return min(0.95, max(0.05, got.n1 / (got.n1 + 2 * got.n2))) if got.n1 + got.n2 else 0.5


def _seated(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables of ``c`` customers (>= 2) seated in order, new-table weight ``a``; and the log of the seating's normaliser.

    The first 16 customers are drawn singly, the others in windows of an eighth
    of those present, whose new tables are one binomial draw.
    """
    t = np.ones(len(c))
    norm = np.zeros(len(c))
    live = np.arange(len(c))
    for j in range(1, 16):
        live = live[c[live] > j]
        if not len(live):
            return t, norm
        total = j - d * t[live] + a[live]
        norm[live] += np.log(total)
        t[live] += rng.random(len(live)) * total < a[live]
    live = live[c[live] > 16]
    n = np.full(len(live), 16.0)
    while len(live):
        m = np.minimum(np.floor(n / 8), c[live] - n)
        stay = n + m / 2 - d * t[live]
        k = rng.binomial(m.astype(np.int64), a[live] / (stay + a[live]))
        norm[live] += m * np.log(stay - d * k / 2 + a[live])
        t[live] += k
        n = n + m
        more = n < c[live]
        live, n = live[more], n[more]
    return t, norm


def tables(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator, proposals: int = PROPOSALS) -> np.ndarray:
    """Re-seat blocks of ``c`` customers: proposals by seating in order, Metropolis test on the normaliser."""
    out = np.minimum(c, 1).astype(np.float64)
    many = np.flatnonzero(c > 1)
    if not len(many):
        return out
    c, a = c[many].astype(np.float64), a[many]
    t, norm = _seated(c, a, d, rng)
    for _ in range(1, proposals):
        new, new_norm = _seated(c, a, d, rng)
        take = np.log(1.0 - rng.random(len(c))) < new_norm - norm
        t, norm = np.where(take, new, t), np.where(take, new_norm, norm)
    out[many] = t
    return out


class State:
    """Totals that a sweep is given: bounded by FREQUENT and CONTEXTS."""

    def __init__(self, customers: np.ndarray, d: tuple[float, float], vocabulary: int, eta: float, frequent: np.ndarray):
        self.customers = customers  # per context
        self.ctx_tables = customers * 0.5  # per context; replaced by the first sweep's
        self.d_context, self.d_word = d
        self.base = (1 - eta) / max(1, vocabulary)
        self.eta = eta
        self.frequent = frequent  # hashes of the frequent words
        self.word_customers = 1.0  # of the word restaurant, all words
        self.word_tables = 0.0
        self.frequent_parent = np.zeros(len(frequent))  # parent's prediction of the frequent words
        self.sweep = 0

    def back_off(self) -> np.ndarray:
        return (THETA_CONTEXT + self.d_context * self.ctx_tables) / (THETA_CONTEXT + self.customers)

    def word_back_off(self) -> float:
        return (THETA_WORD + self.d_word * self.word_tables) / (THETA_WORD + self.word_customers)

    def parent(self, customers: np.ndarray, seats: np.ndarray) -> np.ndarray:
        return (customers - self.d_word * seats) / (THETA_WORD + self.word_customers) + self.word_back_off() * self.base


def _state(values: dict) -> State:
    return revived(State, values)


def seat_part(state: dict, w: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> dict:
    """One sweep over the types of a part (sorted by word): tables per type and, for rarer words, the word restaurant."""
    st = _state(state)
    number = Frequent(st.frequent).number(w)
    first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
    of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(w)]))
    # the part and the sweep decide all draws: a repeated task and the scoring pass seat alike
    rng = np.random.default_rng([st.sweep, int(w[0]), len(w)])

    # rarer words keep no seating between sweeps: a first visit, its parent's prediction from the word's
    # type count (the least its restaurant can hold), sets what the second visit is given
    distinct = np.add.reduceat(np.ones(len(w)), first)
    rare_parent = st.parent(distinct, np.ones(len(first)))
    before = np.where(number >= 0, st.frequent_parent[np.maximum(number, 0)] if len(st.frequent_parent) else 0.0, rare_parent[of])
    a = (THETA_CONTEXT + st.d_context * st.ctx_tables[ctx]) * before
    t = tables(n, a, st.d_context, rng, 1)
    customers = np.add.reduceat(t, first)
    rare = number[first] < 0
    weight = np.full(len(first), max((THETA_WORD + st.d_word * st.word_tables) * st.base, 1e-9))
    seats = tables(customers, weight, st.d_word, rng, 1)
    now = np.where(number >= 0, before, st.parent(customers, seats)[of])
    t = tables(n, (THETA_CONTEXT + st.d_context * st.ctx_tables[ctx]) * now, st.d_context, rng)
    customers = np.add.reduceat(t, first)
    seats = tables(customers, weight, st.d_word, rng)
    return {"t": t, "first": first, "of": of, "number": number, "rare": rare, "customers": customers, "seats": seats}


def sweep(types: DataFrame, state: State) -> State:
    """The totals after one sweep over all types."""
    spark = types.sparkSession
    shipped = spark.sparkContext.broadcast(vars(state))
    width = CONTEXTS + len(state.frequent) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for k in range(batch.num_rows):
                w, ctx, n = (batch.column(i)[k].values.to_numpy() for i in (1, 2, 3))
                s = seat_part(shipped.value, w.view(np.uint64), ctx, n)
                total[:CONTEXTS] += np.bincount(ctx, weights=s["t"], minlength=CONTEXTS)
                own = s["number"] >= 0
                total[CONTEXTS : width - 2] += np.bincount(s["number"][own], weights=s["t"][own], minlength=width - 2 - CONTEXTS)
                total[-2] += s["customers"][s["rare"]].sum()
                total[-1] += s["seats"][s["rare"]].sum()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "x"])

    total = np.zeros(width)
    for r in types.select("part", "w", "ctx", "n").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():  # at most ``width`` rows
        total[r.at] = r.x
    new = _state(vars(state))
    new.sweep = state.sweep + 1
    new.ctx_tables = total[:CONTEXTS]
    customers = np.rint(total[CONTEXTS : width - 2])
    weight = max((THETA_WORD + state.d_word * state.word_tables) * state.base, 1e-9)
    seats = tables(customers, np.full(len(customers), weight), state.d_word, np.random.default_rng([state.sweep, 1]))
    new.word_customers = total[-2] + customers.sum()
    new.word_tables = total[-1] + seats.sum()
    new.frequent_parent = new.parent(customers, seats)
    shipped.unpersist()
    return new


def fit(train: DataFrame) -> tuple[DataFrame, list[State], dict]:
    """(types, the states that the sample sweeps are given, figures) learned from all rows of ``train``."""
    words = word_counts(train)
    got = words.agg(F.count("*").alias("v"), F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    top = words.orderBy(F.desc("n"), "w").limit(FREQUENT).collect()
    counts = {r.w: r.n for r in top}
    frequent = Frequent(np.array([r.w for r in top], dtype=np.int64).view(np.uint64))
    total, vocabulary = int(got.n or 0), int(got.v)
    parts = max(1, math.ceil(total / PART_TOKENS))
    pairs = pair_counts(train, frequent, parts)
    of_top = np.array([counts[int(h)] for h in frequent.sorted.view(np.int64)], dtype=np.int64)
    rare_share = (total - int(of_top.sum())) / max(1, vocabulary - len(of_top)) / max(1, total)
    own = (frequent.sorted, of_top / max(1, total), rare_share, own_discount(pairs, parts))
    types, totals = word_types(pairs, parts, own), own_totals(pairs, parts, own)
    discard(words, pairs)  # the types hold all that is read of them from here on
    flat = types.select(F.explode(F.arrays_zip("ctx", "n")).alias("x")).select("x.ctx", "x.n")
    per_ctx = flat.groupBy("ctx").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.count("*").alias("types")).collect()
    customers, kinds = np.zeros(CONTEXTS), np.zeros(CONTEXTS)
    for r in per_ctx:  # at most CONTEXTS rows
        customers[r.ctx], kinds[r.ctx] = r.n, r.types
    n1, n2 = sum(r.n1 for r in per_ctx), sum(r.n2 for r in per_ctx)
    d = tuple(min(0.95, max(0.05, x / (x + 2 * y))) if x + y else 0.5 for x, y in ((n1, n2), (got.n1, got.n2)))
    eta = min(0.95, got.n1 / (d[0] * d[1] * vocabulary)) if vocabulary else 1.0
    state = State(customers, d, vocabulary, max(eta, 1e-3), frequent.sorted)
    # start: one table per type
    state.ctx_tables = kinds
    state.word_customers, state.word_tables = float(kinds.sum()) or 1.0, float(vocabulary)
    state.frequent_parent = np.array([counts[int(np.int64(np.uint64(h).view(np.int64)))] for h in frequent.sorted], dtype=float) / max(1, total)
    states = [state]
    for _ in range(BURN_IN + SAMPLES):
        states.append(sweep(types, states[-1]))
    figures = {"train_tokens": total, "vocabulary": vocabulary, "counts": of_top, "parts": parts, "frequent": frequent.sorted, "d_own": own[3], "own_totals": totals}
    return types, states, figures


def _predict(samples: list[tuple[dict, dict]], w: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own share per type, parent's prediction per sample and word, first type per word); ``samples``: states given to and left by a sweep."""
    own, parents, first = np.zeros(len(w)), [], None
    for given, left in samples:
        s = seat_part(given, w, ctx, n)
        st = _state(left)
        own += np.maximum(n - st.d_context * s["t"], 0.0) / (THETA_CONTEXT + st.customers[ctx]) / len(samples)
        parents.append(st.parent(s["customers"], s["seats"]))
        first = s["first"]
    return own, np.array(parents), first


def score(docs: DataFrame, types: DataFrame, states: list[State], figures: dict) -> DataFrame:
    """(row_id, doc_id, n_tokens, n_known, base_score, score) per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    pairs = [(vars(a), vars(b)) for a, b in list(zip(states[:-1], states[1:]))[BURN_IN:]]
    back_off = np.array([_state(b).back_off() for _, b in pairs])  # (samples, contexts)
    unknown = np.array([_state(b).word_back_off() * b["eta"] for _, b in pairs])
    total, vocabulary, parts = figures["train_tokens"], figures["vocabulary"], figures["parts"]
    floor = 1.0 / (total + vocabulary + 1)
    frequent = figures["frequent"]
    shipped = spark.sparkContext.broadcast(pairs)

    # frequent words after frequent words: FREQUENT x FREQUENT numbers
    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Frequent(frequent)
        for batch in batches:
            for k in range(batch.num_rows):
                w, ctx, n = (batch.column(i)[k].values.to_numpy() for i in (1, 2, 3))
                number = words.number(w.view(np.uint64))
                if ((number >= 0) & (ctx < FREQUENT)).any():
                    own, _, _ = _predict(shipped.value, w.view(np.uint64), ctx, n)
                    some = np.flatnonzero((number >= 0) & (ctx < FREQUENT))
                    yield pa.RecordBatch.from_arrays([pa.array(number[some]), pa.array(ctx[some].astype(np.int64)), pa.array(own[some])], names=["number", "ctx", "own"])

    got = types.select("part", "w", "ctx", "n").mapInArrow(shares, "number long, ctx long, own double").toPandas()
    dense = np.zeros((len(frequent), FREQUENT))
    dense[got["number"], got["ctx"]] = got["own"]
    for k, (_, left) in enumerate(pairs):
        dense += left["frequent_parent"][:, None] * back_off[k][None, :FREQUENT] / len(pairs)
    dense_bc = spark.sparkContext.broadcast((np.log10(np.maximum(dense, 1e-300)), np.log10((figures["counts"] + 1) * floor)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Frequent(frequent)
        logs, base = dense_bc.value
        held: list[list[np.ndarray]] = []
        size = 0

        def row_of(found: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([found.column(x) if x in found.schema.names else pa.nulls(found.num_rows, ROW_KINDS[x]) for x in ROW_KINDS], names=list(ROW_KINDS))

        def dealt() -> pa.RecordBatch:
            part, *columns = (np.concatenate(x) for x in zip(*held))
            return row_of(_packed(part, columns, ["row_id", "w", "ctx", "u"]))

        for batch in batches:
            rows, ids = batch.column(1).to_numpy(), batch.column(2)
            for at, data, offs in text_chunks(batch.column(0)):
                w, klass, row = tokens(data, offs)
                number = words.number(w)
                ctx = words.contexts(number, klass, w)
                known = number >= 0
                count = len(offs) - 1
                each = rows[at : at + count]
                f, direct = np.flatnonzero(known), np.flatnonzero(known & (ctx < FREQUENT))
                sums = [
                    np.bincount(row, minlength=count),
                    np.bincount(row[f], minlength=count),
                    np.bincount(row[f], weights=base[number[f]] if len(f) else None, minlength=count).astype(float),
                    np.bincount(row[direct], weights=logs[number[direct], ctx[direct]] if len(direct) else None, minlength=count).astype(float),
                ]
                r = np.flatnonzero(~known | (ctx >= FREQUENT))
                if len(r):
                    # gathered over chunks, so that the rows that travel stay long however many parts there are
                    held.append([part_of(w[r], number[r], ctx[r], parts), each[row[r]], w[r].view(np.int64), ctx[r].astype(np.int16), own_context(w, ctx)[r].view(np.int64)])
                    size += len(r)
                home = home_of(each, parts)
                own_ids = np.asarray(ids.slice(at, count).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
                known_ids = ids.slice(at, count).is_valid().to_numpy(zero_copy_only=False)
                documents = _packed(home, [each, own_ids, known_ids, *[s.astype(np.int32) for s in sums[:2]], *sums[2:]], ["row_id", "doc_id", "has_id", "n_tokens", "n_known", "base", "score"])
                if documents is not None:
                    yield row_of(documents)
                if size >= HELD_TOKENS:
                    yield dealt()
                    held, size = [], 0
        if held:
            yield dealt()

    ROW_KINDS = {
        "part": pa.int32(), "row_id": pa.list_(pa.int64()), "w": pa.list_(pa.int64()), "ctx": pa.list_(pa.int16()), "u": pa.list_(pa.int64()), "doc_id": pa.list_(pa.int64()), "has_id": pa.list_(pa.bool_()),
        "n_tokens": pa.list_(pa.int32()), "n_known": pa.list_(pa.int32()), "base": pa.list_(pa.float64()), "score": pa.list_(pa.float64()), "part_score": pa.list_(pa.float32()),
    }
    spread_schema = "part int, row_id array<bigint>, w array<bigint>, ctx array<smallint>, u array<bigint>, doc_id array<bigint>, has_id array<boolean>, n_tokens array<int>, n_known array<int>, base array<double>, score array<double>, part_score array<float>"

    def flat(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
        parts_of = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks if len(c)]
        return np.concatenate(parts_of).astype(dtype) if parts_of else np.zeros(0, dtype)

    def look_up(found: pa.Table, known: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        docs_of = found.filter(pc.is_null(found.column("w")))
        rows = found.filter(pc.is_valid(found.column("w")))
        row, w, ctx = flat(rows.column("row_id"), np.int64), flat(rows.column("w"), np.int64).view(np.uint64), flat(rows.column("ctx"), np.int64)
        u = flat(rows.column("u"), np.int64).view(np.uint64)
        logp, basep, hit, missed = _score_tokens(shipped.value, known, w, ctx, u, back_off, unknown, floor, figures_own)
        each, of = np.unique(row, return_inverse=True)
        # the sums go to the part of their document, packed like everything that travels
        home = home_of(each, parts)
        sums = [np.bincount(of, weights=x, minlength=len(each)) for x in (hit, basep, logp)]
        packed = _packed(home, [each, sums[0].astype(np.int32), sums[1], sums[2].astype(np.float32)], ["row_id", "n_known", "base", "part_score"])
        out = [docs_of.select(list(SUM_KINDS)).cast(pa.schema(SUM_KINDS))]
        # pairs not seen in training: what the previous word passes on to its ending is known at its home
        m = np.flatnonzero(missed)
        for found_here in (packed, _packed(home_of(u[m], parts), [row[m], u[m].view(np.int64)], ["row_id", "u"])):
            if found_here is not None:
                out.append(pa.table({x: found_here.column(x) if x in found_here.schema.names else pa.nulls(found_here.num_rows, kind) for x, kind in SUM_KINDS.items()}))
        return pa.concat_tables(out)

    def pass_on(asked: pa.Table, known: pa.Table) -> pa.Table:
        row, u = flat(asked.column("row_id"), np.int64), flat(asked.column("u"), np.int64).view(np.uint64)
        gain = np.zeros(len(u))
        if known.num_rows and len(u):
            ku, cu, tu = flat(known.column("u"), np.int64).view(np.uint64), flat(known.column("cu"), float), flat(known.column("tu"), float)
            at = np.minimum(np.searchsorted(ku, u), len(ku) - 1)
            gain = np.where(ku[at] == u, np.log10((THETA_CONTEXT + figures_own[0] * tu[at]) / (THETA_CONTEXT + cu[at])), 0.0)
        each, of = np.unique(row, return_inverse=True)
        none = np.zeros(len(each))
        packed = _packed(home_of(each, parts), [each, none.astype(np.int32), none, np.bincount(of, weights=gain, minlength=len(each)).astype(np.float32)], ["row_id", "n_known", "base", "part_score"])
        rows = 0 if packed is None else packed.num_rows
        return pa.table({x: packed.column(x) if rows and x in packed.schema.names else pa.nulls(rows, kind) for x, kind in SUM_KINDS.items()})

    def total(group: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        docs_of = group.filter(pc.is_valid(group.column("n_tokens")))
        row, doc = flat(docs_of.column("row_id"), np.int64), flat(docs_of.column("doc_id"), np.int64)
        order = np.argsort(row)
        docs_first = pa.concat_tables([docs_of, group.filter(pc.is_null(group.column("n_tokens")))])
        spot = order[np.searchsorted(row[order], flat(docs_first.column("row_id"), np.int64))]
        scores = np.r_[flat(docs_of.column("score"), float), flat(docs_first.column("part_score"), float)]
        sums = [np.bincount(spot, weights=x, minlength=len(row)) for x in (flat(docs_first.column("n_known"), float), flat(docs_first.column("base"), float), scores)]
        has_id = flat(docs_of.column("has_id"), bool)
        columns = [row, pa.array(doc, mask=~has_id), flat(docs_of.column("n_tokens"), np.int64), sums[0].astype(np.int64), *sums[1:]]
        return pa.table([pa.array(c) for c in columns], names=["row_id", "doc_id", "n_tokens", "n_known", "base_score", "score"])

    SUM_KINDS = {x: kind for x, kind in ROW_KINDS.items() if x not in ("w", "ctx")}
    figures_own = (figures["d_own"], frequent)
    rows = docs.select("text", F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"))
    sum_schema = "part int, row_id array<bigint>, u array<bigint>, doc_id array<bigint>, has_id array<boolean>, n_tokens array<int>, n_known array<int>, base array<double>, score array<double>, part_score array<float>"
    # tokens take more disk on their way than the texts: a slice of the documents at a time, its shuffle files go with it
    partial = None
    for at in range(SLICES):
        moved = rows.where(F.pmod("row_id", F.lit(SLICES)) == at).mapInArrow(spread, spread_schema).groupBy("part").cogroup(types.groupBy("part"))
        sums = written(moved.applyInArrow(look_up, sum_schema), "op4-sums")
        partial = sums if partial is None else partial.union(sums)
    passed = partial.where("u is not null").groupBy("part").cogroup(figures["own_totals"].groupBy("part")).applyInArrow(pass_on, sum_schema)
    return partial.where("u is null").unionByName(passed).groupBy("part").applyInArrow(total, "row_id long, doc_id long, n_tokens long, n_known long, base_score double, score double")


def _score_tokens(
    pairs: list, known: pa.Table, w: np.ndarray, ctx: np.ndarray, u: np.ndarray, back_off: np.ndarray, unknown: np.ndarray, floor: float, own_level: tuple
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(log10 model probability, log10 base probability, rarer word is known, pair with a rarer previous word is not) of tokens, given the types of their part.

    Frequent words (after rarer ones) count nothing in the second and third: their base is summed in the map.
    """
    d_own, frequent = own_level
    number = Frequent(frequent).number(w)
    above = np.repeat(unknown[:, None], len(w), axis=1)  # the word restaurant's prediction, per sample
    for k, (_, left) in enumerate(pairs):
        if (number >= 0).any():
            above[k] = np.where(number >= 0, left["frequent_parent"][np.maximum(number, 0)], above[k])
    p = (back_off[:, ctx] * above).mean(axis=0)
    base = np.where(number >= 0, 1.0, floor)
    hit = np.zeros(len(w), dtype=bool)
    missed = u != 0
    if known.num_rows and len(w):
        tw, tc, n = (np.concatenate([c.flatten().to_numpy() for c in known.column(k).chunks]) for k in ("w", "ctx", "n"))
        tw = tw.view(np.uint64)
        own, parents, first = _predict(pairs, tw, tc, n)
        word = tw[first]
        below, ku, kc, kt, cu, tu = (np.concatenate([c.flatten().to_numpy() for c in known.column(k).chunks]) for k in ("at", "u", "c", "t", "cu", "tu"))
        total = np.add.reduceat(np.where(tc < FREQUENT, n, 0) + np.bincount(below, weights=kc, minlength=len(tw)), first)
        at = np.minimum(np.searchsorted(word, w), len(word) - 1)
        here = word[at] == w
        hit = here & (number < 0)
        base = np.where(hit, (total[at] + 1) * floor, base)
        p = np.where(hit, (back_off[:, ctx] * parents[:, at]).mean(axis=0), p)
        # the token's own type: contexts of a word are sorted behind its first type
        code = at * CONTEXTS + ctx
        type_code = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(tw)])) * CONTEXTS + tc
        spot = np.minimum(np.searchsorted(type_code, code), len(type_code) - 1)
        mine = here & (type_code[spot] == code)
        p = p + np.where(mine, own[spot], 0.0)
        # the pair itself, below its type
        if len(ku):
            key = mix(ku.view(np.uint64) + (below.astype(np.uint64) + np.uint64(1)) * STEP)
            order = np.argsort(key)
            place = order[np.minimum(np.searchsorted(key[order], mix(u + (spot.astype(np.uint64) + np.uint64(1)) * STEP)), len(key) - 1)]
            pair = mine & (u != 0) & (ku.view(np.uint64)[place] == u) & (below[place] == spot)
            with_own = (np.maximum(kc - d_own * kt, 0.0)[place] + (THETA_CONTEXT + d_own * tu[place]) * p) / (THETA_CONTEXT + cu[place])
            p = np.where(pair, with_own, p)
            missed = missed & ~pair
    return np.log10(np.maximum(p, 1e-300)), np.log10(base), hit, missed


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 7, 2)
    types, states, figures = fit(docs.where(~held_out))
    out = score(docs, types, states, figures)
    if not figures["vocabulary"]:
        out = out.withColumns({"base_score": F.lit(0.0), "score": F.lit(0.0)})
    return out.select(
        "doc_id", in_fold(F.col("doc_id"), 7, 2).alias("held_out"), "n_tokens", "n_known", F.lit(figures["train_tokens"]).cast("long").alias("train_tokens"), "base_score", "score"
    )
