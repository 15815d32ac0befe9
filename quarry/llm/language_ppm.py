"""Operator 9 — language identification by prediction by partial matching (PPM).

Per language a byte context tree of orders 0 to ``ORDER`` is counted on a
bounded sample of labelled rows and then frozen.  The code length of a byte
after its context follows escape method C without exclusions: in a context
seen ``n`` times with ``d`` distinct followers, a follower seen ``k`` times
costs ``-log2 k/(n+d)`` and an escape to the next shorter context
``-log2 d/(n+d)``; an unseen context escapes for nothing; below order 0 all
256 bytes are equally likely.  A text goes to the language with the least
total code length over all its bytes (ties: the smaller language name).

Statistics are frozen, so the code length of every (context, byte) pair seen in
training is computed once: bytes become symbols (each byte seen in training, and
one for all others), contexts and pairs that occur in training get row numbers.  A
byte whose pair was seen takes one gather under all languages; otherwise the
context's escapes are added and the shorter context is asked.  Only seen contexts
and pairs are stored, so the size follows the sample, not contexts x alphabet x languages.

Sample bound: ``ROWS_PER_LANG`` rows per language, those of smallest hash of
``doc_id``; their n-gram counts are added up by Spark, texts are never
collected.

Defined results: null text or text without a letter is ``und`` with score 0;
rows without a language or id are never learned from but predicted; with
nothing to learn from every row is ``und``; repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import in_fold, revived, table, text_chunks

ORDER = 3
ROWS_PER_LANG = 400
UND = "und"
#: (byte, language) cells scored at once.
CELLS = 4 << 20
#: Bytes of text scored together, and rows of a batch handed on together: what a worker holds beside its model and its batch.
SCORED_BYTES = 1 << 18
SCORED_ROWS = 1024


def sample_rows(train: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> DataFrame:
    """(lang, text): per language the rows of smallest id hash; ids are ranked without their texts."""
    labelled = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    chosen = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("hash"))
    # first within 64 slices of a language, then among their winners: no task sees more than a slice's candidates
    for keys in (["lang", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(64))], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("hash", "doc_id")
        chosen = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows_per_lang).drop("rank")
    chosen = chosen.select("lang", "doc_id").distinct()  # at most languages x rows_per_lang ids
    return labelled.select("lang", "doc_id", "text").join(F.broadcast(chosen), ["lang", "doc_id"], "left_semi").select("lang", "text")


def ngram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): counts of all ``order + 1``-byte strings, padded in front with zero bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for at, data, offs in text_chunks(batch.column(1)):
                grams, _ = _grams(data, offs, order)
                owner = np.repeat(langs[at : at + len(offs) - 1], np.diff(offs))
                for lang in np.unique(owner.astype(str)) if len(owner) else []:
                    g, n = np.unique(grams[owner == lang], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    out = rows.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return out.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _grams(data: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: it and the ``order`` bytes before it in its text (zero bytes before the start) as one number."""
    wide = data.astype(np.uint32)
    gram = wide.copy()
    place = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
    for j in range(1, order + 1):
        back = np.zeros(len(data), dtype=np.uint32)
        back[j:] = wide[: len(data) - j] if j < len(data) else 0
        back[place < j] = 0
        gram |= back << np.uint32(8 * j)
    return gram, place


class ContextTrees:
    """Frozen code lengths of all languages, from (lang, gram, n) counts."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int = ORDER):
        if not 1 <= order <= 3:
            raise ValueError("order is 1, 2 or 3")
        self.langs, self.order = langs, order
        seen = sorted({0, *np.unique(gram & 0xFF).tolist()})
        self.width = a = len(seen) + 1  # symbol 0: a byte not seen in training
        self.symbol = np.zeros(256, dtype=np.int32)
        self.symbol[seen] = np.arange(1, a)
        syms = [self.symbol[(gram >> (8 * j)) & 0xFF].astype(np.int64) for j in range(order + 1)]  # 0: the byte, j: j before
        #: By order: context code -> row, (context row, symbol) -> pair row (-1: not seen), bits of escapes and of pairs by language.
        self.rows: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.escape: list[np.ndarray] = []
        self.cost: list[np.ndarray] = []
        for k in range(order + 1):
            code = np.zeros(len(gram), dtype=np.int64)
            for j in range(k, 0, -1):
                code = code * a + syms[j]
            pair, of = np.unique(code * a + syms[0], return_inverse=True)
            hits = np.zeros((len(pair), len(langs)))
            np.add.at(hits, (of, lang), n)
            context, first, row = np.unique(pair // a, return_index=True, return_inverse=True)
            total = np.add.reduceat(hits, first, axis=0) if len(first) else hits
            kinds = np.add.reduceat((hits > 0).astype(float), first, axis=0) if len(first) else hits
            known = total > 0
            whole = np.where(known, total + kinds, 1.0)
            escape = np.where(known, -np.log2(np.where(known, kinds, 1.0) / whole), 0.0)
            # the shorter context drops the oldest symbol; its pair was seen wherever this one was
            short = self.cost[k - 1][self.pairs[k - 1][self.rows[k - 1][pair // a % a ** (k - 1)], pair % a]] if k else 8.0
            direct = -np.log2(np.where(hits > 0, hits, 1.0) / whole[row])
            self.cost.append(np.where(hits > 0, direct, escape[row] + short).astype(np.float32))
            self.escape.append(escape.astype(np.float32))
            self.rows.append(np.full(a**k, -1, dtype=np.int32))
            self.rows[k][context] = np.arange(len(context))
            self.pairs.append(np.full((len(context), a), -1, dtype=np.int32))
            self.pairs[k][row, pair % a] = np.arange(len(pair))

    def _bits(self, code: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """(bytes, languages): bits of every byte after its context."""
        bits = np.zeros((len(sym), len(self.langs)), dtype=np.float32)
        left = np.arange(len(sym))
        for k in range(self.order, -1, -1):
            row = self.rows[k][code[left] % self.width**k]
            seen = row >= 0
            pair = np.full(len(left), -1, dtype=np.int32)
            pair[seen] = self.pairs[k][row[seen], sym[left[seen]]]
            hit = pair >= 0
            bits[left[hit]] += self.cost[k][pair[hit]]
            out = seen & ~hit
            bits[left[out]] += self.escape[k][row[out]]
            left = left[~hit]
        bits[left] += 8.0
        return bits

    def code_lengths(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """(rows, languages): bits of each whole text, ``CELLS`` (byte, language) cells at a time."""
        out = np.zeros((len(offs) - 1, len(self.langs)))
        if not len(data):
            return out
        sym = self.symbol[data].astype(np.int64)
        place = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
        pad = self.symbol[0]
        code = np.zeros(len(data), dtype=np.int64)
        for j in range(self.order, 0, -1):
            back = np.full(len(data), pad, dtype=np.int64)
            back[j:] = sym[: len(data) - j] if j < len(data) else pad
            back[place < j] = pad
            code = code * self.width + back
        step = max(1, CELLS // max(1, len(self.langs)))
        for at in range(0, len(data), step):
            bits = self._bits(code[at : at + step], sym[at : at + step])
            cuts = np.clip(offs - at, 0, len(bits))
            some = np.flatnonzero(np.diff(cuts))
            out[some] += np.add.reduceat(bits, cuts[:-1][some], axis=0, dtype=np.float64)
        return out


def train(rows: DataFrame, rows_per_lang: int = ROWS_PER_LANG, order: int = ORDER) -> ContextTrees:
    """Fit on the bounded sample; what reaches the driver is its n-gram counts."""
    got = ngram_counts(sample_rows(rows, rows_per_lang), order).toArrow().combine_chunks()
    label = got.column("lang").combine_chunks().dictionary_encode()
    label = label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label
    names = label.dictionary.to_pylist()
    langs = sorted(names)
    lang = np.array([langs.index(x) for x in names], dtype=np.int64)[label.indices.to_numpy()] if langs else np.zeros(0, np.int64)
    return ContextTrees(langs, lang, got.column("gram").to_numpy(), got.column("n").to_numpy().astype(float), order)


def identify(df: DataFrame, trees: ContextTrees, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but ``text``) plus lang_pred, score (posterior under equal priors), bits_per_byte of the best language.

    An input column with an output's name gives way to the output.  ``text`` may be
    a field of a struct column.
    """
    shipped = df.sparkSession.sparkContext.broadcast(vars(trees))  # bounded by the sample
    made = ("lang_pred", "score", "bits_per_byte")
    keep = [c for c in (keep or df.columns) if c not in (text, *made)]
    # a text inside a kept struct travels with it, not a second time beside it
    holder, _, inner = text.partition(".")
    inside = bool(inner) and holder in keep
    given = F.lit(None).cast("string") if inside else F.col(text)
    slim = df.select(given.alias("t"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"), *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep])
    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType()), *slim.schema.fields[2:]])
    at_text = 2 + keep.index(holder) if inside else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = revived(ContextTrees, shipped.value)
        names = np.array([*model.langs, UND], dtype=object)
        for whole in batches:
            for top in range(0, whole.num_rows, SCORED_ROWS):
                batch = whole.slice(top, SCORED_ROWS)
                n = batch.num_rows
                best = np.full(n, len(model.langs))
                score, per_byte = np.zeros(n), np.zeros(n)
                letter = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                if model.langs:
                    texts = pc.struct_field(batch.column(at_text), inner) if inside else batch.column(0)
                    for at, data, offs in text_chunks(texts, SCORED_BYTES):
                        bits = model.code_lengths(data, offs)
                        where = slice(at, at + len(bits))
                        win = bits.argmin(axis=1)
                        least = bits.min(axis=1)
                        best[where] = win
                        score[where] = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                        per_byte[where] = least / np.maximum(1, np.diff(offs))
                    best[~letter], score[~letter] = len(model.langs), 0.0
                yield pa.RecordBatch.from_arrays([pa.array(names[best], pa.string()), pa.array(score), pa.array(per_byte), *batch.columns[2:]], names=["lang_pred", "score", "bits_per_byte", *batch.schema.names[2:]])

    out = slim.mapInArrow(run, schema)
    return out.select(*[F.col(f"`k_{c}`").alias(c) for c in keep], *made)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    trees = train(docs.where(~held_out))
    out = identify(docs.select("doc_id", held_out.alias("held_out"), "text"), trees)
    return out.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
