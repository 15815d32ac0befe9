"""Operator 3 — SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

``PieceModel`` holds the vocabulary of a BPE model as arrays: a sorted table
of joinable pairs with the rank of the piece they make.  A text becomes
words (a run of the space sign and what follows it; no piece crosses such a
border), equal words of a batch are encoded once, and all new words are
encoded together on flat symbol arrays:

* per round, the segmented minimum of the pair ranks gives each word its best pair;
* all leftmost non-overlapping occurrences of that pair are joined at once —
  only the first one when the joined piece could take part in a better pair
  right away, so the outcome is that of one-by-one merging;
* symbols are compacted, finished words leave, until no word has a pair.

If a word has more than ``LONG_WORD`` symbols, words are first cut between characters that
no piece holds side by side.  In what is still longer, the segments of a round are windows: a pair joins when no
better one starts within ``reach`` symbols of it.  A joined symbol grows over at most the
longest piece, and ``reach`` is over twice that, so nothing that one-by-one merging
does earlier touches the pair or what it grows into, and the outcome is the same; a
long word takes rounds by its pieces, not by its length (``_join_windows``).

Pieces made of space signs alone share one score, the lowest; they are built
last, run by run (:meth:`PieceModel.space_run`).  Characters outside the
vocabulary become byte pieces.  Decoding gathers piece bytes by id.

Defined results: a null text is an empty text; an empty text has no ids and
decodes to an empty text; other columns of the input are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import revived, table

SPACE = "▁"
NO_RANK = np.int64(1 << 40)
#: Words (between characters that pieces join) of more symbols are merged by windows.
LONG_WORD = 256
#: Encoded words kept per task; the memory bound of the cache, not of the result.
CACHE_WORDS = 250_000


def _hash_levels(keys: np.ndarray, ranks: np.ndarray, bits: int = 18) -> list[tuple]:
    """Lookup tables (multiplier, shift, keys by slot, ranks by slot); keys that lose their slot go to the next table."""
    levels = []
    mult = 0x9E3779B97F4A7C15
    while len(keys):
        mult = (mult * 0xD1342543DE82EF95 + 2) & ((1 << 64) - 1) | 1
        slot = (keys.view(np.uint64) * np.uint64(mult)) >> np.uint64(64 - bits)
        _, first = np.unique(slot, return_index=True)
        by_key, by_rank = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        by_key[slot[first]], by_rank[slot[first]] = keys[first], ranks[first]
        levels.append((np.uint64(mult), np.uint64(64 - bits), by_key, by_rank))
        rest = np.ones(len(keys), dtype=bool)
        rest[first] = False
        keys, ranks, bits = keys[rest], ranks[rest], max(12, bits - 3)
    return levels


def _window_min(values: np.ndarray, reach: int) -> np.ndarray:
    """Minimum over the ``reach`` places on either side of each place, by doubling."""
    out = np.pad(values, reach, constant_values=NO_RANK)
    width, done = 2 * reach + 1, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


class PieceModel:
    """Vocabulary arrays of a SentencePiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int]):
        self.pieces = pieces
        self.size = len(pieces)
        normal = {p: i for i, p in enumerate(pieces) if kinds[i] == 1}
        self.byte_id = np.array([pieces.index(f"<0x{b:02X}>") for b in range(256)])
        runs = {len(p): i for p, i in normal.items() if set(p) == {SPACE}}
        if any(SPACE in p[1:] and set(p) != {SPACE} for p in normal):
            raise ValueError("a piece crosses the border of a word")
        self.run_id = runs
        # characters inside pieces that are no pieces themselves get ids past the vocabulary
        extra = sorted({c for p in normal for c in p} - set(normal))
        self.char_id = {c: i for c, i in normal.items() if len(c) == 1}
        self.char_id.update({c: self.size + k for k, c in enumerate(extra)})
        self.extra = extra
        symbols = dict(normal)
        symbols.update(self.char_id)
        inner = {p: i for p, i in normal.items() if len(p) > 1 and set(p) != {SPACE}}
        order = {s: r for r, s in enumerate(sorted({-scores[i] for i in inner.values()}))}
        rank = {i: order[-scores[i]] for i in inner.values()}
        if len(order) != len(inner):
            raise ValueError("two pieces share a score")
        self.width = self.size + len(extra) + 1
        keys, ranks = [], []
        follow = np.full(self.width, NO_RANK)
        for p, i in inner.items():
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    ranks.append(rank[i])
                for part in (a, b):
                    if part is not None:
                        follow[part] = min(follow[part], rank[i])
        self.levels = _hash_levels(np.array(keys, dtype=np.int64), np.array(ranks, dtype=np.int64))
        self.unsafe = np.zeros(len(inner), dtype=bool)  # by rank: the joined piece may have a better pair
        self.piece_of_rank = np.zeros(len(inner), dtype=np.int64)
        for i, r in rank.items():
            self.unsafe[r] = follow[i] <= r
            self.piece_of_rank[r] = i
        self.reach = 2 * max(map(len, pieces)) + 2
        # neighbours within a piece, as symbols of single characters; no merge crosses any others
        codes = sorted({self.char_id[p[k]] * self.width + self.char_id[p[k + 1]] for p in inner for k in range(len(p) - 1)})
        self.bonds = np.array(codes, dtype=np.int64)
        self.splits_lines = not any("\n" in p and len(p) > 1 for p in normal)
        self.words = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if self.splits_lines else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        # decoding
        blobs = []
        for i, p in enumerate(pieces):
            if kinds[i] == 6:
                blobs.append(bytes([int(p[3:5], 16)]))
            elif kinds[i] == 1:
                blobs.append(p.replace(SPACE, " ").encode())
            else:
                blobs.append(b"" if kinds[i] == 3 else " ⁇ ".encode())
        self.blob = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        self.blob_len = np.array([len(b) for b in blobs])
        self.blob_at = np.cumsum(self.blob_len) - self.blob_len
        self.control = np.array([k == 3 for k in kinds])
        self.starts_with_space = np.array([p.startswith(SPACE) and kinds[i] == 1 for i, p in enumerate(pieces)])

    @classmethod
    def load(cls, path: str) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models with identity normalisation and a dummy prefix")
        return cls([p.piece for p in model.pieces], [p.score for p in model.pieces], [p.type for p in model.pieces])

    def space_run(self, n: int) -> list[int]:
        """Pieces of ``n`` space signs, all of one score: always the leftmost pair that makes a piece."""
        longest = max(self.run_id)
        out = []
        while n > 4 * longest:
            out.append(self.run_id[longest])
            n -= longest
        left = [1] * n
        while True:
            at = next((i for i in range(len(left) - 1) if left[i] + left[i + 1] in self.run_id), None)
            if at is None:
                return out + [self.run_id[k] for k in left]
            left[at : at + 2] = [left[at] + left[at + 1]]

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol (NO_RANK: none)."""
        out = np.full(len(sym), NO_RANK)
        if len(sym) < 2:
            return out
        key = np.where((word[1:] == word[:-1]) & (sym[:-1] >= 0) & (sym[1:] >= 0), sym[:-1] * self.width + sym[1:], -1)
        at = np.flatnonzero(key >= 0)
        out[at] = self._rank_of(key[at])
        return out

    def _rank_of(self, key: np.ndarray) -> np.ndarray:
        out = np.full(len(key), NO_RANK)
        for mult, shift, keys, ranks in self.levels:
            slot = (key.view(np.uint64) * mult) >> shift
            hit = np.flatnonzero(keys[slot] == key)
            out[hit] = ranks[slot[hit]]
        return out

    def _grows(self, sym: np.ndarray, pos: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Whether the pieces joined at ``pos`` have a better pair with a neighbour, or with their own kind."""
        made = self.piece_of_rank[rank]
        padded = np.r_[-1, sym, -1]
        grows = self._rank_of(made * self.width + made) <= rank
        for a, b in ((padded[pos], made), (made, padded[pos + 3])):
            grows |= (a >= 0) & (b >= 0) & (self._rank_of(np.maximum(a, 0) * self.width + np.maximum(b, 0)) <= rank)
        return grows

    def _cut(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment of each symbol, word of each segment): words cut where no piece holds both neighbours."""
        if not len(sym):
            return sym, word
        key = np.where((sym[:-1] >= 0) & (sym[1:] >= 0), sym[:-1] * self.width + sym[1:], -1)
        at = np.minimum(np.searchsorted(self.bonds, key), len(self.bonds) - 1)
        cut = np.r_[True, (word[1:] != word[:-1]) | (self.bonds[at] != key)]
        return np.cumsum(cut) - 1, word[cut]

    def _join_windows(self, sym: np.ndarray) -> np.ndarray:
        """Merges one long word: all pairs that are the best within ``reach`` symbols on either side join at once."""
        one_word = np.zeros(len(sym), dtype=np.int8)
        while True:
            rank = self._pairs(sym, one_word[: len(sym)])
            best = _window_min(rank, self.reach)
            if len(best) == 0 or rank.min() >= NO_RANK:
                return sym
            place = np.arange(len(rank))
            ready = (rank == best) & (rank < NO_RANK)
            # equal pairs side by side overlap: every second one, from the first, once that one is ready
            first = np.r_[True, rank[1:] != rank[:-1]]
            start = np.maximum.accumulate(np.where(first, place, 0))
            ready &= ready[start] & ((place - start) % 2 == 0)
            # an equal pair within reach on the left may grow into a better one first: wait for it
            risky = ready & self.unsafe[np.where(ready, rank, 0)]
            if risky.any():
                grows = rank < NO_RANK
                grows[ready | (np.r_[False, ready[:-1]] & ~first)] = False  # the second of an overlap goes with the first
                grows[risky] = self._grows(sym, np.flatnonzero(risky), rank[risky])
                order = np.argsort(rank, kind="stable")
                before = np.r_[-1, np.maximum.accumulate(np.where(grows[order], place, -1))[:-1]]
                left = order[np.maximum(before, 0)]
                waits = np.zeros(len(rank), dtype=bool)
                waits[order] = (before >= 0) & (rank[left] == rank[order]) & (order - left <= self.reach)
                ready &= ~(risky & waits)
            pos = np.flatnonzero(ready)
            sym = sym.copy()
            sym[pos] = self.piece_of_rank[rank[pos]]
            stay = np.ones(len(sym), dtype=bool)
            stay[pos + 1] = False
            sym = sym[stay]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        done_sym, done_word = [], []
        flat = "".join(words)
        cps = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        kinds, inv = np.unique(cps, return_inverse=True)
        codes = np.array([self.char_id.get(chr(c), -1 - int(c)) for c in kinds], dtype=np.int64)
        sym = codes[inv] if len(cps) else cps
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        owner = np.arange(len(words))
        if max(map(len, words), default=0) > LONG_WORD:
            segment, owner = self._cut(sym, word)
            sizes = np.bincount(segment)
            for long in np.flatnonzero(sizes > LONG_WORD):
                at = segment == long
                joined = self._join_windows(sym[at])
                done_sym.append(joined)
                done_word.append(np.full(len(joined), long))
            rest = sizes[segment] <= LONG_WORD
            sym, word = sym[rest], segment[rest]
        while len(sym):
            rank = self._pairs(sym, word)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(word)])
            best = np.minimum.reduceat(rank, start)
            live = best < NO_RANK
            keep = np.repeat(live, size)
            done_sym.append(sym[~keep])
            done_word.append(word[~keep])
            if not live.any():
                break
            sym, word, rank = sym[keep], word[keep], rank[keep]
            size, best = size[live], best[live]
            best_at = np.repeat(best, size)
            hit = rank == best_at
            # leftmost, not overlapping: every second of a run of adjacent hits
            pos = np.flatnonzero(hit)
            new_run = np.r_[True, np.diff(pos) > 1]
            run_first = np.flatnonzero(new_run)
            in_run = np.arange(len(pos)) - np.repeat(run_first, np.diff(np.r_[run_first, len(pos)]))
            pos = pos[in_run % 2 == 0]
            # an unsafe pair is joined once per round and word
            later = np.r_[False, word[pos[1:]] == word[pos[:-1]]]
            pos = pos[~(later & self.unsafe[best_at[pos]])]
            sym = sym.copy()
            sym[pos] = self.piece_of_rank[best_at[pos]]
            stay = np.ones(len(sym), dtype=bool)
            stay[pos + 1] = False
            sym, word = sym[stay], word[stay]
        sym, word = np.concatenate([*done_sym, np.zeros(0, np.int64)]), np.concatenate([*done_word, np.zeros(0, np.int64)])
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], owner[word[order]]
        bounds = np.searchsorted(word, np.arange(len(words) + 1))
        odd = np.zeros(len(words), dtype=bool)
        one = self.run_id[1]
        odd[word[(sym < 0) | (sym >= self.size)]] = True
        odd[word[:-1][(sym[:-1] == one) & (sym[1:] == one) & (word[:-1] == word[1:])]] = True
        out = [sym[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for w in np.flatnonzero(odd):
            out[w] = self._finish(out[w])
        return out

    def _finish(self, sym: np.ndarray) -> np.ndarray:
        """Runs of the space sign and characters outside the vocabulary."""
        ids: list[int] = []
        run = 0
        for s in [*sym.tolist(), None]:
            if s == self.run_id[1]:
                run += 1
                continue
            if run:
                ids += self.space_run(run)
                run = 0
            if s is None:
                break
            if 0 <= s < self.size:
                ids.append(s)
            else:
                c = chr(-1 - s) if s < 0 else self.extra[s - self.size]
                ids += self.byte_id[list(c.encode())].tolist()
        return np.array(ids, dtype=np.int64)

    def split(self, text: str) -> list[str]:
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: np.ndarray) -> str:
        """Text of ``ids``: the prefix space goes, bytes that are no UTF-8 become U+FFFD one by one."""
        control = np.flatnonzero(self.control[ids]) if len(ids) else ids
        if not len(control):
            return self._text(ids, True)
        # control pieces have no text; bytes on either side of one make no character together
        runs = [r[~self.control[r]] for r in np.split(ids, control)]
        runs = [r for r in runs if len(r)]
        return "".join(self._text(r, k == 0) for k, r in enumerate(runs))

    def _text(self, ids: np.ndarray, first: bool) -> str:
        if not len(ids):
            return ""
        size = self.blob_len[ids]
        begin = np.cumsum(size) - size
        data = self.blob[np.arange(int(size.sum())) + np.repeat(self.blob_at[ids] - begin, size)].tobytes()
        if first and self.starts_with_space[ids[0]]:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _lossy(data)


def _lossy(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


class Encoder:
    """Encodes texts, each distinct word of a batch once; a bounded cache keeps words between batches."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.cache: dict[str, bytes] = {}  # ids as 32-bit integers

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.model.split(t) for t in texts]
        new = list({w for p in parts for w in p if w not in self.cache})
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache = {}
            new = list({w for p in parts for w in p})
        for w, ids in zip(new, self.model.encode_words(new)):
            self.cache[w] = ids.astype(np.int32).tobytes()
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, p)), dtype=np.int32) for p in parts]


def _groups(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows with about ``limit`` bytes together; null is empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, [t or "" for t in column.slice(at, end - at).to_pylist()]
        at = end


def encode_documents(df: DataFrame, model: PieceModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but ``text``) plus ``ids array<int>`` and ``decoded string``.

    An input column with an output's name gives way to the output.
    """
    keep = [c for c in (keep or df.columns) if c not in (text, "ids", "decoded")]
    shipped = df.sparkSession.sparkContext.broadcast(vars(model))  # a vocabulary file: fixed size
    slim = df.select(F.col(text).alias("t"), *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep])
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()), *slim.schema.fields[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(revived(PieceModel, shipped.value))
        for batch in batches:
            for at, group in _groups(batch.column(0)):
                ids = enc.encode(group)
                cols = [pa.array(ids, pa.list_(pa.int32())), pa.array([enc.model.decode(i) for i in ids], pa.string())]
                rest = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([*cols, *rest.columns[1:]], names=["ids", "decoded", *rest.schema.names[1:]])

    out = slim.mapInArrow(run, schema)
    return out.select(*[F.col(f"`k_{c}`").alias(c) for c in keep], "ids", "decoded")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of ids and of the decoded text per document (whole texts)."""
    import public_tokenizers

    model = PieceModel.load(public_tokenizers.path("piece_bpe_32k.model"))
    out = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
