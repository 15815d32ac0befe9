"""Vector expressions (V1-V5).

Row-wise distances between two ``array<float|double>`` columns are native
higher-order-function expressions (no Python).  Arithmetic is DOUBLE.

Ranking keys: distances rank by ``floor(x * 1e12 + 0.5)`` (a whole number held
as DOUBLE), fine enough to separate any distances that differ beyond the
rounding of the sums themselves, so ranks and id tie-breaks agree across
engines.  The value reported is rounded to 6 decimals.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS = ("cosine", "l2", "ip")
# Resolution of ranking keys, and of reported values (6 decimals).
KEY_SCALE = 1e12
REPORT_SCALE = 1e6


def _d(x: Column) -> Column:
    return x.cast("double")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: _d(x) * _d(y)), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: _d(x) * _d(x)), F.lit(0.0), lambda acc, v: acc + v))


def cosine_distance(a: Column, b: Column) -> Column:
    """V3 — ``1 - a.b / (|a| |b|)``; null when either norm is zero."""
    den = norm(a) * norm(b)
    return F.when(den > 0, F.lit(1.0) - dot(a, b) / den)


def l2_distance(a: Column, b: Column) -> Column:
    """V4 — Euclidean distance."""
    sq = F.zip_with(a, b, lambda x, y: (_d(x) - _d(y)) * (_d(x) - _d(y)))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def ip_distance(a: Column, b: Column) -> Column:
    """V5 — negative inner product (smaller is closer)."""
    return -dot(a, b)


def distance(a: Column, b: Column, metric: str = "cosine") -> Column:
    if metric == "cosine":
        return cosine_distance(a, b)
    if metric == "l2":
        return l2_distance(a, b)
    if metric == "ip":
        return ip_distance(a, b)
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")


def rank_key(x: Column, scale: float = KEY_SCALE) -> Column:
    """Ranking key ``floor(x * scale + 0.5)`` as DOUBLE."""
    y = x * F.lit(scale) + F.lit(0.5)
    return y - F.pmod(y, F.lit(1.0))


def from_key(k: Column, scale: float = KEY_SCALE) -> Column:
    """The reported value of a ranking key, to 6 decimals."""
    return F.floor(k / F.lit(scale / REPORT_SCALE) + F.lit(0.5)).cast("double") / F.lit(REPORT_SCALE)


def np_rank_key(x: np.ndarray, scale: float = KEY_SCALE) -> np.ndarray:
    return np.floor(x * scale + 0.5)


def np_distances(q: np.ndarray, m: np.ndarray, metric: str) -> np.ndarray:
    """Distances between query rows ``q`` (nq x d) and corpus rows ``m`` (n x d).

    Returns (nq x n) float64; NaN where cosine is undefined (zero norm).
    """
    if metric == "cosine":
        qn = np.linalg.norm(q, axis=1)
        mn = np.linalg.norm(m, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            sim = (q @ m.T) / np.outer(qn, mn)
        sim[:, mn == 0] = np.nan
        sim[qn == 0, :] = np.nan
        return 1.0 - sim
    if metric == "l2":
        # by differences (the expanded form cancels for close or large vectors), some queries at a time
        out = np.empty((len(q), len(m)))
        step = max(1, 1_000_000 // max(1, m.size))
        for i in range(0, len(q), step):
            diff = q[i : i + step, None, :] - m[None, :, :]
            out[i : i + step] = np.sqrt(np.einsum("qnd,qnd->qn", diff, diff))
        return out
    if metric == "ip":
        return -(q @ m.T)
    raise ValueError(f"unknown metric {metric!r}")


# ---------------------------------------------------------------- embedder (V1)

def token_buckets(tokens: Column, dim: int) -> Column:
    """Hash every token to a bucket in ``[0, dim)`` with the first 32 bits of its MD5.

    MD5 is available in every SQL engine, so an oracle can rebuild the
    embedding exactly.
    """
    return F.transform(
        tokens,
        lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int"),
    )


@functools.lru_cache(maxsize=1 << 17)
def _md5_bucket(term: str, dim: int) -> int:
    """Bucket of one term: first 32 bits of its MD5 (hex), modulo ``dim`` — as ``token_buckets``."""
    return int(hashlib.md5(term.encode("utf-8")).hexdigest()[:8], 16) % dim


#: Rows embedded at once inside a task.
EMBED_ROWS = 2048


def _hashed_tf_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def hashed_tf(tokens: pa.Array) -> pa.Array:
        # some rows at a time: what a task holds beside its batch does not grow with the batch
        parts = [vectors_of(tokens.slice(at, EMBED_ROWS)) for at in range(0, len(tokens), EMBED_ROWS)]
        return pa.concat_arrays(parts) if parts else vectors_of(tokens)

    def vectors_of(tokens: pa.Array) -> pa.Array:
        n = len(tokens)
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.zeros((n, dim))
        if lengths.sum():
            flat = pc.list_flatten(tokens)
            rows = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            enc = pc.dictionary_encode(flat)
            # one MD5 per distinct term of the batch, not per occurrence
            per_term = np.fromiter(
                (_md5_bucket(t, dim) for t in enc.dictionary.to_pylist()), dtype=np.int64, count=len(enc.dictionary)
            )
            buckets = per_term[enc.indices.to_numpy(zero_copy_only=False)]
            counts = np.bincount(rows * dim + buckets, minlength=n * dim).reshape(n, dim).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            vecs = np.where(norms[:, None] > 0, counts / norms[:, None], 0.0).astype(np.float32)
        offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(vecs.ravel()), mask=pc.is_null(tokens))

    return hashed_tf


def hashed_tf_embedding(tokens: Column, dim: int = 64) -> Column:
    """V1 default embedder: L2-normalised hashed term counts as ``array<float>``.

    An Arrow UDF over the token arrays: the batch's tokens are
    dictionary-encoded, each *distinct* term is hashed once (MD5, the same
    bucket as ``token_buckets`` and as SQL engines compute), and one numpy
    ``bincount`` over ``row * dim + bucket`` builds every vector of the batch.
    """
    return _hashed_tf_udf(dim)(tokens)
