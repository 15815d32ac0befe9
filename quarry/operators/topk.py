"""Ranking helpers shared by every search leg.

``top_k_per_group`` keeps the ``row_number() <= k`` filter directly on the
window output so Catalyst inserts ``WindowGroupLimit`` *Partial* before the
shuffle and *Final* after it: each map task ships at most ``k`` rows per
group, whatever the group's size, so a hot query/key never funnels its whole
candidate set into one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_KEY = np.inf
#: Slices per group in the first of two merge levels: no task sees more than a slice of what all tasks send for one group.
MERGE_SLICES = 32


def top_k_per_group(
    df: DataFrame,
    group_cols: list[str | Column],
    order_cols: list[Column],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    tmp = f"__{rank_col}"
    return (
        df.withColumn(tmp, F.row_number().over(w))
        .where(F.col(tmp) <= k)
        .withColumn(rank_col, F.col(tmp).cast("long"))
        .drop(tmp)
    )


def number_rows(df: DataFrame, group_cols: list[str], order_cols: list[Column], rank_col: str = "rank") -> DataFrame:
    """W1 — rank from 1 within already-bounded groups (after a top-k)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long"))


def top_k(df: DataFrame, order_cols: list[Column], k: int) -> DataFrame:
    """O2 / V6 — global top-k: ``TakeOrderedAndProject`` (per-task heaps, k rows each)."""
    return df.orderBy(*order_cols).limit(k)


def merge_top_k(df: DataFrame, group_cols: list[str], order_cols: list[Column], id_col: str, k: int, rank_col: str = "rank") -> DataFrame:
    """Global top-k of per-task winners, in two levels: within id slices of each group, then of the slices' winners."""
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(id_col), F.lit(MERGE_SLICES)))
    first = top_k_per_group(sliced, [*group_cols, "__slice"], order_cols, k, "__first").drop("__first", "__slice")
    return top_k_per_group(first, group_cols, order_cols, k, rank_col)


class RunningTopK:
    """Per-query running top-k of ``(key, id)`` across the batches of one partition, as flat arrays."""

    def __init__(self, n_queries: int, k: int):
        self.n, self.k = n_queries, k
        self.q = np.empty(0, dtype=np.int64)
        self.keys = np.empty(0, dtype=np.float64)
        self.ids = np.empty(0, dtype=object)
        # k-th best key per query once k rows are held (NO_KEY until then)
        self.worst = np.full(n_queries, NO_KEY)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def offer(self, q: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
        """Offer rows ``(query position, key, id)``; a tie with the k-th key may still win on id."""
        good = (keys <= self.worst[q]) & (keys < NO_KEY)
        if not good.any():
            return
        self.waiting.append((q[good], keys[good], ids[good]))
        self.n_waiting += int(good.sum())
        if self.n_waiting > max(100_000, 4 * self.n * self.k):
            self._settle()

    def offer_block(self, keys: np.ndarray, ids: np.ndarray, queries: np.ndarray | None = None) -> None:
        """Offer a (queries x rows) key matrix; only keys up to each query's k-th smallest go further."""
        if keys.shape[1] > self.k:
            kth = np.partition(keys, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            qi, ri = np.nonzero(keys <= kth)
        else:
            qi, ri = (x.ravel() for x in np.indices(keys.shape))
        self.offer(qi if queries is None else queries[qi], keys[qi, ri], ids[ri])

    def _settle(self) -> None:
        q = np.concatenate([self.q, *[w[0] for w in self.waiting]])
        keys = np.concatenate([self.keys, *[w[1] for w in self.waiting]])
        ids = np.concatenate([self.ids, *[w[2].astype(object) for w in self.waiting]])
        self.waiting, self.n_waiting = [], 0
        order = np.lexsort((ids, keys, q))
        q, keys, ids = q[order], keys[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        last = place == self.k - 1
        self.worst[q[last]] = keys[last]
        self.q, self.keys, self.ids = q[keep], keys[keep], ids[keep]

    def rows(self, qids: list):
        """Lists of query id, row id and key."""
        self._settle()
        return [qids[i] for i in self.q.tolist()], self.ids.tolist(), self.keys.tolist()
