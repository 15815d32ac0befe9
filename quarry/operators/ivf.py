"""Approximate nearest neighbours as an inverted-file layout (V9) and its recall.

The reference configures an HNSW graph inside its engine; a graph is an
engine internal, so the Spark-first equivalent here is a *table layout*
in two levels:

* ``build_ivf``: MLlib ``KMeans`` gives *coarse* centroids (at most 1,024, the only
  ones ever broadcast); within each of them k-means on a bounded, documented sample
  (``TRAIN_ROWS`` vectors a coarse centroid; every vector is indexed) gives the
  *cells*.  About the square root of the row count of cells.
* ``ivf_append``: new vectors join the cell of their nearest centroid.
* **Cells follow the data.**  After every write, cells with more than ``cell_rows`` vectors
  are split by k-means; equal vectors, which no centroid tells apart, are dealt among
  equal centroids by a hash of the row.  So a cell always fits a task, whatever is appended.
* The centroid table is versioned and written last: its latest version says which
  cells are live.  Rows of split cells are removed after it.
* ``ivf_knn``: each query goes to the cells of its nearest coarse centroids, keeps the
  ``nprobe`` nearest, and meets their rows in a join by cell: a task holds one
  cell and streams the queries that probe it.  Queries, probes and centroids of
  cells are never collected.

With every cell probed the result is exactly ``knn``.  ``calibrate`` measures recall
for all probe levels at once against exact search and stores the smallest level
whose lower confidence bound reaches the target.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.vectors import np_distances, np_rank_key
from quarry.operators.knn import DIST_CELLS, _matrix, _merged, knn_join
from quarry.operators.topk import NO_KEY, RunningTopK, top_k_per_group

#: Coarse centroids at most (they are broadcast), vectors used to train the cells of one, most rows of a cell.
MAX_COARSE = 1024
TRAIN_ROWS = 20_000
CELL_ROWS = 65_536
#: Rows of one coarse centroid are dealt over so many tasks.
SALTS = 8
#: Queries that meet a cell's rows together.
QUERY_CHUNK = 4096
#: Cells named in a pruning predicate at most.
PRUNED_CELLS = 1000
#: Coarse centroids visited: so many times the share of cells asked for.
COARSE_FACTOR = 4


def _k_means(points: np.ndarray, k: int, metric: str, seed: int, rounds: int = 10) -> np.ndarray:
    """At most ``k`` centroids of a bounded sample (Lloyd, farthest-first start among random rows)."""
    rng = np.random.default_rng(seed)
    x = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12) if metric == "cosine" else points
    centers = x[[int(rng.integers(len(x)))]]
    while len(centers) < min(k, len(x)):
        some = x[rng.integers(len(x), size=64)]
        far = np.linalg.norm(some[:, None] - centers[None], axis=2).min(axis=1)
        centers = np.concatenate([centers, some[[int(far.argmax())]]])
    for _ in range(rounds):
        near = (x @ centers.T - 0.5 * (centers * centers).sum(axis=1)).argmax(axis=1)
        sums, n = np.zeros_like(centers), np.bincount(near, minlength=len(centers))
        np.add.at(sums, near, x)
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def _fields(df: DataFrame) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType) for f in df.schema]


def _coarse(spark: SparkSession, location: str) -> np.ndarray:
    """The coarse centroids: at most ``MAX_COARSE`` rows."""
    return np.array([r["center"] for r in spark.read.parquet(f"{location}/coarse").orderBy("coarse").collect()], dtype=np.float64)


def centroids(spark: SparkSession, location: str) -> DataFrame:
    """``(coarse, cell, center)`` of the live cells."""
    versions = spark.read.parquet(f"{location}/centroids")
    return versions.where(F.col("version") == versions.agg(F.max("version")).first()[0]).select("coarse", "cell", "center")


def n_cells(spark: SparkSession, location: str) -> int:
    return centroids(spark, location).count()


def live_vectors(spark: SparkSession, location: str) -> DataFrame:
    """Every indexed row with its ``cell``."""
    return spark.read.parquet(f"{location}/cells").join(centroids(spark, location).select("cell"), "cell", "left_semi")


def _near_coarse(rows: DataFrame, vec_col: str, centers: np.ndarray, metric: str, n: int) -> DataFrame:
    """Each row with a usable vector once for every one of its ``n`` nearest coarse centroids (``_coarse``); fails on others."""
    shipped = rows.sparkSession.sparkContext.broadcast(centers)
    at = rows.columns.index(vec_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cmat = shipped.value
        for batch in batches:
            good, mat = _matrix(batch.column(at), cmat.shape[1])
            if len(good) < batch.num_rows:
                raise ValueError(f"{batch.num_rows - len(good)} vectors of a batch are null or not of {cmat.shape[1]} dimensions")
            d = np.nan_to_num(np_distances(mat, cmat, metric), nan=np.inf)
            near = np.argsort(d, axis=1, kind="stable")[:, :n]
            row = pa.array(np.repeat(np.arange(len(good)), near.shape[1]))
            yield pa.RecordBatch.from_arrays([*batch.take(row).columns, pa.array(near.ravel().astype(np.int32))], names=[*batch.schema.names, "_coarse"])

    return rows.mapInArrow(run, T.StructType([*_fields(rows), T.StructField("_coarse", T.IntegerType())]))


def _near_cells(rows: DataFrame, cents: DataFrame, vec_col: str, metric: str, n: int | None, one_of_equals: bool) -> DataFrame:
    """Rows (with ``_coarse``) and their ``n`` nearest cells of that centroid: adds ``cell`` and ``_key``.

    A join by coarse centroid: its cells come first in every task, then rows are
    streamed.  With ``one_of_equals`` a row takes one of the equally near cells, by its hash.
    """
    fields = _fields(rows)
    names = [f.name for f in fields]
    salt = F.pmod(F.xxhash64(F.to_json(F.struct(vec_col)), F.monotonically_increasing_id()), F.lit(SALTS))
    right = rows.select(F.col("_coarse").alias("k"), salt.alias("s"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("c"), F.col(vec_col).cast("array<double>").alias("v"), F.struct(*names).alias("row"))
    empty = T.StructType(fields)
    left = cents.select(
        F.col("coarse").alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("s"), F.lit(0).alias("side"),
        F.col("cell").alias("c"), F.col("center").alias("v"), F.lit(None).cast(empty).alias("row"),
    )
    met = left.unionByName(right).repartition("k", "s").sortWithinPartitions("k", "s", "side", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cells, mats, cmat = None, [], [], None
        for batch in batches:
            where = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            cuts = np.flatnonzero(np.r_[True, (where[:, 1:] != where[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                part = batch.slice(a, b - a)
                if key != tuple(where[:2, a]):
                    key, cells, mats, cmat = tuple(where[:2, a]), [], [], None
                if where[2, a] == 0:
                    cells.append(part.column(3).to_numpy())
                    mats.append(np.stack(part.column(4).to_numpy(zero_copy_only=False)))
                    continue
                if cmat is None:
                    cmat, ids = np.concatenate(mats), np.concatenate(cells)
                _, mat = _matrix(part.column(4), cmat.shape[1])
                step = max(1, DIST_CELLS // len(ids))
                for at in range(0, len(mat), step):
                    m = mat[at : at + step]
                    d = np_rank_key(np.nan_to_num(np_distances(m, cmat, metric), nan=1e3))
                    if one_of_equals:
                        least = d == d.min(axis=1, keepdims=True)
                        turn = (np.arange(at, at + len(m)) + int(key[1])) % least.sum(axis=1)
                        near = (np.cumsum(least, axis=1) == turn[:, None] + 1).argmax(axis=1)[:, None]
                    else:
                        near = np.argsort(d, axis=1, kind="stable")[:, :n]
                    row = pa.array(np.repeat(np.arange(at, at + len(m)), near.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(5).take(row), pa.array(ids[near.ravel()]), pa.array(np.take_along_axis(d, near, axis=1).ravel())], names=["row", "cell", "_key"]
                    )

    found = met.mapInArrow(run, T.StructType([T.StructField("row", empty), T.StructField("cell", T.LongType()), T.StructField("_key", T.DoubleType())]))
    return found.select("row.*", "cell", "_key").drop("_coarse")


def _trained(rows: DataFrame, vec_col: str, label: str, metric: str, seed: int) -> DataFrame:
    """``(label, no, center)``: ``_k`` centroids for the rows of each label from at most ``TRAIN_ROWS`` of them."""
    numbered = Window.partitionBy(label).orderBy("_pick")
    sample = rows.select(label, F.col(vec_col).cast("array<double>").alias("v"), F.xxhash64(F.to_json(vec_col)).alias("_pick"), "_k")
    sample = sample.withColumn("_n", F.row_number().over(numbered)).where(F.col("_n") <= TRAIN_ROWS).drop("_n", "_pick")

    def train(key: tuple, table: pa.Table) -> pa.Table:
        points = np.stack(table.column("v").to_numpy(zero_copy_only=False))
        k = table.column("_k")[0].as_py()
        made = _k_means(points, k, metric, seed)
        if len(made) < k:  # too few different vectors: equal centroids share them
            made = np.concatenate([made, made[np.arange(k - len(made)) % len(made)]])
        return pa.table({label: pa.array([key[0].as_py()] * k, table.schema.field(label).type), "no": pa.array(np.arange(k, dtype=np.int64)), "center": pa.array(made.tolist(), pa.list_(pa.float64()))})

    kind = rows.schema[label].dataType.simpleString()
    return sample.groupBy(label).applyInArrow(train, f"{label} {kind}, no long, center array<double>")


def _place(rows: DataFrame, location: str, cents: DataFrame, vec_col: str, metric: str, mode: str) -> None:
    """Write rows (with ``_coarse``) to their cells; range-partitioned by cell, so a task writes few folders and a hot cell is split."""
    placed = _near_cells(rows, cents, vec_col, metric, None, True).drop("_key")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    placed.repartitionByRange(parts, "cell", "_at").drop("_at").sortWithinPartitions("cell").write.mode(mode).partitionBy("cell").parquet(f"{location}/cells")


def _new_version(spark: SparkSession, location: str, version: int, cents: DataFrame) -> None:
    cents.select("coarse", "cell", "center").write.mode("overwrite").parquet(f"{location}/centroids/version={version}")


def _split_oversize(spark: SparkSession, location: str, metric: str, vec_col: str, cell_rows: int, seed: int) -> None:
    """Split cells until none has more than ``cell_rows`` rows."""
    from quarry.sources.collection import _delete

    for attempt in range(16):
        cents = centroids(spark, location)
        sizes = live_vectors(spark, location).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
        crowded = sizes.withColumn("_k", F.ceil(F.col("n") * 2 / F.lit(cell_rows)).cast("int"))
        crowded = spark.createDataFrame(crowded.select("cell", "_k").collect(), "cell long, _k int")  # cells over their bound: at most rows / cell_rows
        if crowded.isEmpty():
            return
        version = spark.read.parquet(f"{location}/centroids").agg(F.max("version")).first()[0]
        old = [r["cell"] for r in crowded.collect()]
        rows = spark.read.parquet(f"{location}/cells").where(F.col("cell").isin(old)).join(F.broadcast(crowded), "cell")
        first = cents.agg(F.max("cell")).first()[0] + 1
        parts = _trained(rows, vec_col, "cell", metric, seed + attempt)
        numbers = Window.orderBy("cell", "no")  # a few new cells per crowded one
        made = parts.withColumn("_new", (F.row_number().over(numbers) - 1 + first).cast("long"))
        path = f"{location}/scratch-{uuid.uuid4().hex}"
        made.join(cents.select("coarse", "cell"), "cell").select("coarse", F.col("cell").alias("was"), F.col("_new").alias("cell"), "center").write.parquet(path)
        made = spark.read.parquet(path)
        # rows of a split cell choose among its children only
        moving = rows.drop("_k").withColumnRenamed("cell", "_coarse")
        _place(moving, location, made.select(F.col("was").alias("coarse"), "cell", "center"), vec_col, metric, "append")
        kept = cents.join(F.broadcast(crowded.select("cell")), "cell", "left_anti").select("coarse", "cell", "center")
        _new_version(spark, location, version + 1, kept.unionByName(made.select("coarse", "cell", "center")))
        _delete(spark, path, *(f"{location}/cells/cell={c}" for c in old))
    raise RuntimeError("cells stay over their bound")


def build_ivf(
    corpus: DataFrame,
    location: str,
    n_cells: int | None = None,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
    seed: int = 42,
    max_iter: int = 20,
    cell_rows: int = CELL_ROWS,
) -> str:
    """V9 build — train coarse centroids and cells, write ``coarse``, ``cells`` (partitioned) and ``centroids``.

    ``n_cells`` defaults to the square root of the number of vectors.
    """
    spark = corpus.sparkSession
    feats = corpus.withColumn("_features", array_to_vector(F.col(vec_col))).persist(StorageLevel.MEMORY_AND_DISK)
    n_cells = n_cells or max(2, round(feats.count() ** 0.5))
    n_coarse = min(MAX_COARSE, max(1, math.isqrt(n_cells)))
    measure = "cosine" if metric == "cosine" else "euclidean"
    if n_coarse > 1:
        km = KMeans(k=n_coarse, featuresCol="_features", predictionCol="_label", distanceMeasure=measure, seed=seed, maxIter=max_iter)
        centers = np.array(km.fit(feats).clusterCenters())
    else:
        centers = np.zeros((1, feats.select(F.max(F.size(vec_col))).first()[0]))
    feats.unpersist()
    spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)], "coarse int, center array<double>").coalesce(1).write.mode("overwrite").parquet(f"{location}/coarse")
    rows = _near_coarse(corpus, vec_col, centers, metric, 1)
    per = max(1, n_cells // len(centers))
    cells = _trained(rows.withColumn("_k", F.lit(per)), vec_col, "_coarse", metric, seed)
    cells = cells.select(F.col("_coarse").alias("coarse"), (F.col("_coarse").cast("long") * per + F.col("no")).alias("cell"), "center")
    _new_version(spark, location, 0, cells)
    _place(rows, location, centroids(spark, location), vec_col, metric, "overwrite")
    _split_oversize(spark, location, metric, vec_col, cell_rows, seed)
    return location


def ivf_append(vectors: DataFrame, location: str, metric: str = "cosine", vec_col: str = "embedding", cell_rows: int = CELL_ROWS, seed: int = 42) -> None:
    """New vectors (with the stored columns) go to the cell of their nearest centroid; cells over ``cell_rows`` are split."""
    spark = vectors.sparkSession
    rows = _near_coarse(vectors, vec_col, _coarse(spark, location), metric, 1)
    _place(rows, location, centroids(spark, location), vec_col, metric, "append")
    _split_oversize(spark, location, metric, vec_col, cell_rows, seed)


def probe_cells(spark: SparkSession, location: str, queries: DataFrame, nprobe: int, metric: str, qid_col: str, qvec_col: str) -> DataFrame:
    """``(query_id, query_vector, cell, level)``: the ``nprobe`` nearest cells of every query, nearest first."""
    cents, centers = centroids(spark, location), _coarse(spark, location)
    total = cents.count()
    wide = min(len(centers), max(1, math.ceil(COARSE_FACTOR * nprobe * len(centers) / max(total, 1))))
    usable = queries.select(qid_col, qvec_col).where((F.size(qvec_col) == centers.shape[1]) & ~F.exists(qvec_col, lambda x: x.isNull()))
    near = _near_cells(_near_coarse(usable, qvec_col, centers, metric, wide), cents, qvec_col, metric, nprobe, False)
    return top_k_per_group(near, [qid_col], [F.col("_key").asc(), F.col("cell").asc()], nprobe, "level").drop("_key")


def ivf_knn(
    spark: SparkSession,
    location: str,
    queries: DataFrame,
    k: int,
    nprobe: int | None = None,
    metric: str = "cosine",
    id_col: str = "id",
    vec_col: str = "embedding",
    qid_col: str = "query_id",
    qvec_col: str = "query_vector",
) -> DataFrame:
    """V9 query — approximate top-k: ``(query_id, id, distance, rank)``; ``nprobe`` defaults to the calibrated level."""
    nprobe = nprobe or calibrated(spark, location)
    probes = probe_cells(spark, location, queries, nprobe, metric, qid_col, qvec_col)
    vectors = spark.read.parquet(f"{location}/cells")
    id_type, qid_type = vectors.schema[id_col].dataType, queries.schema[qid_col].dataType
    rows = vectors.select(F.col("cell").cast("long"), F.lit(0).alias("side"), F.lit(None).cast(qid_type).alias("qid"), F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    # only the rows of probed cells go on: a small set of cells prunes the folders, a large one is a semi join
    wanted = probes.select("cell").distinct()
    few = [r[0] for r in wanted.limit(PRUNED_CELLS + 1).collect()]
    rows = rows.where(F.col("cell").isin(few)) if len(few) <= PRUNED_CELLS else rows.join(wanted, "cell", "left_semi")
    asked = probes.select("cell", F.lit(1).alias("side"), F.col(qid_col).alias("qid"), F.lit(None).cast(id_type).alias("id"), F.col(qvec_col).cast("array<double>").alias("v"))
    met = rows.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "side")
    schema = T.StructType([T.StructField(qid_col, qid_type), T.StructField(id_col, id_type), T.StructField("dist_key", T.DoubleType())])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, mats, own = None, [], [], None
        for batch in batches:
            where = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(2)])
            cuts = np.flatnonzero(np.r_[True, (where[:, 1:] != where[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                if where[0, a] != cell:
                    cell, ids, mats, own = where[0, a], [], [], None
                part = batch.slice(a, b - a)
                if where[1, a] == 0:
                    ids.append(part.column(3).to_numpy(zero_copy_only=False))
                    mats.append(part.column(4))
                    continue
                if not ids:
                    continue
                if own is None:
                    width = len(part.column(4)[0])
                    own = _matrix(pa.concat_arrays(mats), width)[1], np.concatenate(ids)
                for at in range(0, part.num_rows, QUERY_CHUNK):
                    some = part.slice(at, QUERY_CHUNK)
                    qids, q = some.column(2).to_pylist(), _matrix(some.column(4), own[0].shape[1])[1]
                    best = RunningTopK(len(qids), k)
                    step = max(1, DIST_CELLS // len(qids))
                    for start in range(0, len(own[0]), step):
                        d = np_distances(q, own[0][start : start + step], metric)
                        best.offer_block(np.where(np.isnan(d), NO_KEY, np_rank_key(np.nan_to_num(d, nan=0.0))), own[1][start : start + step])
                    out = best.rows(qids)
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], names=schema.names)

    return _merged(met.mapInArrow(run, schema), k, id_col, qid_col)


# ------------------------------------------------------------------ recall


def recall_curve(
    spark: SparkSession, location: str, queries: DataFrame, k: int, metric: str = "cosine", id_col: str = "id", vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query_vector", max_level: int | None = None
) -> DataFrame:
    """V10 — ``(nprobe, n_queries, recall, lower)`` for every probe level from one exact search.

    A true neighbour is found from the level at which its cell is probed, so the
    levels need no search of their own.  ``lower`` is the 95 % lower bound of the mean
    recall over queries (normal approximation).
    """
    stored = live_vectors(spark, location)
    exact = knn_join(stored.select(id_col, vec_col), queries, k, metric, id_col, vec_col, qid_col, qvec_col)
    exact = exact.join(stored.select(id_col, "cell"), id_col)
    levels = max_level or n_cells(spark, location)
    order = probe_cells(spark, location, queries, levels, metric, qid_col, qvec_col).select(qid_col, "cell", "level")
    found = exact.join(order, [qid_col, "cell"], "left").groupBy(qid_col, "level").agg(F.count(F.lit(1)).alias("n"))
    true = F.sum("n").over(Window.partitionBy(qid_col))
    each = found.withColumn("share", F.col("n") / true).where("level is not null")
    wanted = spark.createDataFrame([(n,) for n in sorted({min(levels, 1 << i) for i in range(levels.bit_length() + 1)})], "nprobe long")
    asked = found.select(qid_col).distinct().withColumn("nprobe", F.explode(F.array(*[F.lit(r["nprobe"]) for r in wanted.collect()])))
    reached = asked.join(each, qid_col, "left").groupBy(qid_col, "nprobe").agg(F.coalesce(F.sum(F.when(F.col("level") <= F.col("nprobe"), F.col("share"))), F.lit(0.0)).alias("recall"))
    bound = F.avg("recall") - 1.645 * F.coalesce(F.stddev_samp("recall"), F.lit(0.0)) / F.sqrt(F.count(F.lit(1)))
    return reached.groupBy("nprobe").agg(F.count(F.lit(1)).alias("n_queries"), F.avg("recall").alias("recall"), bound.alias("lower"))


def calibrate(spark: SparkSession, location: str, queries: DataFrame, k: int, target: float = 0.9, **columns) -> int:
    """Measure the recall curve, store it and return the smallest level whose lower bound reaches ``target``."""
    recall_curve(spark, location, queries, k, **columns).withColumn("target", F.lit(target)).write.mode("overwrite").parquet(f"{location}/recall")
    return calibrated(spark, location)


def calibrated(spark: SparkSession, location: str) -> int:
    """The stored level; every cell if no smaller one reaches the target."""
    curve = spark.read.parquet(f"{location}/recall")
    level = curve.where("lower >= target").agg(F.min("nprobe")).first()[0]
    return level or n_cells(spark, location)


def recall_at_k(approx: DataFrame, exact: DataFrame, k: int, qid_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """V10 — per query ``|approx ∩ exact| / k`` and its mean: one row ``(n_queries, recall)``."""
    hits = exact.select(qid_col, id_col).join(approx.select(qid_col, id_col), [qid_col, id_col], "left_semi")
    per_q = exact.select(qid_col).distinct().join(
        hits.groupBy(qid_col).agg(F.count(F.lit(1)).alias("hits")), qid_col, "left"
    )
    return per_q.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg(F.coalesce(F.col("hits"), F.lit(0)) / F.lit(float(k))).alias("recall"),
    )


def wrong_distances(found: DataFrame, corpus: DataFrame, queries: DataFrame, metric: str = "cosine", id_col: str = "id", vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query_vector") -> DataFrame:
    """One row ``n_wrong``: found pairs whose distance differs from the row expression's by more than its last reported digit."""
    from quarry.functions.vectors import distance as distance_expr

    pairs = found.join(corpus.select(id_col, vec_col), id_col).join(queries.select(qid_col, qvec_col), qid_col)
    off: Column = F.abs(F.col("distance") - distance_expr(F.col(vec_col), F.col(qvec_col), metric)) > 1.5e-6
    return pairs.agg(F.count_if(off).alias("n_wrong"))
