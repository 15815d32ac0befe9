"""Incremental ingest with Structured Streaming.

A file-stream source feeds a preparation plan, and every micro-batch is
written once, by ``foreachBatch``, to a folder of its own below the target:

    rows/run=<checkpoint>/epoch=<batch id>/

A repeated micro-batch overwrites its own folder, so nothing is stored twice
and nothing is lost whatever the order of the files; no micro-batch reads what
earlier ones wrote, so the total work follows the input.  Every row is kept:
``ingested`` returns the first row of each key and ``duplicates`` all others.
The checkpoint lives in the cluster's shared folder.

``ingest_collection`` streams into a stored collection instead: every micro-batch is
one append (records, keys, postings, statistics) committed under its run and epoch,
so it is searchable as soon as it is committed and a replayed epoch changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir
from quarry.sources.collection import add_records

PLACE = ("run", "epoch")


def _stored(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("basePath", f"{target}/rows").parquet(f"{target}/rows")


def _order(rows: DataFrame, key: str, order_cols: list[str]) -> Column:
    """A total order of the copies of a key: ``order_cols``, then every other column."""
    rest = [c for c in rows.columns if c not in (key, *order_cols, *PLACE, "copies")]
    return F.struct(*order_cols, *rest)


def _first(rows: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """The first copy of each key; ``min`` combines map-side, so a hot key is one partial row per task."""
    least = rows.groupBy(key).agg(F.min(_order(rows, key, order_cols)).alias("first"))
    return least.select(key, "first.*")


def ingested(spark: SparkSession, target: str, key: str = "id", order_cols: list[str] | None = None) -> DataFrame:
    """The first row of every key (by ``order_cols``, then all columns) in ``target``."""
    rows = _stored(spark, target).drop(*PLACE)
    columns = [c for c in rows.columns if c != "copies"]
    return _first(rows.select(columns), key, order_cols or []).select(columns)


def duplicates(spark: SparkSession, target: str, key: str = "id") -> DataFrame:
    """``(key, copies)``: how many rows beyond the first every repeated key has."""
    return _stored(spark, target).groupBy(key).agg((F.sum("copies") - 1).alias("copies")).where("copies > 0")


def _run_files(
    spark: SparkSession,
    source_dir: str,
    file_glob: str,
    schema,
    prepare: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, int], None],
    max_bytes_per_trigger: int | None,
    max_files_per_trigger: int | None,
    checkpoint: str,
) -> None:
    """Every file present at start through ``prepare`` and ``write``, in micro-batches bounded by bytes or files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger is not None:  # one bound per source
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    query = prepare(reader.parquet(source_dir)).writeStream.foreachBatch(write)
    query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_of(checkpoint: str) -> str:
    """The name of a checkpoint's run: epochs are counted per checkpoint."""
    return hashlib.md5(checkpoint.encode()).hexdigest()


def ingest_collection(
    spark: SparkSession,
    source_dir: str,
    file_glob: str,
    schema,
    prepare: Callable[[DataFrame], DataFrame],
    location: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = 4 << 30,
    on_progress: Callable[[dict], None] | None = None,
    **options,
) -> str:
    """S6 — stream files into a stored collection, exactly once; returns the checkpoint.

    ``prepare`` gives (id, document, metadata[, embedding]); ``options`` go to
    ``add_records``.  A run that is started again with its checkpoint replays the
    micro-batch that broke off: if it was committed nothing happens, else its
    folders are overwritten.  ``on_progress`` (U2) receives ``{"batch_id", "n_stored",
    "n_tokens", "replayed"}`` per micro-batch.
    """
    checkpoint = checkpoint or shared_dir(spark, "collection-checkpoint")
    run = run_of(checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        out = add_records(spark, location, batch, epoch=(run, epoch), **options)
        if on_progress:
            on_progress({"batch_id": epoch, "replayed": out.get("replayed", False), **out["progress"]})

    _run_files(spark, source_dir, file_glob, schema, prepare, write, max_bytes_per_trigger, max_files_per_trigger, checkpoint)
    return checkpoint


def ingest_files(
    spark: SparkSession,
    source_dir: str,
    file_glob: str,
    schema,
    prepare: Callable[[DataFrame], DataFrame],
    target: str,
    key: str = "id",
    order_col: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = 4 << 30,
    checkpoint: str | None = None,
    on_progress: Callable[[dict], None] | None = None,
) -> DataFrame:
    """S6 — stream files through ``prepare`` into ``target``; returns the first row of every key.

    Runs with ``trigger(availableNow=True)``: every file present at start is
    processed in micro-batches bounded by bytes, then the query stops.
    ``on_progress`` (U2) receives ``{"batch_id", "n_input"}`` per non-empty
    micro-batch, counted while the batch is written (``Observation``).
    """
    checkpoint = checkpoint or shared_dir(spark, "ingest-checkpoint")
    run = run_of(checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        seen = Observation(f"ingest-{epoch}")
        rows = batch.observe(seen, F.count(F.lit(1)).alias("n_input")) if on_progress else batch
        # equal rows become one with a count: a map-side combine, nothing is lost
        packed = rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count(F.lit(1)).alias("copies"))
        packed.write.mode("overwrite").parquet(f"{target}/rows/run={run}/epoch={epoch}")
        if on_progress and seen.get.get("n_input", 0):  # empty batches are not reported
            on_progress({"batch_id": epoch, "n_input": seen.get["n_input"]})

    _run_files(spark, source_dir, file_glob, schema, prepare, write, max_bytes_per_trigger, max_files_per_trigger, checkpoint)
    return ingested(spark, target, key, [order_col] if order_col else None)


def dedupe_events(
    spark: SparkSession,
    source_dir: str,
    file_glob: str,
    schema,
    key: str,
    event_time: str,
    target: str,
    max_files_per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """S6 for event streams — one row per key, the earliest by event time, whatever order files arrive in.

    No watermark: an event may be arbitrarily late and is never thrown away.
    """
    return ingest_files(
        spark, source_dir, file_glob, schema, lambda stream: stream, target, key, event_time, max_files_per_trigger, checkpoint=checkpoint
    )
