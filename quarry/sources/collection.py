"""Stored collections (S3, S4, S5, S7, P16, P17, T2/T3 materialised).

A collection is a folder on shared storage with parquet datasets:

    records/     id, document, metadata (JSON text), gen_<field> typed columns,
                 embedding (optional), dl (token count)
    postings/    term, id, tf, dl, sorted by term (row groups are skipped by term)
    terms/       term, df, cf of an append (additive statistics)
    keys/        the append's ids in pieces with Bloom filters (``keys``)
    quarantine/  rejected rows with reject_reason
    commits/     one row per append, written last: statistics, schema, folders, stream epoch
    properties/  one row: name, dimension, metric, analyzer, embedder

Every append has folders of its own (``ingest_batch=<id>``); readers open the
folders of committed appends only, so an append that broke off is not seen, and a
stream epoch is committed at most once.  ``compact`` folds all appends into one.
The schema is in the commit: no footers are merged and no folder is looked for.

Writes go through the DataFrame writer (any Hadoop file system), so the
same code runs against a cluster's shared folder.  Queries read only what
they need: typed columns instead of JSON parsing (pushed-down filters), postings
of the query's terms, stored statistics.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import json_safe, json_safe_value
from quarry.functions.tokens import tokenize
from quarry.functions.vectors import hashed_tf_embedding
from quarry.operators.fulltext import postings_of_tokens, term_stats
from quarry.operators.prepare import storable
from quarry.session import shared_dir
from quarry.sources.keys import confirmed, key_pieces, located, piece_schema, possible

# Metadata field -> typed column type, and the default field list.
FIELD_TYPES = {
    "genre": "string",
    "author": "string",
    "year": "bigint",
    "user_rating": "double",
    "reviews": "bigint",
    "price": "double",
    "name": "string",
}
DEFAULT_INDEX_FIELDS = ["genre", "year", "user_rating", "author"]
UNKNOWN_FIELD_TYPE = "string"


def typed_column(field: str, metadata_col: str = "metadata", dtype: str | None = None) -> Column:
    """P16 — ``gen_<field>``: the JSON path value, unquoted, cast with ``try_cast``.

    Spark's ``get_json_object`` returns strings unquoted, so ``{"genre":
    "Fiction"}`` matches the literal ``Fiction``; DOUBLE (not FLOAT) keeps
    ``>=`` boundaries exact.
    """
    t = dtype or FIELD_TYPES.get(field, UNKNOWN_FIELD_TYPE)
    return F.get_json_object(F.col(metadata_col), f"$.{field}").try_cast(t).alias(f"gen_{field}")


def add_typed_columns(
    df: DataFrame, fields: list[str] | dict[str, str] | None = None, metadata_col: str = "metadata"
) -> DataFrame:
    """P17 — add ``gen_<field>`` for every field (default: genre, year, user_rating, author).

    ``fields`` is a list (types from ``FIELD_TYPES``, unknown -> string) or
    a ``{field: type}`` mapping.
    """
    fields = fields or DEFAULT_INDEX_FIELDS
    spec = fields if isinstance(fields, dict) else {f: None for f in fields}
    return df.withColumns({f"gen_{f}": typed_column(f, metadata_col, t) for f, t in spec.items()})


DATASETS = ("records", "postings", "terms", "keys", "quarantine")


def _paths(location: str) -> dict[str, str]:
    base = location.rstrip("/")
    return {k: f"{base}/{k}" for k in (*DATASETS, "commits", "properties", "staging")}


def _delete(spark: SparkSession, *paths: str) -> None:
    """Remove folders that no commit refers to, through the Hadoop FileSystem of their path."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (any shared store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def exists(spark: SparkSession, location: str) -> bool:
    return _path_exists(spark, _paths(location)["properties"])


def create_collection(
    spark: SparkSession,
    location: str,
    name: str,
    dimension: int | None = None,
    metric: str = "cosine",
    analyzer: str = "basic",
    recreate: bool = False,
    id_type: str = "string",
    embedder: str = "hashed_tf",
) -> dict[str, Any]:
    """S3 — create (or, with ``recreate``, replace) an empty collection; returns its properties."""
    replaced = exists(spark, location)
    if replaced and not recreate:
        return properties(spark, location)
    p = _paths(location)
    props = spark.createDataFrame(
        [(name, dimension, metric, analyzer, id_type, embedder)],
        "name string, dimension int, metric string, analyzer string, id_type string, embedder string",
    )
    props.coalesce(1).write.mode("overwrite").parquet(p["properties"])
    # first no append is committed, then the data of an earlier collection go
    spark.createDataFrame([], COMMIT_SCHEMA).write.mode("overwrite").parquet(p["commits"])
    if replaced:
        _delete(spark, *(p[k] for k in (*DATASETS, "staging")))
    return properties(spark, location)


#: folder: of the records; schema: of the records, as JSON; run, epoch: of a streamed append;
#: replaces: appends folded into this one; epochs: the last epoch of every run folded in.
COMMIT_SCHEMA = (
    "ingest_batch string, folder string, schema string, n_docs bigint, total_terms bigint, n_rejected bigint, "
    "run string, epoch bigint, replaces array<string>, epochs map<string, bigint>"
)


def _live(spark: SparkSession, location: str) -> list[Row]:
    """The commits in force, one small row per append since the last ``compact``."""
    path = _paths(location)["commits"]
    rows = spark.read.schema(COMMIT_SCHEMA).parquet(path).collect() if _path_exists(spark, path) else []
    gone = {b for r in rows for b in r.replaces or []}
    return sorted((r for r in rows if r.ingest_batch not in gone), key=lambda r: r.ingest_batch)


def _commit(spark: SparkSession, location: str, **values: Any) -> None:
    names = [f.name for f in spark.createDataFrame([], COMMIT_SCHEMA).schema]
    row = tuple(values.get(n) for n in names)
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(_paths(location)["commits"])


def _committed(live: list[Row], epoch: tuple[str, int]) -> bool:
    """Whether the stream epoch is in the collection; Spark replays only the last epoch of a run."""
    run, number = epoch
    return any((r.run == run and r.epoch == number) or (r.epochs or {}).get(run, -1) >= number for r in live)


def _record_schema(live: list[Row], id_type: str) -> T.StructType:
    """The columns of all appends (later ones may add typed fields or vectors)."""
    fields: dict[str, T.StructField] = {f.name: f for f in T._parse_datatype_string(f"id {id_type}, document string, metadata string, dl bigint")} if not live else {}
    for r in live:
        for f in T.StructType.fromJson(json.loads(r.schema)):
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"appends disagree on the type of {f.name}: {fields[f.name].dataType.simpleString()}, {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def _read(spark: SparkSession, location: str, key: str, live: list[Row] | None = None) -> DataFrame:
    """A data set of the collection: the folders of the committed appends (or of ``live``); none reads as empty."""
    live = _live(spark, location) if live is None else live
    records = _record_schema(live, properties(spark, location).get("id_type") or "string")
    id_type = records["id"].dataType
    schema = {
        "records": records,
        "quarantine": T.StructType([*records, T.StructField("reject_reason", T.StringType())]),
        "postings": T.StructType([T.StructField("term", T.StringType()), T.StructField("id", id_type), T.StructField("tf", T.LongType()), T.StructField("dl", T.LongType())]),
        "terms": T._parse_datatype_string("term string, df bigint, cf bigint"),
        "keys": piece_schema(id_type),
    }[key]
    if key == "quarantine":
        live = [r for r in live if r.n_rejected]
    if not live:
        return spark.createDataFrame([], schema)
    path = _paths(location)[key]
    return spark.read.schema(schema).parquet(*(f"{path}/{r.folder if key == 'records' else 'ingest_batch=' + r.ingest_batch}" for r in live))


def _stored_keys(spark: SparkSession, location: str, live: list[Row]) -> DataFrame:
    """The key pieces of ``live`` with the append they belong to (a partition column)."""
    path = _paths(location)["keys"]
    return spark.read.option("basePath", path).parquet(*(f"{path}/ingest_batch={r.ingest_batch}" for r in live)).withColumn("ingest_batch", F.col("ingest_batch").cast("string"))


def properties(spark: SparkSession, location: str) -> dict[str, Any]:
    row = spark.read.parquet(_paths(location)["properties"]).first()
    return row.asDict()


#: Embedders by the name a collection stores: (text column, dimension, analyzer) -> vector column.
EMBEDDERS = {"hashed_tf": lambda text, dimension, analyzer: hashed_tf_embedding(tokenize(text, analyzer), dimension)}


def embedder_of(props: dict[str, Any]):
    """U1 — the embedding function of a collection, from its stored name, dimension and analyzer."""
    make = EMBEDDERS[props.get("embedder") or "hashed_tf"]
    return lambda text: make(text, props["dimension"], props.get("analyzer") or "basic")


def _cleaned(records: DataFrame) -> DataFrame:
    """P14 at append — JSON-safe document; metadata given as a struct or map is cleaned value by value and serialised."""
    out = records.withColumn("document", json_safe(F.col("document")))
    kind = records.schema["metadata"].dataType
    if not isinstance(kind, T.StringType):
        out = out.withColumn("metadata", F.to_json(json_safe_value(F.col("metadata"), kind)))
    return out


def add_records(
    spark: SparkSession,
    location: str,
    records: DataFrame,
    embed=None,
    typed_fields: list[str] | dict[str, str] | None = None,
    clean: bool = True,
    epoch: tuple[str, int] | None = None,
    on_stage: Callable[[str], None] | None = None,
) -> dict[str, Any]:
    """S4 — clean, validate, de-duplicate and append records; returns ``stored`` and ``rejected``.

    The batch is evaluated once, by writing its cleaned, typed and embedded rows to
    the append's folder; everything after reads that.  A row is rejected as
    ``missing_id``, ``not_storable`` (P14), ``dimension`` (V2), ``duplicate_in_batch``
    (every copy of an id but the first: lowest ``_pos``, then all columns) or
    ``duplicate_id`` (the id is in the collection, see ``keys``).  Only if there are such rows
    is the folder written again without them; they go to ``quarantine/``, so
    stored + rejected = input.  Postings are counted per row, without a shuffle,
    and term statistics from them.  The commit is written last.

    ``epoch`` (run, number) names a streamed micro-batch: one that is committed is not
    added again, one that broke off is overwritten.  ``on_stage`` (U2) is called with the
    name of every dataset when it has been written.
    """
    live = _live(spark, location)
    done = on_stage or (lambda stage: None)
    batch = uuid.uuid4().hex if epoch is None else f"{epoch[0]}-{epoch[1]}"
    if epoch is not None and _committed(live, epoch):
        return _outcome(spark, location, batch) | {"replayed": True}
    props = properties(spark, location)
    p = _paths(location)
    dim = props.get("dimension")
    analyzer = props.get("analyzer") or "basic"

    recs = _cleaned(records) if clean else records
    given = recs.columns
    # tokens are found once, for the length and for the default embedder
    recs = recs.withColumn("_tokens", tokenize(F.col("document"), analyzer))
    if "embedding" not in given and (embed is not None or dim is not None):
        default = embed is None and (props.get("embedder") or "hashed_tf") == "hashed_tf"
        vector = hashed_tf_embedding(F.col("_tokens"), dim) if default else (embed or embedder_of(props))(F.col("document"))
        recs = recs.withColumn("embedding", vector)
    recs = add_typed_columns(recs, typed_fields)
    reason = F.when(F.col("id").isNull(), F.lit("missing_id")).when(~storable(), F.lit("not_storable"))
    if dim is not None and "embedding" in recs.columns:
        reason = reason.when(F.coalesce(F.size("embedding"), F.lit(-1)) != dim, F.lit("dimension"))
    length = F.size("_tokens").cast("long")
    rows = recs.withColumns({"reject_reason": reason, "_seq": F.monotonically_increasing_id(), "dl": length}).drop("_tokens")
    keep = [c for c in rows.columns if c not in ("reject_reason", "_seq", "_pos")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.select(*keep).schema])

    def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation(f"ingest-{batch}")
        good = F.col("reject_reason").isNull()
        return df.observe(seen, F.count_if(good).alias("n_stored"), F.coalesce(F.sum(F.when(good, F.col("dl"))), F.lit(0)).alias("n_tokens"), F.count_if(~good).alias("n_rejected")), seen

    folder = f"ingest_batch={batch}"
    rows, seen = counted(rows)
    rows.write.mode("overwrite").parquet(f"{p['records']}/{folder}")
    staged = spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])).parquet(f"{p['records']}/{folder}")
    done("records")

    ok = staged.where("reject_reason is null")
    _write_keys(ok, f"{p['keys']}/{folder}")
    keys = spark.read.schema(piece_schema(rows.schema["id"].dataType)).parquet(f"{p['keys']}/{folder}")
    repeated = keys.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    known = _known(spark, location, live, keys, f"{p['staging']}/{batch}-maybe")
    done("keys")

    if seen.get["n_rejected"] or repeated or known is not None:
        losers = _losers(ok, repeated, known, [c for c in records.columns if c not in ("id", "_pos")])
        losers.write.mode("overwrite").parquet(f"{p['staging']}/{batch}-losers")
        losers = spark.read.schema(losers.schema).parquet(f"{p['staging']}/{batch}-losers")
        folder = f"ingest_batch={batch}-kept"
        n_in_all = seen.get["n_stored"] + seen.get["n_rejected"]
        winners, seen = counted(ok.join(losers, "_seq", "left_anti"))
        winners.select(*keep, "reject_reason").drop("reject_reason").write.mode("overwrite").parquet(f"{p['records']}/{folder}")
        rejected = staged.join(losers, "_seq", "left").withColumn("reject_reason", F.coalesce("reject_reason", "_why")).where("reject_reason is not null")
        rejected.select(*keep, "reject_reason").write.mode("overwrite").parquet(f"{p['quarantine']}/ingest_batch={batch}")
        _write_keys(spark.read.schema(schema).parquet(f"{p['records']}/{folder}"), f"{p['keys']}/ingest_batch={batch}")
        done("quarantine")
    got = {k: seen.get[k] for k in ("n_stored", "n_tokens")}
    n_rejected = 0 if folder == f"ingest_batch={batch}" else n_in_all - got["n_stored"]

    _write_postings(spark.read.schema(schema).parquet(f"{p['records']}/{folder}"), analyzer, p, batch)
    done("postings")
    _commit(
        spark, location, ingest_batch=batch, folder=folder, schema=schema.json(), n_docs=got["n_stored"], total_terms=got["n_tokens"],
        n_rejected=n_rejected, run=epoch[0] if epoch else None, epoch=epoch[1] if epoch else None,
    )
    _delete(spark, f"{p['staging']}/{batch}-maybe", f"{p['staging']}/{batch}-losers")
    if n_rejected:
        _delete(spark, f"{p['records']}/ingest_batch={batch}")
    return _outcome(spark, location, batch) | {"progress": got}


def _outcome(spark: SparkSession, location: str, batch: str) -> dict[str, Any]:
    own = [r for r in _live(spark, location) if r.ingest_batch == batch]
    rejected = _read(spark, location, "quarantine", own)
    copies = rejected.where("reject_reason = 'duplicate_in_batch'").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    # Numbers observed while the batch was written (no extra pass)
    progress = {"n_stored": own[0].n_docs, "n_tokens": own[0].total_terms} if own else {"n_stored": 0, "n_tokens": 0}
    return {"stored": _read(spark, location, "records", own), "rejected": rejected, "duplicates_in_batch": copies, "progress": progress}


def _known(spark: SparkSession, location: str, live: list[Row], keys: DataFrame, scratch: str) -> DataFrame | None:
    """Ids of the new pieces that are stored already, None if no filter lets any pass."""
    if not live:
        return None
    stored = _stored_keys(spark, location, live)
    maybe = possible(keys, stored)
    maybe.write.mode("overwrite").parquet(scratch)
    maybe = spark.read.schema(maybe.schema).parquet(scratch)
    where = maybe.groupBy("ingest_batch").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row per append
    if not where:
        return None
    return confirmed(maybe, stored.where(F.col("ingest_batch").isin([r.ingest_batch for r in where])))


def _losers(ok: DataFrame, repeated: int, known: DataFrame | None, given: list[str]) -> DataFrame:
    """``(_seq, _why)`` of duplicate rows; a later copy of a stored id is a duplicate in the batch first."""
    parts = [ok.where(F.lit(False)).select("_seq", F.lit("").alias("_why"))]
    if repeated:
        # of each id the first copy; the columns of equal copies are equal, the row number decides
        twice = ok.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        copies = ok.join(twice, "id")
        tied = F.struct(*(["_pos"] if "_pos" in ok.columns else []), F.md5(F.to_json(F.struct(*given))).alias("_content"), "_seq")
        firsts = copies.groupBy("id").agg(F.min(tied).alias("_first"))
        parts.append(copies.join(firsts, "id").where(tied != F.col("_first")).select("_seq", F.lit("duplicate_in_batch").alias("_why")))
    if known is not None:
        parts.append(ok.select("id", "_seq").join(known, "id", "left_semi").select("_seq", F.lit("duplicate_id").alias("_why")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("_seq").agg(F.max("_why").alias("_why"))


def _write_keys(records: DataFrame, path: str) -> None:
    """The pieces of the ids of stored records, with the file of each."""
    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    key_pieces(records.select("id", file.alias("file"))).write.mode("overwrite").parquet(path)


#: Documents whose tokens a Python worker is sent at once while postings are made.
POSTING_ROWS = 512
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _write_postings(records: DataFrame, analyzer: str, p: dict[str, str], batch: str) -> None:
    """Postings of an append, sorted by term inside each task (no shuffle), and its df and cf per term."""
    tokens = records.select("id", tokenize(F.col("document"), analyzer).alias("tokens"))
    posts = postings_of_tokens(tokens).select("term", "id", "tf", "dl")
    conf = records.sparkSession.conf
    before = conf.get(ARROW_ROWS)
    conf.set(ARROW_ROWS, str(min(int(before), POSTING_ROWS) if int(before) > 0 else POSTING_ROWS))
    try:
        posts.sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{p['postings']}/ingest_batch={batch}")
    finally:
        conf.set(ARROW_ROWS, before)
    posts = records.sparkSession.read.schema(posts.schema).parquet(f"{p['postings']}/ingest_batch={batch}")
    term_stats(posts).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{p['terms']}/ingest_batch={batch}")


def z_value(records: DataFrame, fields: list[str], bits: int = 8) -> Column:
    """P17 — position on a Z-order curve over up to seven ``fields``: the bits of their quantiles (of a text: its hash) interleaved.

    Quantiles come from one approximate aggregate: ``2^bits`` numbers a field reach the driver.
    """
    numeric = [f for f in fields if not isinstance(records.schema[f].dataType, T.StringType)]
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = records.agg(*[F.percentile_approx(f, steps).alias(f) for f in numeric]).first() if numeric else None
    z = F.lit(0).cast("long")
    for n, f in enumerate(fields):
        if f in numeric:
            cuts = sorted({c for c in row[f] or []})
            place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(f))) if cuts else F.lit(0)
            place = F.coalesce(place, F.lit(0))
        else:
            place = F.coalesce(F.pmod(F.xxhash64(f), F.lit(1 << bits)).cast("int"), F.lit(0))
        for bit in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(fields) + n))
    return z


def compact(spark: SparkSession, location: str, cluster_by: list[str] | None = None, files: int | None = None) -> None:
    """Fold all appends into one: records and postings in ranges, statistics summed, one set of keys.

    Records are laid out by id, or along a Z-order curve over the columns ``cluster_by``
    (P17), so that a filter on any of them skips files by their statistics.  The commit of the
    result names the appends it replaces, so readers change over at once; the replaced
    folders are removed after it.
    """
    live = _live(spark, location)
    if not live or (len(live) < 2 and not cluster_by):
        return
    p, batch, parts = _paths(location), uuid.uuid4().hex, files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"ingest_batch={batch}"
    records = _read(spark, location, "records", live)
    laid = records.withColumn("_z", z_value(records, cluster_by) if cluster_by else F.lit(0).cast("long"))
    laid = laid.repartitionByRange(parts, "_z", "id").sortWithinPartitions("_z", "id").drop("_z")
    laid.write.parquet(f"{p['records']}/{folder}")
    _read(spark, location, "postings", live).repartitionByRange(parts, "term", "id").sortWithinPartitions("term", "id").write.parquet(f"{p['postings']}/{folder}")
    terms = _read(spark, location, "terms", live).groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    terms.repartitionByRange(parts, "term").sortWithinPartitions("term").write.parquet(f"{p['terms']}/{folder}")
    _write_keys(spark.read.schema(records.schema).parquet(f"{p['records']}/{folder}"), f"{p['keys']}/{folder}")
    if any(r.n_rejected for r in live):
        _read(spark, location, "quarantine", live).write.parquet(f"{p['quarantine']}/{folder}")
    epochs: dict[str, int] = {}
    for r in live:
        for run, number in [*(r.epochs or {}).items(), *([(r.run, r.epoch)] if r.run is not None else [])]:
            epochs[run] = max(number, epochs.get(run, -1))
    total = lambda f: sum(r[f] for r in live)
    _commit(
        spark, location, ingest_batch=batch, folder=folder, schema=records.schema.json(), n_docs=total("n_docs"), total_terms=total("total_terms"),
        n_rejected=total("n_rejected"), replaces=[b for r in live for b in [r.ingest_batch, *(r.replaces or [])]], epochs=epochs,
    )
    _delete(spark, *(f"{p[k]}/{r.folder if k == 'records' else 'ingest_batch=' + r.ingest_batch}" for r in live for k in DATASETS))


def get_collection(spark: SparkSession, location: str) -> DataFrame:
    """S5 — the records of a collection."""
    return _read(spark, location, "records")


#: Files named in one read at most; more winners than that are joined with all records.
MAX_FILES = 10_000


def files_of(spark: SparkSession, location: str, ids: DataFrame, live: list[Row]) -> list[tuple[str, str]] | None:
    """(append, file) of every stored id of a one-column table, from the key pieces alone; None if they are too many to name."""
    stored = _stored_keys(spark, location, live)
    found = located(possible(key_pieces(ids), stored), stored).select("ingest_batch", "file").distinct()
    rows = found.limit(MAX_FILES + 1).collect()
    return [(r["ingest_batch"], r["file"]) for r in rows] if len(rows) <= MAX_FILES else None


def hydrate_stored(spark: SparkSession, location: str, winners: DataFrame, payload: list[str]) -> DataFrame:
    """H7 on a stored collection — payload columns of the winners, read from the files that hold them and no others."""
    live = _live(spark, location)
    records = _read(spark, location, "records", live)
    files = files_of(spark, location, winners.select("id"), live) if live else None
    if files:
        folders, path = {r.ingest_batch: r.folder for r in live}, _paths(location)["records"]
        records = spark.read.schema(records.schema).parquet(*(f"{path}/{folders[b]}/{f}" for b, f in files))
    return winners.join(records.select("id", *payload), "id")


def collection_info(spark: SparkSession, location: str, name: str | None = None) -> DataFrame:
    """S7 — ``(name, n_records, error)``; a missing collection gives 0 and the error text."""
    schema = "name string, n_records bigint, error string"
    if not exists(spark, location):
        return spark.createDataFrame([(name or location, 0, f"collection not found: {location}")], schema)
    props = properties(spark, location)
    recs = get_collection(spark, location)
    return recs.agg(F.count(F.lit(1)).alias("n_records")).select(
        F.lit(props["name"]).alias("name"), "n_records", F.lit(None).cast("string").alias("error")
    )


def stored_stats(spark: SparkSession, location: str, live: list[Row] | None = None) -> DataFrame:
    """T3 from the commits: one row ``n_docs, avgdl``."""
    live = _live(spark, location) if live is None else live
    n, terms = sum(r.n_docs for r in live), sum(r.total_terms for r in live)
    return spark.createDataFrame([(n, terms / n if n else None)], "n_docs bigint, avgdl double")


#: Vocabularies up to this size are pushed to the scan as equality predicates (row groups without the term are skipped).
PUSHED_TERMS = 32


def _of_terms(df: DataFrame, vocab: list[str]) -> DataFrame:
    """Rows of ``vocab``: row groups sorted by term are skipped by predicates, the rest by a bounded broadcast semi join."""
    term = F.col("term")
    if len(vocab) <= PUSHED_TERMS:
        wanted = F.lit(False)
        for t in vocab:
            wanted = wanted | (term == t)
        return df.where(wanted)
    vocab_df = df.sparkSession.createDataFrame([(t,) for t in vocab], "term string")
    return df.where((term >= min(vocab)) & (term <= max(vocab))).join(F.broadcast(vocab_df), "term", "left_semi")


def query_postings(spark: SparkSession, location: str, vocab: list[str], live: list[Row] | None = None) -> DataFrame:
    """Postings of ``vocab`` only."""
    return _of_terms(_read(spark, location, "postings", live), vocab)


def document_frequencies(spark: SparkSession, location: str, vocab: list[str], live: list[Row] | None = None) -> dict[str, int]:
    """T3 — stored df of ``vocab`` (bounded by the caller): the appends' partial counts summed; no posting is read."""
    stored = _of_terms(_read(spark, location, "terms", live), vocab)
    return {r["term"]: r["df"] for r in stored.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _indexed_kernel(bc, k: int, qid_col: str, kinds: list):
    """Scores postings that arrive sorted by document as a stream: memory holds one batch and the last document."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from quarry.operators.fulltext import TermIndex, bm25_weights, offer_scores, winners
    from quarry.operators.topk import RunningTopK

    def kernel(batches):
        vocab_list, idf, qids, qterm_idx, avgdl, k1, b = bc.value
        vocab = pa.array(vocab_list, type=pa.string())
        index = TermIndex(qterm_idx, len(vocab_list))
        best = RunningTopK(len(qids), k)

        def score(t: pa.Table) -> None:
            ids = t.column(0).combine_chunks().to_numpy(zero_copy_only=False)
            new = np.r_[True, ids[1:] != ids[:-1]]
            code = pc.index_in(t.column(1).combine_chunks(), value_set=vocab).to_numpy(zero_copy_only=False).astype(np.int64)
            tf, dl = (t.column(i).to_numpy().astype(np.float64) for i in (2, 3))
            offer_scores(best, index, np.cumsum(new) - 1, code, bm25_weights(idf[code], tf, dl, avgdl, k1, b), ids[new])

        held = None
        for rb in batches:
            t = pa.Table.from_batches([rb])
            t = t if held is None else pa.concat_tables([held, t])
            ids = t.column(0).combine_chunks().to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            whole = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if (ids != ids[-1]).any() else 0
            if whole:
                score(t.slice(0, whole))
            held = t.slice(whole)
        if held is not None and held.num_rows:
            score(held)
        yield from winners(best, qids, qid_col, "id", kinds)

    return kernel


def bm25_indexed(
    spark: SparkSession,
    location: str,
    queries: DataFrame,
    k: int,
    where: dict[str, Any] | None = None,
    qid_col: str = "query_id",
    qtext_col: str = "query_text",
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """T5 over a stored collection, per pass of queries:

    * postings of the pass vocabulary only;
    * N and avgdl from the commits, df from the stored term statistics (one
      row per vocabulary term reaches the driver): no aggregate over postings;
    * the matched postings (never multiplied by the number of queries) are
      shuffled by document id and scored as a sorted stream in
      ``mapInArrow``, keeping a running top-k;
    * two ``WindowGroupLimit`` windows merge the partition winners.
    """
    import math

    import numpy as np
    from quarry.functions.vectors import from_key
    from quarry.operators.filters import build_filter
    from quarry.operators.fulltext import SCORE_SCALE, _arrow_type, _query_term_passes, score_schema
    from quarry.operators.topk import merge_top_k

    props = properties(spark, location)
    analyzer = props.get("analyzer") or "basic"
    live = _live(spark, location)
    st = stored_stats(spark, location, live).first()
    n_docs, avgdl = st["n_docs"] or 0, st["avgdl"] or 0.0
    recs = _read(spark, location, "records", live)
    schema = score_schema(qid_col, "id", queries, recs)
    kinds = [_arrow_type(f.dataType) for f in schema]
    parts = []
    for chunk in _query_term_passes(queries, qid_col, qtext_col, analyzer) if n_docs else []:
        vocab = sorted({t for _, terms in chunk for t in terms})
        post = query_postings(spark, location, vocab, live)
        dfs = document_frequencies(spark, location, vocab, live)
        pos = {t: i for i, t in enumerate(vocab)}
        idf = np.array([math.log(1.0 + (n_docs - dfs.get(t, 0) + 0.5) / (dfs.get(t, 0) + 0.5)) for t in vocab])
        qids = [q for q, _ in chunk]
        qterm_idx = [np.array([pos[t] for t in terms], dtype=np.int64) for _, terms in chunk]
        bc = spark.sparkContext.broadcast((vocab, idf, qids, qterm_idx, float(avgdl), k1, b))
        cand = post
        if where:
            keep = recs.where(build_filter(where, recs.columns)).select("id")
            cand = cand.join(keep, "id", "left_semi")
        by_doc = cand.select("id", "term", "tf", "dl").repartition("id").sortWithinPartitions("id", "term")
        parts.append(by_doc.mapInArrow(_indexed_kernel(bc, k, qid_col, kinds), schema))
    if not parts:
        return spark.createDataFrame([], schema).select(
            qid_col, "id", F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("rank")
        )
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    ranked = merge_top_k(out, [qid_col], [F.col("score_key").desc(), F.col("id").asc()], "id", k)
    return ranked.select(qid_col, "id", from_key(F.col("score_key"), SCORE_SCALE).alias("score"), "rank")


def knn_stored(spark: SparkSession, location: str, queries: DataFrame, k: int, where: dict[str, Any] | None = None, **kw) -> DataFrame:
    """V7/V8 over a stored collection: its vectors, metric and dimension; filters on typed columns reach the scan."""
    from quarry.operators.filters import build_filter
    from quarry.operators.knn import knn

    props = properties(spark, location)
    recs = get_collection(spark, location)
    pred = build_filter(where, recs.columns) if where else None
    return knn(recs, queries, k, metric=props["metric"], where=pred, dim=props["dimension"], **kw)


def hybrid_stored(
    spark: SparkSession,
    location: str,
    queries: DataFrame,
    k: int = 10,
    n_text: int | None = None,
    n_vector: int | None = None,
    where: dict[str, Any] | None = None,
    payload: list[str] | None = None,
) -> DataFrame:
    """H1 over a stored collection: pruned postings, stored statistics and vectors; no document is tokenised or embedded.

    Analyzer, metric, dimension and embedder are the collection's.
    """
    from quarry.operators.hybrid import display_order, fuse_rrf

    props = properties(spark, location)
    text = bm25_indexed(spark, location, queries, n_text or k, where).withColumnRenamed("rank", "text_rank")
    qs = queries.withColumn("query_vector", embedder_of(props)(F.col("query_text")))
    vector = knn_stored(spark, location, qs, n_vector or k, where).withColumnRenamed("rank", "vector_rank")
    shown = display_order(fuse_rrf([text, vector], ["text_rank", "vector_rank"], k))
    if not payload:
        return shown
    # the fused rows are few and used twice: for the files that hold them and for the join
    path = f"{shared_dir(spark, 'winners')}"
    shown.write.parquet(path)
    return hydrate_stored(spark, location, spark.read.schema(shown.schema).parquet(path), payload)


__all__ = [
    "add_records",
    "add_typed_columns",
    "bm25_indexed",
    "collection_info",
    "compact",
    "create_collection",
    "document_frequencies",
    "get_collection",
    "hybrid_stored",
    "hydrate_stored",
    "knn_stored",
    "properties",
    "query_postings",
    "stored_stats",
    "typed_column",
]
