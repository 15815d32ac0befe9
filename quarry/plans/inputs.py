"""The collections and query batches the scenarios run on, built from the given tables.

* ``vector_collection``: ``documents JOIN embeddings ON doc_id = vec_id``,
  i.e. records that carry a precomputed vector.
* ``vectors_only``: every vector of ``embeddings``.
* ``text_collection``: every document (text-only corpus).
* ``centroid_queries``: one query vector per embedding label, the label's
  mean vector (derived from the whole ``embeddings`` table).
* ``vector_queries``: every vector whose id is divisible by 100.
* ``benchmark_queries``: every ``benchmark`` passage as a query text.
* ``raw_books``: raw book rows from ``part`` (see ``books_from_part``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.knn import label_centroids
from quarry.sources.raw import books_from_part, read_table


def text_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", spread_by="doc_id")
    return d.select(
        F.col("doc_id").alias("id"), F.col("text").alias("document"), "lang", "source", "n_chars"
    )


def vector_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_collection(spark, sf_dir)
    emb = read_table(spark, sf_dir, "embeddings", spread_by="vec_id").select(
        F.col("vec_id").alias("id"), "embedding", "label"
    )
    return docs.join(emb, "id")


def vectors_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` with its id; no document column is needed to rank them."""
    return read_table(spark, sf_dir, "embeddings", spread_by="vec_id").select(F.col("vec_id").alias("id"), "embedding")


def centroid_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return label_centroids(emb, "label", "embedding")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors_only(spark, sf_dir).where(F.col("id") % 100 == 0).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def raw_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books_from_part(read_table(spark, sf_dir, "part", spread_by="p_partkey"))
