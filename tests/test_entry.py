"""Driver contract: entry runs, every query has a name-matched oracle, a sample agrees with DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans import scenarios
from quarry.sources.raw import TABLES

SF = "/root/testdata/sf0.001"
NO_ORACLE = {"ivf_knn", "ivf_recall"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"query_id", "id", "rrf", "rrf_rank", "distance_rank"} <= set(df.columns)


def test_every_query_has_oracle():
    missing = set(scenarios.REGISTRY) - set(entry.oracle_sql())
    assert missing == NO_ORACLE


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, (list, tuple)):
            return tuple(n(x) for x in v)
        return v

    return [cols[i] for i in order], sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["prepare_books", "knn_cosine", "bm25_topk", "hybrid_rrf", "compare_overlap"])
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert _canon(df.columns, df.collect()) == _canon(rel.columns, rel.fetchall())
