"""Result-set comparison (C1-C6) and timing roll-ups.

Comparison works on two ranked result DataFrames keyed by ``(query_id, id)``:
distinct ids (C1), a full outer join with membership flags gives the
intersection and both differences (C2/C3) in one shuffle, and one
``groupBy(query_id)`` produces the overlap report (C4) and member lists
(C5).  Member lists are only built over top-k results, so every list is
bounded by k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pct(num: Column, den: Column) -> Column:
    """``num / den * 100``, 0 when the denominator is 0 (A3, C4)."""
    return F.when(den > 0, num / den * F.lit(100.0)).otherwise(F.lit(0.0))


def distinct_ids(results: DataFrame, qid_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """C1."""
    return results.select(qid_col, id_col).distinct()


def intersect_ids(a: DataFrame, b: DataFrame, qid_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """C2 — ids in both results (semi join)."""
    return distinct_ids(a, qid_col, id_col).join(distinct_ids(b, qid_col, id_col), [qid_col, id_col], "left_semi")


def difference_ids(a: DataFrame, b: DataFrame, qid_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """C3 — ids only in ``a`` (anti join)."""
    return distinct_ids(a, qid_col, id_col).join(distinct_ids(b, qid_col, id_col), [qid_col, id_col], "left_anti")


def membership(a: DataFrame, b: DataFrame, names: tuple[str, str], qid_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """C2/C3 in one join — ``(query_id, id, membership)``: ``both``, or the name of the only result that has the id."""
    da = distinct_ids(a, qid_col, id_col).withColumn("_a", F.lit(True))
    db = distinct_ids(b, qid_col, id_col).withColumn("_b", F.lit(True))
    where = F.when(F.col("_b").isNull(), F.lit(names[0])).when(F.col("_a").isNull(), F.lit(names[1])).otherwise(F.lit("both"))
    return da.join(db, [qid_col, id_col], "full_outer").select(qid_col, id_col, where.alias("membership"))


def compare_results(
    a: DataFrame,
    b: DataFrame,
    queries: DataFrame | None = None,
    qid_col: str = "query_id",
    id_col: str = "id",
) -> DataFrame:
    """C4/C5 — per query: counts, overlap percentages and sorted member lists.

    Columns: ``n_a, n_b, n_common, n_a_only, n_b_only, overlap_pct_a,
    overlap_pct_b, common_ids, a_only_ids, b_only_ids``.  With ``queries``
    every query appears, zero-filled when neither side returned anything.
    """
    da = distinct_ids(a, qid_col, id_col).withColumn("_a", F.lit(True))
    db = distinct_ids(b, qid_col, id_col).withColumn("_b", F.lit(True))
    j = da.join(db, [qid_col, id_col], "full_outer")
    in_a = F.coalesce(F.col("_a"), F.lit(False))
    in_b = F.coalesce(F.col("_b"), F.lit(False))
    agg = j.groupBy(qid_col).agg(
        F.count_if(in_a).alias("n_a"),
        F.count_if(in_b).alias("n_b"),
        F.count_if(in_a & in_b).alias("n_common"),
        F.count_if(in_a & ~in_b).alias("n_a_only"),
        F.count_if(in_b & ~in_a).alias("n_b_only"),
        F.sort_array(F.collect_list(F.when(in_a & in_b, F.col(id_col)))).alias("common_ids"),
        F.sort_array(F.collect_list(F.when(in_a & ~in_b, F.col(id_col)))).alias("a_only_ids"),
        F.sort_array(F.collect_list(F.when(in_b & ~in_a, F.col(id_col)))).alias("b_only_ids"),
    )
    if queries is not None:
        id_type = a.schema[id_col].dataType.simpleString()
        empty = F.array().cast(f"array<{id_type}>")
        agg = queries.select(qid_col).join(agg, qid_col, "left").select(
            qid_col,
            *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_common", "n_a_only", "n_b_only")],
            *[F.coalesce(F.col(c), empty).alias(c) for c in ("common_ids", "a_only_ids", "b_only_ids")],
        )
    return agg.select(
        qid_col,
        "n_a",
        "n_b",
        "n_common",
        "n_a_only",
        "n_b_only",
        _pct(F.col("n_common"), F.col("n_a")).alias("overlap_pct_a"),
        _pct(F.col("n_common"), F.col("n_b")).alias("overlap_pct_b"),
        "common_ids",
        "a_only_ids",
        "b_only_ids",
    )


def comparison_rollup(report: DataFrame) -> DataFrame:
    """C6 — totals over queries and the micro-averaged overlap ``sum common / sum n_a * 100``."""
    t = report.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.sum("n_a").cast("long").alias("total_a"),
        F.sum("n_b").cast("long").alias("total_b"),
        F.sum("n_common").cast("long").alias("total_common"),
    )
    return t.withColumn("overlap_pct", _pct(F.col("total_common"), F.col("total_a")))


# ------------------------------------------------------------------ timing roll-ups


# Fixed value: decimals kept for summed measures (a floating sum depends on
# the order of its terms in the last bits; 9 decimals make it reproducible).
SUM_DECIMALS = 9


def _stable(c: Column) -> Column:
    return F.round(c, SUM_DECIMALS)


def measure_stats(
    timings: DataFrame, key_cols: list[str], value_col: str = "seconds"
) -> DataFrame:
    """A1 — avg, min, max, sum and count of a measure per key (partial + final hash aggregate)."""
    v = F.col(value_col)
    return timings.groupBy(*key_cols).agg(
        _stable(F.avg(v)).alias("avg"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        _stable(F.sum(v)).alias("total"),
        F.count(v).alias("n"),
    )


def side_by_side(
    timings: DataFrame,
    query_col: str,
    method_col: str,
    base_method: str,
    other_method: str,
    value_col: str = "seconds",
) -> DataFrame:
    """A2-A4 — per query: both averages, relative difference % and the faster method.

    ``diff_pct = (other - base) / base * 100`` (0 when base is 0); a
    positive difference means the base method is faster.
    """
    v = F.col(value_col)
    m = F.col(method_col)
    per_q = timings.where(m.isin(base_method, other_method)).groupBy(query_col).agg(
        _stable(F.avg(F.when(m == base_method, v))).alias("base_avg"),
        _stable(F.avg(F.when(m == other_method, v))).alias("other_avg"),
    )
    diff = _stable(F.coalesce(_pct(F.col("other_avg") - F.col("base_avg"), F.col("base_avg")), F.lit(0.0)))
    return per_q.select(
        query_col,
        "base_avg",
        "other_avg",
        F.coalesce(diff, F.lit(0.0)).alias("diff_pct"),
        F.when(F.coalesce(diff, F.lit(0.0)) > 0, F.lit(base_method)).otherwise(F.lit(other_method)).alias("faster"),
        F.abs(F.coalesce(diff, F.lit(0.0))).alias("diff_abs_pct"),
    )


def overall_summary(stats: DataFrame, method_col: str) -> DataFrame:
    """A5/A6 — per method: macro average of per-query averages, grand total, mean per query."""
    return stats.groupBy(method_col).agg(
        _stable(F.avg("avg")).alias("macro_avg"),
        _stable(F.sum("total")).alias("grand_total"),
        F.count(F.lit(1)).alias("n_queries"),
    ).withColumn("mean_per_query", _stable(F.col("grand_total") / F.col("n_queries")))
