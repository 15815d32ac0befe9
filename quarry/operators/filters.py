"""Filter dictionaries -> Column predicates.

``build_filter`` turns the reference's metadata ``where`` dictionaries into
plain Column algebra, so Catalyst pushes the comparisons into the parquet
scan of typed columns (``PushedFilters``).  A field resolves to its typed
column ``gen_<field>`` when the collection has one, else to ``<field>``.
Missing fields are a SQL null comparison, i.e. no match.

Used by the reference: equality, ``$gte``, ``$lte``, ``$and``.
Also accepted (plain algebra, same rules): ``$eq $ne $gt $lt $in $nin $or $not``.

``document_filter`` handles ``where_document``: ``$contains`` as a literal,
case-sensitive substring (F7) or, with ``mode="tokens"``, as a token match
on the analyzer's token array (F8, any/all query tokens).
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.tokens import tokenize

_CMP = {
    "$eq": lambda c, v: c == F.lit(v),
    "$ne": lambda c, v: c != F.lit(v),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~c.isin(list(v)),
}


def field_column(field: str, columns: list[str] | None = None) -> Column:
    if columns is not None and f"gen_{field}" in columns:
        return F.col(f"gen_{field}")
    return F.col(f"`{field}`")


def _and(cs: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cs) if cs else F.lit(True)


def _or(cs: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cs) if cs else F.lit(False)


def build_filter(where: dict[str, Any] | None, columns: list[str] | None = None) -> Column:
    """F1-F6 — metadata filter dictionary -> predicate Column (True when empty)."""
    if not where:
        return F.lit(True)
    clauses = []
    for key, value in where.items():
        if key == "$and":
            clauses.append(_and([build_filter(w, columns) for w in value]))
        elif key == "$or":
            clauses.append(_or([build_filter(w, columns) for w in value]))
        elif key == "$not":
            clauses.append(~build_filter(value, columns))
        elif key.startswith("$"):
            raise ValueError(f"unknown logical operator {key!r}")
        else:
            col = field_column(key, columns)
            if isinstance(value, dict):
                parts = []
                for op, v in value.items():
                    if op not in _CMP:
                        raise ValueError(f"unknown comparison operator {op!r}")
                    parts.append(_CMP[op](col, v))
                clauses.append(_and(parts))
            else:
                clauses.append(col == F.lit(value))
    return _and(clauses)


def contains(doc: Column, keyword: str | Column, case_sensitive: bool = True) -> Column:
    """F7 — literal substring test."""
    kw = F.lit(keyword) if isinstance(keyword, str) else keyword
    if case_sensitive:
        return F.contains(doc, kw)
    return F.contains(F.lower(doc), F.lower(kw))


def contains_tokens(doc_tokens: Column, query_tokens: Column, require_all: bool = False) -> Column:
    """F8 — token reading: any (default) or all query tokens occur in the document."""
    if require_all:
        return F.size(F.array_except(query_tokens, doc_tokens)) == 0
    return F.arrays_overlap(doc_tokens, query_tokens)


def document_filter(
    where_document: dict[str, Any] | None,
    doc: Column | str = "document",
    mode: str = "substring",
    analyzer: str = "basic",
) -> Column:
    """F7/F8 — ``{"$contains": kw}`` / ``{"$not_contains": kw}`` / ``$and`` / ``$or``."""
    doc_col = F.col(doc) if isinstance(doc, str) else doc
    if not where_document:
        return F.lit(True)
    clauses = []
    for key, value in where_document.items():
        if key == "$and":
            clauses.append(_and([document_filter(w, doc_col, mode, analyzer) for w in value]))
        elif key == "$or":
            clauses.append(_or([document_filter(w, doc_col, mode, analyzer) for w in value]))
        elif key in ("$contains", "$not_contains"):
            if mode == "substring":
                c = contains(doc_col, value)
            elif mode == "tokens":
                c = contains_tokens(tokenize(doc_col, analyzer), tokenize(F.lit(value), analyzer))
            else:
                raise ValueError(f"unknown document filter mode {mode!r}")
            clauses.append(c if key == "$contains" else ~c)
        else:
            raise ValueError(f"unknown document operator {key!r}")
    return _and(clauses)


def apply_filters(
    df: DataFrame,
    where: dict[str, Any] | None = None,
    where_document: dict[str, Any] | None = None,
    doc_col: str = "document",
    mode: str = "substring",
) -> DataFrame:
    """F6/F9 — one filter shared by every leg of a search."""
    pred = build_filter(where, df.columns) & document_filter(where_document, doc_col, mode)
    return df.where(pred)
