"""Filter dictionaries -> predicates."""

import pytest

from quarry.operators.filters import apply_filters, build_filter


@pytest.fixture()
def books(spark):
    rows = [(1, "Fiction", 4.6, 2016, 12.0, 20000), (2, "Non Fiction", 4.4, 2010, 5.0, 500),
            (3, "Fiction", 3.9, 2019, 15.0, 9999), (4, "Fiction", 4.0, 2015, 15.01, 10000)]
    return spark.createDataFrame(rows, "id int, genre string, user_rating double, year int, price double, reviews int")


def ids(df):
    return sorted(r["id"] for r in df.collect())


# The filter dictionaries of the scenarios under test.
def test_reference_filters(books):
    assert ids(books.where(build_filter({"user_rating": {"$gte": 4.5}}))) == [1]
    assert ids(books.where(build_filter({"genre": "Non Fiction"}))) == [2]
    w = {"$and": [{"year": {"$gte": 2015}}, {"user_rating": {"$gte": 4.0}}, {"genre": "Fiction"}]}
    assert ids(books.where(build_filter(w))) == [1, 4]
    assert ids(books.where(build_filter({"reviews": {"$gte": 10000}}))) == [1, 4]
    w = {"$and": [{"price": {"$gte": 5}}, {"price": {"$lte": 15}}, {"user_rating": {"$gte": 4.0}}]}
    assert ids(books.where(build_filter(w))) == [1, 2]


def test_extensions_and_typed_columns(books, spark):
    assert ids(books.where(build_filter({"$or": [{"id": 1}, {"id": {"$in": [3]}}]}))) == [1, 3]
    assert ids(books.where(build_filter({"$not": {"genre": "Fiction"}}))) == [2]
    typed = books.withColumnRenamed("genre", "gen_genre")
    assert ids(typed.where(build_filter({"genre": "Fiction"}, typed.columns))) == [1, 3, 4]
    assert ids(books.where(build_filter({}))) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        build_filter({"$xor": []})


def test_document_filter(spark):
    docs = spark.createDataFrame([(1, "good book here"), (2, "Good Books"), (3, "nothing")], "id int, document string")
    assert ids(apply_filters(docs, where_document={"$contains": "good book"})) == [1]
    assert ids(apply_filters(docs, where_document={"$contains": "book"}, mode="tokens")) == [1]
    assert ids(apply_filters(docs, where_document={"$not_contains": "good"})) == [2, 3]
