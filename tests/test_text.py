"""Hand-made edge rows (FIXTURES §4) for the cleaning, validation and fallback semantics."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.numeric import clean_float, clean_int
from quarry.functions.text import json_safe, sanitize, snippet, strip_unicode
from quarry.operators.prepare import prepare_records


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).first()["r"]


def test_sanitize_edges(spark):
    assert one(spark, sanitize, None) == ""
    assert one(spark, sanitize, "  a\t\tb  ") == "a b"
    assert one(spark, sanitize, "a\n \n\nb") == "a\nb"
    assert one(spark, sanitize, "x\x00\x07y\x7f\x9fz") == "xyz"
    assert one(spark, sanitize, "　 abc ") == "abc"  # Unicode strip
    assert one(spark, sanitize, "keep\ttab? no: a\tb") == "keep tab? no: a b"


def test_json_safe_edges(spark):
    assert one(spark, json_safe, "a\nb") == "ab"
    assert one(spark, json_safe, 'say "x" “y”') == "say 'x' “y”"
    assert one(spark, json_safe, None) is None


def test_strip_is_python_strip(spark):
    samples = ["  hi  ", "\n\r\tx\n", "​zero-width​", ""]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r["r"] for r in df.select(strip_unicode("v").alias("r")).collect()]
    assert got == [s.strip() for s in samples]


def test_clean_float(spark):
    for v in [float("inf"), float("nan"), None]:
        assert one(spark, lambda c: clean_float(c, T.DoubleType()), v, "double") == 0.0
    assert one(spark, lambda c: clean_float(c, T.StringType()), "abc") == 0.0
    assert one(spark, lambda c: clean_float(c, T.StringType()), "4.7f") == 0.0
    assert one(spark, lambda c: clean_float(c, T.StringType()), " 4.5 ") == 4.5
    assert one(spark, lambda c: clean_float(c, T.StringType()), "1e400") == 0.0


def test_clean_int(spark):
    assert one(spark, lambda c: clean_int(c, T.DoubleType()), 4.9, "double") == 4
    assert one(spark, lambda c: clean_int(c, T.DoubleType()), -4.9, "double") == -4
    assert one(spark, lambda c: clean_int(c, T.StringType()), "4.9") == 0
    assert one(spark, lambda c: clean_int(c, T.StringType()), "12.0") == 0
    assert one(spark, lambda c: clean_int(c, T.StringType()), " 42 ") == 42
    assert one(spark, lambda c: clean_int(c, T.DoubleType()), float("nan"), "double") == 0
    assert one(spark, lambda c: clean_int(c, T.DoubleType()), float("inf"), "double") is None


def test_snippet(spark):
    assert one(spark, lambda c: snippet(c, 3), "abcdef") == "abc..."
    assert one(spark, lambda c: snippet(c, 10), "abc") == "abc"
    assert one(spark, lambda c: snippet(c, 10, always_ellipsis=True), "abc") == "abc..."


RAW = "Name string, Author string, `User Rating` double, Reviews bigint, Price double, Year bigint, Genre string, k bigint"


def prepared(spark, rows):
    df = spark.createDataFrame(rows, RAW)
    return {r["id"]: r for r in prepare_records(df, id_col="k").collect()}


def test_validation_and_fallback(spark):
    long_name = "n" * 600
    rows = [
        ("A", "B", 5.0, 1, 1.0, 2000, "G", 0),  # valid, boundary rating
        ("A", "B", 5.01, 1, 1.0, 2000, "G", 1),  # rating fails
        ("A", "B", 4.0, 1, 1.0, None, "G", 2),  # missing year -> 0 -> fails
        ("A", "B", 9.0, 1, 1.0, 1, "G", 3),  # rating first
        ("A", "", 9.0, 1, 1.0, 2000, "", 4),  # invalid + empty author -> Unknown
        ("A", "", 4.0, 1, 1.0, 2000, "", 5),  # valid + empty author -> ""
        (long_name, "B", 4.0, 1, 1.0, 2000, "G", 6),  # valid: capped at 500
        (long_name, "B", 9.0, 1, 1.0, 2000, "G", 7),  # invalid: not capped
        ("A", "B", 4.0, -1, 1.0, 2000, "G", 8),  # reviews
        ("A", "B", 4.0, 1, -0.5, 2000, "G", 9),  # price before reviews
        ("A", "B", None, None, None, 1950, None, 10),  # missing numbers pass as 0
    ]
    r = prepared(spark, rows)
    assert r["0"]["invalid_reason"] is None and r["0"]["user_rating"] == 5.0
    assert r["1"]["invalid_reason"] == "user_rating"
    assert r["2"]["invalid_reason"] == "year" and r["2"]["year"] == 2000 and r["2"]["user_rating"] == 0.0
    assert r["3"]["invalid_reason"] == "user_rating"
    assert r["4"]["author"] == "Unknown" and r["4"]["genre"] == "Unknown" and r["4"]["reviews"] == 0
    assert r["5"]["author"] == "" and r["5"]["invalid_reason"] is None
    assert len(r["6"]["name"]) == 500
    assert len(r["7"]["name"]) == 600
    assert r["8"]["invalid_reason"] == "reviews"
    assert r["9"]["invalid_reason"] == "price"
    assert r["10"]["invalid_reason"] is None and r["10"]["genre"] == "" and r["10"]["user_rating"] == 0.0
    assert r["0"]["document"] == "A B"
    assert r["0"]["metadata"].startswith('{"name":"A","author":"B","user_rating":5.0')


def test_document_json_safe_once_metadata_twice(spark):
    rows = [("a \n b", 'say "hi"', 4.0, 1, 1.0, 2000, "G", 0)]
    r = prepared(spark, rows)["0"]
    # the document is JSON-cleaned once: the deleted newline leaves two spaces
    assert r["document"] == "a  b say 'hi'"
    # the metadata is cleaned twice: the second pass collapses the spaces
    assert r["name"] == "a b"
    assert r["author"] == "say 'hi'"
    assert r["user_rating"] == 4.0


def test_json_safe_value_nested(spark):
    from quarry.functions.text import json_safe_value

    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    df = spark.createDataFrame(
        [(["x\ty", None], float("nan"), 3, None)], "l array<string>, f double, i int, s string"
    ).select(F.create_map(F.lit("a\n"), F.lit(1.0), F.lit("a"), F.lit(float("inf"))).alias("m"), "*")
    row = df.select(*[json_safe_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]).first()
    assert row["m"] == {"a": 0.0}  # keys cleaned, colliding keys: last wins, inf -> 0.0
    assert row["l"] == ["x y", None]
    assert row["f"] == 0.0 and row["i"] == 3 and row["s"] is None


def test_read_csv_pandas_nulls_and_quotes(spark, tmp_path):
    from quarry.sources.raw import BOOK_SCHEMA, read_csv

    p = tmp_path / "books.csv"
    p.write_text(
        'Name,Author,User Rating,Reviews,Price,Year,Genre\n'
        '"A ""quoted"" name",NA,4.5,10,9.99,2019,Fiction\n'
        '"multi\nline",Bob,N/A,null,1,2020,None\n'
    )
    rows = read_csv(spark, str(p), schema=BOOK_SCHEMA, pandas_nulls=True, multi_line=True).collect()
    assert rows[0]["Name"] == 'A "quoted" name' and rows[0]["Author"] is None
    assert rows[1]["Name"] == "multi\nline" and rows[1]["User Rating"] is None and rows[1]["Genre"] is None
    plain = read_csv(spark, str(p), schema=BOOK_SCHEMA).collect()
    assert plain[0]["Author"] == "NA"


def test_with_row_ids_consecutive(spark):
    from quarry.operators.prepare import with_row_ids

    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "v")
    rows = with_row_ids(df, "pos").collect()
    assert sorted(r["pos"] for r in rows) == list(range(1000))
    assert all(r["pos"] == r["v"] for r in rows)  # scan order


def test_read_csv_rejects_reordered_header(spark, tmp_path):
    import pytest

    from quarry.sources.raw import BOOK_SCHEMA, read_csv

    p = tmp_path / "reordered.csv"
    p.write_text("Author,Name,User Rating,Reviews,Price,Year,Genre\nBob,A,4.5,10,9.99,2019,Fiction\n")
    with pytest.raises(Exception):
        read_csv(spark, str(p), schema=BOOK_SCHEMA).collect()
