"""The q-gram anchor index against plain containment."""

import numpy as np
import pytest

from quarry.operators import substring
from quarry.operators.fulltext import fulltext_get
from quarry.operators.substring import Matcher, substring_matches


def brute(docs, queries):
    return sorted((q, i) for q, kw in queries for i, t in docs if kw is not None and t is not None and kw in t)


def run(spark, docs, queries, **kw):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "id long, document string, query_id string").repartition(3)
    q = spark.createDataFrame(queries, "query_id long, query_text string")
    return sorted(map(tuple, substring_matches(d, q, **kw).collect()))


def texts(n=300):
    r = np.random.default_rng(3)
    syllables = ["the", "an", "é", "日本", "ing ", " ", "tio", "n", "😀", "\n", "a", "th"]
    out = [(i, "".join(syllables[j] for j in r.integers(0, len(syllables), r.integers(0, 120)))) for i in range(n)]
    return out + [(n, None), (n + 1, ""), (n + 2, "needle" * 3), (n + 3, "x" * 50_000 + "the end" + "y" * 9)]


def keywords(docs):
    r = np.random.default_rng(4)
    cut = []
    for i, t in docs[:120]:
        if t:
            a = int(r.integers(0, len(t)))
            cut.append(t[a : a + int(r.integers(1, 60))])
    return cut + ["", None, "a", "th", "the", "then", "日本", "😀", "needleneedle", "needlenee", "the end", "yyyyyyyyy", "yyyyyyyyyy", "nowhere at all", "x" * 49_000, docs[5][1], docs[5][1]]


def test_equals_containment(spark, monkeypatch):
    docs = texts()
    queries = list(enumerate(keywords(docs)))
    want = brute(docs, queries)
    assert run(spark, docs, queries) == want
    # small segments, blocks of pairs and broadcasts: the same
    for name, value in (("SEGMENT", 64), ("PAIRS", 50), ("MAX_NEEDLE_BYTES", 300)):
        monkeypatch.setattr(substring, name, value)
    assert run(spark, docs[:120], queries[:60]) == brute(docs[:120], queries[:60])


def test_case_and_empty_tables(spark):
    docs = [(1, "Straße ÉCOLE"), (2, "école"), (3, None)]
    assert run(spark, docs, [(0, "École")], case_sensitive=False) == [(0, 1), (0, 2)]
    assert run(spark, [], [(0, "a")]) == [] and run(spark, docs, []) == [] and run(spark, docs, [(0, None)]) == []


@pytest.mark.parametrize("sample", ["", "common words only"])
def test_the_anchor_is_a_choice_of_speed_only(sample):
    data = np.frombuffer("common words and a rare zyxwvuts word, common words".encode(), np.uint8)
    needles = [b"common words", b"words and", b"zyxwvuts", b"rare zyxwvuts word", b"absent from it", b"o", b"wor", b"word,"]
    got = Matcher(needles, np.frombuffer(sample.encode(), np.uint8)).match(data, np.array([0, len(data)]))
    assert got.tolist() == [0, 1, 2, 3, 5, 6, 7]


def test_get_takes_the_first_ids(spark):
    d = spark.createDataFrame([(i, "every text has this") for i in range(500)], "id long, document string").repartition(8)
    q = spark.createDataFrame([(1, "has th"), (2, "none")], "query_id long, query_text string")
    assert [tuple(r) for r in fulltext_get(d, q, 3).orderBy("rank").collect()] == [(1, 0, 1), (1, 1, 2), (1, 2, 3)]
