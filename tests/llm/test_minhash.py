import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.minhash_dedup import K, cross_links, near_duplicates, one_per_class, prob_minhash
from tests.llm.helpers import LOWER, Groups, bag, bag_similarity, documents, prose, words


def brute_classes(rows):
    bags = {i: bag(words((t or "").translate(LOWER))) for i, t in rows}
    groups = Groups(bags)
    ids = sorted(bags)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if bags[a] and bags[b] and bag_similarity(bags[a], bags[b]) >= 0.8:
                groups.join(a, b)
    return {i: groups.find(i) for i in ids}


def test_registers_agree_with_probability_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    a, b = base[:240], base[60:]
    wa, wb = np.ones(240), np.ones(240)
    wa[100:120] = 3.0
    rows = np.r_[np.zeros(240, int), np.ones(240, int)]
    names = prob_minhash(rows, np.r_[a, b], np.r_[wa, wb], 2, k=4000)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    exact = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
    assert abs((names[0] == names[1]).mean() - exact) < 0.04


def test_classes_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(spark).select("doc_id", "text")).collect()}
    assert got == brute_classes(rows)


def test_chain_behind_a_star_is_found(spark):
    # each text is near the next only: a star around the smallest cannot reach all of them
    base = prose(3, 400)
    texts = []
    for k in range(12):
        texts.append((k, " ".join(base)))
        at = 25 + 30 * k
        base = base[:at] + prose(100 + k, 6) + base[at + 6 :]
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute_classes(texts) and set(got.values()) == {0}


def test_hot_copies_null_empty_long_repeated(spark):
    long = " ".join(prose(5, 30_000))
    rows = [(i, "the very same words in every row here") for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \n "), (303, "one"), (304, "One"), (305, long), (306, long + " end"), (307, "solo text of its own words"), (307, "solo text of its own words"), (None, "solo text of its own words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.class_id for r in got}
    assert {by[i] for i in range(300)} == {0}
    assert [by[i] for i in (300, 301, 302, 303, 304, 305, 306, 307)] == [300, 301, 302, 303, 303, 305, 305, 307]
    assert by[None] == 307
    kept = one_per_class(df.withColumn("node", F.lit("x")).withColumn("n", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "node", "n"]
    assert sorted(r.doc_id for r in kept.collect()) == [0, 300, 301, 302, 303, 305, 307]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_blocks_join_all_components_of_a_bucket(spark):
    n = 1300  # three blocks of one bucket, two kinds of text
    kinds = [" ".join(prose(1, 60)), " ".join(prose(2, 60))]
    sigs = [bytes([7] * K), bytes([9] * K)]
    rows = [(1, n, f"{i:04d}".encode(), f"{i:04d}".encode(), sigs[i % 2], kinds[i % 2]) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, m long, node binary, component binary, sig binary, text string")
    links = [(r.a, r.b) for r in cross_links(df, 0.8, 0.1).collect()]
    groups = Groups(f"{i:04d}".encode() for i in range(n))
    for a, b in links:
        groups.join(a, b)
    assert len({groups.find(x) for x in groups.up}) == 2 and len(links) < 10 * n


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 9)], [(i + 1, i) for i in range(40)] + [(0, 100 + i) for i in range(60)]])
def test_components(spark, edges):
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for x in groups.up if any(a != b and x in (a, b) for a, b in edges)}
