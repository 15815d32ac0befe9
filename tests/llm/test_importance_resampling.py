import hashlib
import math
import re
import zlib

from pyspark.sql import functions as F

from quarry.llm.importance_resampling import drawn, numbered, resample

from .helpers import LOWER, prose

DOCS = "doc_id long, text string, weight string"


def brute(docs, target, ngram=1, buckets=50, share=(10, 100), min_words=20):
    def found(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]

    bags = [(i, *found(t)) for i, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, f in bags:
        for b in f:
            s[b] += 1
    for x in target:
        for b in found(x)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows, able = [], []
    for i, n, f in bags:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None])
        if n >= min_words and i is not None:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(able[: share[0] * len(able) // share[1]], 1):
        r[4] = rank
    return sorted(map(tuple, rows), key=repr)


def run(spark, docs, target, **kw):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], DOCS)
    t = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id long")
    return d, t, sorted((tuple(r) for r in resample(d, t, buckets=50, **kw).collect()), key=repr)


def corpus():
    docs = [(i, " ".join(prose(i % 17, 5 + i % 40))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "\x00 ,;"), (None, " ".join(prose(1, 40))), (1003, "ÀB-ÀB 日本 " * 30), (1004, "word " * 200_000), (1005, "x" * 300_000)]
    return docs + [(7, docs[7][1])] * 2  # repeated rows


def test_equals_brute_force(spark):
    target = [" ".join(prose(i, 30)) for i in (1, 2, 3)] + [None, ""]
    for ngram in (1, 3):
        assert run(spark, corpus(), target, ngram=ngram)[2] == brute(corpus(), target, ngram)
    assert run(spark, corpus(), target, share=(1, 2), min_words=1)[2] == brute(corpus(), target, share=(1, 2), min_words=1)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"])[2] == []
    assert run(spark, corpus()[:30], [])[2] == brute(corpus()[:30], [])


def test_drawn_rows_are_whole(spark):
    target = [" ".join(prose(1, 30))]
    docs, wanted, rows = run(spark, corpus(), target, share=(1, 2))
    texts = dict(corpus())
    got = {r.doc_id: r for r in drawn(docs, wanted, buckets=50, share=(1, 2)).collect()}
    assert set(got) == {r[0] for r in rows if r[4] is not None}
    assert all(r.text == texts[i] and r.weight == "clash" for i, r in got.items())


def test_a_crowd_of_equal_keys_is_numbered(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    got = [(r["rank"], r["k"]) for r in numbered(rows, [F.col("k").desc()]).orderBy("rank").collect()]
    assert [r for r, _ in got] == list(range(1, 5001)) and [k for _, k in got] == sorted((k for _, k in got), reverse=True)
