import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language_ppm, shared
from quarry.llm.language_ppm import ContextTrees, identify, ngram_counts, sample_rows, train
from quarry.llm.shared import in_fold, text_chunks
from tests.llm.helpers import DOCS, SMALL

import pyarrow as pa


def brute_bits(samples, text, order=3):
    """Code length of ``text`` by escape method C, straight from the definition."""
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for s in samples:
        data = b"\0" * order + s.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[k][data[i - k : i]][data[i]] += 1
    bits, data = 0.0, b"\0" * order + text.encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            c = seen[k].get(data[i - k : i])
            if not c:
                continue
            total = sum(c.values()) + len(c)
            if c[data[i]]:
                bits -= math.log2(c[data[i]] / total)
                break
            bits -= math.log2(len(c) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_equal_the_definition(spark):
    samples = {"aa": ["the cat sat on the mat", "a hat"], "bb": ["der hund ist da", "größe"]}
    df = spark.createDataFrame([(k, t) for k, v in samples.items() for t in v], "lang string, text string")
    got = ngram_counts(df).toPandas()
    trees = ContextTrees(["aa", "bb"], (got["lang"] == "bb").to_numpy().astype(int), got["gram"].to_numpy(), got["n"].to_numpy(float))
    texts = ["the hat", "größe", "", "zzz", "漢 cat", "th"]
    for _, data, offs in text_chunks(pa.array(texts)):
        bits = trees.code_lengths(data, offs)
    want = np.array([[brute_bits(samples[k], t) for k in ("aa", "bb")] for t in texts])
    assert np.allclose(bits, want, rtol=1e-5)


def test_lengths_do_not_depend_on_slices(monkeypatch):
    """A long text scored in many slices: sums of the slices, also across texts."""
    import quarry.llm.language_ppm as ppm

    gram = np.array([(b << 8 | c) & 0xFFFFFFFF for b, c in zip(b"abcabcab", b"bcabcabx")])
    trees = ContextTrees(["x", "y"], np.array([0, 1] * 4), gram, np.ones(8), order=1)
    texts = ["abcab" * 50, "", "x", "zz abc"]
    whole = [trees.code_lengths(data, offs) for _, data, offs in text_chunks(pa.array(texts))]
    monkeypatch.setattr(ppm, "CELLS", 6)
    for a, (_, data, offs) in zip(whole, text_chunks(pa.array(texts))):
        assert np.allclose(a, trees.code_lengths(data, offs))


def test_many_labels_stay_small():
    """Size follows the seen pairs: 32 labels of one text take little more than 32 cost columns."""
    rng = np.random.default_rng(0)
    gram = rng.integers(97, 123, 20_000) | rng.integers(97, 123, 20_000) << 8 | rng.integers(97, 123, 20_000) << 16 | rng.integers(97, 123, 20_000) << 24
    trees = ContextTrees([f"l{i:02}" for i in range(32)], rng.integers(0, 32, 20_000), gram, np.ones(20_000))
    size = sum(x.nbytes for part in (trees.rows, trees.pairs, trees.escape, trees.cost) for x in part)
    assert size < 20 << 20


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    held = in_fold(F.col("doc_id"), 4, 2)
    out = identify(docs.where(held), train(docs.where(~held)))
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95
    assert out.where("score < 0 or score > 1 or lang_pred = 'und'").isEmpty()


def test_sample_bound_and_rows_not_learned_from(spark):
    rows = [(i, f"text {i}", "xx") for i in range(500)] + [(None, "no id", "yy"), (600, None, "yy"), (601, "no lang", None), (602, "zz", "zz"), (602, "zz", "zz")]
    got = sample_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 50).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"xx": 50, "zz": 2}


def test_edges(spark):
    docs = spark.createDataFrame([(1, "hello there world", "en", "s", 1), (2, "hallo da welt", "de", "s", 1)], DOCS)
    rows = [(3, None), (4, ""), (5, "123 !?"), (6, "hello " * 100_000), (6, "hello"), (None, "welt")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("letter", F.lit(1))
    got = identify(df, train(docs)).collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [(3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (None, "de")]
    assert all(r.score == 0 for r in got[:3])
    assert {r.lang_pred for r in identify(df, train(docs.limit(0))).collect()} == {"und"}
    assert identify(df.limit(0), train(docs)).collect() == []


def most_held(work) -> float:
    """MB that numpy and Python hold at most while ``work`` runs."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_scoring_and_of_hashing_is_a_chunks():
    """What a worker holds beside its model and its batch, for 6 MB of texts (before: 150 and 76 MB, now 25 and 19)."""
    texts = pa.array(["the cat sat on the mat " * 90] * 3000)
    gram = np.array([int.from_bytes(b"cat ", "big")])
    trees = ContextTrees([f"l{i}" for i in range(4)], np.array([0]), gram, np.ones(1))

    def score():
        for _, data, offs in text_chunks(texts, language_ppm.SCORED_BYTES):
            trees.code_lengths(data, offs)

    def hashes():
        shared._powers.clear()
        for _, data, offs in text_chunks(texts):
            starts, ends, _ = shared.word_spans(data, offs)
            shared.span_hashes(data, starts, ends, lower=True)

    assert most_held(score) < 50
    assert most_held(hashes) < 50


def test_power_tables_grow_with_the_longest_chunk():
    shared._powers.clear()
    for n in (1, 70_000, 300, 65_536):
        p, q = shared._power_tables(n)
        assert n + 1 <= len(p) <= 70_000 + (1 << 16) and len(p) == len(q)
        assert ((p * q) == 1).all() and p[0] == 1 and int(p[1]) == shared._BASE


def test_text_inside_a_struct_is_read_from_there(spark):
    """As by a column of its own, over more rows than are handed on together; the text is not sent twice."""
    docs = spark.createDataFrame([(1, "hello there world", "en", "s", 1), (2, "hallo da welt", "de", "s", 1)], DOCS)
    trees = train(docs)
    texts = ["hello", None, "", "welt da", "12"]
    df = spark.createDataFrame([(i, texts[i % 5]) for i in range(2 * language_ppm.SCORED_ROWS + 7)], "doc_id long, text string").coalesce(1)
    made = ["lang_pred", "score", "bits_per_byte"]
    plain = identify(df, trees).select("doc_id", *made).orderBy("doc_id").collect()
    held = identify(df.select(F.struct("*").alias("doc")), trees, text="doc.text")
    assert held.select("doc.doc_id", *made).orderBy("doc_id").collect() == plain and len(plain) == df.count()
    assert [r.text for r in held.select("doc.*").orderBy("doc_id").limit(5).collect()] == texts
    assert "null AS t#" in held._jdf.queryExecution().optimizedPlan().toString()
