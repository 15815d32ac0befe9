from pyspark.sql import functions as F

from quarry.llm.decontaminate import contaminated
from tests.llm.helpers import LOWER, SMALL, bag, bag_similarity, documents, prose, words


def brute(docs, items):
    found = {}
    bags = {k: (len(words(t)), bag(words(t.translate(LOWER)))) for k, t in items}
    for i, text in docs:
        w = words((text or "").translate(LOWER))
        for k, (n, b) in bags.items():
            if n and any(s in b for s in bag(w)) or 0 < n < 5:
                best = max((bag_similarity(bag(w[p : p + n]), b) for p in range(max(1, len(w) - n + 1))), default=0)
                if best >= 0.8:
                    found[i, k] = best
    return found


def test_equals_brute_force(spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text")
    docs = documents(spark).select("doc_id", "text")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(docs, items).collect()}
    assert got == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert got


def test_edited_passages_of_many_sizes(spark):
    items, docs = [], []
    for k, n in enumerate((5, 6, 9, 14, 20, 27, 33, 47, 60, 90, 150, 400)):
        passage = prose(k, n)
        items.append((k, " ".join(passage)))
        for v, edit in enumerate((passage, passage[:-1] + ["zz"], passage[: n // 2] + ["zz"] + passage[n // 2 + 1 :], [p.upper() for p in passage], passage[: n // 3])):
            docs.append((10 * k + v, " ".join(prose(1000 + 10 * k + v, 101 + 3 * v) + edit + prose(5000 + 10 * k + v, 50))))
    got = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == set(brute(docs, items))


def test_edges(spark):
    same = " ".join(prose(2, 30))
    items = spark.createDataFrame([(1, same), (1, same), (2, None), (3, ""), (4, "tiny item")], "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, same), (3, same), (None, same), (4, " ".join(prose(3, 50_000)) + " " + same), (5, "a Tiny item here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in contaminated(docs.withColumn("item_id", F.lit(0)), items).collect()), key=str)
    assert got == [(3, 1), (4, 1), (5, 4), (None, 1)]
    assert contaminated(docs, items.limit(0)).collect() == [] and contaminated(docs.limit(0), items).collect() == []
