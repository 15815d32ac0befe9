from pyspark.sql import functions as F

from quarry.llm.line_quality import apply_rules, cleaned
from tests.llm.helpers import DOCS, prose

SCHEMA = "doc_id long, text string, source string"


def rules(spark, rows, **kw):
    return {r.doc_id: r for r in apply_rules(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_frequent_lines_deplete_documents_of_one_host(spark):
    line = " ".join(prose(1, 60))
    rows = [(i, f"{line}\n{' '.join(prose(10 + i, 20))}", "hot") for i in range(20)]
    rows += [(100 + i, f"{line}\n{' '.join(prose(200 + i, 80))}", "hot") for i in range(5)]
    rows += [(200, f"{line.upper()}\n  {line} ", "other")]
    got = rules(spark, rows)
    assert all(got[i].depleted and not got[i].kept and got[i].removed_words == 60 for i in range(20))
    assert all(got[100 + i].kept and got[100 + i].removed_words == 60 for i in range(5))
    assert got[200].removed_words == 0 and got[200].n_dup_lines == 0


def test_counts_and_edges(spark):
    text = "a b c\n\na b c\nx # |y\n \né<z> é<z>"
    got = rules(spark, [(1, text, None), (2, None, None), (3, "", "s"), (4, "word " * 200_000, "s"), (5, " ".join(prose(4, 50)), "s"), (5, " ".join(prose(4, 50)), "s")])
    r = got[1]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (11, 18, 6, 1, 6)
    assert got[2].base_failed and got[2].n_words == 0 and not got[2].kept
    assert got[4].base_failed and got[4].n_repeat_words == 200_000
    assert got[5].kept and not got[5].base_failed


def test_rows_that_repeat_a_document_count_once(spark):
    line = " ".join(prose(1, 60))
    rows = [(7, line, "s")] * 30 + [(8, line, "s")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row_id", F.lit(1)).withColumn("n_words", F.lit("clash"))
    out = apply_rules(df).collect()
    assert len(out) == 31 and all(r.removed_words == 0 and r.kept for r in out)


def test_empty_table(spark):
    assert apply_rules(spark.createDataFrame([], DOCS)).collect() == []


def test_texts_lose_their_frequent_lines(spark):
    line, own = " ".join(prose(1, 6)), [" ".join(prose(10 + i, 60)) for i in range(12)]
    rows = [(i, f"{own[i]}\n\t{line.upper()} \n\nend {i}\r\n{line}", "hot") for i in range(12)]
    rows += [(20, line, "hot"), (21, f"{line}\nx", "other"), (22, None, "hot"), (23, f"é\n{line}\n", "hot"), (23, f"é\n{line}\n", "hot")]
    out = cleaned(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert all(got[i].text == f"{own[i]}\n\nend {i}\r" and got[i].removed_words == 12 for i in range(12))
    assert (got[20].text, got[21].text, got[22].text, got[23].text) == ("", f"{line}\nx", None, "é\n")
    assert got[20].removed_words == 6 and got[21].removed_words == 0
