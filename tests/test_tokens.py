"""Analyzer modes on the reference's tokenizer inputs."""

from pyspark.sql import functions as F

from quarry.functions.tokens import tokenize


# The texts below are the tokenizer inputs under test.


def toks(spark, text, mode):
    return spark.createDataFrame([(text,)], "t string").select(tokenize(F.col("t"), mode).alias("x")).first()["x"]


def test_basic_latin(spark):
    assert toks(spark, "Hello, World! 42 times", "basic") == ["hello", "world", "42", "times"]


def test_smart_keeps_mail_ip_host(spark):
    got = toks(spark, "详见WWW.XXX.COM, 邮箱xx@OB.COM 192.168.1.1", "smart")
    assert "www.xxx.com" in got
    assert "xx@ob.com" in got
    assert "192.168.1.1" in got
    assert "详见" in got and "邮箱" in got


def test_smart_splits_han_from_latin(spark):
    assert toks(spark, "Business 商业 书籍推荐", "smart") == ["business", "商业", "书籍推荐"]


def test_max_word_bigrams_and_parts(spark):
    got = toks(spark, "南京市长江大桥有1千米长", "max_word")
    assert "南京" in got and "长江" in got and "大桥" in got
    got = toks(spark, "mail xx@ob.com", "max_word")
    assert got == ["mail", "xx@ob.com", "xx", "ob", "com"]
    assert toks(spark, "书", "max_word") == ["书"]


def test_long_runs_are_single_tokens(spark):
    rows = [("x" * 30_000,), ("ü9" * 20_000 + " a@b.cd",), ("中" * 5 + "é" * 20_000,)]
    df = spark.createDataFrame(rows, "t string")
    assert [r.n for r in df.select(F.size(tokenize("t", "smart")).alias("n")).collect()] == [1, 2, 2]
