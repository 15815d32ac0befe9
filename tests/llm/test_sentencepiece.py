import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from quarry.llm.sentencepiece_bpe import CACHE_WORDS, Encoder, PieceModel, encode_documents  # noqa: E402
from tests.llm.helpers import documents  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PATH)


def same(model, library, texts):
    for text, ids in zip(texts, Encoder(model).encode(texts)):
        assert ids.tolist() == library.encode(text), text[:80]
        assert model.decode(ids) == library.decode(library.encode(text)), text[:80]


def test_equals_the_library(model, library):
    r = random.Random(7)
    letters = "ab tehrn  \n\t▁é😀ß漢字<>|s01.,-\u0000Z "
    texts = ["", " ", "\n", "▁", "<s>hi</s>", *(" " * k + "x" for k in range(80)), *(" " * k for k in range(70)), *("ab" * k for k in range(1, 90, 7))]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 300))) for _ in range(600)]
    same(model, library, texts)


def test_long_texts(model, library):
    same(model, library, ["x" * 5000, "word " * 40_000, "\n" * 3000, "漢" * 3000])


def test_long_words_without_spaces(model, library, monkeypatch):
    r = random.Random(11)
    prose_run = "".join(r.choice(["the", "there", "nation", "in", "ing", "string", "able", "reason", "ation", "al", "on", "s"]) for _ in range(4000))
    texts = [
        "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)),
        "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(100_000)),
        "".join(r.choice("ACGT") for _ in range(20_000)),
        "".join(r.choice("etaoins") for _ in range(20_000)),
        prose_run, "x" * 5001, "=" * 4097, "ab" * 3000, "the" * 20_001, "there" * 3000 + "he" * 999, "ing" * 5001, "aaab" * 900, "e" * 999 + "re" * 500, "-" * 300 + "." * 300 + "漢é😀" * 300,
    ]
    same(model, library, texts)
    # windows decide from the shortest words on
    monkeypatch.setattr("quarry.llm.sentencepiece_bpe.LONG_WORD", 1)
    same(model, library, ["".join(r.choice("etaoinsrh  ") for _ in range(r.randint(1, 400))) for _ in range(300)] + ["a" * k for k in range(1, 60)])


def test_decoding_of_any_ids(model, library):
    r = random.Random(3)
    for _ in range(300):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), 0, 1, 2]) for _ in range(r.randint(1, 8))]
        assert model.decode(np.array(ids)) == library.decode(ids), ids


def test_cache_does_not_change_results(model, library, monkeypatch):
    monkeypatch.setattr("quarry.llm.sentencepiece_bpe.CACHE_WORDS", 3)
    assert CACHE_WORDS > 3
    enc = Encoder(model)
    for text in ("one two three four", "two five six", "one two"):
        assert enc.encode([text])[0].tolist() == library.encode(text)


def test_documents(spark, model, library):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()] + [(None, None), (1, ""), (1, "")]
    df = spark.createDataFrame([(i, t, "clash", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, ids string, k long")
    out = encode_documents(df, model).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.doc_id == rows[r.k][0] and r.ids == library.encode(rows[r.k][1] or "") and r.decoded == (rows[r.k][1] or "").replace("▁", " ")
    assert encode_documents(df.limit(0), model).collect() == []
