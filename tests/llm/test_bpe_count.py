import random

import pytest
from pyspark.sql import functions as F

from formline.llm import bpe_count as C

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_library_on_a_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in C.count_tokens(docs, PATH, limit=500).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        text = r["text"] or ""
        n = len(library.encode(text))
        assert tuple(got[r["doc_id"]]) == (r["doc_id"], len(text.encode()), n, n > 500)


ODD = ["", " ", "  ", "\n", "a\n b", " \n\n  x", "▁▁x", "<s>hi</s>", "<0x0A>", "日本語 テキスト", "é́ ", "\t\t\tx", "a" * 3000, " " * 4000, "\x00a", "😀😀 ok", "<unk>", "x  y   z    " * 50]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, library):
    assert C.Vocabulary(open(PATH, "rb").read()).count(text) == len(library.encode(text))


def test_random_texts_with_a_forgetful_cache(library, monkeypatch):
    monkeypatch.setattr(C, "CACHE_CHUNKS", 20)
    vocabulary = C.Vocabulary(open(PATH, "rb").read())
    rnd = random.Random(1)
    for _ in range(1500):
        text = "".join(rnd.choice(" \n▁aetherin.,日é😀\t") for _ in range(rnd.randrange(60)))
        assert vocabulary.count(text) == len(library.encode(text))


def test_odd_rows(make_docs, library):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "same"), (3, "same"), (4, "long words here " * 20_000)]
    df = make_docs(rows, {"id": F.lit("x"), "n_tokens": F.lit(1)})
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in C.count_tokens(df, PATH).collect())
    assert got == sorted((i or 0, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows)
    assert C.count_tokens(make_docs([]), PATH).collect() == []


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        C.Vocabulary(b"\x12\x02\x18\x01")  # a unigram model
