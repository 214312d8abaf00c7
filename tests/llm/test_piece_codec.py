"""Piece encoding and decoding against the public library: ids, byte spans, texts and character maps."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from formline.llm.bpe_count import _fields
from formline.llm.piece_codec import Codec, Memory, Normaliser, decode_ids, digests, encode_texts, round_trip, unpacked

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "Hi  ▁x", "☃\x00a\n\n b", "", "  ", "▁", "<s>a</s>", "a" * 200, "x́ " * 100, "日本語 текст 🤷🏽‍♀️",
    "\r\n\t x", "  \n  ab", "<0x41>", "�", "ab" * 5000 + " " + "é☃" * 300, " the the the " * 40,
]


def some_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab the ▁\n☃é<s>\x00🤷x") for _ in range(rng.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return Codec(f.read())


def test_ids_spans_and_decoding_are_the_librarys(library, codec):
    for text in HARD + some_texts(400):
        raw = text.encode()
        ids, begins, ends = codec.encode(raw)
        wanted = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == list(wanted)
        assert codec.decode(ids).decode() == library.decode(list(wanted))
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == [(0, 0), *spans, (len(raw), len(raw))]


def test_spans_cover_the_text_in_order(codec):
    for text in HARD + some_texts(100, 5):
        raw = text.encode()
        ids, begins, ends = codec.encode(raw)
        assert b"".join(raw[b:e] for b, e in zip(begins, ends, strict=True)) == raw
        assert (np.diff(begins) >= 0).all() and (ends >= begins).all()


def test_a_full_memory_forgets_without_changing_results(monkeypatch, codec):
    texts = [t.encode() for t in some_texts(60, 8)]
    wanted = [codec.encode(t)[0].tolist() for t in texts]
    monkeypatch.setattr("formline.llm.piece_codec.CACHE_CHUNKS", 5)
    monkeypatch.setattr("formline.llm.piece_codec.CACHE_CHARS", 3)
    codec.memory = Memory(codec, {})
    assert [codec.encode(t)[0].tolist() for t in texts] == wanted


def test_long_and_short_merges_agree(monkeypatch, codec):
    words = ["a" * 30, "thethethe", "x" * 7 + "ing" * 12, "▁Unbelievable", "☃☃abc"]
    short = [codec.merged(w) for w in words]
    monkeypatch.setattr("formline.llm.piece_codec.SHORT", 1)
    assert [codec.merged(w) for w in words] == short


def test_decoding_any_ids(library, codec):
    rng = random.Random(1)
    for _ in range(200):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 12))]
        assert codec.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("trim", [True, False])
def test_compiled_character_maps(rule, prefix, trim):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=trim, escape_whitespaces=True
    )
    blob = dict(_fields(dict(_fields(library.serialized_model_proto()))[3]))[2]
    own = Normaliser(blob, prefix, trim, True)
    rng = random.Random(2)
    letters = "aA ① ﬁ　ｶﾞガé́▁\n\t​½㌀Ωß한하🤷�\x00\xa0"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        norm, align = own.normalised(text.encode())
        wanted, offsets = library.normalize(text, with_offsets=True)
        assert norm.decode() == wanted
        widths = np.cumsum([0] + [len(c.encode()) for c in text])
        starts = np.cumsum([0] + [len(c.encode()) for c in norm.decode()])
        assert align[starts].tolist() == [widths[i] for i in offsets]


def test_bytes_that_are_no_text_read_as_replacements(codec):
    raw = b"ab \xff\xfe c\xe2\x82"
    ids, begins, ends = codec.encode(raw)
    assert ids.tolist() == codec.encode("ab �� c��".encode())[0].tolist()
    assert b"".join(raw[b:e] for b, e in zip(begins, ends, strict=True)) == raw


def test_tables_with_odd_rows(spark, library):
    rows = [(1, "Hi  there", "x"), (1, "Hi  there", "x"), (None, "☃", "y"), (2, None, "z"), (3, "", "z"), (4, "w " * 30_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = round_trip(docs, MODEL)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "ids", "begins", "ends", "decoded"]
    got = {(r["doc_id"], r["decoded"]): r for r in found.withColumn("list", unpacked("ids")).collect()}
    assert found.count() == 6 and len(got) == 5
    for doc_id, text, _ in rows:
        wanted = library.encode(text or "", add_bos=True, add_eos=True)
        row = got[doc_id, library.decode(wanted)]
        assert row["list"] == list(wanted) and row["n_tokens"] == len(wanted) and row["n_bytes"] == len((text or "").encode())
    assert round_trip(docs.limit(0), MODEL).count() == 0
    assert unpacked_empty(spark) == []
    read = decode_ids(encode_texts(docs, MODEL), MODEL).select("doc_id", "decoded")
    assert sorted(read.collect(), key=str) == sorted(found.select("doc_id", "decoded").collect(), key=str)


def unpacked_empty(spark):
    return spark.sql("SELECT X'' AS ids").select(unpacked("ids").alias("l")).first()["l"]


def test_query_digests(spark, library):
    from formline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op11_piece_codec"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert len(got) == docs.count()
    for row in docs.collect():
        ids = library.encode(row["text"], add_bos=True, add_eos=True)
        found = got[row["doc_id"]]
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_digests_are_of_the_real_outputs(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    row = digests(round_trip(docs, MODEL)).first()
    assert row["decoded_sha256"] == hashlib.sha256(b"a b").hexdigest() and row["n_tokens"] == 4
