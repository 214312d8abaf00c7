import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import kneser_ney as K


def brute(rows, order=3):
    """The model, straight from its definition, over dictionaries."""

    def tokens(text):
        return (text or "").encode().lower().split() + [None]

    held = {i: i is None or zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    words, grams = Counter(), [None, Counter(), Counter(), Counter()]
    for i, text in rows:
        if not held[i]:
            t = tokens(text)
            words.update(t)
            padded = ["start"] * (order - 1) + t
            grams[order].update(zip(*(padded[k:] for k in range(order)), strict=False))
    for k in range(order - 1, 0, -1):  # how many different words precede
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    n, v = sum(words.values()), len(words)
    discounts = [None] + [K._discounts([sum(c == j for c in g.values()) for j in (1, 2, 3, 4)]) for g in grams[1:]]
    total, mass = Counter(), defaultdict(float)
    for k in range(1, order + 1):
        for g, c in grams[k].items():
            total[g[:-1]] += c
            mass[g[:-1]] += discounts[k][min(c, 3) - 1]

    def p(context, w):
        shorter = p(context[1:], w) if context else 1 / (v + 1)
        if not total[context]:
            return shorter
        k = len(context) + 1
        c = grams[k].get((*context, w), 0)
        return max(c - (discounts[k][min(c, 3) - 1] if c else 0), 0) / total[context] + mass[context] / total[context] * shorter

    out = []
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        padded = ["start"] * (order - 1) + t
        score = sum(math.log10(p(tuple(padded[k : k + order - 1]), padded[k + order - 1])) for k in range(len(t)))
        out.append((i, held[i], len(t), sum(words[w] > 0 for w in t), n, base, score))
    return out, p, words


def same(got, want):
    got = sorted(tuple(r)[:7] for r in got.collect()) if not isinstance(got, list) else got
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want)):
        assert a[:5] == b[:5]
        assert a[5:7] == pytest.approx(b[5:7], rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_equals_brute_force_on_a_whole_table(spark, sf_dir, order):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want, p, words = brute(rows, order)
    same(K.train_and_score(docs, parts=3, order=order), want)
    # over all words and an unknown one, after histories seen, half seen and unseen
    for history in ((b"of", b"the"), (b"never seen", b"the"), (b"the", b"never seen"), ("start", "start")):
        assert sum(p(history[3 - order :], w) for w in words) + p(history[3 - order :], b"zzz") == pytest.approx(1.0)
    held = [(r[5], r[6]) for r in want if r[1]]
    assert sum(s for _, s in held) > sum(b for b, _ in held)


def test_more_context_predicts_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

    def perplexity(order):
        held = K.train_and_score(docs, order=order).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
        return 10 ** (-held[0] / held[1])

    assert perplexity(3) < perplexity(2) < 2700


def test_order_is_two_or_three(make_docs):
    with pytest.raises(ValueError):
        K.fit(make_docs([(2, "a")]).select("text"), order=4)


@pytest.mark.parametrize("single", [True, False])
def test_hot_words_are_dealt_by_pairs(make_docs, monkeypatch, single):
    monkeypatch.setattr(K, "FLUSH_PAIRS", 50)
    monkeypatch.setattr(K, "FLUSH_WORDS", 5)
    monkeypatch.setattr(K, "SHORT_LIST", 2)
    if not single:
        monkeypatch.setattr(K, "TRIPLE_BITS", 0)
    rows = [(i, " ".join(f"the W{(i * j) % 23}" for j in range(20))) for i in range(60)]
    for order in (2, 3):
        same(K.train_and_score(make_docs(rows), parts=5, order=order), brute(rows, order)[0])


def test_odd_rows(make_docs):
    rows = [(2, None), (3, ""), (4, " \t\n"), (5, "A a\x0bB"), (5, "A a\x0bB"), (7, "é" * 5000), (8, "a b c a b c")]
    docs = make_docs(rows, {"score": F.lit("x"), "held_out": F.lit(1)})
    same(K.train_and_score(docs), brute(rows)[0])
    nulls = K.train_and_score(make_docs([(None, "a b"), (9, "a")])).where("doc_id is null").first()
    assert nulls["held_out"] and nulls["n_tokens"] == 3


def test_empty_and_untrained(make_docs):
    assert K.train_and_score(make_docs([])).collect() == []
    r = K.train_and_score(make_docs([(None, "a b")])).first()
    assert (r["train_tokens"], r["n_known"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)


def test_tokens_are_those_of_bytes():
    texts = [b"", b" \t\n", b"A a\x0bB ", "\u00c9 \u00e9\u2003x\u0085y \x1cZ\x1dz".encode(), b"\xff\xc3 Q\xa0q\x0c\r\rA", b"a " * 50]
    distinct, codes, first = K._tokens(texts)
    assert len(set(distinct)) == len(distinct)
    want = [[*t.lower().split(), K.END] for t in texts]
    assert [list(x) for x in np.split(distinct[codes], first[1:])] == want


@pytest.mark.parametrize("far", [1, 2**38])
def test_ranks_with_and_without_room_for_places(far):
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 9, 500) * far, rng.integers(0, 2**20, 500) % 7
    first, second, place = K._ranked(high, low, 2**20)
    assert list(zip(first.tolist(), second.tolist(), strict=True)) == sorted(set(zip(high.tolist(), low.tolist(), strict=True)))
    assert (first[place] == high).all() and (second[place] == low).all()


def test_contexts_are_looked_up_once(make_docs, monkeypatch):
    """Not once for every word that follows them; and no whole stored array is converted for a search."""
    texts = [f"a b word{i}" for i in range(300)]
    model = K.fit(make_docs([(2, t) for t in texts]).select("text"), parts=1)
    reader, asked, searched = K.Reader(model), [], []
    within, search = K._within, np.searchsorted
    monkeypatch.setattr(K, "_within", lambda *a: asked.append((a[0], len(a[3]))) or within(*a))
    monkeypatch.setattr(np, "searchsorted", lambda a, v, **k: searched.append((a, v)) or search(a, v, **k))
    distinct, codes, first = K._tokens([t.encode() for t in texts])
    K.log_probabilities(reader, reader.words(distinct), codes, first)
    # (start, start), (start, a), (a, b) and (b, word) for each of the words
    assert [n for stored, n in asked if stored is reader.array("left", 0)] == [303]
    of_model = [(a, v) for a, v in searched if any(a is x for x in reader.open.values())]
    assert of_model and all(a.dtype == v.dtype for a, v in of_model)
