"""Runs against a plain search, extensions against plain comparison, and the query against a plain reading."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formline.llm import periodic_runs as R


def plain_runs(s, min_length=12):
    n, out = len(s), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(2 * q, min_length):
                out.setdefault((i, j + q), q)  # periods come in order, so the smallest stays
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def plain_collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_words(text, doc_id):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def plain_row(doc_id, text):
    words = plain_words(text, doc_id)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def found(symbols, min_length):
    return [tuple(r) for r in R.find_runs(np.array(symbols, np.int32), min_length).tolist()]


small_texts = st.one_of(
    st.lists(st.integers(1, 2), max_size=60),
    st.lists(st.integers(1, 4), max_size=90),
    st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=20), st.integers(1, 9), st.lists(st.integers(1, 3), max_size=9)).map(
        lambda t: t[2] + t[0] * t[1] + t[2]
    ),
)


@settings(max_examples=400, deadline=None)
@given(small_texts, st.sampled_from([2, 4, 12]))
def test_runs_of_small_texts(symbols, min_length):
    assert found(symbols, min_length) == plain_runs(symbols, min_length)


def word_with(seed, n):
    """Texts with copies of stretches, so that extensions are long."""
    rng = random.Random(seed)
    out = [rng.randint(1, rng.choice([2, 5, 500])) for _ in range(30)]
    while len(out) < n:
        a = rng.randrange(len(out))
        out += out[a : a + rng.randint(1, 150)] * rng.choice([1, 1, 2, 3]) if rng.random() < 0.6 else [rng.randint(1, 9)]
    return out[:n]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_long_texts_in_grid_steps(seed, monkeypatch):
    symbols = word_with(seed, 900)
    wanted = plain_runs(symbols, 4)
    assert found(symbols, 4) == wanted
    monkeypatch.setattr(R, "GRID_STEP", 37)
    R._first_grid.cache_clear()
    try:
        assert found(symbols, 4) == wanted
    finally:
        R._first_grid.cache_clear()


def test_structured_words():
    fib, last = [1], [1, 2]
    while len(last) < 600:
        fib, last = last, last + fib
    for symbols in (last, [1] * 500, [1, 2] * 300, list(range(1, 400)), [*([1] * 9 + [2])] * 40, []):
        assert found(symbols, 12) == plain_runs(symbols, 12)


@pytest.mark.parametrize("seed", range(4))
def test_extensions(seed):
    symbols = word_with(10 + seed, 700)
    n, rng = len(symbols), random.Random(seed)
    x = np.array([rng.randrange(n - 1) for _ in range(2000)])
    y = np.array([rng.randrange(a + 1, n + 1) for a in x])
    extensions = R.Extensions(np.array(symbols, np.int32))
    got = extensions.of(x, y)
    for a, b, k in zip(x, y, got, strict=True):
        wanted = next((i for i in range(n - b) if symbols[a + i] != symbols[b + i]), n - b)
        assert k == wanted
    assert extensions.suffixes is not None
    places = extensions.suffixes.places
    assert set(places % R.MODULUS) == set(R.COVER)  # only these were sorted
    order = places[np.argsort(extensions.suffixes.rank)]
    assert order.tolist() == sorted(places.tolist(), key=lambda p: symbols[p:])


def test_texts_without_long_repeats_sort_nothing(monkeypatch):
    monkeypatch.setattr(R, "SampledSuffixes", None)
    rng = random.Random(4)
    assert found([rng.randint(1, 50) for _ in range(3000)], 12) == []


def test_every_shift_reaches_the_cover():
    for a in range(R.MODULUS):
        for b in range(R.MODULUS):
            assert {(a + R._SHIFT[a, b]) % R.MODULUS, (b + R._SHIFT[a, b]) % R.MODULUS} <= set(R.COVER)


def some_rows():
    rng = random.Random(9)
    rows = [(None, "a a a " * 9), (None, None), (5, ""), (5, " \n "), (6, "ä ß\x0bä ß " * 8), (7, "x " * 5000), (7, "x " * 5000)]
    planted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    for i in planted[:60]:
        rows.append((i, rng.choice(["", None, "one", "two words"]) if i % 7 == 0 else " ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 300)))))
    for i in range(3001, 3040):
        rows.append((i, "\t".join(rng.choice("abc") for _ in range(200))))
    return rows


def test_tables_equal_a_plain_reading(make_docs):
    rows = some_rows()
    docs = make_docs(rows, {"runs": F.lit(1), "id": F.lit(2), "words": F.lit("w"), "g": F.lit(0), "a": F.lit(1)})
    got = R.run_digests(R.periodic_runs(R.with_planted_runs(docs))).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain_row(*r)) for r in rows)
    assert R.run_digests(R.periodic_runs(R.with_planted_runs(docs.limit(0)))).count() == 0


def test_runs_and_collapsed_texts(make_docs):
    docs = make_docs([(1, "start " + "la di da " * 6 + "end"), (2, None)])
    one, two = sorted(R.periodic_runs(docs).collect(), key=lambda r: r["doc_id"])
    assert [tuple(r) for r in one["runs"]] == [(1, 18, 3)] and one["collapsed"] == "start la di da end"
    assert (two["n_words"], two["runs"], two["collapsed"]) == (0, [], "")


def test_query_on_a_whole_table(spark, sf_dir):
    from formline.llm.queries import QUERIES

    got = {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).select(*COLUMNS).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r["text"] or "") < 12_000]  # the plain search is quadratic
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    for r in short:
        assert plain_row(r["doc_id"], r["text"]) in got
