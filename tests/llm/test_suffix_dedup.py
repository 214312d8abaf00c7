import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import suffix_dedup as D
from formline.llm import suffix_sort as S


def brute(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(hash(t[s : s + length]) for _, t in raw for s in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        gone = np.zeros(len(t) + 1, np.int64)
        for s in range(len(t) - length + 1):
            if times[hash(t[s : s + length])] > 1:
                gone[s] += 1
                gone[s + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def check(df, rows, length=200):
    got = [tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=key) == sorted(brute(rows, length), key=key)


def test_ranks_order_suffixes():
    rnd = random.Random(3)
    for _ in range(200):
        text = np.array([rnd.randrange(1, rnd.choice([2, 3, 4])) for _ in range(rnd.randrange(1, 50))])
        depth = rnd.choice([1, 2, 3, 4, 7, 10, 100])
        rank, suffix = S.ranks(text, depth), [tuple(text[i : i + depth]) for i in range(len(text))]
        assert all(rank[i] < rank[j] for i in range(len(text)) for j in range(len(text)) if suffix[i] < suffix[j])


def test_names_of_wide_symbols_are_sorted():
    text = np.array([5, 2**40, 7, 5, 2**40, 7, 1, 2**41])
    rank = S.ranks(text, 100)
    assert sorted(range(8), key=lambda i: rank[i]) == sorted(range(8), key=lambda i: tuple(text[i:]))


def test_equals_brute_force_on_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(D.repeats_removed(docs), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def mixed_rows(seed, n=120, size=400):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé ") for _ in range(5))
    passages = ["".join(word() for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = ["".join(word() for _ in range(rnd.randrange(size // 10))) for _ in range(3)]
        parts.insert(rnd.randrange(3), rnd.choice(passages)[rnd.randrange(30) :])
        rows.append((i, "".join(parts)))
    return rows


def test_shared_passages(make_docs):
    rows = mixed_rows(1)
    check(D.repeats_removed(make_docs(rows)), rows)


def test_owners_with_many_pieces_are_dealt_anew(make_docs, monkeypatch):
    monkeypatch.setattr(D, "HOT_PIECES", 3)
    monkeypatch.setattr(D, "SORT_BYTES", 3000)
    rows = mixed_rows(2)
    check(D.repeats_removed(make_docs(rows)), rows)


def test_a_passage_shared_with_many_neighbours_is_counted_not_gathered(make_docs, monkeypatch):
    rnd = random.Random(5)
    line = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = line(500)
    rows = [(i, line(150) + passage + line(150)) for i in range(60)]
    sort = D.repeated_starts

    def few_equal(data, times, length):
        assert max(Counter(data).values()) == 1, "equal strings in one sort"
        return sort(data, times, length)

    monkeypatch.setattr(D, "HOT_PIECES", 20)
    monkeypatch.setattr(D, "repeated_starts", few_equal)
    check(D.repeats_removed(make_docs(rows)), rows)


def test_long_texts_are_cut_with_an_overlap(make_docs, monkeypatch):
    monkeypatch.setattr(D, "STEP", 700)
    rows = mixed_rows(4, n=30, size=3000)
    rows.append((99, rows[3][1] + rows[5][1]))
    check(D.repeats_removed(make_docs(rows)), rows)


@pytest.mark.parametrize("text", ["a" * 1000, "ab" * 500, "x" * 199 + "y" * 202, "abc" * 66 + "ab"])
def test_strings_that_overlap_themselves(make_docs, text):
    rows = [(1, text), (2, "other " + text[:150])]
    check(D.repeats_removed(make_docs(rows)), rows)


def test_odd_rows(make_docs):
    long = " ".join(str(i * i) for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, "é" * 150), (None, "z" * 100 + long[:260]), (5, long), (6, "q" + long[:199]), (6, "q" + long[:199])]
    check(D.repeats_removed(make_docs(rows, {"n_bytes": F.lit(1), "k1": F.lit(2), "h": F.lit("x")})), rows)


def test_texts_without_repeats(make_docs):
    a, b = "".join(map(str, range(200))), "".join(map(str, range(5000, 5200)))
    rows = [(1, a + b), (2, b + "tail"), (3, None), (4, "alone")]
    docs = make_docs(rows, {"k1": F.lit(5)})
    cut = D.without_repeats(docs)
    assert cut.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in cut.collect()) == [(1, a), (2, "tail"), (3, None), (4, "alone")]


def test_empty_table(make_docs):
    assert D.repeats_removed(make_docs([])).collect() == []
    assert D.without_repeats(make_docs([])).collect() == []


def test_clashing_columns_and_nothing_left_in_the_catalogue(make_docs, spark):
    passage = " ".join(f"word{i}" for i in range(60))
    names = ("a", "b", "k1", "k2", "rest", "h", "p", "n", "spans", "hs", "copies")
    docs = make_docs([(1, "one " + passage), (2, passage + " two"), (3, None)], {c: F.lit(c) for c in names})
    before = {t.name for t in spark.catalog.listTables()}
    rows = {r["doc_id"]: r for r in D.without_repeats(docs).collect()}
    assert D.without_repeats(docs).columns == docs.columns
    assert rows[1]["text"] == "one " and rows[2]["text"] == " two" and rows[3]["text"] is None
    assert all(tuple(r)[5:] == names for r in rows.values())
    assert {t.name for t in spark.catalog.listTables()} == before
