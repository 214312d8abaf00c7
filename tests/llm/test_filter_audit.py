"""The filter audit against plain sets, and its merges against Python's own."""

import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formline.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int"


def plain_failures(rows):
    """Per row the set of failed filters, by reading the rules."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in rows):
            fails.add("E")
        out.append(fails)
    return out


def plain_audit(rows, labels):
    fails = plain_failures(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        inside = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        shapley = dict.fromkeys(A.FILTERS, 0)
        for order in itertools.permutations(A.FILTERS):
            left = set(inside)
            for step, f in enumerate(order, 1):
                gone = {i for i in left if f in fails[i]}
                failing = {i for i in inside if f in fails[i]}
                shapley[f] += len(gone)
                left -= gone
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing - gone), sum(fails[i] == {f} for i in inside),
                    sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    rows = df.select("part", "filter_order", "step", *A.COUNTS, "shapley").collect()
    out = {(r[0], r[1], r[2]): tuple(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def some_rows(n, seed):
    rng = random.Random(seed)
    words = ["a", "b", "Cc", "DD", "e#", "f", "ä", "日本"] + [f"w{i}" for i in range(150)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.3:
            text = rng.choice(rows)[1]
        elif kind < 0.4:
            text = rng.choice([None, "", " \n", "A B C", "x" * 50])
        else:
            pool = words[: rng.choice([3, 20, 158])]
            text = rng.choice([" ", "\n", "\t "]).join(rng.choice(pool) for _ in range(rng.choice([5, 99, 100, 120, 200])))
        rows.append((rng.choice([i, i, i, rng.randint(0, n), None]), text, rng.choice(["en", "de", "", None])))
    labels = [(rng.choice([rng.randint(0, n), None]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(n)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_sets(spark, make_docs, seed):
    rows, labels = some_rows(250, seed)
    docs = make_docs(rows, {"id": F.lit(1), "part": F.lit("x"), "fails": F.lit(0), "n": F.lit(2)})
    marks = spark.createDataFrame(labels, LABELS).withColumn("id", F.lit(7))
    assert found(A.audit(docs, marks)) == plain_audit(rows, labels)


def test_small_ranges_and_hot_texts_change_nothing(spark, make_docs, monkeypatch):
    rows, labels = some_rows(200, 5)
    rows += [(1000 + i, "the same text", "en") for i in range(150)] + [(7, "again", "de")] * 120
    monkeypatch.setattr(A, "RANGE_IDS", 50)
    monkeypatch.setattr(A, "HOT_SHARE", 4)
    monkeypatch.setattr(A, "RANGE_ROWS", 10)
    docs, marks = make_docs(rows), spark.createDataFrame(labels, LABELS)
    assert found(A.audit(docs, marks)) == plain_audit(rows, labels)


def test_no_documents_and_no_labels(spark, make_docs):
    no_labels = spark.createDataFrame([], LABELS)
    assert A.audit(make_docs([]), no_labels).count() == 0
    rows = [(1, "one", "en"), (2, "one", "en")]
    assert found(A.audit(make_docs(rows), no_labels)) == plain_audit(rows, [])


def test_any_filters(spark):
    """Two filters over string ids, given as bits."""
    failing = spark.createDataFrame([("a", "p", 1), ("b", "p", 3), ("c", "p", 2), ("d", "p", 0)], "id string, part string, fails int")
    labels = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    assert found(A.interactions(failing, labels, "XY")) == {
        ("p", "XY", 1): (2, 2, 0, 1, 1, 0, 3),
        ("p", "XY", 2): (1, 1, 1, 1, 0, 0, 3),
        ("p", "YX", 1): (2, 2, 0, 1, 0, 0, 3),
        ("p", "YX", 2): (1, 1, 1, 1, 1, 0, 3),
    }
    with pytest.raises(ValueError):
        A.interactions(failing, labels, "ABCDEFG")


def test_long_texts_are_cut_at_gaps(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(5000)).encode()
    whole = A.word_numbers(text)
    monkeypatch.setattr(A, "CUT_BYTES", 64)
    assert A.word_numbers(text) == whole == (5000, 700)
    assert A.word_numbers(b"\n" * 500 + b"x" * 500) == (1, 1)


sorted_ids = st.lists(st.integers(0, 60), max_size=40).map(lambda v: sorted(set(v)))


@settings(max_examples=300, deadline=None)
@given(st.lists(sorted_ids, max_size=6))
def test_union(lists):
    assert A.union(lists) == sorted(set().union(*lists))


@settings(max_examples=300, deadline=None)
@given(sorted_ids, sorted_ids)
def test_difference(values, without):
    left = [v for a, b in A.difference(values, without) for v in values[a:b]]
    assert left == [v for v in values if v not in set(without)]
    assert all(A.gallop(values, x, 0) == sum(v < x for v in values) for x in (0, 17, 60, 99))
