import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from formline.llm import mixture as M

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes):
    """Water-filling, one source at a time."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    capped = set()
    while True:
        left = sum(sizes) - sum(3 * sizes[i] for i in capped)
        total = sum(w for i, w in enumerate(weight) if i not in capped)
        out = [3 * n if i in capped else left * weight[i] / total for i, n in enumerate(sizes)]
        over = [i for i in range(len(sizes)) if i not in capped and out[i] > 3 * sizes[i]]
        if not over:
            return out
        capped.update(over)


def check(df, rows):
    got = defaultdict(list)
    for r in df.collect():
        got[r["doc_id"]].append(r)
    size = {}
    by_source = defaultdict(int)
    for d, text, source in rows:
        size.setdefault(d, []).append((len(WORD.findall(text or "")), source))
        by_source[source] += len(WORD.findall(text or ""))
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(names, targets([by_source[s] for s in names]), strict=True))
    assert {d: len(x) for d, x in got.items()} == {d: len(x) for d, x in size.items()}
    taken = defaultdict(int)
    for d, found in got.items():
        assert sorted(r["size"] for r in found) == sorted(n for n, _ in size[d])
        for r in found:
            assert 0 <= r["taken"] <= 3 * r["size"]
        source = size[d][0][1]
        for r in found:
            assert r["source_size"] == by_source[source]
            assert r["target"] == pytest.approx(want[source])
            taken[source] += r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= 32, (s, taken[s], want[s])


def table(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]


def test_whole_table_comes_near_its_targets_and_repeats(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = M.mixed_documents(docs)
    check(first, table(docs))
    again = M.mixed_documents(docs.repartition(5))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_small_sources_are_capped_and_buckets_join_up(make_docs, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 7)
    rows = [(i, f"word{i} " * (i % 40), None, "b" if i < 190 else "a" if i < 195 else None) for i in range(200)]
    docs = make_docs(rows)
    check(M.mixed_documents(docs), table(docs))


def test_mix_holds_each_slot_once(make_docs):
    docs = make_docs([(i, "x y z " * (i + 1), None, "ab"[i % 2]) for i in range(30)])
    made = M.mix(docs, block_words=8, n_shards=3)
    rows = made.rows().collect()
    assert all(0 < r["words"] <= 8 for r in rows)
    spans = defaultdict(int)
    for r in rows:
        spans[r["shard"], r["slot"]] += r["words"]
    assert all(n <= 8 for n in spans.values())
    slots = made.slots.collect()
    assert len({(s["shard"], s["slot"]) for s in slots}) == len(slots) == sum(s.slots for s in made.sources)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 33, 1000, 4097])
def test_permutations(n):
    p = M.permuted(np.arange(n), n, 99)
    assert sorted(p) == list(range(n))
    assert (M.permuted(p, n, 99, back=True) == np.arange(n)).all()


def test_word_counts(monkeypatch):
    monkeypatch.setattr(M, "STEP_BYTES", 12)
    texts = ["", "a", " ", "a b", " ", "a\x0bb\x1cc", None, "end", "start", "  x  ", "long word" * 9]
    column = pa.array(texts)
    assert M.word_counts(column).tolist() == [len(WORD.findall(t or "")) for t in texts]
    assert M.word_counts(column.slice(3, 5)).tolist() == [len(WORD.findall(t or "")) for t in texts[3:8]]


def test_odd_rows(make_docs):
    rows = [(1, None, None, "a"), (2, "", None, None), (None, "p q r", None, "a"), (3, "same " * 90, None, None), (3, "same " * 90, None, None), (4, "w " * 50_000, None, "é")]
    docs = make_docs(rows, {"size": F.lit(3), "code": F.lit("x"), "at": F.lit(1)})
    check(M.mixed_documents(docs), table(docs))


def test_nothing_to_mix(make_docs):
    assert M.mixed_documents(make_docs([])).collect() == []
    empty = M.mixed_documents(make_docs([(1, None, None, "a"), (2, " ", None, "b")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in empty] == [(0, 0.0, 0)] * 2


def test_equal_rows_are_laid_side_by_side(make_docs, monkeypatch):
    monkeypatch.setattr(M, "REPEAT_ROWS", 16)
    monkeypatch.setattr(M, "SLOT_ROWS", 5)
    monkeypatch.setattr(M, "BUCKET_ROWS", 20)
    rows = [(None, "p q r", None, "a")] * 70 + [(5, "x " * 40, None, "b")] * 33 + [(i + 10, "y z " * i, None, "a") for i in range(20)]
    docs = make_docs(rows)
    check(M.mixed_documents(docs, block_words=4, n_shards=3), table(docs))
    assert M.mix(docs, block_words=4, n_shards=3).places.count() == len(rows)
