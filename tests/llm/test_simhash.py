import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from formline.llm import simhash as S


def fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    joined = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in joined]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance=4):
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [(d, f"{p:016x}", least[root(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)


def check(df, rows):
    got = [tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_equals_brute_force_on_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(S.near_duplicate_groups(docs), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def near_copies(n, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(words) for _ in range(150)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        out.append(" ".join(copy))
    return out


def test_near_copies_over_many_shards_and_blocks(make_docs, monkeypatch):
    for name, value in (("SHARD_ROWS", 16), ("LEAF_SAMPLE", 4), ("BLOCK_ROWS", 40), ("LEAF_ROWS", 8)):
        monkeypatch.setattr(S, name, value)
    monkeypatch.setattr(S.build_tree, "__defaults__", (16,))
    texts = [t for seed in range(4) for t in near_copies(60, seed)]
    rows = list(enumerate(texts, 100))
    df = S.near_duplicate_groups(make_docs(rows))
    check(df, rows)


def test_trees_lose_no_link():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 500, dtype=np.uint64)
    points = [base]
    for k in range(1, 6):
        flips = np.zeros(500, np.uint64)
        for _ in range(k):
            flips ^= np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)
        points.append(base ^ flips)
    points = np.unique(np.concatenate(points))
    for distance in (0, 1, 2, 3, 4, 7):
        want = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points) <= distance), strict=True) if i < j}
        forest = S.Forest(points)
        masks = S.part_masks(distance)
        for mask in masks:
            radius = distance // len(masks)
            tree, _ = S.build_tree(points[::3], len(points), mask, radius, 50)
            for _, homes, guests in S.route(tree, points, points[:0], mask, radius):
                a, b = S.link_shard(homes, guests, mask, radius, distance)
                forest.tie(np.searchsorted(points, a), np.searchsorted(points, b))
        assert all(forest.parent[i] == forest.parent[j] for i, j in want)


def test_odd_rows(make_docs):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(9, None), (3, ""), (7, " \t"), (5, "One two"), (4, "one TWO"), (8, long), (2, long), (8, long), (None, "solo text here"), (None, "one two"), (6, "é É")]
    check(S.near_duplicate_groups(make_docs(rows, {"fp": F.lit(1), "component_id": F.lit("x"), "id": F.lit(2)})), rows)


def test_one_document_of_each_group_stays(make_docs):
    rows = [(9, None), (3, ""), (5, "One two"), (4, "one TWO"), (8, "a b c d e"), (8, "a b c d e"), (None, "solo"), (None, "lone")]
    docs = make_docs(rows, {"fp": F.lit(1)})
    kept = S.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == sorted(
        [(3, ""), (4, "one TWO"), (8, "a b c d e"), (-1, "solo"), (-1, "lone")]
    )


def test_empty_table(make_docs):
    assert S.near_duplicate_groups(make_docs([])).collect() == []
    assert S.without_near_duplicates(make_docs([])).collect() == []


def kept_rows(docs):
    return sorted(map(str, map(tuple, S.without_near_duplicates(docs).collect())))


def test_one_row_of_each_group_stays_whatever_the_columns(make_docs, monkeypatch):
    """Names that the operator uses itself, null ids, rows repeated word for word, ids with several texts."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (2, " ".join(words)), (3, "quite another text of its own"), (4, None), (5, ""), (None, None)]
    rows += [(6, "repeated word for word")] * 3 + [(None, "without an id")] * 2 + [(7, "a b c d e f"), (7, "g h i j k l")]
    extra = {n: F.lit(n) for n in ("id", "fp", "text_hash", "least", "kept", "turn", "mark_id", "mark_hash", "held")}
    docs = make_docs(rows, extra)
    want = {(i, t) for i, t in rows if i not in (2, 5, None)} | {(None, "without an id")}
    found = S.without_near_duplicates(docs)
    assert found.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    assert {tuple(r)[5:] for r in found.collect()} == {tuple(extra)}
    few = kept_rows(docs)
    monkeypatch.setattr(S, "rows_within", lambda df: None)
    assert kept_rows(docs) == few
    assert S.without_near_duplicates(docs.limit(0)).collect() == []
