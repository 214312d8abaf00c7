import random

import pytest
from compare import compare, oracle_connection
from pyspark.sql import functions as F

from formline.llm import decontaminate as D
from formline.llm.queries import ORACLES, QUERIES


def brute(rows, items, similarity=0.8):
    """Every passage against every item."""
    loaded = []
    for i, text in items:
        words = D.words_of((text or "").lower())
        if words:
            loaded.append(D.Item(i, words, len(words) - max(1, len(words) // 3)))
    if not loaded:
        return []
    longest = max(len(i.words) for i in loaded)
    reach = -(-(longest + int((1 - similarity) * longest + 1e-9) - 1) // D.STRIDE) + 1
    out = set()
    for d, text in rows:
        words = D.words_of((text or "").lower())
        blocks = -(-len(words) // D.STRIDE)
        for item in loaded:
            hits = []
            for k in range(max(1, blocks - reach + 1)):
                share, question, answer = item.overlap(words[k * D.STRIDE : (k + reach) * D.STRIDE])
                if share >= similarity - 1e-9 and question >= 0.5 and answer >= 0.5:
                    hits.append(share)
            if hits:
                out.add((d, item.id, len(hits), max(hits)))
    return out


def check(df, rows, items, similarity=0.8):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    assert set(got) == set(brute(rows, items, similarity))
    return got


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force_on_a_whole_table(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert check(D.contaminated(docs, bench), rows, [tuple(r) for r in bench.select("item_id", "text").collect()])


def altered(seed, n=150):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.6)) % 900}" for _ in range(20_000)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([3, 5, 9, 20, 40, 70])))) for i in range(60)]
    rows = []
    for d in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randrange(300))]
        passage = rnd.choice(items)[1].split()
        for _ in range(rnd.randrange(5)):
            passage[rnd.randrange(len(passage))] = rnd.choice(words)
        passage = passage[rnd.randrange(3) :]
        at = rnd.randrange(len(text) + 1)
        rows.append((d, " ".join(text[:at] + passage + text[at:])))
    return rows, items


@pytest.mark.parametrize("similarity", [0.8, 0.5])
def test_altered_items_are_found_as_by_brute_force(spark, make_docs, similarity):
    rows, items = altered(3)
    got = check(D.contaminated(make_docs(rows), items_table(spark, items), similarity=similarity), rows, items, similarity)
    assert len(got) > 40


def test_slices_of_the_benchmark(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "SLICE_ITEMS", 7)
    rows = [(1, "a b c d e f"), (2, "g h i j k l m x"), (3, "none")]
    items = [(i, t) for i, t in enumerate(["a b c d e f", "g h i j k l m", *(f"q{i} r s t u v" for i in range(20))])]
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(make_docs(rows), items_table(spark, items)).collect()}
    assert got == {(1, 0), (2, 1)}
    assert [r["doc_id"] for r in D.without_contaminated(make_docs(rows), items_table(spark, items)).collect()] == [3]


def test_slicing_does_not_change_the_passages(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "SLICE_ITEMS", 7)
    rows, items = altered(3)
    assert len(check(D.contaminated(make_docs(rows), items_table(spark, items)), rows, items)) > 40


def test_a_sliced_benchmark_equals_sql(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(D, "SLICE_ITEMS", 5)
    key = "op5_decontamination"
    result = compare(spark, oracle_connection(sf_dir), sf_dir, QUERIES[key], ORACLES[key])
    assert result["equal"] and result["rows"], result


def test_question_and_answer_must_both_overlap(spark, make_docs):
    question, answer = "what is the name of the river that runs through town today", "it is the old green river"
    bench = spark.createDataFrame([(1, question, answer)], "item_id long, text string, reply string")
    rows = [(1, f"x {question}? {answer.upper()}. y"), (2, f"{question} nobody knows"), (3, answer), (4, f"{answer} {question}")]
    got = D.contaminated(make_docs(rows), bench, answer_col="reply", similarity=0.6).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 4]


def test_odd_rows(spark, make_docs):
    long = " ".join(f"n{i}" for i in range(50_000))
    items = [(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "!!!"), (5, "solo"), (6, "n777 n778 n779 n780 n781 n782")]
    text = "Alpha beta, GAMMA delta epsilon_zeta"
    rows = [(1, None), (2, ""), (3, text), (3, text), (4, long), (None, "x solo y"), (5, "clean one")]
    docs = make_docs(rows, {"item_id": F.lit("x"), "share": F.lit(1)})
    check(D.contaminated(docs, items_table(spark, items)), rows, items)
    clean = D.without_contaminated(docs, items_table(spark, items))
    assert clean.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect()) == [(1, None), (2, ""), (5, "clean one")]


def test_empty_tables(spark, make_docs):
    assert D.contaminated(make_docs([]), items_table(spark, [(1, "a b")])).collect() == []
    assert D.contaminated(make_docs([(1, "a b")]), items_table(spark, [])).collect() == []
    assert D.without_contaminated(make_docs([(1, "a b")]), items_table(spark, [])).count() == 1


def test_many_items_are_searched_by_one_operator(spark, make_docs, monkeypatch):
    """Five thousand items in five slices, of which a worker keeps two."""
    monkeypatch.setattr(D, "LOADED", 2)
    rnd = random.Random(11)
    items = [(i, " ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([4, 8, 15])))) for i in range(5000)]
    rows = [(d, " ".join(f"w{rnd.randrange(3000)}" for _ in range(80)) + " " + (rnd.choice(items)[1] if d % 3 else "")) for d in range(30)]
    found = D.contaminated(make_docs(rows), items_table(spark, items))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert len(check(found, rows, items)) >= 20
    clean = D.without_contaminated(make_docs(rows), items_table(spark, items))
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    bad = {d for d, *_ in brute(rows, items)}
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - bad


def test_long_texts_are_searched_in_pieces(spark, make_docs, monkeypatch):
    rows, items = altered(5, 60)
    long = [(1000, " ".join(t for _, t in rows)), (1001, " ".join(t for _, t in rows[::-1]))]
    monkeypatch.setattr(D, "STEP_BLOCKS", 5)
    assert len(check(D.contaminated(make_docs(rows + long), items_table(spark, items)), rows + long, items)) > 20


def test_copies_with_words_put_in_are_found_wherever_they_stand(spark, make_docs):
    item = [f"i{k}" for k in range(97)]
    rows = []
    for shift in range(40):
        altered_copy = item[:30] + ["x", "y", "z"] + item[30:60] + ["u", "v"] * 4 + item[60:]
        rows.append((shift, " ".join([f"f{k}" for k in range(shift)] + altered_copy + ["tail"] * 50)))
    got = check(D.contaminated(make_docs(rows), items_table(spark, [(1, " ".join(item))])), rows, [(1, " ".join(item))])
    assert len(got) == 40


@pytest.mark.parametrize("kind", ["smallint", "tinyint", "string", "decimal(9,0)", "date", "double"])
def test_any_type_of_item_id(spark, make_docs, kind):
    value = "DATE'2020-01-02'" if kind == "date" else f"CAST(7 AS {kind})"
    bench = spark.sql(f"SELECT {value} AS item_id, 'a b c d e f' AS text")
    got = D.contaminated(make_docs([(1, "x a b c d e f y")]), bench)
    assert got.dtypes[1] == ("item_id", kind) and got.first()["item_id"] == bench.first()["item_id"]
