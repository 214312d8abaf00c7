"""Every stage against brute force over what its predecessor kept."""

import numpy as np
import pytest
from test_decontaminate import brute as leaks
from test_mixture import check as check_mix
from test_simhash import brute as groups
from test_suffix_dedup import brute as repeats

import corpus_pipeline
from formline.llm import lang_id
from formline.llm.common import written

SHAPE = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output rows of every stage over a whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((before, docs))
    return out


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda x: x[0])


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "source_mix"]
    for before, after in stages[:-1]:
        assert before.columns == after.columns == SHAPE
        assert [t for _, t in before.dtypes] == [t for _, t in after.dtypes]


def test_language_stage_keeps_identified_documents(stages):
    before, after = stages[0]
    found = {r["doc_id"]: r for r in lang_id.predictions(before).collect()}
    want = [(i, t) for i, t in pairs(before) if found[i]["lang_pred"] != "und" and found[i]["score"] >= 1.05 / 4]
    assert pairs(after) == want
    assert len(want) >= 0.97 * before.count()


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = stages[1]
    rows = pairs(before)
    first = {component for _, _, component in groups(rows)}
    assert pairs(after) == [(i, t) for i, t in rows if i in first]


def test_suffix_stage_cuts_repeats(stages):
    before, after = stages[2]
    rows, kept = pairs(before), pairs(after)
    assert [i for i, _ in rows] == [i for i, _ in kept]
    for (i, text), (_, rest), (_, n, removed, _, _) in zip(rows, kept, repeats(rows), strict=True):
        lost = len(text.encode()) - len(rest.encode())
        assert removed <= lost <= removed + 6 * (removed > 0), i  # a cut may fall inside a character
        if not removed:
            assert rest == text
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_decontamination_stage_drops_what_holds_an_item(stages, spark, sf_dir):
    before, after = stages[3]
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, *_ in leaks(pairs(before), bench)}
    assert pairs(after) == [(i, t) for i, t in pairs(before) if i not in bad]


def test_mix_stage(stages):
    before, after = stages[4]
    check_mix(after, [(r["doc_id"], r["text"], r["source"]) for r in before.collect()])


def test_run_equals_the_stages(stages, spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[-1][1].collect()))


def test_odd_rows_pass_all_stages(spark, sf_dir, make_docs):
    rows = [(None, None, None, None), (1, None, "en", "a"), (2, "", None, "a"), (3, "12 34", "en", None)]
    rows += [(10 + i, "the " * 30 + f"and number {i} of them", ("en", "de")[i % 2], "b") for i in range(8)] + [(10, "x y z", "en", None)] * 2
    for docs in (make_docs(rows), make_docs([])):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf_dir), "test-odd")
        assert all(np.isfinite(r["target"]) for r in docs.collect())
