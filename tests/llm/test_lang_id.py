import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import lang_id as L

EN = "the cat and the dog went with the other animals that they had thought of "
DE = "der hund und die katze sind nicht auf der straße aber über dem zaun "
FR = "le chat est très élégant où les élèves mangent du pain à côté des autres "


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 3 == 1


def sample(n):
    return [(i, (EN, DE, FR)[i % 3] * 3, ("en", "de", "fr")[i % 3]) for i in range(n)]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = L.Network.start(["a", "b", "c"], 5, 1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    codes, mask = L.padded([b"abc", b"de", b"fghij", b"k"])
    labels = np.array([0, 1, 2, 1])

    def loss():
        p = net.positions(codes, mask)
        return -(np.log(p[:, np.arange(4), labels]) * mask.T).sum() / mask.sum()

    grad = net.gradients(codes, mask, labels)
    for name, w in net.weights.items():
        for _ in range(6):
            at = (int(codes.ravel()[rng.integers(5)]), rng.integers(w.shape[1])) if name.startswith("in_") else tuple(rng.integers(0, w.shape))
            before = w[at]
            w[at] = before + 1e-3
            up = loss()
            w[at] = before - 1e-3
            down = loss()
            w[at] = before
            assert grad[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-4), name


@pytest.fixture(scope="module")
def network():
    return L.train([EN.encode(), DE.encode(), FR.encode()], ["en", "de", "fr"], n_steps=30, batch=24)


def in_one_go(network, text):
    codes = np.frombuffer(text, np.uint8)[None, :]
    return network.positions(codes, np.ones(codes.shape, np.float32))[:, 0]


def test_windows_equal_reading_whole_texts(network):
    """States are carried along, also through runs that a margin does not see the end of: less than 0.001 apart."""
    rng = np.random.default_rng(2)
    parts = (EN, DE, FR, "日本語 текст\n\n", "x" * 500, " 12 !! ")
    texts = ["".join(parts[i] for i in rng.integers(0, 6, n)).encode() for n in (1, 2, 9, 60, 300)] + [b"", b"a", "é".encode()]
    for window, margin in ((L.WINDOW, L.MARGIN), (64, 24), (L.AGAIN + 5, 3)):
        labels = [np.full(len(t), -1) for t in texts]
        sums = L.window_sums(network, texts, window, margin, labels)
        for text, own, label in zip(texts, sums, labels, strict=True):
            if not text:
                assert own.tolist() == [0.0] * 3
                continue
            whole = in_one_go(network, text)
            assert own.sum() == pytest.approx(len(text), rel=1e-4)  # every position counts once
            assert np.abs(whole.sum(axis=0) - own).max() < 0.001 * len(text) + 0.01
            assert label.min() >= 0 and (label == whole.argmax(axis=1)).mean() > 0.995


def test_long_texts_are_read_in_pieces(network, monkeypatch):
    texts = [(EN + DE) .encode() * 40, FR.encode(), (DE * 3).encode()]
    wanted, labels = L.window_sums(network, texts), [np.full(len(t), -1) for t in texts]
    monkeypatch.setattr(L, "HELD", 3 * 2000)
    monkeypatch.setattr(L, "LOOK", 300)
    found = L.window_sums(network, texts, labels=labels)
    assert found == pytest.approx(wanted, abs=1.0) and found.sum(axis=1) == pytest.approx([len(t) for t in texts])
    for text, label in zip(texts, labels, strict=True):
        assert (label == in_one_go(network, text).argmax(axis=1)).mean() > 0.99


def test_a_text_that_fits_a_window_is_read_exactly(network):
    for text in (b"a", EN.encode(), (EN + DE + FR).encode()):
        whole = in_one_go(network, text)
        assert L.window_sums(network, [text], len(text), 8)[0] == pytest.approx(whole.sum(axis=0), rel=1e-3, abs=1e-4)


def test_words_are_read_in_their_context(network):
    words = EN.split() + DE.split()
    one, other = " ".join(words).encode(), " ".join(words[::2] + words[1::2]).encode()
    spaced = "  ".join(words).encode()
    first, second, third = L.pooled(network, [one, other, spaced])
    assert np.abs(first - second).max() > 1e-3 and np.abs(first - third).max() > 1e-4


def test_few_rows_of_many_languages_are_all_learned(spark, make_docs):
    """No language is left out, however many there are, and every text may give any of its windows."""
    letters = [chr(0x4E00 + k) for k in range(300)]
    rows = [(i, letters[k] * 40, f"l{k:03d}") for k in range(300) for i in range(10 * k, 10 * k + 10) if not held(i)]
    windows, labels = L.labelled_sample(make_docs(rows), "doc_id", "text", "lang", per_lang=30)
    assert set(labels) == {r[2] for r in rows} and len({g for g in labels}) == 300
    long = make_docs([(i, "a" * 5000 + "b" * 5000, "x") for i in range(30)])
    drawn = L.labelled_sample(long, "doc_id", "text", "lang")[0]
    assert {c for w in drawn for c in w.decode()} == {"a", "b"} and max(map(len, drawn)) <= L.SPAN
    assert 500 <= len(drawn) <= 2 * L.PER_LANG


def test_clashing_columns(make_docs):
    docs = make_docs(sample(30), {"held_out": F.lit(1), "lang_pred": F.lit("x"), "score": F.lit(0.5), "Lang_Pred_": F.lit(1)})
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and {tuple(r)[5:] for r in kept.collect()} == {(1, "x", 0.5, 1)}
    with pytest.raises(ValueError):
        L.identify(docs)


def test_held_out_accuracy_on_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in L.predictions(docs).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    assert all(got[r["doc_id"]]["held_out"] == held(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    judged = [r for r in rows if held(r["doc_id"]) and r["lang"] and len(r["text"] or "") > 60]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in judged)
    assert right >= 0.97 * len(judged)


def test_languages_and_sources_of_predicted_rows_do_not_matter(make_docs):
    rows = [(i, t, g, "s") for i, t, g in sample(60)]
    first = {r["doc_id"]: r for r in L.predictions(make_docs(rows)).collect()}
    other = [(i, t, "xx" if held(i) else g, "other") for i, t, g, _ in rows]
    again = {r["doc_id"]: r for r in L.predictions(make_docs(other)).collect()}
    assert first == again
    assert all(r["lang_pred"] == rows[i][2] for i, r in first.items())


def test_odd_rows(make_docs):
    rows = sample(40) + [(100, None, "en"), (101, "", "de"), (102, "123 ... !!", "fr"), (None, DE, "xx"), (103, DE, None), (103, DE, None), (104, FR * 3000, "fr"), (105, "É" * 9000, None)]
    docs = make_docs(rows, {"held_out": F.lit(1), "score": F.lit("x"), "lang_pred": F.lit(2)})
    got = L.predictions(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i in (100, 101, 102):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[None]["held_out"] and by_id[None]["lang_pred"] == "de"
    assert (by_id[103]["lang_pred"], by_id[104]["lang_pred"]) == ("de", "fr")
    assert "xx" not in {r["lang_pred"] for r in got}
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(rows) - 3


def test_nothing_to_learn_from(make_docs):
    assert L.predictions(make_docs([])).collect() == []
    got = L.predictions(make_docs([(1, EN, None), (2, EN, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    one = [i for i in range(20) if not held(i)][:3]
    got = L.predictions(make_docs([(i, EN, "en") for i in one])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("en", 1.0)}


def test_windows_that_have_ended_are_not_read_on(monkeypatch):
    read = []
    plain = L.Way.step
    monkeypatch.setattr(L.Way, "step", lambda self, codes: read.append(len(codes)) or plain(self, codes))
    network = L.Network.start(["a", "b"], 4, 1)
    texts = [b"x" * 300, *[b"yz"] * 50]
    sums = L.window_sums(network, texts)
    assert sum(read) == 2 * sum(map(len, texts))
    whole = [network.positions(*L.padded([t])).sum(axis=(0, 1)) for t in texts]
    assert np.allclose(sums, whole, atol=1e-3)


def test_reading_looks_gates_up(network, monkeypatch):
    """Only new states' tangents are computed, and gates are those that training meets, also far from zero."""
    text = (EN + DE + FR).encode()[: L.WINDOW]
    whole = in_one_go(network, text).mean(axis=0)
    steep = {k: v * 30 if k.startswith("rec") else v for k, v in network.weights.items()}
    run, largest = L.Way(L.Network(network.langs, steep), "f", 1), 0.0
    for code in np.frombuffer(text, np.uint8):
        state = run.state[0].copy()
        x = (steep["in_f"][code] + steep["bias_f"]).reshape(3, -1)
        h = (state @ steep["rec_f"]).reshape(3, -1)
        reset, update = 0.5 * np.tanh(0.5 * (x[:2] + h[:2])) + 0.5
        wanted = update * state + (1 - update) * np.tanh(x[2] + reset * h[2])
        run.step(np.array([code]))
        # a gate is off by 0.0001 at most, which weighs as much as what it lets through
        assert (np.abs(run.state[0] - wanted) < 0.0003 + 0.0001 * np.abs(h[2])).all()
        largest = max(largest, np.abs(x[:2] + h[:2]).max())
    assert largest > 16  # beyond the tables

    computed, tanh = [], np.tanh
    monkeypatch.setattr(np, "tanh", lambda x, **k: computed.append(x.size) or tanh(x, **k))
    assert L.pooled(network, [text])[0] == pytest.approx(whole, abs=0.001)
    assert sum(computed) == 2 * len(text) * L.HIDDEN
