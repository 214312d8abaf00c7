"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in both directions, labels every byte position with a distribution over
the learned languages, and a document's probabilities are the mean over all its positions. It is
written and trained in numpy by back-propagation through time, on windows drawn from whole labelled texts.

Whole texts are read in windows of ``WINDOW`` bytes, many at a time. Each direction enters a window with the state
that the ``MARGIN`` bytes before it (after it, for the way back) leave. Where the neighbouring window then ends in
another state, by more than ``APART`` in any unit, the window is read again from that state, and so on along the
text: states are carried over whole texts as if these were read byte by byte. Texts of more than ``HELD`` numbers
of results are read in pieces that overlap by ``LOOK`` bytes, so memory is bounded.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0; so is every text
when no labelled row could be learned from; a row with a null id is predicted, never learned from and
counts as held out; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.functions.columns import quoted
from formline.llm.common import steps, unused
from formline.session import rows_within

WINDOW = 384
MARGIN = 64
HIDDEN = 12
#: Difference of states from which on a window is read again.
APART = 0.05
#: Bytes that are read again before a look whether that still makes a difference.
AGAIN = 32
#: Numbers of results (one a byte and language) that reading holds per direction, and the bytes around a piece
#: of a longer text that are read with it.
HELD = 8_000_000
LOOK = 4_096
#: Windows read side by side at most.
ABREAST = 1_024
#: When whole texts are read, gates come from a table of so many entries, so many a unit (from -8 to 8, where the tangent
#: of which a gate is half is 1 but for 3e-7). Training computes them.
ENTRIES = 1 << 16
PER_UNIT = 1 << 12
UNDETERMINED = "und"
#: Bytes of a training window that are learned from.
MOST_BYTES = 144
#: Characters of a training window, windows per language, and windows of all languages together (at least
#: ``FEWEST`` of each are drawn, however many languages there are).
SPAN = 224
PER_LANG = 600
ALL_WINDOWS = 60_000
FEWEST = 8
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """Weights of one trained network; ``langs`` in the order of the outputs."""

    langs: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def start(langs: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for way in ("f", "b"):
            w[f"in_{way}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            w[f"rec_{way}"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden))
            w[f"bias_{way}"] = np.zeros(3 * hidden)
        w["out"] = rng.normal(0, 0.3, (2 * hidden, len(langs)))
        w["bias_out"] = np.zeros(len(langs))
        return Network(langs, {k: v.astype(np.float32) for k, v in w.items()})

    def _read(self, way: str, codes: np.ndarray, mask: np.ndarray, keep: bool):
        """States after each column of ``codes``; the state stays as it is where ``mask`` is 0."""
        w_in, rec, bias = (self.weights[f"{k}_{way}"] for k in ("in", "rec", "bias"))
        n, length = codes.shape
        hidden = rec.shape[0]
        table = w_in + bias
        state = np.zeros((n, hidden), np.float32)
        states = np.zeros((length, n, hidden), np.float32)
        kept = []
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            x = table[codes[:, t]]
            h = state @ rec
            gates = np.tanh(0.5 * (x[:, : 2 * hidden] + h[:, : 2 * hidden])) * 0.5 + 0.5
            reset, update = gates[:, :hidden], gates[:, hidden:]
            new = np.tanh(x[:, 2 * hidden :] + reset * h[:, 2 * hidden :])
            m = mask[:, t : t + 1]
            if keep:
                kept.append((t, state, reset, update, new, h[:, 2 * hidden :], m))
            state = state + m * (1 - update) * (new - state)
            states[t] = state
        return states, kept

    def positions(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probabilities of every position of rows read in one go: (length, rows, languages)."""
        both = np.concatenate([self._read(way, codes, mask, False)[0] for way in ("f", "b")], axis=2)
        return _softmax(both @ self.weights["out"] + self.weights["bias_out"])

    def gradients(self, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over positions, by back-propagation through time.

        ``labels`` has a language a row, or a row of languages, one a position.
        """
        hidden = self.weights["rec_f"].shape[0]
        runs = {way: self._read(way, codes, mask, True) for way in ("f", "b")}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        error = _softmax(both @ self.weights["out"] + self.weights["bias_out"])
        places = np.broadcast_to(labels[:, None] if labels.ndim == 1 else labels, codes.shape).T
        error[np.arange(len(places))[:, None], np.arange(len(labels)), places] -= 1
        error *= (mask.T / max(mask.sum(), 1))[:, :, None]
        grad = {
            "out": np.tensordot(both, error, axes=([0, 1], [0, 1])),
            "bias_out": error.sum(axis=(0, 1)),
        }
        d_both = error @ self.weights["out"].T
        for way, part in (("f", slice(0, hidden)), ("b", slice(hidden, None))):
            rec = self.weights[f"rec_{way}"]
            d_in = np.zeros((256, 3 * hidden), np.float32)
            d_rec, carried = np.zeros_like(rec), 0.0
            for t, before, reset, update, new, h_new, m in reversed(runs[way][1]):
                d = d_both[t][:, part] + carried
                d_new = d * m * (1 - update) * (1 - new * new)
                d_update = -d * m * (new - before) * update * (1 - update)
                d_reset = d_new * h_new * reset * (1 - reset)
                d_x = np.concatenate([d_reset, d_update, d_new], axis=1)
                d_h = np.concatenate([d_reset, d_update, d_new * reset], axis=1)
                np.add.at(d_in, codes[:, t], d_x)
                d_rec += before.T @ d_h
                carried = d * (1 - m * (1 - update)) + d_h @ rec.T
            grad |= {f"in_{way}": d_in, f"rec_{way}": d_rec, f"bias_{way}": d_in.sum(axis=0)}
        return grad


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


#: By place: the reset gate, and what the update gate lets pass of a new state. Gates are sigmoids, written as hyperbolic
#: tangents of halves.
_RESET = (0.5 + 0.5 * np.tanh((np.arange(ENTRIES) - ENTRIES // 2) / PER_UNIT)).astype(np.float32)
_KEEP = 1 - _RESET


class Way:
    """One direction of a network, step by step over many windows, without allocating."""

    def __init__(self, network: Network, way: str, n: int):
        w_in, rec, bias = (network.weights[f"{k}_{way}"] for k in ("in", "rec", "bias"))
        hidden = rec.shape[0]
        parts = [slice(k * hidden, (k + 1) * hidden) for k in range(3)]
        # what matrices yield of gates is places in the tables; half a place more, so that cutting decimals off rounds
        scales = (0.5 * PER_UNIT, 0.5 * PER_UNIT, 1.0)
        middles = (ENTRIES // 2 + 0.5, ENTRIES // 2 + 0.5, 0.0)
        self.tables = [
            np.ascontiguousarray((w_in + bias)[:, p] * s + m, np.float32) for p, s, m in zip(parts, scales, middles, strict=True)
        ]
        self.rec = [np.ascontiguousarray(rec[:, p] * s, np.float32) for p, s in zip(parts, scales, strict=True)]
        self.state = np.zeros((n, hidden), np.float32)
        self.held = [np.empty((n, hidden), np.float32) for _ in range(6)]
        self.whole, self.places = np.empty((n, hidden), np.int32), np.empty((n, hidden), np.intp)

    def step(self, codes: np.ndarray) -> None:
        """One step of the first ``len(codes)`` windows; the states of the others stay."""
        reset, keep, new, by_reset, by_keep, by_new = (h[: len(codes)] for h in self.held)
        state, whole, places = (h[: len(codes)] for h in (self.state, self.whole, self.places))
        for table, out in zip(self.tables, (reset, keep, new), strict=True):
            table.take(codes, axis=0, out=out, mode="clip")
        for rec, out in zip(self.rec, (by_reset, by_keep, by_new), strict=True):
            np.matmul(state, rec, out=out)
        for gate, by, values in ((reset, by_reset, _RESET), (keep, by_keep, _KEEP)):
            gate += by
            np.copyto(whole, gate, casting="unsafe")  # by way of four bytes, as this takes half the time
            np.copyto(places, whole)
            values.take(places, out=gate, mode="clip")
        reset *= by_new
        new += reset
        # a new state is computed: rounded, it would pull states that settle off
        np.tanh(new, out=new)
        new -= state
        new *= keep
        state += new


class Windows:
    """Texts cut into windows, read by one direction at a time."""

    def __init__(self, network: Network, texts: list[bytes], window: int, margin: int):
        self.network, self.margin = network, margin
        self.flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.intp)
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = -(-sizes // window)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        begins = np.cumsum(sizes) - sizes
        self.first = begins[self.text] + self.number * window
        self.length = np.minimum(sizes[self.text] - self.number * window, window)
        #: text before and after each window
        self.before = self.number * window
        self.after = sizes[self.text] - self.before - self.length
        #: windows from the longest on, and their places in that order, by which results are kept
        self.order = np.argsort(-self.length, kind="stable")
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.arange(len(self.order))

    def read(self, way: str) -> np.ndarray:
        """This direction's share of the logits: (place, language, window in ``order``)."""
        n = len(self.first)
        hidden = self.network.weights["rec_f"].shape[0]
        out = np.zeros((int(self.length.max()), len(self.network.langs), n), np.float32)
        entered, left = np.zeros((2, n, hidden), np.float32)
        for at in range(0, n, ABREAST):
            self._pass(way, at, min(at + ABREAST, n), out, entered, left)
        # the window that is read before each one, in this direction
        turn = 1 if way == "f" else -1
        after = (self.number > 0) if way == "f" else (self.after > 0)
        chained = np.flatnonzero(after)
        apart = np.zeros(n, bool)
        apart[chained] = np.abs(entered[chained] - left[chained - turn]).max(axis=1, initial=0.0) > APART
        while apart.any():
            ready = np.flatnonzero(apart)
            ready = ready[~(apart[ready - turn] & after[ready])]
            for at in range(0, len(ready), ABREAST):
                rows = ready[at : at + ABREAST]
                rows = rows[np.argsort(-self.length[rows], kind="stable")]
                self._again(way, rows, left[rows - turn], out, entered, left)
            apart[ready] = False
            following = ready + turn
            following = following[(following >= 0) & (following < n)]
            following = following[after[following]]
            apart[following] = np.abs(entered[following] - left[following - turn]).max(axis=1, initial=0.0) > APART
        return out

    def _pass(self, way: str, since: int, until: int, out: np.ndarray, entered: np.ndarray, left: np.ndarray) -> None:
        """Reads the windows from ``since`` to ``until`` in ``order``, entering them through their margins."""
        rows = self.order[since:until]
        run = Way(self.network, way, len(rows))
        room = np.minimum(self.before[rows] if way == "f" else self.after[rows], self.margin)
        lead = int(room.max(initial=0))
        for t in range(-lead, 0):
            run.state[room < -t] = 0.0
            run.step(self._codes(way, rows, t))
        run.state[room == 0] = 0.0
        entered[rows] = run.state
        found = self._steps(run, way, rows, 0, int(self.length[rows[0]]), left)
        self._store(way, rows, slice(since, until), 0, found, out)

    def _again(
        self, way: str, rows: np.ndarray, states: np.ndarray, out: np.ndarray, entered: np.ndarray, left: np.ndarray
    ) -> None:
        """Reads windows again from ``states``, each as far as that makes a difference."""
        entered[rows] = states
        at = 0
        while len(rows):
            run = Way(self.network, way, len(rows))
            run.state[:] = states
            end = min(at + AGAIN, int(self.length[rows[0]]))
            found = self._steps(run, way, rows, at, end, left)
            going = np.flatnonzero(self.length[rows] > end)
            seen = min(8, end - at)
            places = np.arange(end - seen, end)[:, None]
            if way == "b":
                places = self.length[rows[going]] - 1 - places
            known = out[places, :, self.rank[rows[going]]]
            differ = np.abs(known - found[-seen:, :, going].transpose(0, 2, 1)).max(axis=(0, 2), initial=0.0) > APART
            self._store(way, rows, self.rank[rows], at, found, out)
            rows, states, at = rows[going[differ]], run.state[going[differ]], end

    def _codes(self, way: str, rows: np.ndarray, t: int) -> np.ndarray:
        """The bytes that come ``t`` steps after windows are entered."""
        place = self.first[rows] + t if way == "f" else self.first[rows] + self.length[rows] - 1 - t
        return np.take(self.flat, place, mode="clip")

    def _steps(self, run: Way, way: str, rows: np.ndarray, start: int, end: int, left: np.ndarray) -> np.ndarray:
        """This direction's logits (step, language, window) from ``start`` to ``end``; keeps the states windows are left with."""
        hidden = run.state.shape[1]
        weights = self.network.weights["out"]
        share = np.ascontiguousarray((weights[:hidden] if way == "f" else weights[hidden:]).T)
        length = self.length[rows]
        place = self.first[rows] + start if way == "f" else self.first[rows] + length - 1 - start
        codes = np.empty(len(rows), np.intp)
        out = np.empty((end - start, len(share), len(rows)), np.float32)
        ends = np.searchsorted(-length, -np.arange(start, end + 1), side="left")  # windows longer than each step
        for t in range(end - start):
            # windows that have ended are not read on; found are zeros there, which nothing looks at
            on = int(ends[t])
            run.step(self.flat.take(place[:on], out=codes[:on], mode="clip"))
            if on == len(rows):
                np.matmul(share, run.state.T, out=out[t])
            else:
                out[t, :, :on] = share @ run.state[:on].T
                out[t, :, on:] = 0.0
            if ends[t + 1] < on:
                done = slice(ends[t + 1], on)
                left[rows[done]] = run.state[done]
            place += 1 if way == "f" else -1
        return out

    def _store(self, way: str, rows: np.ndarray, at: slice | np.ndarray, start: int, found: np.ndarray, out: np.ndarray) -> None:
        """Puts logits that :meth:`_steps` found of ``rows``, which are ``at`` these places in ``order``, where they belong."""
        if way == "f":
            out[start : start + len(found)][:, :, at] = found
            return
        length, steps = self.length[rows], np.arange(start, start + len(found))
        whole = len(out)
        n_full = int(np.count_nonzero(length == whole))  # they come first
        full = slice(at.start, at.start + n_full) if isinstance(at, slice) else at[:n_full]
        out[whole - start - len(found) : whole - start][:, :, full] = found[::-1, :, :n_full]
        if n_full < len(rows):
            places = length[n_full:] - 1 - steps[:, None]
            step, which = np.nonzero(places >= 0)
            out[places[step, which], :, self.rank[rows[n_full:]][which]] = found[step, :, n_full + which]


def window_sums(
    network: Network, texts: list[bytes], window: int = WINDOW, margin: int = MARGIN, labels: list[np.ndarray] | None = None
) -> np.ndarray:
    """Per text the sum of its positions' probabilities: (texts, languages).

    With ``labels``, an array per text of one number a byte, these get the most likely language of each position.
    """
    out = np.zeros((len(texts), len(network.langs)))
    most = max(window, HELD // max(1, len(network.langs)))
    # text, where its piece counts from and to, where the piece begins in the text, and the piece
    group: list[tuple[int, int, int, int, bytes]] = []
    size = 0

    def flush() -> None:
        pieces = Windows(network, [p for *_, p in group], window, margin)
        if not len(pieces.first):
            return
        logits = pieces.read("f")
        logits += pieces.read("b")
        logits += network.weights["bias_out"][None, :, None]
        text, before, length = (c[pieces.order] for c in (pieces.text, pieces.before, pieces.length))
        which, counts_from, counts_to, begins = (np.array(c)[text] for c in list(zip(*group, strict=True))[:4])
        origin = np.maximum(counts_from - before, 0)
        until = np.maximum(np.minimum(counts_to - before, length), origin)
        total = np.zeros((len(network.langs), len(which)))
        best = []
        for t, p in enumerate(logits):
            if labels is not None:
                best.append(p.argmax(axis=0))
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            p *= (origin <= t) & (t < until)
            total += p
        np.add.at(out, which, total.T)
        if labels is not None:
            found, places = np.array(best), begins + before
            for row, text in enumerate(which):
                labels[text][places[row] + origin[row] : places[row] + until[row]] = found[origin[row] : until[row], row]

    for text, raw in enumerate(texts):
        for at in range(0, len(raw), most):
            start, end = max(0, at - LOOK), min(len(raw), at + most)
            piece = raw[start : min(len(raw), end + LOOK)]
            if group and size + len(piece) > most:
                flush()
                group.clear()
                size = 0
            group.append((text, at - start, end - start, start, piece))
            size += len(piece)
    if group:
        flush()
    return out


def padded(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    width = max(len(s) for s in windows)
    flat = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in windows), np.uint8)
    sizes = np.array([len(s) for s in windows])
    return flat.reshape(-1, width), (np.arange(width) < sizes[:, None]).astype(np.float32)


def train(
    windows: list[bytes],
    labels: list[str],
    hidden: int = HIDDEN,
    n_steps: int = 120,
    batch: int = 384,
    rate: float = 0.02,
    seed: int = 7,
) -> Network:
    """A network fitted by Adam on batches in which the languages are equally frequent.

    Every other window is cut to a random part, so that short texts are met as well; of the long ones every other
    one is followed by a part of another, so that a language is left as soon as its text ends.
    """
    langs = sorted(set(labels))
    network = Network.start(langs, hidden, seed)
    if len(langs) < 2:
        return network
    rng = np.random.default_rng(seed)
    number = {g: k for k, g in enumerate(langs)}
    pools: list[list[bytes]] = [[] for _ in langs]
    for window, lang in zip(windows, labels, strict=True):
        if window:
            pools[number[lang]].append(window)
    filled = [k for k, pool in enumerate(pools) if pool]
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    for step in range(1, n_steps + 1 if filled else 0):
        wanted = rng.permutation(np.resize(rng.permutation(filled), batch))
        other = rng.permutation(wanted)
        drawn, joints = [], []
        for row, k in enumerate(wanted):
            window = pools[k][rng.integers(len(pools[k]))]
            if row % 2:
                size = int(rng.integers(8, 49))
                at = int(rng.integers(max(1, len(window) - size + 1)))
                window = window[at : at + size]
            joint = len(window)
            if row % 4 == 0:
                joint = int(rng.integers(16, MOST_BYTES - 16))
                following = pools[other[row]]
                window = window[:joint] + b" " + following[rng.integers(len(following))]
            drawn.append(window[:MOST_BYTES])
            joints.append(min(joint, len(window)))
        # long and short windows apart, so that none is padded much
        for half in (0, 1):
            codes, mask = padded(drawn[half::2])
            begun = np.arange(codes.shape[1]) < np.array(joints[half::2])[:, None]
            grad = network.gradients(codes, mask, np.where(begun, wanted[half::2, None], other[half::2, None]))
            pace = rate * min(1.0, 2 * (1 - (step - 1) / n_steps))
            turn = 2 * step - 1 + half
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-7)
                network.weights[k] = (network.weights[k] - pace * move).astype(np.float32)
    return network


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """Per text the mean probabilities over its positions (0 without any)."""
    sums = window_sums(network, texts)
    totals = sums.sum(axis=1, keepdims=True)
    return np.divide(sums, totals, out=np.zeros_like(sums), where=totals > 0)


def labelled_sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int = PER_LANG, span: int = SPAN
) -> tuple[list[bytes], list[str]]:
    """About ``per_lang`` windows of each language, at places of whole texts that a hash of the id picks.

    Rows whose crc32 of the id mod 3 is 1, null ids and null languages never enter. A language of few
    rows gives several windows of each. Only windows of ``span`` characters reach the driver; of very many
    languages each gives fewer, and no more than ``FEWEST``.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    n_langs = counts.count()
    if not n_langs:
        return [], []
    wanted = max(FEWEST, min(per_lang, ALL_WINDOWS // n_langs))
    per_row = F.ceil(wanted / F.col("n")).cast("int")
    shares = counts.select("lang", per_row.alias("per_row"), (wanted / (F.col("n") * per_row)).alias("share"))
    few = rows_within(shares)
    highest = shares.agg(F.max("share")).first()[0]
    chance = F.pmod(F.xxhash64("id", F.lit("lang")), F.lit(1 << 20)) / (1 << 20)
    drawn = (
        rows.where(chance < highest)
        .join(shares if few is None else F.broadcast(few), "lang")
        .where(chance < F.col("share"))
        .withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("per_row"))))
        .withColumn("at", F.pmod(F.xxhash64("id", "turn"), F.greatest(F.char_length("text") - span + 1, F.lit(1))) + 1)
        .select("lang", "id", "turn", F.substr("text", F.col("at").cast("int"), F.lit(span)).alias("window"))
    )
    # repeated rows could exceed the share, so the sample is cut at twice what is meant
    picked = drawn.orderBy(F.xxhash64("id", "turn"), "id", "turn", "lang", "window").limit(2 * wanted * n_langs).collect()
    return [r["window"].encode() for r in picked], [r["lang"] for r in picked]


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id, as text, leaves remainder 1 by 3; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    out: tuple[str, str, str] = ("held_out", "lang_pred", "score"),
    per_lang: int = PER_LANG,
) -> DataFrame:
    """``docs`` with whether a row is held out, its language and score (the pooled probability) appended.

    ``out`` names the three columns, which ``docs`` must not have. The sample that reaches the driver is
    bounded, see :func:`labelled_sample`. Prediction moves no rows.
    """
    return _identified(docs, id_col, text_col, lang_col, out, per_lang)[0]


def _identified(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, out: tuple[str, str, str], per_lang: int
) -> tuple[DataFrame, int]:
    """What ``identify`` returns, and the number of languages learned."""
    if unused(docs, *out) != list(out):
        raise ValueError(f"one of the columns {out} exists")
    windows, labels = labelled_sample(docs, id_col, text_col, lang_col, per_lang)
    network = train(windows, labels) if windows else Network([])
    source = docs.withColumn(out[0], held_out(F.col(id_col)))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, text_col):
            lang = np.full(len(raw), UNDETERMINED, dtype=object)
            score = np.zeros(len(raw))
            if network.langs:
                found = pooled(network, raw)
                letters = np.array([bool(_LETTER.search(t.decode("utf-8", "replace"))) for t in raw])
                best = found.argmax(axis=1)
                lang = np.where(letters, np.array(network.langs, dtype=object)[best], UNDETERMINED)
                score = np.where(letters, np.clip(found.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*batch.schema.names, *out[1:]],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(tasks, f"{fields}, `{out[1]}` string, `{out[2]}` double"), len(network.langs)


def predictions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **sample
) -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred`` and ``score``; other columns are left out."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    found = identify(slim, "id", "text", "lang", **sample)
    return found.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")


def keep_identified(
    docs: DataFrame,
    above_chance: float = 1.05,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = PER_LANG,
) -> DataFrame:
    """The rows of ``docs`` whose language is found, all columns as they are.

    Rejected are undetermined texts and those whose best language scores less than ``above_chance``
    times what each of the learned languages would have by chance.
    """
    names = tuple(unused(docs, "held_out", "lang_pred", "score"))
    found, n_langs = _identified(docs, id_col, text_col, lang_col, names, per_lang)
    least = above_chance / n_langs if n_langs > 1 else 0.0
    return found.where((F.col(names[1]) != UNDETERMINED) & (F.col(names[2]) >= least)).select(*(quoted(c) for c in docs.columns))
