"""Scores texts with an interpolated modified Kneser-Ney model of two or three words.

The model is counted in Spark and stored as sorted hash arrays in the shared folder, which workers map
into memory; no worker reads it whole and nothing of it passes through the driver but one row per
file. Steps of the model of three words:

1. Word counts of the training texts, kept sorted by 64-bit word hash. A word's number is its place.
2. Triples (u, v, w) are counted, partial sums made before the shuffle, in parts dealt by a hash of the middle
   word; a word so frequent that it would weigh a part down is dealt by (u, v) instead. A part keeps, sorted, its
   middle words, the words u before each, and the words w after each pair with their counts; and the sums of the
   pairs with many successors.
3. From the distinct triples, how many different words precede each pair (v, w): kept sorted by (v, w) in parts
   dealt by a hash of v, or of the pair where v is frequent. (In the model of two words: how often pairs occur.)
4. Per word, as a context: its total and how many of its pairs count one, two, more; as a
   continuation: how many different words precede it. Partial sums are made before the shuffle.
5. Scoring: p(w|uv) = max(c(uvw) - D, 0) / c(uv) + spare(uv) p(w|v), p(w|v) likewise from the counts of step 3 over
   p(w), and p(w) from continuation counts, interpolated with 1 / (V + 1). Each order has its own three
   discounts, from its counts of counts. An unseen context leaves the word to the shorter one.

Texts are lower-cased (A-Z), words are runs without ASCII white space, one end follows. Before the first
word stand starts, which are no tokens. Rows whose crc32 of the id mod 5 is 1 are held out.

Defined cases: a null or empty text is just its end; a null id is held out; repeated rows count as often
as they occur; without training rows every probability is that of an unknown word; an empty table gives
an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm.common import memory_of, steps
from formline.session import fresh_path

#: White space cannot be part of a word, so no word has this hash by being equal.
END = b" "
#: Pairs, and distinct words, that a task gathers before it passes them on.
FLUSH_PAIRS = 3_000_000
FLUSH_WORDS = 500_000
HOT_SHARE = 8
#: Bits of a number that holds a triple.
TRIPLE_BITS = 64
#: Successors of a pair up to which its sums are made when they are asked for.
SHORT_LIST = 8


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(True))


def model_folder(spark: SparkSession) -> str:
    """A new folder inside the shared one, as a path that tasks can map files of."""
    url = urlparse(fresh_path(spark, "kneser-ney"))
    if url.scheme not in ("", "file"):
        raise ValueError("memory-mapped models need a shared folder that is mounted as a file system")
    os.makedirs(url.path)
    return url.path


def _save(path: str, array: np.ndarray) -> None:
    """Whole or not at all, and the same again if a task is repeated."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns byte plane by byte plane, which compresses well when values are sorted or small."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)


def _unpack(raw: bytes, *types: type) -> list[np.ndarray]:
    sizes = [np.dtype(t).itemsize for t in types]
    n, at, out = len(raw) // sum(sizes), 0, []
    for t, size in zip(types, sizes, strict=True):
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += n * size
    return out


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *(np.add.reduceat(v[order], first, dtype=v.dtype) if len(keys) else v for v in values)]


def _divided(keys: np.ndarray, by: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """``divmod`` with a division by a constant, which numpy turns into a multiplication."""
    whole = keys // by
    return whole, keys - whole * by


def _by_part(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs and its rows, in their order."""
    if not len(parts):
        return
    # numbers of two bytes are sorted by digits
    small = parts.astype(np.uint16) if parts.max() < 1 << 16 else parts
    order = np.argsort(small, kind="stable")
    dealt = parts[order]
    first = np.flatnonzero(np.concatenate([[True], dealt[1:] != dealt[:-1]]))
    yield from zip(dealt[first].tolist(), np.split(order, first[1:]), strict=True)


def _dealt(parts: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The packed columns of each part; ``columns`` stay in their order inside a part."""
    for p, rows in _by_part(parts):
        yield p, _pack(*(c[rows] for c in columns))


def _rows(parts: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for p, raw in parts:
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([raw], pa.binary())], ["part", "data"])


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens as bytes, the place of every token among them, and each text's first token.

    Arrow's ASCII functions work byte by byte, as those of ``bytes`` do, and split at the same white space.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    words = split.flatten()
    whole = np.asarray(pc.binary_length(words)) > 0  # white space at an end of a text leaves an empty word there
    sizes = np.add.reduceat(whole, np.asarray(split.offsets)[:-1], dtype=np.int64) + 1
    coded = words.filter(pa.array(whole)).dictionary_encode()
    distinct = np.empty(len(coded.dictionary) + 1, object)
    distinct[:-1] = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    distinct[-1] = END
    ends = np.cumsum(sizes) - 1
    codes = np.full(ends[-1] + 1, len(distinct) - 1, np.int64)
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = np.asarray(coded.indices)
    return distinct, codes, ends + 1 - sizes


def _hashes(words: np.ndarray) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _after(values: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """For every token the value of the token before it, ``start`` where a text begins."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first] = start
    return out


def _ranked(high: np.ndarray, low: np.ndarray, n_low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (high, low) in order, as two columns, and the place of every row among them.

    ``low`` is below ``n_low``. Where pair and row fit into one number, numbers are sorted, which is several times as fast
    as sorting places.
    """
    keys = high * n_low + low
    bits = len(keys).bit_length()
    if (int(keys.max()) + 1) << bits < 1 << 63:
        packed = (keys << bits) | np.arange(len(keys))
        packed.sort()
        order, keys = packed & ((1 << bits) - 1), packed >> bits
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(fresh) - 1
    keys = keys[fresh]
    first = keys // n_low
    return first, keys - first * n_low, place


@dataclass
class Model:
    """Where the arrays are, and the few numbers that all tasks need."""

    folder: str
    parts: int
    tokens: int = 0
    words: int = 0
    bases: list[int] = field(default_factory=list)
    order: int = 2
    triple_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    continuations: int = 0
    spare: float = 1.0

    def part_of_hash(self, hashes: np.ndarray) -> np.ndarray:
        return (((hashes >> np.uint64(32)) * np.uint64(self.parts)) >> np.uint64(32)).astype(np.int64)

    def part_of_number(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.bases), numbers, side="right") - 1

    def part_of_pair(self, before: np.ndarray, number: np.ndarray, hot: np.ndarray) -> np.ndarray:
        x = before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= np.where(hot, number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0))
        x ^= x >> np.uint64(31)
        return self.part_of_hash(x * np.uint64(0xBF58476D1CE4E5B9))


class Reader:
    """The mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.open: dict[str, np.ndarray] = {}

    def array(self, name: str, part: int) -> np.ndarray:
        key = f"{name}-{part:05d}.npy"
        if key not in self.open:
            # still mapped, but read without the checks of numpy's own class for maps
            self.open[key] = np.load(f"{self.model.folder}/{key}", mmap_mode="r").view(np.ndarray)
        return self.open[key]

    def words(self, words: np.ndarray) -> np.ndarray:
        """Numbers of words; -1 for those that training never met."""
        hashes = _hashes(words)
        found = np.full(len(words), -1, np.int64)
        order = np.argsort(hashes)
        hashes = hashes[order]  # as they are stored, so that searches go from place to place
        for part, rows in _by_part(self.model.part_of_hash(hashes)):
            known = self.array("word", part)
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes[rows]), len(known) - 1)
                found[order[rows]] = np.where(known[place] == hashes[rows], place + self.model.bases[part], -1)
        return found

    def per_word(self, name: str, numbers: np.ndarray, shape: int = 0) -> np.ndarray:
        """Values of an array that has one row per word; 0 for number -1."""
        out = np.zeros((len(numbers), shape) if shape else len(numbers), np.int64)
        valid = np.flatnonzero(numbers >= 0)
        for part, rows in _by_part(self.model.part_of_number(numbers[valid])):
            out[valid[rows]] = self.array(name, part)[numbers[valid[rows]] - self.model.bases[part]]
        return out

    def is_hot(self, before: np.ndarray) -> np.ndarray:
        """Whether pairs after a word are dealt by the pair, from distinct or sorted words; those after the start always are."""
        fresh = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])[: len(before)])
        words = before[fresh]
        start = words == self.model.words
        counts = self.per_word("count", np.where(start, -1, words))
        hot = start | (counts * self.model.parts * HOT_SHARE > self.model.tokens)
        return np.repeat(hot, np.diff(np.append(fresh, len(before))))

    def pair_counts(self, before: np.ndarray, number: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Counts of pairs; ``hot`` tells of each whether ``before`` is. Best in order, so that neighbours touch the same pages."""
        out = np.zeros(len(number), np.int64)
        known = np.flatnonzero((before >= 0) & (number >= 0))
        for part, rows in _by_part(self.model.part_of_pair(before[known], number[known], hot[known])):
            heads, tails, stored, times = (self.array(n, part) for n in ("heads", "tails", "pair", "times"))
            if len(heads):
                rows, at = _listed(heads, before, known[rows])
                found = _within(stored, tails[at], tails[at + 1], number[rows])
                out[rows[found >= 0]] = times[found[found >= 0]]
        return out

    def triples(
        self, u: np.ndarray, v: np.ndarray, hot: np.ndarray, each: np.ndarray, w: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of triples, the totals of their contexts (u, v), and how many of a context's successors count one, two, more.

        Contexts are distinct and in the order of (v, u), ``each`` is how many of the words ``w`` follow it, and ``hot`` tells of
        each whether v is.
        """
        counts, totals = np.zeros(len(w), np.int64), np.zeros(len(u), np.int64)
        kinds = np.zeros((len(u), 3), np.int64)
        begins = np.cumsum(each) - each
        known = np.flatnonzero((u >= 0) & (v >= 0))
        for part, rows in _by_part(self.model.part_of_pair(v[known], u[known], hot[known])):
            arrays = [self.array(name, part) for name in ("middle", "middles", "left", "lefts", "right", "seen", "long", "sums")]
            middle, middles, left, lefts, right, seen, long, sums = arrays
            if not len(middle):
                continue
            rows, at = _listed(middle, v, known[rows])
            context = _within(left, middles[at], middles[at + 1], u[rows])
            rows, context = rows[context >= 0], context[context >= 0]
            if not len(rows):
                continue
            totals[rows], kinds[rows] = _context_sums(context, lefts, seen, long, sums)
            size = each[rows]
            places = np.arange(size.sum()) + np.repeat(begins[rows] - np.cumsum(size) + size, size)
            context = np.repeat(context, size)
            real = w[places] >= 0
            places, context = places[real], context[real]
            found = _within(right, lefts[context], lefts[context + 1], w[places])
            counts[places[found >= 0]] = seen[found[found >= 0]]
        return counts, totals, kinds


def _listed(stored: np.ndarray, wanted: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``rows`` whose number among ``wanted`` is in sorted ``stored``, and its place there."""
    # of one type, else the whole stored array would be converted
    numbers = wanted[rows].astype(stored.dtype)
    place = np.minimum(np.searchsorted(stored, numbers), len(stored) - 1)
    there = stored[place] == numbers
    return rows[there], place[there]


def _within(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted number (none below 0) in its stretch of sorted ``values``, -1 where it is not there."""
    place = low.astype(np.int64)
    size = high.astype(np.int64) - place
    wanted = wanted.astype(values.dtype)
    out = np.full(len(place), -1, np.int64)
    active = np.flatnonzero(size > 0)
    place, size, wanted = place[active], size[active], wanted[active]
    while len(active):
        # halves of stretches are left out until one number is left
        longer = size > 1
        if 2 * np.count_nonzero(longer) < len(active):
            one = ~longer
            met = values[place[one]] == wanted[one]
            out[active[one][met]] = place[one][met]
            active, place, size, wanted = (x[longer] for x in (active, place, size, wanted))
            continue
        half = size >> 1
        place += half * (values[place + half] <= wanted)
        size -= half
    return out


def _context_sums(
    context: np.ndarray, lefts: np.ndarray, seen: np.ndarray, long: np.ndarray, sums: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Total, and successors that count one, two, more, of the contexts of one part."""
    start = lefts[context].astype(np.int64)
    size = lefts[context + 1].astype(np.int64) - start
    out = np.zeros((len(context), 4), np.int64)
    many = np.flatnonzero(size > SHORT_LIST)
    out[many] = sums[np.searchsorted(long, context[many].astype(long.dtype))]
    # a context of one successor is counted by it
    one = np.flatnonzero(size == 1)
    c = seen[start[one]].astype(np.int64)
    out[one, 0] = c
    out[one, np.minimum(c, 3)] = 1
    few = np.flatnonzero((size > 1) & (size <= SHORT_LIST))
    if len(few):
        ends = np.cumsum(size[few])
        at = np.arange(ends[-1]) + np.repeat(start[few] - ends + size[few], size[few])
        c = seen[at].astype(np.int64)
        for k, x in enumerate((c, c == 1, c == 2, c >= 3)):
            out[few, k] = np.add.reduceat(x, ends - size[few], dtype=np.int64)
    return out[:, 0], out[:, 1:]


def _reader(model: Model) -> Reader:
    """One reader per worker and model."""
    held = memory_of(__name__)
    if not held or held[0].model != model:
        held[:] = [Reader(model)]
    return held[0]


def _smallest(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()) if values.size else 0))


def _lines(reader: Reader, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all tokens, of the tokens before them, and each text's first place."""
    distinct, codes, first = _tokens(texts)
    numbers = reader.words(distinct)[codes]
    return numbers, _after(numbers, first, reader.model.words), first


def count_words(texts: DataFrame, model: Model) -> None:
    """Step 1 over the column ``text``; sets the model's totals."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def passed_on(hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield from _rows(_dealt(model.part_of_hash(hashes), hashes, counts))

        def added_up() -> list[np.ndarray]:
            return _summed(*(np.concatenate(c) for c in zip(*held, strict=True)))

        for _, raw in steps(batches, "text"):
            distinct, codes, _ = _tokens(raw)
            held.append([_hashes(distinct), np.bincount(codes, minlength=len(distinct)).astype(np.uint64)])
            size += len(distinct)
            if size > 2 * FLUSH_WORDS:
                held = [added_up()]
                size = len(held[0][0])
                if size > FLUSH_WORDS:
                    yield from passed_on(*held[0])
                    held, size = [], 0
        if held:
            yield from passed_on(*added_up())

    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        blobs = [_unpack(raw, np.uint64, np.uint64) for raw in table.column("data").to_pylist()]
        hashes, counts = _summed(*(np.concatenate(c) for c in zip(*blobs, strict=True)))
        _save(f"{model.folder}/word-{part:05d}.npy", hashes)
        _save(f"{model.folder}/count-{part:05d}.npy", _smallest(counts))
        return pa.table({"part": [part], "words": [len(hashes)], "tokens": [int(counts.sum())]})

    schema = "part bigint, words bigint, tokens bigint"
    rows = texts.mapInArrow(gather, "part int, data binary").groupBy("part").applyInArrow(store, schema).collect()
    found = {r["part"]: r for r in rows}
    for part in range(model.parts):
        model.bases.append(model.words)
        if part in found:
            model.words += found[part]["words"]
            model.tokens += found[part]["tokens"]
        else:
            for name in ("word", "count"):
                _save(f"{model.folder}/{name}-{part:05d}.npy", np.zeros(0, np.uint64))


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """From the numbers of entries with counts 1 to 4; halves where the counts are too few to tell."""
    if not n[0] or not n[1]:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return tuple(float(min(max(d, 0.05 * k), 0.95 * k)) for k, d in zip((1, 2, 3), raw, strict=True))


def _gathered_pairs(texts: DataFrame, vocabulary: Model) -> DataFrame:
    """(part, data): pairs of neighbouring words and how often they occur, partly added up."""
    width = np.uint64(vocabulary.words + 1)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(vocabulary)
        held: list[np.ndarray] = []
        size = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            before, number = (x.astype(np.int64) for x in _divided(keys, width))
            parts = vocabulary.part_of_pair(before, number, reader.is_hot(before))
            del before, number
            yield from _rows(_dealt(parts, keys, counts.astype(np.uint64)))

        for _, raw in steps(batches, "text"):
            numbers, before, _ = _lines(reader, raw)
            held.append(before.astype(np.uint64) * width + numbers.astype(np.uint64))
            size += len(numbers)
            if size >= FLUSH_PAIRS:
                yield from passed_on()
                size = 0
        if size:
            yield from passed_on()

    return texts.mapInArrow(gather, "part int, data binary")


def _counted_triples(texts: DataFrame, vocabulary: Model) -> DataFrame:
    """Steps 2 and 3: stores the triples; (part, data): pairs and how many words precede them, partly added up."""
    width = np.uint64(vocabulary.words + 1)
    # a triple is one number where three words fit into 64 bits, else a pair and a word
    single = (vocabulary.words + 1) ** 3 < 2**TRIPLE_BITS
    types = (np.uint64, np.uint32) if single else (np.uint64, np.uint64, np.uint32)

    def summed(columns: list[np.ndarray]) -> list[np.ndarray]:
        *keys, counts = columns
        order = np.argsort(keys[0], kind="stable") if single else np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        fresh = np.zeros(len(order), bool)
        fresh[:1] = True
        for k in keys:
            fresh[1:] |= k[1:] != k[:-1]
        first = np.flatnonzero(fresh)
        return [*(k[first] for k in keys), np.add.reduceat(counts[order], first, dtype=np.uint64).astype(np.uint32)]

    def parted(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(v, u, w) of triples."""
        pair, w = _divided(keys[0], width) if single else keys
        v, u = _divided(pair, width)
        return v.astype(np.int64), u.astype(np.int64), w.astype(np.int64)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(vocabulary)
        held: list[list[np.ndarray]] = []
        size = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            if single:  # numbers are sorted faster than places
                columns[0].sort()
                first = np.flatnonzero(np.concatenate([[True], columns[0][1:] != columns[0][:-1]]))
                keys, counts = [columns[0][first]], np.diff(np.append(first, len(columns[0]))).astype(np.uint32)
            else:
                *keys, counts = summed([*columns, np.ones(len(columns[0]), np.uint32)])
            del columns
            v, u, _ = parted(keys)
            parts = vocabulary.part_of_pair(v, u, reader.is_hot(v))
            del v, u
            yield from _rows(_dealt(parts, *keys, counts))

        for _, raw in steps(batches, "text"):
            numbers, before, first = _lines(reader, raw)
            earlier = _after(before, first, vocabulary.words)
            pair = before.astype(np.uint64) * width + earlier.astype(np.uint64)
            w = numbers.astype(np.uint64)
            held.append([pair * width + w] if single else [pair, w])
            size += len(numbers)
            if size >= FLUSH_PAIRS:
                yield from passed_on()
                size = 0
        if size:
            yield from passed_on()

    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        blobs = [_unpack(raw, *types) for raw in table.column("data").to_pylist()]
        *keys, counts = summed([np.concatenate(c) for c in zip(*blobs, strict=True)])
        del blobs
        v, u, w = parted(keys)
        del keys
        new = np.concatenate([[True], (v[1:] != v[:-1]) | (u[1:] != u[:-1])])
        starts = np.flatnonzero(new)  # of contexts
        of_middle = np.flatnonzero(np.concatenate([[True], v[starts][1:] != v[starts][:-1]]))
        sizes = np.diff(np.append(starts, len(v)))
        long = np.flatnonzero(sizes > SHORT_LIST)
        sums = np.stack(
            [np.add.reduceat(x, starts, dtype=np.int64)[long] for x in (counts, counts == 1, counts == 2, counts >= 3)], axis=1
        )
        small = _smallest(np.array([vocabulary.words])).dtype
        for name, array in (
            ("middle", v[starts[of_middle]].astype(small)),
            ("middles", _smallest(np.append(of_middle, len(starts)))),
            ("left", u[starts].astype(small)),
            ("lefts", _smallest(np.append(starts, len(v)))),
            ("right", w.astype(small)),
            ("seen", _smallest(counts)),
            ("long", _smallest(long)),
            ("sums", sums),
            ("times3", np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64)),
        ):
            _save(f"{vocabulary.folder}/{name}-{part:05d}.npy", array)
        pairs, preceded = np.unique(v.astype(np.uint64) * width + w.astype(np.uint64), return_counts=True)
        del v, u, w
        before, number = (x.astype(np.int64) for x in _divided(pairs, width))
        parts = vocabulary.part_of_pair(before, number, _reader(vocabulary).is_hot(before))
        rows = list(_dealt(parts, pairs, preceded.astype(np.uint64)))
        return pa.table({"part": pa.array([p for p, _ in rows], pa.int32()), "data": pa.array([d for _, d in rows], pa.binary())})

    triples = texts.mapInArrow(gather, "part int, data binary")
    return triples.groupBy("part").applyInArrow(store, "part int, data binary")


def count_pairs(texts: DataFrame, model: Model) -> None:
    """Steps 2 to 4 over the column ``text``; sets discounts and continuation totals."""
    vocabulary = Model(model.folder, model.parts, model.tokens, model.words, model.bases, model.order)
    width = np.uint64(model.words + 1)

    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        blobs = [_unpack(raw, np.uint64, np.uint64) for raw in table.column("data").to_pylist()]
        keys, times = _summed(*(np.concatenate(c) for c in zip(*blobs, strict=True)))
        del blobs
        before, number = _divided(keys, width)
        del keys
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        small = _smallest(np.array([model.words])).dtype
        for name, array in (
            ("heads", before[heads].astype(small)),
            ("tails", _smallest(np.append(heads, len(before)))),
            ("pair", number.astype(small)),
            ("times", _smallest(times)),
        ):
            _save(f"{model.folder}/{name}-{part:05d}.npy", array)
        kinds = [(times == 1), (times == 2), (times >= 3)]
        context = _summed(before, times.astype(np.uint64), *(k.astype(np.uint64) for k in kinds))
        follows = _summed(number, np.ones(len(number), np.uint64))
        out: list[tuple[str, int, bytes]] = []
        for kind, columns in (("context", context), ("follows", follows)):
            start = columns[0] == width - np.uint64(1)  # the start has no row of its own among words
            place = np.where(start, np.int64(-1), columns[0].astype(np.int64))
            parts = np.where(start, model.parts, vocabulary.part_of_number(place))
            out += [(kind, p, raw) for p, raw in _dealt(parts, *columns)]
        counted = [int((times == k).sum()) for k in (1, 2, 3, 4)]
        out.append(("counts", -1, np.array(counted, np.int64).tobytes()))
        return pa.table(
            {
                "kind": [k for k, _, _ in out],
                "part": pa.array([p for _, p, _ in out], pa.int32()),
                "data": pa.array([d for _, _, d in out], pa.binary()),
            }
        )

    def settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
        result = {"part": [part], "follows": [0], "counts": [[0, 0, 0, 0, 0]]}
        types = {"context": (np.uint64,) * 5, "follows": (np.uint64,) * 2}
        summed = {}
        for kind, of in types.items():
            blobs = [_unpack(raw, *of) for k, raw in zip(kinds, data, strict=True) if k == kind]
            columns = [np.concatenate(c) for c in zip(*blobs, strict=True)] or [np.zeros(0, t) for t in of]
            summed[kind] = _summed(*columns)
        if part < 0:
            totals = sum((np.frombuffer(raw, np.int64) for raw in data), np.zeros(4, np.int64))
            result["counts"] = [[*totals.tolist(), 0]]
        elif part == model.parts:
            _save(f"{model.folder}/start-00000.npy", np.array([int(c[0]) for c in summed["context"][1:]], np.int64))
        else:
            base = model.bases[part]
            n = (model.bases[part + 1] if part + 1 < model.parts else model.words) - base
            numbers, total, *rest = summed["context"]
            whole = np.zeros(n, np.uint64)
            whole[numbers.astype(np.int64) - base] = total
            counts = np.zeros((n, 3), np.uint64)
            counts[numbers.astype(np.int64) - base] = np.stack(rest, axis=1)
            numbers, precede = summed["follows"]
            follows = np.zeros(n, np.uint64)
            follows[numbers.astype(np.int64) - base] = precede
            for name, array in (("total", whole), ("kinds", counts), ("follows", follows)):
                _save(f"{model.folder}/{name}-{part:05d}.npy", _smallest(array))
            result["follows"] = [int(follows.sum(dtype=np.int64))]
            result["counts"] = [[*(int((follows == k).sum()) for k in (1, 2, 3, 4)), int((follows >= 3).sum())]]
        return pa.table(result)

    pairs = _counted_triples(texts, vocabulary) if model.order == 3 else _gathered_pairs(texts, vocabulary)
    stored = pairs.groupBy("part").applyInArrow(store, "kind string, part int, data binary")
    rows = stored.groupBy("part").applyInArrow(settle, "part bigint, follows bigint, counts array<bigint>").collect()
    words = np.zeros(5, np.int64)
    for r in rows:
        if r["part"] < 0:
            model.pair_discounts = _discounts(r["counts"][:4])
        else:
            words += np.array(r["counts"])
            model.continuations += r["follows"]
    model.word_discounts = _discounts(words[:4].tolist())
    if model.continuations:
        kinds = np.array([words[0], words[1], words[4]])
        model.spare = float(kinds @ np.array(model.word_discounts)) / model.continuations
    for part in range(model.parts):  # parts that no row reached
        for name in ("heads", "pair", "times", "total", "follows"):
            _fill(model, name, part, np.zeros(0, np.uint64))
        _fill(model, "tails", part, np.zeros(1, np.uint8))
        _fill(model, "kinds", part, np.zeros((0, 3), np.uint64))
    _fill(model, "start", 0, np.zeros(4, np.int64))
    if model.order == 3:
        times = np.zeros(4, np.int64)
        for part in range(model.parts):
            for name in ("middle", "left", "right", "seen", "long"):
                _fill(model, name, part, np.zeros(0, np.uint64))
            for name, empty in (("middles", np.zeros(1, np.uint8)), ("lefts", np.zeros(1, np.uint8)), ("sums", np.zeros((0, 4), np.int64))):
                _fill(model, name, part, empty)
            _fill(model, "times3", part, np.zeros(4, np.int64))
            times += np.load(f"{model.folder}/times3-{part:05d}.npy")
        model.triple_discounts = _discounts(times.tolist())


def _fill(model: Model, name: str, part: int, empty: np.ndarray) -> None:
    path = f"{model.folder}/{name}-{part:05d}.npy"
    if not os.path.exists(path):
        _save(path, empty)


def fit(texts: DataFrame, parts: int | None = None, order: int = 3) -> Model:
    """A model of the whole column ``text``, in ``parts`` files of each kind (default: shuffle partitions)."""
    if order not in (2, 3):
        raise ValueError("models have an order of 2 or 3")
    spark = texts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = Model(model_folder(spark), parts, order=order)
    count_words(texts, model)
    if (model.words + 1) ** 2 >= 2**64:
        raise ValueError("too many distinct words for pairs of 64 bits")
    count_pairs(texts, model)
    return model


def log_probabilities(
    reader: Reader, numbers: np.ndarray, codes: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log10 p(word | words before) of every token, the training counts of distinct words, and each token's place among these.

    ``numbers`` are those of distinct words, ``codes`` the place of every token among them, ``first`` each text's first
    token. Each distinct word, pair, context and triple is looked up once.
    """
    model = reader.model

    def cut(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
        return np.maximum(counts - np.array([0.0, *discounts])[np.minimum(counts, 3)], 0.0)

    # words in order: -1 (unknown) first where it occurs; the start comes behind the last
    words, rank = np.unique(numbers, return_inverse=True)
    start = len(words)
    word = rank[codes]
    counts = reader.per_word("count", words)
    single = np.full(start, model.spare / (model.words + 1))
    if model.continuations:
        single += cut(reader.per_word("follows", words), model.word_discounts) / model.continuations
    of_start = reader.array("start", 0)
    total = np.append(reader.per_word("total", words), of_start[0])
    kinds = np.concatenate([reader.per_word("kinds", words, 3), of_start[None, 1:]])
    whole = np.maximum(total, 1)
    spare = np.where(total > 0, kinds @ np.array(model.pair_discounts) / whole, 1.0)
    hot = np.append(counts * model.parts * HOT_SHARE > model.tokens, True)
    numbered = np.append(words, model.words)
    # pairs in the order of (word, word before): as contexts these are in the order in which triples are stored
    w, c, pair = _ranked(word, _after(word, first, start), start + 1)
    by_before, by_word, place = _ranked(c, w, start)
    often = reader.pair_counts(numbered[by_before], numbered[by_word], hot[by_before])[place]
    paired = cut(often, model.pair_discounts) / whole[c] + spare[c] * single[w]
    if model.order == 2:
        return np.log10(paired)[pair], counts, word
    # a text's first word has the context (start, start), which comes behind all pairs
    x, last, triple = _ranked(_after(pair, first, len(w)), word, start)
    backed = np.empty(len(x))
    backed[triple] = paired[pair]
    heads = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    each = np.diff(np.append(heads, len(x)))
    v, u = (np.append(ranks, start)[x[heads]] for ranks in (w, c))
    often, total, kinds = reader.triples(numbered[u], numbered[v], hot[v], each, words[last])
    whole = np.maximum(total, 1)
    spare = np.where(total > 0, kinds @ np.array(model.triple_discounts) / whole, 1.0)
    found = cut(often, model.triple_discounts) / np.repeat(whole, each) + np.repeat(spare, each) * backed
    return np.log10(found)[triple], counts, word


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity."""
    source = docs.select(
        F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text")
    )
    floor = np.log10(model.tokens + 0.5 * (model.words + 1))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(model)
        for batch, raw in steps(batches, "text"):
            distinct, codes, first = _tokens(raw)
            scores, counts, word = log_probabilities(reader, reader.words(distinct), codes, first)
            sums = [
                np.diff(np.append(first, len(codes))),
                np.add.reduceat((counts > 0).astype(np.int64)[word], first),
                np.add.reduceat((np.log10(counts + 0.5) - floor)[word], first),
                np.add.reduceat(scores, first),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(s) for s in sums)],
                ["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    fields = (
        f"id {source.schema['id'].dataType.simpleString()}, held_out boolean, "
        "n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return source.mapInArrow(tasks, fields).select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def train_and_score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, order: int = 3
) -> DataFrame:
    """Learns from the rows of ``docs`` that are not held out and scores all of them."""
    model = fit(docs.where(~held_out(F.col(id_col))).select(F.col(text_col).alias("text")), parts, order)
    return score(docs, model, id_col, text_col)
