"""Piece encoding that keeps offsets, and its decoding.

A text is normalised first: at every place the longest key of the model's compiled character map (a
double array of 32-bit units) that the text continues with is replaced, anything else is kept, and each
normalised byte records the original byte it stands for. Spaces become the space symbol. The normalised
text is merged into pieces, lowest rank first and leftmost among equals; characters that no piece covers
become one byte piece per byte. Every piece is projected through the recorded alignment to a span of
original UTF-8 bytes: a replaced stretch belongs to the piece that holds its normalised bytes, the byte
pieces of one character but the last have empty spans at its start.

Only the model file comes from outside; normalising, merging and decoding are done here. Rows are not
moved, and a task holds one slice of texts and a bounded memory of chunks at a time.

Defined cases: a null text is an empty one and gives the begin and end ids only; rows with null ids are
encoded like any other; repeated rows give repeated results; bytes that are not UTF-8 read as U+FFFD each;
an empty table gives an empty result; columns other than the id and the text are left out.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.bpe_count import _fields
from formline.llm.common import memory_of, steps, texts_of

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Distinct chunks whose ids a worker remembers, in each of two generations.
CACHE_CHUNKS = 300_000
CACHE_CHARS = 48
#: Chunks of more symbols are merged with a heap, shorter ones by looking for the least rank.
SHORT = 48
_NEVER = float("inf")


class CharacterMap:
    """The compiled character map: a double array over UTF-8 bytes whose values point at replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]
        self.starts = frozenset(b for b in range(256) if self._child(self._root(), b) is not None)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _root(self) -> int:
        return self._offset(self.units[0])

    def _child(self, base: int, byte: int) -> int | None:
        """Place of the unit that ``byte`` leads to, if there is one."""
        place = base ^ byte
        if place < len(self.units) and self.units[place] & 0x800000FF == byte:
            return place
        return None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``data`` continues with at ``at``."""
        base, found = self._root(), None
        for i in range(at, len(data)):
            place = self._child(base, data[i])
            if place is None:
                break
            unit = self.units[place]
            base = place ^ self._offset(unit)
            if unit >> 8 & 1:
                value = self.units[base] & 0x7FFFFFFF
                found = i + 1 - at, self.texts[value : self.texts.index(0, value)]
        return found


class Normaliser:
    """Text to normalised bytes with the original place of each of them (and the end)."""

    def __init__(self, blob: bytes, dummy_prefix: bool = True, trim: bool = False, escape: bool = True):
        self.map = CharacterMap(blob) if blob else None
        self.dummy_prefix, self.trim, self.escape = dummy_prefix, trim, escape

    def pieces(self, data: bytes, widths: dict[int, int]) -> Iterator[tuple[int, bytes]]:
        """Length consumed and bytes put out, place by place; ``widths`` names original lengths that differ."""
        starts = self.map.starts if self.map else frozenset()
        at, n = 0, len(data)
        while at < n:
            lead = data[at]
            if lead in starts and (hit := self.map.longest(data, at)):
                yield sum(widths.get(i, 1) for i in range(at, at + hit[0])) if widths else hit[0], hit[1]
                at += hit[0]
                continue
            end = at + 1 if lead < 0x80 else at + 2 if lead < 0xE0 else at + 3 if lead < 0xF0 else at + 4
            yield sum(widths.get(i, 1) for i in range(at, end)) if widths else end - at, data[at:end]
            at = end

    def normalised(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes of ``raw`` and, for each and the end, the original byte offset."""
        data, widths = _valid(raw)
        space = SPACE_BYTES if self.escape else b" "
        out: list[bytes] = []
        places: list[int] = []
        lengths: list[int] = []
        at, started, after_space = 0, False, self.trim
        for width, put in self.pieces(data, widths):
            if not started and not (self.trim and put == b" "):
                started = True
                if self.dummy_prefix:
                    out.append(space)
                    places.append(at)
                    lengths.append(len(space))
            if started:
                if after_space:
                    put = put.lstrip(b" ")
                if put:
                    after_space = self.trim and put.endswith(b" ")
                    escaped = put.replace(b" ", space)
                    out.append(escaped)
                    places.append(at)
                    lengths.append(len(escaped))
            at += width
        end = at if started else 0
        if self.trim:
            while out and out[-1].endswith(space):
                out[-1] = out[-1][: -len(space)]
                lengths[-1] -= len(space)
                end = places[-1]
                if not out[-1]:
                    out.pop(), places.pop(), lengths.pop()
        return b"".join(out), np.concatenate([np.repeat(np.array(places, np.int64), lengths), [end]])


def _valid(raw: bytes) -> tuple[bytes, dict[int, int]]:
    """``raw`` with U+FFFD for each byte that is not UTF-8, and the original widths of bytes put in for them."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        pass
    else:
        return raw, {}
    out, widths = bytearray(), {}
    for char in raw.decode("utf-8", "surrogateescape"):
        if "\udc80" <= char <= "\udcff":
            widths |= {len(out): 1, len(out) + 1: 0, len(out) + 2: 0}
            out += b"\xef\xbf\xbd"
        else:
            out += char.encode()
    return bytes(out), widths


class Memory(dict):
    """Packed ids of the chunks met since the last one was full; others come from that, or are made."""

    def __init__(self, codec: Codec, old: dict[str, bytes]):
        super().__init__()
        self.codec, self.old = codec, old

    def __missing__(self, chunk: str) -> bytes:
        packed = self.old.get(chunk)
        if packed is None:
            packed = self.codec.chunk_ids(chunk)
        if len(chunk) <= CACHE_CHARS:
            self[chunk] = packed
        return packed


class Codec:
    """Pieces, ranks and rules of one model file.

    Accepted are byte-pair models with byte fallback and without user-defined or unused pieces.
    """

    def __init__(self, model: bytes):
        names, scores, self.kinds = [], [], []
        rules: dict = {}
        trainer: dict = {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                names.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("not a byte-pair model with byte fallback and leading spaces")
        if not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.begin, self.end = names.index("<s>"), names.index("</s>")
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ")
        self.rules = Normaliser(rules.get(2, b""), bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(rules.get(5, 1)))
        self.plain = not self.rules.map and not self.rules.trim and self.rules.escape
        self.ids = {p: i for i, p in enumerate(names) if self.kinds[i] == NORMAL}
        self.rank = {p: -scores[i] for p, i in self.ids.items()}
        self.byte_ids = [names.index(f"<0x{b:02X}>") for b in range(256)]
        self._tables(names)
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            chunk = r"(?s:.+)"  # merges may cross spaces: the text is one chunk
        elif "\n" in joined:
            chunk = f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
        else:  # no merge crosses the start of a run of spaces or touches a line break
            chunk = f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+"
        self.chunks = re.compile(chunk).findall
        self.memory = Memory(self, {})

    def _tables(self, names: list[str]) -> None:
        """Per id: what it reads as, and its width in normalised bytes and (each space one) in plain ones."""
        n = len(names)
        self.surface: list[bytes] = [b""] * n
        self.byte_of = np.full(n, -1, np.int32)
        self.width = np.zeros(n, np.int64)
        self.plain_width = np.zeros(n, np.int64)
        for b, i in enumerate(self.byte_ids):
            self.surface[i], self.byte_of[i] = bytes([b]), b
            self.width[i] = self.plain_width[i] = 1
        for i, (name, kind) in enumerate(zip(names, self.kinds, strict=True)):
            if kind == NORMAL:
                self.surface[i] = name.replace(SPACE, " ").encode()
                self.width[i], self.plain_width[i] = len(name.encode()), len(self.surface[i])
            elif kind == UNKNOWN:
                self.surface[i] = self.unknown_text
        self.spaced = np.array([k == NORMAL and p.startswith(SPACE) for k, p in zip(self.kinds, names, strict=True)])

    def merged(self, chunk: str) -> list[str]:
        """``chunk`` after all merges."""
        get = self.rank.get
        parts = list(chunk)
        if len(parts) > SHORT:
            return self._merged_long(parts)
        ranks = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], _NEVER)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
        return parts

    def _merged_long(self, parts: list[str | None]) -> list[str]:
        rank, n = self.rank, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in rank]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != pair:
                continue  # one side has been merged since
            parts[i], parts[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := pair + parts[k]) in rank:
                    heappush(heap, (rank[p], i, p))
            h = before[i]
            if h >= 0 and (p := parts[h] + pair) in rank:
                heappush(heap, (rank[p], h, p))
        return [p for p in parts if p is not None]

    def chunk_ids(self, chunk: str) -> bytes:
        """Packed ids of a chunk, which no merge leaves."""
        ids: list[int] = []
        known = self.ids
        for part in self.merged(chunk):
            if part in known:
                ids.append(known[part])
            else:  # a single character: merges only make pieces
                ids += [self.byte_ids[b] for b in part.encode()]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a whole text with begin and end, and where each piece's original bytes begin and end."""
        if self.plain and SPACE_BYTES not in raw and (text := _decoded(raw)) is not None:
            norm, align = (SPACE if text and self.rules.dummy_prefix else "") + text.replace(" ", SPACE), None
        else:
            data, align = self.rules.normalised(raw)
            norm = data.decode()
        if len(self.memory) > CACHE_CHUNKS:
            self.memory = Memory(self, dict(self.memory))
        packed = b"".join(map(self.memory.__getitem__, self.chunks(norm)))
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        widths = (self.plain_width if align is None else self.width)[ids]
        if align is None and len(ids) and self.rules.dummy_prefix:
            widths[0] -= 1  # the first space is not in the text
        ends = np.cumsum(widths)
        begins = ends - widths
        self._gather_bytes(ids, begins, ends)
        if align is not None:
            begins, ends = align[begins], align[ends]
        size = len(raw)
        return (
            np.concatenate([[self.begin], ids, [self.end]]),
            np.concatenate([[0], begins, [size]]),
            np.concatenate([[0], ends, [size]]),
        )

    def _gather_bytes(self, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        """Gives the span of a character to the last of its byte pieces, an empty one to the others."""
        at = np.flatnonzero(self.byte_of[ids] >= 0)
        if not len(at):
            return
        lead = (self.byte_of[ids[at]] & 0xC0) != 0x80
        first = begins[at[np.maximum.accumulate(np.where(lead, np.arange(len(at)), 0))]]
        last = np.append(lead[1:], True)
        begins[at] = first
        ends[at[~last]] = first[~last]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ``ids``: control ids read as nothing, runs of byte pieces as UTF-8.

        Bytes of a run that are not UTF-8 read as U+FFFD each.
        """
        out = b"".join(map(self.surface.__getitem__, ids.tolist()))
        seen = np.flatnonzero(np.array([k != CONTROL for k in map(self.kinds.__getitem__, ids[:2].tolist())], bool))
        first = int(seen[0]) if len(seen) else next((i for i, k in enumerate(ids.tolist()) if self.kinds[k] != CONTROL), None)
        if first is not None and (self.rules.dummy_prefix or self.rules.trim) and self.spaced[ids[first]]:
            out = out[1:]
        return _valid(out)[0]


def _decoded(raw: bytes) -> str | None:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


@lru_cache(maxsize=1)
def _loaded(model: bytes) -> Codec:
    return Codec(model)


def _codec(model: bytes) -> Codec:
    """One codec per worker, remembered between tasks."""
    held = memory_of(__name__)
    if not held or held[0][0] != model:
        held[:] = [(model, Codec(model))]
    return held[0][1]


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, ``n_tokens`` and the packed columns ``ids``, ``begins``, ``ends``.

    Packed columns are little-endian unsigned 32-bit integers, one per id; ``begins`` and ``ends`` are
    byte offsets into the text's UTF-8. ``unpacked`` turns one into an array.
    """
    return _mapped(docs, model_path, id_col, text_col, decode=False)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_texts`` and, as ``decoded``, the text that decoding the ids gives."""
    return _mapped(docs, model_path, id_col, text_col, decode=True)


def _mapped(docs: DataFrame, model_path: str, id_col: str, text_col: str, decode: bool) -> DataFrame:
    with open(model_path, "rb") as f:
        model = f.read()
    _loaded(model)  # refuse an unsuitable model before any task starts
    source = texts_of(docs, id_col, text_col)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch, raw in steps(batches, "text"):
            sizes, counts, columns = [], [], ([], [], [], [])
            for text in raw:
                ids, begins, ends = codec.encode(text)
                sizes.append(len(text))
                counts.append(len(ids))
                for column, values in zip(columns, (ids, begins, ends), strict=False):
                    column.append(_packed(values))
                if decode:
                    columns[3].append(codec.decode(ids).decode())
            made = [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), *(pa.array(c, pa.binary()) for c in columns[:3])]
            names = ["id", "n_bytes", "n_tokens", "ids", "begins", "ends"]
            if decode:
                made.append(pa.array(columns[3], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names)

    fields = f"id {source.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, "
    fields += "ids binary, begins binary, ends binary" + (", decoded string" if decode else "")
    found = source.mapInArrow(tasks, fields)
    return found.select(F.col("id").alias(id_col), *found.columns[1:])


def decode_ids(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the packed ids appended; null ids give null."""
    with open(model_path, "rb") as f:
        model = f.read()
    _loaded(model)

    @F.pandas_udf("string")
    def read(ids):
        codec = _codec(model)
        return ids.map(lambda raw: codec.decode(np.frombuffer(raw, "<u4")).decode(), na_action="ignore")

    return encoded.withColumn(text_col, read(F.col(ids_col)))


def unpacked(packed: str | F.Column) -> F.Column:
    """An array of the integers of a packed column."""
    column = F.col(packed) if isinstance(packed, str) else packed
    digits = F.hex(column)  # eight digits an integer, lowest byte first
    places = F.sequence(F.lit(0), (F.length(column) / 4).cast("int") - 1)

    def value(i):
        pair = [F.substr(digits, i * 8 + 1 + 2 * k, F.lit(2)) for k in (3, 2, 1, 0)]
        return F.conv(F.concat(*pair), 16, 10).cast("bigint")

    return F.when(F.length(column) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(places, value))


def digests(round_trips: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 digests of what ``round_trip`` returns."""
    return round_trips.select(
        id_col,
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "n_bytes",
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
    )
