"""Token counts by heap-and-linked-list byte-pair merging.

A text becomes one symbol per character; the adjacent pair of lowest rank (leftmost among equals) is
merged again and again until no pair is a vocabulary entry. The count is the number of initial symbols
minus the number of merges, where a character that no entry covers counts once per UTF-8 byte. No ids
are produced. Only the vocabulary file is taken from outside; the merging is done here.

Defined cases: a null or empty text has 0 tokens; a row with a null id is counted like any other;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import texts_of

SPACE = "▁"
#: Distinct chunks whose counts a worker remembers, in each of two generations.
CACHE_CHUNKS = 150_000
CACHE_CHARS = 48
NORMAL, USER_DEFINED = 1, 4


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, raw[at : at + size]
        at += size


class Vocabulary:
    """Merge ranks and rules of a piece model file.

    Only models without a character map and without user-defined pieces are accepted: others would
    need rules that this counter does not have.
    """

    def __init__(self, model: bytes):
        self.rank: dict[str, float] = {}
        self.known: set[str] = set()
        self.byte_fallback = False
        self.dummy_prefix = True
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                name, kind = piece[1].decode(), piece.get(3, NORMAL)
                self.known.add(name)
                if kind == USER_DEFINED:
                    raise ValueError("user-defined pieces are not supported")
                if kind == NORMAL:
                    self.rank[name] = -struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            elif field == 2:
                trainer = dict(_fields(value))
                if trainer.get(3, 1) != 2:
                    raise ValueError("the model is not a byte-pair model")
                self.byte_fallback = bool(trainer.get(35, 0))
            elif field == 3:
                rules = dict(_fields(value))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("the model's normalisation is not supported")
                self.dummy_prefix = bool(rules.get(3, 1))
        joined = {c for p in self.rank if len(p) > 1 for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            chunk = r"(?s:.+)"  # merges may cross spaces: the text is one chunk
        elif "\n" in joined:
            chunk = f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
        else:  # no merge crosses the start of a run of spaces or touches a line break
            chunk = f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+"
        self.chunks = re.compile(chunk).findall
        self._new: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def merged(self, chunk: str) -> int:
        """Tokens of ``chunk`` after all merges."""
        n = len(chunk)
        if n == 1:
            return self._symbols(chunk)
        rank = self.rank
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        symbol: list[str | None] = list(chunk)
        heap = []
        for i in range(n - 1):
            pair = chunk[i : i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = right[i]
            if symbol[i] is None or j >= n or symbol[i] + symbol[j] != pair:
                continue  # one side was merged meanwhile
            symbol[i], symbol[j] = pair, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                after = pair + symbol[k]
                if after in rank:
                    heappush(heap, (rank[after], i, after))
            h = left[i]
            if h >= 0:
                before = symbol[h] + pair
                if before in rank:
                    heappush(heap, (rank[before], h, before))
        known = self.known
        return sum(1 if s in known else self._symbols(s) for s in symbol if s is not None)

    def _symbols(self, s: str) -> int:
        return len(s.encode()) if self.byte_fallback and s not in self.known else 1

    def count(self, text: str) -> int:
        """Tokens of a whole text, special strings inside it being ordinary text."""
        if not text:
            return 0
        if self.dummy_prefix:
            text = " " + text
        total = 0
        new, old = self._new, self._old
        for chunk in self.chunks(text.replace(" ", SPACE)):
            n = new.get(chunk)
            if n is None:
                n = old.get(chunk)
                if n is None:
                    n = self.merged(chunk)
                if len(chunk) <= CACHE_CHARS:
                    if len(new) >= CACHE_CHUNKS:
                        self._old = old = new
                        self._new = new = {}
                    new[chunk] = n
            total += n
        return total


@lru_cache(maxsize=2)
def _loaded(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, ``n_tokens`` and whether the tokens exceed ``limit``.

    The model file (under 1 MB) travels with the tasks; rows are not moved.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    Vocabulary(model)  # refuse an unsuitable model before any task starts
    source = texts_of(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(model)
        for batch in batches:
            counts = [vocabulary.count(t.as_py()) for t in batch.column(1)]
            sizes = [len(t.as_py().encode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    counted = source.mapInArrow(tasks, f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
