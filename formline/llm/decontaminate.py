"""Finds training passages that hold benchmark items, through a BM25 index with block-max bounds.

The benchmark items are indexed, the training passages are the queries. A text's words are laid into
blocks of ``STRIDE``; a passage is as many neighbouring blocks as the longest item of the whole benchmark can
touch, also if 1 - ``similarity`` of its number of words were put in, however the benchmark is sliced. There is one
passage per block, so every item that stands in a text, altered as far as that, stands whole in some passage.

* Impacts are BM25 weights divided by what an item's weights must at least add up to. A passage
  that holds ``similarity`` of an item's m shingles lacks at most (1 - similarity) m of its words, so
  that least sum is the item's own score less its heaviest weights of that number. The threshold is then
  1 for every item, and retrieval loses no passage that verification would accept.
* Items stand in blocks of ``ITEM_BLOCK`` by length; per term and block the largest impact is kept. As
  in block-max WAND, the bounds of a passage's terms are added up first, and postings are read only in
  those item blocks whose bound reaches the threshold.
* Retrieved pairs are verified on the words: at least ``similarity`` of the item's distinct five-word
  shingles stand in the passage, and matching shingles cover at least half of the words of the
  question and half of those of the answer.

Words are lower-cased runs of letters and digits. An item without an answer column has its last third
(one word at least) as the answer.

Defined cases: null or empty texts hold nothing; items that are null or without words are never found; an
item shorter than a shingle must occur as a whole; rows with a null id are found under it; rows that
repeat an id are reported once; an empty table or benchmark gives an empty result.
"""

from __future__ import annotations

import os
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from formline.llm.common import memory_of
from formline.session import fresh_path

STRIDE = 32
SHINGLE = 5
ITEM_BLOCK = 4
#: Items and characters of one index; larger benchmarks are indexed and searched slice by slice.
SLICE_ITEMS = 1024
SLICE_CHARS = 4_000_000
MAX_ITEMS = 200_000
STEP_WORDS = 200_000
#: Blocks whose bounds are held at a time.
STEP_BLOCKS = 8_192
#: Indexes of slices that a worker keeps.
LOADED = 4
K1, B = 1.2, 0.75
_EPS = 1e-4
words_of = re.compile(r"[^\W_]+").findall


@dataclass
class Item:
    """One benchmark item, its distinct shingles with the words they cover, and its parts."""

    id: int
    words: list[str]
    question: int

    def __post_init__(self) -> None:
        width = min(SHINGLE, len(self.words))
        self.width = width
        self.places: dict[tuple[str, ...], list[int]] = {}
        for p in range(len(self.words) - width + 1):
            self.places.setdefault(tuple(self.words[p : p + width]), []).append(p)

    def overlap(self, passage: list[str]) -> tuple[float, float, float]:
        """Share of the shingles in ``passage``; shares of question and answer words they cover."""
        there = {tuple(passage[p : p + self.width]) for p in range(len(passage) - self.width + 1)}
        covered = np.zeros(len(self.words), bool)
        hits = 0
        for shingle, places in self.places.items():
            if shingle in there:
                hits += 1
                for p in places:
                    covered[p : p + self.width] = True
        question, answer = covered[: self.question], covered[self.question :]
        return hits / len(self.places), *(float(x.mean()) if len(x) else 1.0 for x in (question, answer))


class Index:
    """Impact-ordered postings of one slice of items, with the largest impact per term and block.

    ``reach`` is the blocks of a passage.
    """

    def __init__(self, items: list[Item], similarity: float, reach: int):
        self.items = sorted(items, key=lambda i: (len(i.words), i.id))  # alike lengths, alike impacts
        self.similarity = similarity
        self.terms: dict[str, int] = {}
        for word in chain.from_iterable(i.words for i in self.items):
            self.terms.setdefault(word, len(self.terms))
        mean = sum(len(i.words) for i in self.items) / len(self.items)
        rows = [np.unique([self.terms[w] for w in i.words], return_counts=True) for i in self.items]
        frequency = np.bincount(np.concatenate([t for t, _ in rows]), minlength=len(self.terms))
        idf = np.log1p((len(items) - frequency + 0.5) / (frequency + 0.5))
        terms, numbers, impacts = [], [], []
        for number, (item, (t, tf)) in enumerate(zip(self.items, rows, strict=True)):
            weight = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(item.words) / mean))
            may_lack = int((1 - similarity) * len(item.places) + 1e-9)
            least = weight.sum() - np.sort(weight)[::-1][:may_lack].sum()
            terms.append(t)
            numbers.append(np.full(len(t), number))
            impacts.append(weight / max(least, 1e-12))
        terms, numbers, impacts = map(np.concatenate, (terms, numbers, impacts))
        order = np.lexsort((numbers, terms))
        self.numbers, self.impacts = numbers[order], impacts[order]
        self.first = np.searchsorted(terms[order], np.arange(len(self.terms) + 1))
        self.bounds = np.zeros((len(self.terms), -(-len(self.items) // ITEM_BLOCK)), np.float32)
        np.maximum.at(self.bounds, (terms, numbers // ITEM_BLOCK), impacts.astype(np.float32))
        self.reach = reach

    def retrieved(self, terms: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Items of the given blocks whose score for these terms reaches the threshold."""
        rows = np.concatenate([np.arange(self.first[t], self.first[t + 1]) for t in terms])
        rows = rows[np.isin(self.numbers[rows] // ITEM_BLOCK, blocks)]
        score = np.bincount(self.numbers[rows], weights=self.impacts[rows], minlength=len(self.items))
        return np.flatnonzero(score >= 1 - _EPS)

    def search(self, texts: list[list[str]]) -> Iterator[tuple[int, Item, float]]:
        """(text number, item, share of its shingles) for every passage that holds an item.

        Long texts are searched piece by piece, with the blocks that a piece's last passages reach into.
        """
        held: list[tuple[int, int, int, list[str]]] = []  # text, first block, passages, words
        size = 0
        for t, words in enumerate(texts):
            n_blocks = -(-len(words) // STRIDE)
            # passages that begin with a text's last blocks lie inside an earlier one
            passages = max(1, n_blocks - self.reach + 1)
            for first in range(0, passages, STEP_BLOCKS):
                own = min(STEP_BLOCKS, passages - first)
                part = words[first * STRIDE : (first + own + self.reach - 1) * STRIDE]
                if held and size + len(part) > STEP_BLOCKS * STRIDE:
                    yield from self._search(held)
                    held, size = [], 0
                held.append((t, first, own, part))
                size += len(part)
        if held:
            yield from self._search(held)

    def _search(self, pieces: list[tuple[int, int, int, list[str]]]) -> Iterator[tuple[int, Item, float]]:
        texts = [p[3] for p in pieces]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = list(chain.from_iterable(texts))
        get = self.terms.get
        ids = np.fromiter(map(get, flat, repeat(-1)), np.int64, len(flat))
        blocks = -(-sizes // STRIDE)
        first_block, first_word = np.cumsum(blocks) - blocks, np.cumsum(sizes) - sizes
        inside = np.arange(len(flat)) - np.repeat(first_word, sizes)
        block = np.repeat(first_block, sizes) + inside // STRIDE
        known = ids >= 0
        pairs = np.unique(block[known] * len(self.terms) + ids[known])
        at, term = np.divmod(pairs, len(self.terms))
        bound = np.zeros((int(blocks.sum()), self.bounds.shape[1]), np.float32)
        if len(at):
            start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            bound[at[start]] = np.add.reduceat(self.bounds[term], start, axis=0)
        piece = np.repeat(np.arange(len(texts)), blocks)
        total = bound.copy()
        for k in range(1, self.reach):
            same = np.flatnonzero(piece[k:] == piece[:-k]) if k < len(piece) else np.zeros(0, np.int64)
            total[same] += bound[same + k]
        for p in np.flatnonzero(total.max(axis=1, initial=0) >= 1 - _EPS).tolist():
            t = int(piece[p])
            if p - first_block[t] >= pieces[t][2]:
                continue
            lo = first_word[t] + (p - first_block[t]) * STRIDE
            hi = min(first_word[t] + sizes[t], lo + self.reach * STRIDE)
            terms = np.unique(ids[lo:hi])
            found = self.retrieved(terms[terms >= 0], np.flatnonzero(total[p] >= 1 - _EPS))
            for number in found.tolist():
                item = self.items[number]
                share, question, answer = item.overlap(flat[lo:hi])
                if share >= self.similarity - 1e-9 and question >= 0.5 and answer >= 0.5:
                    yield pieces[t][0], item, share


def passage_blocks(benchmark: DataFrame, text_col: str, answer_col: str | None, similarity: float) -> int:
    """The most blocks that an item of the benchmark can touch, with as many words put in as it may lack."""
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(text_col).alias("text"), answer.alias("answer"))

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, answers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sizes = [
                len(words_of((t or "").lower())) + len(words_of((a or "").lower()))
                for t, a in zip(texts, answers, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([max(sizes, default=0)], pa.int64())], ["n"])

    most = rows.mapInArrow(longest, "n bigint").agg(F.max("n")).first()[0] or 1
    most += int((1 - similarity) * most + 1e-9)
    return (most - 1 + STRIDE - 1) // STRIDE + 1


def load_items(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> Iterator[list[Item]]:
    """Slices of the benchmark's items (refused beyond ``MAX_ITEMS``); at most one slice is held at a time."""
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), answer.alias("answer"))
    held: list[Item] = []
    size = seen = 0
    for row in rows.toLocalIterator():
        seen += 1
        if seen > MAX_ITEMS:
            raise ValueError(f"more than {MAX_ITEMS} benchmark items")
        words, reply = words_of((row["text"] or "").lower()), words_of((row["answer"] or "").lower())
        if not words and not reply:
            continue
        question = len(words) if reply or answer_col else len(words) - max(1, len(words) // 3)
        held.append(Item(row["id"], words + reply, question))
        size += len(row["text"] or "") + len(row["answer"] or "")
        if len(held) >= SLICE_ITEMS or size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _in_steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Slices of batches with the words of their texts, ``STEP_WORDS`` or one text at a time."""
    memory_of(__name__)
    for batch in batches:
        start = size = 0
        held: list[list[str]] = []
        for i, value in enumerate(batch.column(batch.schema.get_field_index(column))):
            words = words_of((value.as_py() or "").lower())
            if held and size + len(words) > STEP_WORDS:
                yield batch.slice(start, i - start), held
                start, size, held = i, 0, []
            held.append(words)
            size += len(words)
        if held:
            yield batch.slice(start, len(held)), held


class Slices:
    """The indexes of a benchmark's slices, for tasks to take one after the other.

    One slice travels with the tasks. Several are stored in the shared folder where that is mounted, or else
    broadcast one by one; a worker keeps ``LOADED`` of them.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None, similarity: float):
        spark = docs.sparkSession
        reach = passage_blocks(benchmark, text_col, answer_col, similarity)
        self.only: Index | None = None
        self.stored: list = []
        folder = urlparse(fresh_path(spark, "benchmark"))
        for items in load_items(benchmark, item_col, text_col, answer_col):
            index = Index(items, similarity, reach)
            if self.only is None and not self.stored:
                self.only = index
                continue
            for further in filter(None, (self.only, index)):
                raw = pickle.dumps(further)
                if folder.scheme in ("", "file"):
                    os.makedirs(folder.path, exist_ok=True)
                    path = f"{folder.path}/{len(self.stored):05d}"
                    with open(path, "wb") as f:
                        f.write(raw)
                    self.stored.append(path)
                else:
                    self.stored.append(spark.sparkContext.broadcast(raw))
            self.only = None

    def __iter__(self) -> Iterator[Index]:
        if self.only is not None:
            yield self.only
        held = memory_of(__name__)
        for source in self.stored:
            key = source if isinstance(source, str) else source.id
            index = next((i for k, i in held if k == key), None)
            if index is None:
                if isinstance(source, str):
                    with open(source, "rb") as f:
                        index = pickle.load(f)
                else:
                    index = pickle.loads(source.value)
                held.append((key, index))
                del held[:-LOADED]
            yield index


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    similarity: float = 0.8,
) -> DataFrame:
    """(id, item id, n_passages, similarity): which documents hold which items, and the best share of shingles.

    Texts are read once and stay put, whatever the benchmark's size; see :class:`Slices`.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType
    arrow_item = to_arrow_type(item_type)
    slices = Slices(docs, benchmark, item_col, item_text_col, answer_col, similarity)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _in_steps(batches, "text"):
            best: dict[tuple[int, object], list] = {}
            for index in slices:
                for t, item, share in index.search(texts):
                    entry = best.setdefault((t, item.id), [0, 0.0])
                    entry[0] += 1
                    entry[1] = max(entry[1], share)
            if best:
                rows = pa.array([t for t, _ in best])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        pa.array([i for _, i in best], arrow_item),
                        pa.array([n for n, _ in best.values()], pa.int64()),
                        pa.array([s for _, s in best.values()], pa.float64()),
                    ],
                    ["id", "item", "passages", "share"],
                )

    found = source.mapInArrow(tasks, f"id {id_type}, item {item_type.simpleString()}, passages bigint, share double")
    return (
        found.groupBy("id", "item")
        .agg(F.max("passages").alias("n_passages"), F.max("share").alias("similarity"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_passages", "similarity")
    )


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    similarity: float = 0.8,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are. No row is moved."""
    slices = Slices(docs, benchmark, item_col, item_text_col, answer_col, similarity)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _in_steps(batches, text_col):
            clean = np.ones(len(texts), bool)
            for index in slices:
                left = np.flatnonzero(clean)
                for t, _, _ in index.search([texts[i] for i in left]):
                    clean[left[t]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(tasks, docs.schema)
