"""Benchmark decontamination by Wu-Manber multi-pattern search over word sequences.

The patterns are all windows of ``width`` consecutive words of the benchmark items. Patterns
of one length share a SHIFT table over blocks of two words: a block that ends no pattern
prefix moves the search on by up to ``width - 1`` words, so most positions are never looked
at. A block with shift 0 selects the patterns that end in it (suffix bucket), the first word
of the window narrows them, and a direct comparison of all words confirms an occurrence.

Scale: documents are read once, row by row, without a shuffle; a task holds one Arrow batch
and one pattern block, whose windows are places in one list of words. The benchmark reaches the tasks in blocks of at most ``block_bytes`` of
text, each a broadcast of proven size; the driver holds one block while it is built. More
benchmark text means more blocks searched one after another, with the same result.

Defined cases: null or word-free text has no words and no hits. Rows are judged one by one, so
repeated documents repeat their result. Repeated items count once by id. An item without
words has no window. An item whose id is null marks words as hit but has no id to list.
An empty benchmark hits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import SLICE_BYTES, by_batch, carried, whole_row

WIDTH = 10
#: Benchmark text per block; its tables take some hundred bytes a word.
BLOCK_BYTES = 4 << 20
#: With several blocks, so many bytes of documents meet one block before the next one's tables are made.
HELD_BYTES = 64 << 20

# A-Z become lower case; every byte that is no digit, letter or part of a non-ASCII character becomes a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WordPatterns:
    """Wu-Manber tables of one pattern length (in words); a pattern is the place where it begins in the list of the items' words."""

    def __init__(self, length: int, text: list[bytes], patterns: dict[tuple[bytes, ...], int]):
        self.length, self.block, self.text = length, min(2, length), text
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list[int]]] = {}
        for pattern, at in patterns.items():
            for k in range(self.far):
                block = pattern[k : k + self.block]
                self.shift[block] = min(self.shift.get(block, self.far), length - self.block - k)
            self.buckets.setdefault(pattern[length - self.block :], {}).setdefault(pattern[0], []).append(at)

    def search(self, seq: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(start, end, place of the pattern) of every occurrence, by end."""
        n, m, far, shift, single, text = len(seq), self.length, self.far, self.shift.get, self.block == 1, self.text
        last = m - 1
        while last < n:
            block = (seq[last],) if single else (seq[last - 1], seq[last])
            step = shift(block, far)
            if step:
                last += step
                continue
            first = last - m + 1
            for at in self.buckets[block].get(seq[first], ()):
                if seq[first : last + 1] == text[at : at + m]:
                    yield first, last + 1, at
            last += 1


class ItemMatcher:
    """All window lengths of one block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int):
        known: dict[bytes, bytes] = {}  # equal words once
        text: list[bytes] = []
        by_length: dict[int, dict[tuple[bytes, ...], int]] = {}
        self.owners: dict[int, str | None | set] = {}  # of the window at a place: its item, or a set of several
        for item, body in items:
            seq = [known.setdefault(w, w) for w in words(body)]
            size, base = min(width, len(seq)), len(text)
            text += seq
            for k in range(len(seq) - size + 1 if size else 0):
                at = by_length.setdefault(size, {}).setdefault(tuple(seq[k : k + size]), base + k)
                had = self.owners.setdefault(at, item)
                if isinstance(had, set):
                    had.add(item)
                elif had != item:
                    self.owners[at] = {had, item}
        self.tables = [WordPatterns(n, text, p) for n, p in sorted(by_length.items())]

    def search(self, seq: list[bytes]) -> Iterator[tuple[int, int, set]]:
        for table in self.tables:
            for first, last, at in table.search(seq):
                own = self.owners[at]
                yield first, last, own if isinstance(own, set) else {own}


def item_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[Broadcast]:
    """The items with text, in broadcasts of at most ``block_bytes`` of text (one item at least)."""
    sc, out, block, size = benchmark.sparkSession.sparkContext, [], [], 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(text).cast("binary")).where(F.col(text).isNotNull()).distinct()
    for item_id, body in rows.toLocalIterator():
        if block and size + len(body) > block_bytes:
            out.append(sc.broadcast((uuid.uuid4().hex, block)))
            block, size = [], 0
        block.append((item_id, bytes(body)))
        size += len(body)
    return [*out, sc.broadcast((uuid.uuid4().hex, block))] if block else out


_BUILT: dict[tuple[str, int], ItemMatcher] = {}


def _matcher(block: Broadcast, width: int) -> ItemMatcher:
    """The tables of a block; a worker keeps those of one block only."""
    key, items = block.value
    if (key, width) not in _BUILT:
        _BUILT.clear()
        _BUILT[key, width] = ItemMatcher(items, width)
    return _BUILT[key, width]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str | Column],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, n_words, n_hit, hit_spans (word
    positions [start, end), merged) and item_ids (string, sorted) of items with an occurrence."""
    blocks = item_blocks(benchmark, item, item_text, block_bytes)
    ddl = "n_words long, n_hit long, hit_spans array<struct<start:long,end:long>>, item_ids array<string>"
    arrow, schema = carried(docs, keep, ddl)

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        n_words, spans, ids = [0] * len(texts), [[] for _ in texts], [set() for _ in texts]
        for block in blocks or [None]:
            matcher = _matcher(block, width) if block else None
            for i, t in enumerate(texts):
                seq = words(t)
                n_words[i] = len(seq)
                for a, b, owners in matcher.search(seq) if matcher else ():
                    spans[i].append((a, b))
                    ids[i] |= owners
        merged = [_merged(s) for s in spans]
        yield {f: batch.column(k) for k, (f, _) in enumerate(arrow)} | {
            "n_words": n_words,
            "n_hit": [sum(b - a for a, b in s) for s in merged],
            "hit_spans": [[{"start": a, "end": b} for a, b in s] for s in merged],
            "item_ids": [sorted(x for x in s if x is not None) for s in ids],
        }

    out = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("hit_spans", _SPANS), ("item_ids", pa.list_(pa.string()))]
    held = HELD_BYTES if len(blocks) > 1 else SLICE_BYTES
    return docs.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(by_batch(rows, arrow + out, slice_bytes=held), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark window occurs."""
    cols = docs.columns
    found = find_items(docs, benchmark, [whole_row(docs)], **options)
    return found.where("n_hit = 0").select(*[F.col("row").getField(c).alias(c) for c in cols])
