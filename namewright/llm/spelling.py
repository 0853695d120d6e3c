"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

A word's vector counts its letters (code points modulo BINS). One replaced letter lowers at most one count by one and
raises at most one by one, one deleted letter lowers one: one edit moves the vector by an L1 distance of at most two.
Words of one length form a k-d tree. Each word searches the tree of its own length for replacements and the tree of the next shorter
length for deletions (insertions are those seen from the other word). A search enters a box only if the word's vector can
reach it with these moves, and the words of the boxes that remain are compared letter by letter.

Scale: the trees' upper parts are planned on a bounded sample of the words (at most SAMPLE, chosen by hash) and cut every
length's words into cells of about ``cell`` words; every word is filed in its cell and sent to the few cells that its search can
enter. A task builds the lower part over one cell's words at a time and streams the searching words through it, so
memory is bounded by a cell. Of two moves over planes the lowered letter must be the smaller one, so every replacement is found from
one of its two words only. Words that share all letter counts stay in one cell, whatever their number. The plan (a few numbers a cell, at most
SAMPLE / 16 cells) is all that is broadcast or reaches the driver.

Forms are followed by pointer doubling: each round joins the words that have a form with themselves, until none moves.

Defined cases: null and empty texts have no runs. In a row without id no letter is dropped. Repeated rows count again. Words with equal
n are ordered by code points. An empty table, or one without frequent words, gives no rows. Runs are taken
from whole texts of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, written

RUN = re.compile("[a-zÀ-ÿ]+")  # of texts in which A-Z are lower case
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
DROP_EVERY = 199
LEAST_LENGTH, LEAST_COUNT, LEAD = 6, 5, 5
BINS = 32
CELL, SAMPLE, LEAF = 4096, 200_000, 32
HELD, ASKED = 250_000, 20_000
INDEX, REPLACED, DELETED = 0, 1, 2


# -- words and their counts ------------------------------------------------------------------


def typed(word: str, doc: bytes | None) -> str:
    """The word as document ``doc`` has it: of one in DROP_EVERY pairs of both a letter is dropped."""
    if doc is None:
        return word
    h = zlib.crc32(word.encode(), zlib.crc32(doc + b":"))
    if h % DROP_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``least_length`` letters that occur at least ``least_count`` times in all documents."""
    held: Counter[str] = Counter()

    def flush() -> Iterator[dict]:
        out = [(w, n) for w, n in held.items() if len(w) >= least_length]
        held.clear()
        if out:
            yield {"word": [w for w, _ in out], "n": [n for _, n in out]}

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            runs = Counter(RUN.findall(text.translate(_LOWER).decode())) if text else {}
            doc = None if doc is None else doc.encode()
            for run, n in runs.items():
                held[typed(run, doc)] += n
            if len(held) > HELD:
                yield from flush()

    found = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("binary"))
    found = found.mapInArrow(by_batch(rows, [("word", pa.string()), ("n", pa.int64())], flush), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- letter counts and trees -----------------------------------------------------------------


def letters(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), BINS), np.int16)
    rows = np.arange(len(codes))
    for column in codes.T:
        out[rows, column % BINS] += 1
    return out


def _plane(counts: np.ndarray) -> tuple[int, int] | None:
    """(bin, most on the left side) near the median of the bin that spreads most; None if all vectors are equal."""
    spread = counts.var(axis=0)
    d = int(spread.argmax())
    if spread[d] == 0:
        return None
    values = np.sort(counts[:, d])
    at = int(values[len(values) // 2])
    return d, at if at < values[-1] else at - 1


@dataclass
class Plan:
    """The upper part of the tree of one length: planes, and cells as its leaves."""

    length: int
    planes: list[tuple[int, int, int, int]] = field(default_factory=list)  # bin, most on the left, left node, right node; or -1, cell
    cells: int = 0

    @classmethod
    def of(cls, length: int, counts: np.ndarray, most: int) -> Plan:
        plan = cls(length)
        plan._grow(counts, most)
        return plan

    def _grow(self, counts: np.ndarray, most: int) -> int:
        at = len(self.planes)
        self.planes.append((-1, self.cells, -1, -1))
        plane = _plane(counts) if len(counts) > most else None
        if plane is None:
            self.cells += 1
            return at
        d, t = plane
        left = counts[:, d] <= t
        self.planes[at] = (d, t, self._grow(counts[left], most), self._grow(counts[~left], most))
        return at

    def own(self, counts: np.ndarray) -> np.ndarray:
        """The cell in which each vector lies."""
        out = np.zeros(len(counts), np.int64)
        todo = [(0, np.arange(len(counts)))]
        while todo:
            node, rows = todo.pop()
            d, t, left, right = self.planes[node]
            if d < 0:
                out[rows] = t
            elif len(rows):
                below = counts[rows, d] <= t
                todo += [(left, rows[below]), (right, rows[~below])]
        return out

    def reached(self, counts: np.ndarray, raising: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, rows) of the vectors that can get into a cell by lowering one count and, if ``raising``, raising a later one."""
        n = len(counts)
        todo = [(0, np.arange(n), np.full(n, BINS), np.full(n, -1))]  # node, rows, bin raised (BINS: none yet), bin lowered (-1: none yet)
        while todo:
            node, rows, raised, lowered = todo.pop()
            if not len(rows):
                continue
            d, t, left, right = self.planes[node]
            if d < 0:
                yield t, rows
                continue
            x = counts[rows, d]
            down = (x == t + 1) & (lowered == -1) & (d < raised)
            up = (x == t) & (raised == BINS) & (lowered < d) & raising
            stay = x <= t
            go = stay | down
            todo.append((left, rows[go], raised[go], np.where(stay, lowered, d)[go]))
            go = ~stay | up
            todo.append((right, rows[go], np.where(stay, d, raised)[go], lowered[go]))


class Cell:
    """The words of one cell, searched by boxes of their letter counts."""

    def __init__(self, words: list[str], ns: list[int]):
        self.words, self.ns = np.array(words, object), np.array(ns, np.int64)
        self.codes = letters(words)
        self.counts = letter_counts(self.codes)
        self.root = self._grow(np.arange(len(words)))

    def _grow(self, rows: np.ndarray) -> tuple:
        """(lowest counts, highest counts, rows) or (lowest, highest, bin, most on the left, left, right)."""
        counts = self.counts[rows]
        box = counts.min(axis=0), counts.max(axis=0)
        plane = _plane(counts) if len(rows) > LEAF else None
        if plane is None:
            return *box, rows
        d, t = plane
        left = counts[:, d] <= t
        return *box, d, t, self._grow(rows[left]), self._grow(rows[~left])

    def search(self, codes: np.ndarray, counts: np.ndarray, raising: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking rows, rows of this cell) of the words near each other; replacements from the word with the smaller letter."""
        todo = [(self.root, np.arange(len(codes)))]
        while todo:
            node, asking = todo.pop()
            lowest, highest = node[:2]
            x = counts[asking]
            raised, lowered = np.maximum(lowest - x, 0).sum(axis=1), np.maximum(x - highest, 0).sum(axis=1)
            asking = asking[(raised <= int(raising)) & (lowered <= 1)]
            if not len(asking):
                continue
            if len(node) == 3:
                yield from self._compare(codes, asking, node[2], raising)
                continue
            _, _, d, t, left, right = node
            x = counts[asking, d]
            todo += [(left, asking[x <= t + 1]), (right, asking[x >= t] if raising else asking[x > t])]

    def _compare(self, codes: np.ndarray, asking: np.ndarray, rows: np.ndarray, raising: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        own, size = self.codes[rows], self.codes.shape[1]
        step = max(1, (1 << 21) // (len(rows) * size))
        for a in range(0, len(asking), step):
            some = asking[a : a + step]
            word = codes[some][:, None, :]
            if raising:
                other = word != own
                i, j = np.nonzero(other.sum(axis=2) == 1)
                at = other[i, j].argmax(axis=1)
                mine, theirs = codes[some[i], at].astype(np.int64), own[j, at].astype(np.int64)
                first = (mine % BINS < theirs % BINS) | (mine % BINS == theirs % BINS) & (mine < theirs)
                i, j = i[first], j[first]
            else:
                head = np.logical_and.accumulate(word[:, :, :size] == own, axis=2).sum(axis=2)
                tail = np.logical_and.accumulate((word[:, :, 1:] == own)[:, :, ::-1], axis=2).sum(axis=2)
                i, j = np.nonzero(head + tail >= size)
            if len(i):
                yield some[i], rows[j]


# -- near words ------------------------------------------------------------------------------


def _plans(words: DataFrame, cell: int, sample: int) -> dict[int, Plan]:
    """A plan per length, from at most about ``sample`` words in all, about 64 a cell."""
    sizes = {r.size: r.n for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("n")).collect()}
    share = min(1.0, 64 / cell, sample / max(1, sum(sizes.values())))
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int((1 << 30) * share)).select("word")
    by_size: dict[int, list[str]] = {size: [] for size in sizes}
    for (word,) in some.collect():
        by_size[len(word)].append(word)
    least = max(cell * share, 16 if share < 1 else 1)
    return {size: Plan.of(size, letter_counts(letters(found)) if found else np.zeros((0, BINS), np.int16), int(least)) for size, found in by_size.items()}


def near_pairs(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, near, near_n) of all words of (word, n) that are one edit apart, both ways round."""
    plans = words.sparkSession.sparkContext.broadcast(_plans(words, cell, sample))

    def route(batch: pa.RecordBatch) -> Iterator[dict]:
        by_size: dict[int, list[int]] = {}
        found = batch.column(0).to_pylist()
        for k, word in enumerate(found):
            by_size.setdefault(len(word), []).append(k)
        for size, rows in by_size.items():
            rows = np.array(rows)
            counts = letter_counts(letters([found[k] for k in rows]))
            plan, shorter = plans.value[size], plans.value.get(size - 1)
            out = [(size, plan.own(counts), rows, INDEX)]
            out += [(size, np.full(len(r), c), rows[r], REPLACED) for c, r in plan.reached(counts, True)]
            out += [(size - 1, np.full(len(r), c), rows[r], DELETED) for c, r in shorter.reached(counts, False)] if shorter else []
            for length, cells, rows_of, role in out:
                of = pa.array(rows_of)
                yield {"cell": pa.array((length << 40) + cells), "role": pa.array(np.full(len(of), role, np.int8)), "word": batch.column(0).take(of), "n": batch.column(1).take(of)}

    types = [("cell", pa.int64()), ("role", pa.int8()), ("word", pa.string()), ("n", pa.int64())]
    routed = words.select("word", "n").mapInArrow(by_batch(route, types), "cell long, role byte, word string, n long")
    routed = routed.repartition("cell").sortWithinPartitions("cell", "role")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, cell = None, ([], []), None  # cell number, words and counts of its index so far, the built index
        for batch in batches:
            cells, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(roles) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cells)], strict=True):
                if a == b:
                    continue
                if cells[a] != here:
                    here, held, cell = cells[a], ([], []), None
                found, ns = batch.column(2).slice(a, b - a).to_pylist(), batch.column(3).slice(a, b - a).to_pylist()
                if roles[a] == INDEX:
                    held[0].extend(found)
                    held[1].extend(ns)
                    continue
                if not held[0]:
                    continue
                cell = cell or Cell(*held)
                for k in range(0, len(found), ASKED):
                    asking, own = found[k : k + ASKED], np.array(ns[k : k + ASKED], np.int64)
                    codes = letters(asking)
                    pairs = list(cell.search(codes, letter_counts(codes), bool(roles[a] == REPLACED)))
                    if pairs:
                        i, j = (np.concatenate(p) for p in zip(*pairs, strict=True))
                        word = np.array(asking, object)[i]
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([word, cell.words[j]])), pa.array(np.concatenate([cell.words[j], word])), pa.array(np.concatenate([cell.ns[j], own[i]]))], names=["word", "near", "near_n"])

    return routed.mapInArrow(search, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to their last, by doubling the steps until none moves."""
    steps = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        steps = moved.select("word", "root")


def variants(words: DataFrame, lead: int = LEAD, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of (word, n).

    ``form`` is the near word of largest n (the smallest of equals), if that is at least ``lead`` times the word's own n."""
    words = written(words.select("word", "n"), "words")
    best = near_pairs(words, cell, sample).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best"))
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n"))
    leads = F.col("near_n") >= F.col("n") * lead
    found = written(found.select("word", F.when(leads, F.col("near")).alias("form"), "n", "n_near", F.when(leads, F.col("near_n")).alias("form_n")), "near")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
