"""Removal of byte strings that occur more than once, by Burrows-Wheeler interval expansion.

Every window of ``size`` bytes is filed under its minimizer: the smallest hash of the k-grams in it, the
rightmost of equal ones. Equal windows have equal minimizers, so they meet wherever they stand. Consecutive windows with one
minimizer form a segment. Segments whose minimizer occurs once in the corpus hold no repeated window
and are left behind; equal segments are folded into one with a count. What remains of a
minimizer's different segments goes to one block, and in each block the Burrows-Wheeler transform of the segments
yields common prefix lengths in increasing order: breadth-first backward extension from the boundaries of
prefix length 0 finds those of length 1, 2, ... and stops at ``size - 1``. The suffixes between
the boundaries that are left share ``size`` bytes; a window is repeated if its interval's
segments occur at least twice in all.

Scale: pass one counts minimizers (summed per Arrow batch), pass two joins the segments of repeated
ones; both rows are a few dozen bytes per some 80 bytes of text. Everything after works on the repeated part only. Copies of a
text share one key (128-bit hashes of text and segment), so a group of copies is one row after partial aggregation. A
minimizer with more than ``most`` different segments (a passage that very many texts continue
differently) is split exactly: its segments are cut into runs of 16 windows filed under the bytes that all 16
have in common, and runs that are still too many into single windows. Blocks hold about ``block_bytes``; a task holds one.

Defined cases: null text is empty. Texts under ``size`` bytes lose nothing. Rows are judged one by one: repeated
rows are copies of each other, whatever their ids, and lose everything from ``size`` bytes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, carried, written
from namewright.llm.hashing import window_minima

SIZE, GRAM = 200, 40
MOST, BLOCK_BYTES = 8192, 1 << 18
CHUNKS = (16, 1)


class Segments:
    """The segments of a text: first window, number of windows, anchor (position of the minimizer), key (its hash)."""

    def __init__(self, data: bytes, size: int, gram: int):
        self.data, self.size = data, size
        first, anchor, key = [], [], []
        if len(data) >= size:
            values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
            for at, best, h in window_minima(values, gram, size - gram + 1):
                new = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
                first.append(at + new)
                anchor.append(at + best[new])
                key.append(h[best[new]])
        self.first = np.concatenate(first) if first else np.empty(0, np.int64)
        self.anchor = np.concatenate(anchor) if anchor else self.first
        self.key = np.concatenate(key).view(np.int64) if key else self.first
        self.count = np.diff(np.append(self.first, len(data) - size + 1)) if first else self.first

    def content(self, i: int) -> bytes:
        return self.data[self.first[i] : self.first[i] + self.count[i] - 1 + self.size]

    def ids(self) -> np.ndarray:
        """128-bit hashes of the contents, as pairs of signed 64-bit numbers."""
        data, stop = self.data, (self.first + self.count - 1 + self.size).tolist()
        digest = xxhash.xxh3_128_digest
        return np.frombuffer(b"".join([digest(data[a:b]) for a, b in zip(self.first.tolist(), stop, strict=True)]), np.int64).reshape(-1, 2)


def suffix_order(symbols: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Rank of every suffix of the segments, each of which ends in symbol 0; equal suffixes rank by segment. Prefix doubling from packed 7-grams."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(7):
        key = (key << 9) | np.where(alive, padded[k : n + k], 0)
        alive &= padded[k : n + k] != 0
    order = np.lexsort((np.where(alive, 0, segment), key))
    same = (key[order[1:]] == key[order[:-1]]) & (alive[order[1:]] | (segment[order[1:]] == segment[order[:-1]]))
    rank = np.empty(n, np.int64)  # the place of the first of those that are equal so far
    rank[order] = _first_of_run(np.concatenate([[True], ~same]))
    open_ = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    width = 7
    while len(open_):
        key = rank[open_] * n + rank[np.minimum(open_ + width, n - 1)]  # suffixes that end before have a rank of their own already
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        group = rank[open_]
        place = group + np.arange(len(by)) - _first_of_run(np.concatenate([[True], group[1:] != group[:-1]]))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[open_] = place[_first_of_run(new)]
        open_ = open_[~(new & np.append(new[1:], True))]
        width *= 2
    return rank


def _first_of_run(new: np.ndarray) -> np.ndarray:
    """The index at which each element's run begins; ``new`` marks the beginnings."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def repeated_windows(contents: list[bytes], counts: list[int], size: int) -> list[np.ndarray]:
    """For each content (all different) a mask of its windows that occur at least twice, a content counting ``counts`` times."""
    lengths = np.array([len(c) for c in contents])
    symbols = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.uint16) + 1
    stops = np.cumsum(lengths + 1) - 1
    symbols[stops] = 0
    n = len(symbols)
    segment = np.repeat(np.arange(len(contents)), lengths + 1)
    rank = suffix_order(symbols, segment).astype(np.int32)
    order = np.empty(n, np.int32)
    order[rank] = np.arange(n, dtype=np.int32)
    before = order - 1  # of position 0 the last one: a separator, which is never extended by
    transform, back = symbols[before], rank[before]  # the transform and its last-to-first mapping
    earlier = np.full(n, -1, np.int32)  # the same symbol's place before in the transform
    by_symbol = np.argsort(transform, kind="stable")
    same = (transform[by_symbol[1:]] == transform[by_symbol[:-1]]) & (transform[by_symbol[1:]] != 0)
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    head = symbols[order]
    prefix = np.full(n, -1, np.int16)  # common prefix length with the suffix ranked before, once known
    prefix[0] = 0
    prefix[1:][(head[1:] != head[:-1]) | (head[1:] == 0)] = 0
    frontier = np.flatnonzero(prefix == 0)
    for length in range(1, size):
        if not len(frontier):
            break
        # A frontier's stretch ends at the next known boundary. Newer boundaries only shorten stretches, so
        # they are gathered now and then, and whenever the stretches would overlap much.
        if length < 16 or length % 8 == 0:
            known = np.append(np.flatnonzero(prefix >= 0), n)
        widths = known[np.searchsorted(known, frontier, "right")] - frontier
        if widths.sum() > n // 4:
            known = np.append(np.flatnonzero(prefix >= 0), n)
            widths = known[np.searchsorted(known, frontier, "right")] - frontier
        ends = np.cumsum(widths)
        at = np.arange(ends[-1]) + np.repeat(frontier - (ends - widths), widths)
        low = earlier[at]
        at = at[(low >= 0) & (low < np.repeat(frontier, widths))]
        target = back[at]
        target = target[prefix[target] < 0]
        prefix[target] = length
        frontier = np.unique(target)
    interval = np.cumsum(prefix >= 0) - 1
    times = np.bincount(interval, weights=np.asarray(counts, float)[segment[order]])
    repeated = np.empty(n, bool)
    repeated[order] = times[interval] >= 2
    starts = stops - lengths
    return [repeated[a : a + m - size + 1] for a, m in zip(starts.tolist(), lengths.tolist(), strict=True)]


def runs_of(mask: np.ndarray) -> np.ndarray:
    """First and stop of the runs of True, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))


def _keys(text: str) -> list[Column]:
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return [F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2"), body.alias("body")]


_ID = ["s1", "s2"]
_RUNS = "s1 long, s2 long, runs array<long>"


def _block_runs(segments: DataFrame, size: int, block_bytes: int) -> DataFrame:
    """s1, s2, runs of repeated windows; segments: key, s1, s2, n, content, whole groups of a key in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        held, last = 0, None

        def done() -> pa.RecordBatch:
            masks = repeated_windows([x[4] for x in block], [x[3] for x in block], size)
            return pa.RecordBatch.from_pydict(
                {"s1": pa.array([x[1] for x in block], pa.int64()), "s2": pa.array([x[2] for x in block], pa.int64()), "runs": pa.array([runs_of(m).tolist() for m in masks], pa.list_(pa.int64()))}
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held > block_bytes and row[0] != last:
                    yield done()
                    block, held = [], 0
                block.append(row)
                held, last = held + len(row[4]), row[0]
        if block:
            yield done()

    tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return segments.select("key", *_ID, "n", "content").repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, _RUNS)


def _cut(segments: DataFrame, size: int, chunk: int) -> DataFrame:
    """The segments in runs of up to ``chunk`` windows with the same place of the anchor by whole chunks: parent p1, p2, offset at, and a segment's own columns."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {name: [] for name, _ in types}
        for p1, p2, n, anchor, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            windows = len(content) - size + 1
            at = 0
            while at < windows:
                low = anchor - at - (anchor - at) % chunk  # the chunk's smallest distance of the anchor from a window's start
                stop = min(windows, anchor - low + 1)
                part = content[at : stop - 1 + size]
                shared = content[anchor - low : anchor - low - chunk + 1 + size]  # in all windows of a whole chunk
                s1, s2 = np.frombuffer(xxhash.xxh3_128_digest(part), np.int64).tolist()
                key = xxhash.xxh3_64_intdigest(shared, low) - (1 << 63)
                for name, value in zip(out, (p1, p2, at, key, s1, s2, n, anchor - at, part), strict=True):
                    out[name].append(value)
                at = stop
        yield out

    longs = [(k, pa.int64()) for k in ("p1", "p2", "at", "key", *_ID, "n", "anchor")]
    types = [*longs, ("content", pa.binary())]
    return segments.select(*_ID, "n", "anchor", "content").mapInArrow(by_batch(rows, types), ", ".join(f"{k} long" for k, _ in longs) + ", content binary")


def _expand(segments: DataFrame, size: int, most: int, block_bytes: int, chunks: tuple[int, ...] = CHUNKS) -> DataFrame:
    """s1, s2, runs of all segments (key, s1, s2, n, anchor, content; all different)."""
    groups = segments.groupBy("key").agg(F.count("*").alias("different")).where(F.col("different") > most)
    crowded = written(groups.select("key"), "crowded") if chunks else None
    if crowded is None or crowded.isEmpty():
        return _block_runs(segments, size, block_bytes)
    plain = _block_runs(segments.join(crowded, "key", "left_anti"), size, block_bytes)
    cut = written(_cut(segments.join(crowded, "key"), size, chunks[0]), "cut")
    parts = cut.groupBy("key", *_ID).agg(F.sum("n").alias("n"), F.first("anchor").alias("anchor"), F.first("content").alias("content"))
    found = _expand(written(parts, "parts"), size, most, block_bytes, chunks[1:])
    back = cut.select("p1", "p2", "at", *_ID).join(found, _ID).select(F.col("p1").alias("s1"), F.col("p2").alias("s2"), F.transform("runs", lambda x: x + F.col("at")).alias("runs"))
    # Runs of neighbouring parts may touch; they are only ever used as sets of windows.
    return plain.unionByName(back.groupBy(*_ID).agg(F.flatten(F.collect_list("runs")).alias("runs")))


def repeated_segments(docs: DataFrame, text: str, size: int, gram: int, most: int, block_bytes: int) -> DataFrame:
    """t1, t2 (text key) and found: s1, s2, runs of the text's segments with repeated windows."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        keys, n = np.unique(np.concatenate([Segments(t, size, gram).key for t in batch.column(0).to_pylist()]), return_counts=True)
        yield {"key": pa.array(keys), "n": pa.array(n)}

    def occur(batch: pa.RecordBatch) -> Iterator[dict]:
        parts = []
        for t1, t2, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = Segments(body, size, gram)
            if len(found.first):
                ids = found.ids()
                _, at, n = np.unique(ids[:, 0], return_index=True, return_counts=True)
                parts.append(np.column_stack([found.key[at], ids[at], np.full(len(at), t1), np.full(len(at), t2), found.count[at], n]))
        if parts:
            yield dict(zip(names, map(pa.array, np.concatenate(parts).T.copy()), strict=True))

    def fetch(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {name: [] for name, _ in content_types}
        for body, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            asked = {(w["s1"], w["s2"]): w["n"] for w in wanted}
            found = Segments(body, size, gram)
            for i, (s1, s2) in enumerate(found.ids().tolist()):
                if (n := asked.pop((s1, s2), None)) is not None:
                    for name, value in zip(out, (int(found.key[i]), s1, s2, n, int(found.anchor[i] - found.first[i]), found.content(i)), strict=True):
                        out[name].append(value)
        yield out

    names = ["key", *_ID, "t1", "t2", "windows", "n"]
    longs = ", ".join(f"{k} long" for k in names)
    content_types = [*((k, pa.int64()) for k in ("key", *_ID, "n", "anchor")), ("content", pa.binary())]
    keyed = docs.select(*_keys(text)).where(F.octet_length("body") >= size)
    counted = keyed.select("body").mapInArrow(by_batch(count, [("key", pa.int64()), ("n", pa.int64())]), "key long, n long")
    repeated = written(counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "repeated")
    every = keyed.mapInArrow(by_batch(occur, [(k, pa.int64()) for k in names]), longs)
    occurring = written(every.join(repeated, "key", "left_semi").groupBy(*names[:-1]).agg(F.sum("n").alias("n")), "occurring")

    segments = occurring.groupBy("key", *_ID).agg(F.sum("n").alias("n"), F.max("windows").alias("windows"), F.min(F.struct("t1", "t2")).alias("one"))
    segments = written(segments, "segments")
    lone = written(segments.groupBy("key").agg(F.count("*").alias("different")), "lone")
    sized = segments.join(lone, "key")
    # All occurrences of a minimizer in equal segments: nothing else to compare with.
    whole = sized.where("different = 1 and n > 1").select(*_ID, F.array(F.lit(0).cast("long"), "windows").alias("runs"))
    asked = sized.where("different > 1").groupBy("one").agg(F.collect_list(F.struct(*_ID, "n")).alias("wanted")).select("one.t1", "one.t2", "wanted")
    # Of equal texts one is enough; most copies go within the tasks that read them.
    texts = keyed.dropDuplicates(["t1", "t2"]).join(asked, ["t1", "t2"])
    contents = written(texts.select("body", "wanted").mapInArrow(by_batch(fetch, content_types), "key long, s1 long, s2 long, n long, anchor long, content binary"), "contents")
    found = written(whole.unionByName(_expand(contents, size, most, block_bytes)).where(F.size("runs") > 0), "runs")
    return written(occurring.select("t1", "t2", *_ID).join(found, _ID).groupBy("t1", "t2").agg(F.collect_list(F.struct(*_ID, "runs")).alias("found")), "found")


def without_windows(body: bytes, found: list[dict] | None, size: int, gram: int) -> tuple[bytes, list[tuple[int, int]]]:
    """(what is left of a text, its removed byte ranges)."""
    if not found:
        return body, []
    runs = {(x["s1"], x["s2"]): x["runs"] for x in found}
    segments = Segments(body, size, gram)
    edges = np.zeros(len(body) + 1, np.int64)
    for first, (s1, s2) in zip(segments.first.tolist(), segments.ids().tolist(), strict=True):
        for a, b in zip(*[iter(runs.get((s1, s2), ()))] * 2, strict=True):
            edges[first + a] += 1
            edges[first + b - 1 + size] -= 1
    bounds = runs_of(np.cumsum(edges[:-1]) > 0).tolist()
    ranges = list(zip(bounds[::2], bounds[1::2], strict=True))
    keep = [0, *bounds, len(body)]
    return b"".join(body[a:b] for a, b in zip(keep[::2], keep[1::2], strict=True)), ranges


def remove_repeats(docs: DataFrame, keep: list[str | Column], text: str = "text", size: int = SIZE, gram: int = GRAM, most: int = MOST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns of every row with kept (binary), n_bytes, and removed: ranges [start, stop) of bytes."""
    found = repeated_segments(docs, text, size, gram, most, block_bytes)
    arrow, schema = carried(docs, keep, "kept binary, n_bytes long, removed array<struct<start:long,stop:long>>")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        k = batch.num_columns
        bodies = batch.column(k - 2).to_pylist()
        out = [without_windows(b, f, size, gram) for b, f in zip(bodies, batch.column(k - 1).to_pylist(), strict=True)]
        yield {f: batch.column(i) for i, (f, _) in enumerate(arrow)} | {
            "kept": [x[0] for x in out],
            "n_bytes": [len(b) for b in bodies],
            "removed": [[{"start": a, "stop": b} for a, b in x[1]] for x in out],
        }

    types = [*arrow, ("kept", pa.binary()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
    whole = docs.select(F.struct(*keep).alias("row"), *_keys(text))
    met = whole.join(found, ["t1", "t2"], "left").select(*[F.col("row").getField(name).alias(name) for name, _ in arrow], F.col("body").alias("__body"), F.col("found").alias("__found"))
    return met.mapInArrow(by_batch(rows, types), schema)


def digest(removed: DataFrame) -> DataFrame:
    """Counts and the hash of what is left, in place of the texts and ranges."""
    spans = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["stop"] - r["start"])
    return removed.withColumns({"n_removed": spans, "n_spans": F.size("removed").cast("long"), "kept_sha256": F.sha2("kept", 256)}).drop("removed", "kept")
