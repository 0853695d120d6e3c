"""Near-duplicate components by circulant MinHash, banding and exact Jaccard verification.

A document's set holds the hashes of its distinct shingles of ``width`` words. Two permutations make
all signature coordinates: sigma (a bijective mix) sends a shingle to one of ``SLOTS`` slots, and
coordinate k is the minimum of pi over the slots shifted circularly by k. As the shifted values
of one slot are neighbours in pi, a shingle's coordinates are read as one stretch of it.
``bands`` bands of ``rows`` coordinates make the bucket keys: a pair at exactly the threshold 0.75
shares none with probability (1 - 0.75**4)**34 = 2.4e-6. Candidates are confirmed on the full word
sets, so no pair is linked wrongly.

Scale: texts stay where they are read; what is shuffled first is one row per band of each *different* text (exact
copies are joined by a partially aggregated text hash). No bucket is collected and no group
is expanded into its pairs: in round one every member of a bucket meets only the bucket's smallest and
largest id, the same few leaders in all buckets of a group, and links are turned into components.
In round two members of one bucket that are still in different components are compared inside their task, in
blocks of at most ``BLOCK`` members, by parity sketches: the bits in which two sketches differ never outnumber the shingles in
which the sets differ, so a pair beyond the threshold's bound is no link for certain, and only the few others
become rows and are confirmed. No link is lost. Only texts that share a bucket are shuffled.
Components come from repeated minimum labels with pointer jumping over written tables.

Defined cases: null, empty or word-free text has an empty set (size 0), is linked with nothing and is its
own component. With fewer than ``width`` words the whole sequence is the only shingle. Rows that share a doc_id
are one document: a link of either text links both. Rows without doc_id are linked with nothing, have a null component
and are kept; ``dedup`` keeps one of the rows that share doc_id (or have none) and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, written
from namewright.llm.hashing import LOWER, WHITE, Words, chunks, mix, run_hashes

WIDTH, THRESHOLD = 5, Fraction(3, 4)
BANDS, ROWS = 34, 4
SLOTS = 1 << 22
_ROWS = 2048
#: Members of a bucket that one task compares with as many others.
BLOCK = 512
EDGES_A_TASK = 20_000


@lru_cache(1)
def _pi(coordinates: int) -> np.ndarray:
    """Row s is pi[s], pi[s + 1], ... around the circle: the coordinates of a shingle in slot s."""
    pi = np.random.default_rng(20240229).permutation(SLOTS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:coordinates]]), coordinates)


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    for a, b in chunks(texts):
        w = Words(texts[a:b], WHITE, LOWER)
        size = np.diff(w.first)
        first = np.arange(len(w.start))
        left = w.first[w.doc + 1] - first  # words from here to the text's end
        first = first[(left >= width) | (first == w.first[w.doc])]
        stop = np.minimum(first + width, w.first[w.doc[first] + 1])
        h, doc = run_hashes(w.h, first, stop, 1), w.doc[first]
        at = np.searchsorted(doc, np.arange(len(size) + 1))
        for i in range(len(size)):
            yield np.unique(h[at[i] : at[i + 1]])


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    rows = _pi(coordinates)
    slots = (mix(shingles) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
    out = rows[slots[:_ROWS]].min(axis=0)
    for at in range(_ROWS, len(slots), _ROWS):
        np.minimum(out, rows[slots[at : at + _ROWS]].min(axis=0), out=out)
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, body (128-bit text hash), n (set size), keys (one per band; empty without shingles)."""

    def of(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(1).to_pylist()
        sizes, sig, some = [], [], []
        for s in shingle_sets(texts, width):
            sizes.append(len(s))
            some.append(len(s) > 0)
            if len(s):
                sig.append(signature(s, bands * rows))
        counts = np.where(some, bands, 0)
        keys = np.empty(0, np.uint64)
        if sig:
            parts = np.stack(sig).reshape(len(sig), bands, rows).astype(np.uint64)
            keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
            for r in range(rows):
                keys = mix(keys ^ parts[:, :, r]) + np.uint64(r)
            keys = keys.ravel()
        offsets = pa.array(np.concatenate([[0], counts.cumsum()]).astype(np.int32))
        yield {
            "doc_id": batch.column(0),
            "body": [xxhash.xxh3_128_digest(t or b"") for t in texts],
            "n": sizes,
            "keys": pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))),
        }

    types = [("doc_id", pa.int64()), ("body", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64()))]
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(by_batch(of, types), "doc_id long, body binary, n long, keys array<long>")


def word_shingles(text: bytes, width: int = WIDTH) -> frozenset:
    seq = text.translate(LOWER).split()
    if len(seq) < width:
        return frozenset([tuple(seq)] if seq else ())
    return frozenset(zip(*(seq[k:] for k in range(width)), strict=False))


def linked(pairs: DataFrame, texts: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose word sets have a Jaccard similarity of at least ``threshold``."""
    up, down = threshold.numerator, threshold.denominator

    def confirm(batch: pa.RecordBatch) -> Iterator[dict]:
        a, ta, b, tb = (batch.column(k).to_pylist() for k in range(4))
        seen, other, good = None, frozenset(), []
        for x, y, key in zip(ta, tb, b, strict=True):
            if seen is not y and (seen is None or seen != y):
                seen, other = y, word_shingles(y, width)
            mine = word_shingles(x, width)
            shared = len(mine & other)
            good.append(down * shared >= up * (len(mine) + len(other) - shared))
        yield {"a": [x for x, g in zip(a, good, strict=True) if g], "b": [x for x, g in zip(b, good, strict=True) if g]}

    met = pairs.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    met = met.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
    return met.select("a", "ta", "b", "tb").mapInArrow(by_batch(confirm, [("a", pa.int64()), ("b", pa.int64())]), "a long, b long")


def parity_sketch(shingles: np.ndarray) -> bytes:
    """A bit for each of 8 to 16 times as many cells as there are shingles (a power of two): whether an odd number falls into it."""
    cells = 1 << (8 * max(8, len(shingles)) - 1).bit_length()
    odd = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketches(texts: DataFrame, width: int) -> DataFrame:
    def of(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"node": batch.column(0), "sketch": [parity_sketch(s) for s in shingle_sets(batch.column(1).to_pylist(), width)]}

    return texts.select("node", "t").mapInArrow(by_batch(of, [("node", pa.int64()), ("sketch", pa.binary())]), "node long, sketch binary")


class _Members:
    """Members of a bucket with sketches of one length."""

    def __init__(self, rows: list[tuple]):
        self.node, self.n, self.label = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        self.bits = np.stack([np.frombuffer(r[3], np.uint64) for r in rows])

    def folded(self, words: int) -> np.ndarray:
        """The sketches over fewer cells."""
        return np.bitwise_xor.reduce(self.bits.reshape(len(self.bits), -1, words), axis=1)


def _close(a: _Members, b: _Members, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the pairs (one of a, one of b) with different labels that may be similar enough."""
    words = min(a.bits.shape[1], b.bits.shape[1])
    one, other = a.folded(words), b.folded(words)
    x, y = [], []
    for i in range(len(one)):
        total = a.n[i] + b.n
        j = np.flatnonzero((b.label != a.label[i]) & (down * a.n[i] >= up * b.n) & (down * b.n >= up * a.n[i]))
        if len(j):
            # similarity >= up / down means: (down + up) * difference <= (down - up) * total
            apart = np.bitwise_count(other[j] ^ one[i]).sum(axis=1, dtype=np.int64)
            j = j[(down + up) * apart <= (down - up) * total[j]]
            x.append(np.full(len(j), a.node[i]))
            y.append(b.node[j])
    return (np.concatenate(x), np.concatenate(y)) if x else (np.empty(0, np.int64), np.empty(0, np.int64))


def close_pairs(members: DataFrame, sketched: DataFrame, threshold: Fraction) -> DataFrame:
    """(a, b), a > b: members of one bucket (key, node, n, label) with different labels whose sketches leave a link possible.

    A bucket's members are dealt into blocks, and a task compares two of them. A label of BLOCK members or more has blocks of its own,
    smaller ones share some; blocks of one label never meet, so that a large component costs its members once per block of the others."""
    up, down = threshold.numerator, threshold.denominator
    labels = members.groupBy("key", "label").agg(F.count("*").alias("size"))
    large = F.col("size") >= BLOCK
    own = F.when(large, F.ceil(F.col("size") / BLOCK)).otherwise(0)
    bucket = Window.partitionBy("key")
    shared = F.ceil(F.sum(F.when(large, 0).otherwise(F.col("size"))).over(bucket) / BLOCK)
    before = F.coalesce(F.sum(own).over(bucket.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = labels.select("key", "label", large.alias("large"), F.when(large, shared + before).otherwise(0).cast("int").alias("first"),
                           F.when(large, own).otherwise(shared).cast("int").alias("blocks"), (shared + F.sum(own).over(bucket)).cast("int").alias("total"))
    places = written(places, "places")
    dealt = members.join(places, ["key", "label"]).withColumn("own", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int"))
    elsewhere = F.filter(F.sequence(F.lit(0), F.col("total") - 1), lambda k: ~(F.col("large") & (k >= F.col("first")) & (k < F.col("first") + F.col("blocks"))))
    dealt = dealt.withColumn("elsewhere", elsewhere).join(sketched, "node").withColumn("other", F.explode("elsewhere"))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "label", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def pairs() -> tuple[np.ndarray, np.ndarray]:
            sides = []
            for own in (at[1], at[2]):
                by_length: dict[int, list] = {}
                for r in group:
                    if r[0] == own:
                        by_length.setdefault(len(r[4]), []).append(r[1:])
                sides.append([_Members(rows) for rows in by_length.values()])
            found = [_close(a, b, up, down) for a in sides[0] for b in sides[1]]
            x, y = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in (0, 1))
            return np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)]), axis=1)

        def out() -> pa.RecordBatch:
            x, y = pairs()
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

        for batch in batches:
            key, i, j, *rest = (c.to_pylist() for c in batch.columns)
            for where, row in zip(zip(key, i, j, strict=True), zip(*rest, strict=True), strict=True):
                if where != at:
                    if group:
                        yield out()
                    at, group = where, []
                group.append(row)
        if group:
            yield out()

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (a, b) as edges (node, smallest node that they connect it with)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([parent[x] for x in nodes], pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of every node that has an edge.

    Each task first contracts its own edges, which shortens all paths; then labels are lowered to the
    neighbours' and to the label's own label until nothing changes. Tasks hold about EDGES_A_TASK edges."""
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(most, -(-edges.count() // EDGES_A_TASK)))
    short = edges.select("a", "b").coalesce(tasks).mapInArrow(_contracted, "a long, b long")
    both = written(short.unionByName(short.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().coalesce(tasks), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")).coalesce(tasks), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("lowest"))
        step = lower.join(jump, "low", "left").select("node", F.col("label").alias("old"), F.least("low", "lowest").alias("label"))
        step = written(step.coalesce(tasks), "labels")
        labels = step.select("node", "label")
        if step.where("old != label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: Fraction = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    found = written(signatures(docs, doc_id, text, width, bands, rows), "signatures")
    named = found.where("doc_id is not null and n > 0")
    nodes = written(named.groupBy("body").agg(F.min("doc_id").alias("node")), "nodes")
    banded = named.groupBy("body").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys")).select(F.explode("keys").alias("key"), "node", "n")
    shared = written(banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high"), "shared")
    buckets = written(banded.join(shared, "key"), "buckets")
    members = written(buckets.select("node").distinct(), "members")
    texts = written(docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).cast("binary").alias("t")).join(members, "node", "left_semi").distinct(), "texts")

    # Several texts of one doc_id belong together, whatever they hold.
    by_text = found.join(nodes, "body", "left")
    own = by_text.where("doc_id is not null and n > 0").select("doc_id", "node").distinct()
    lowest = written(own.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top").select("doc_id", "b"), "lowest")
    several = written(own.join(lowest, "doc_id").where("node != b").select(F.col("node").alias("a"), "b").distinct(), "several")

    first = buckets.select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a != b")
    first = written(first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    links = written(linked(first, texts, width, threshold), "links").unionByName(several)
    labels = components(links)

    # Round two: members of one bucket that are in different components.
    now = buckets.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = written(now.groupBy("key").agg(F.min("label").alias("one"), F.max("label").alias("two")).where("one < two").select("key"), "mixed")
    now = written(now.join(mixed, "key"), "mixed-members")
    rest = written(close_pairs(now, sketches(texts, width), threshold).distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    more = written(linked(rest, texts, width, threshold), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    named_rows = by_text.join(labels, "node", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("label", "node")).otherwise(F.col("doc_id"))
    return named_rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their component; of rows with one doc_id (or none) and one text, one."""
    found = near_duplicates(docs, doc_id, text, **options)
    dropped = written(found.where("not kept").select(F.col("doc_id").alias("__dropped")).distinct(), "dropped")
    kept = docs.join(dropped, F.col(doc_id).cast("long") == F.col("__dropped"), "left_anti")
    names = ("__id", "__h", "__g")
    hashes = [F.col(doc_id).cast("long").alias("__id"), F.xxhash64(text).alias("__h"), F.xxhash64(F.col(text), F.lit(1)).alias("__g")]
    twice = written(docs.select(*hashes).groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*[F.col(k).alias(k + "2") for k in names]), "twice")
    if twice.isEmpty():
        return kept
    same = F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__h") == F.col("__h2")) & (F.col("__g") == F.col("__g2"))
    marked = kept.select("*", *hashes)
    one = marked.join(twice, same, "left_semi").dropDuplicates(names)
    return marked.join(twice, same, "left_anti").unionByName(one).drop(*names)
