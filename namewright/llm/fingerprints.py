"""Document fingerprints by winnowing, and their likeness to edited and neighbouring texts.

The rolling polynomial hashes of all ``k``-byte grams of a text are winnowed: of every ``window``
consecutive hashes the smallest is chosen, the rightmost of equal ones, and chosen hashes keep
their position. Two texts that share ``window + k - 1`` bytes therefore share a fingerprint, and one that
share no ``k`` bytes share none (but for hash collisions). Likeness is the Jaccard similarity of the hash sets.

Scale: fingerprints need no shuffle. The query with neighbours deals the texts out once, by ranges of doc_id whose
bounds come from approximate quantiles, and sorts within the ranges; a text that begins a range is also sent to the range
before it, so that every pair of neighbours meets in one task. Only range bounds and one key per range reach
the driver: their number is the input's bytes by ``range_bytes``, 20,000 at most (then ranges grow). A task streams its rows,
which Spark sorts with spilling, and holds two texts and one Arrow batch.

Defined cases: null text counts as empty. A text of under ``k`` bytes is one gram, an empty one has no
fingerprint; two empty fingerprints are alike (1), an empty and another one are not (0). Rows without doc_id come last
in the descending order; rows that share a doc_id are ordered by text hash. A table of one row is its own next document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch
from namewright.llm.hashing import window_minima

K, WINDOW = 12, 24
RANGE_BYTES, MOST_RANGES, SMALL_BYTES = 16 << 20, 20_000, 1 << 20


def winnow(data: bytes, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the chosen grams, by position."""
    if not data:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes, places = [], []
    for at, best, h in window_minima(np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), k, window):
        chosen = best[np.concatenate([[True], best[1:] != best[:-1]])]
        hashes.append((h[chosen] >> np.uint64(32)).astype(np.uint32))
        places.append(at + chosen)
    h, p = np.concatenate(hashes), np.concatenate(places)
    new = np.concatenate([[True], p[1:] != p[:-1]])  # windows on both sides of a part's end may choose the same gram
    return h[new], p[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes and positions (byte offsets) of every row's fingerprint."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        both = [winnow(t or b"", k, window) for t in batch.column(1).to_pylist()]
        yield {"doc_id": batch.column(0), "hashes": [h.astype(np.int64) for h, _ in both], "positions": [p for _, p in both]}

    types = [("doc_id", pa.int64()), ("hashes", pa.list_(pa.int64())), ("positions", pa.list_(pa.int64()))]
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(by_batch(rows, types), "doc_id long, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, doc_id: str, text: str, range_bytes: int) -> DataFrame:
    """part, guest, doc_id, text (string): each part sorted, followed by the document after its last one (guest = 1)."""
    spark = docs.sparkSession
    least = -(2**63)
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = keyed.select("doc_id", "text", F.coalesce("doc_id", F.lit(least)).alias("place"), F.xxhash64("text").alias("h"))
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least_parts = int(spark.conf.get("spark.sql.shuffle.partitions")) if total > SMALL_BYTES else 1
    parts = min(MOST_RANGES, max(least_parts, math.ceil(total / range_bytes)))
    shares = [i / parts for i in range(1, parts)]
    bounds = keyed.agg(F.percentile_approx("place", shares, 20 * parts)).first()[0] if shares else []
    cuts, times = np.unique(np.array(bounds or [], np.int64), return_counts=True)
    # An id that several bounds fall on (rows without id, or of one id) has parts of its own, by ranges of the text hash.
    own = np.append(np.where(times > 1, times, 0), 0)
    start = np.append(np.cumsum((own + 1)[::-1])[::-1][1:], 0)  # parts before those of each cut, by descending id

    @F.pandas_udf("int")
    def part_of(place, h):
        import pandas as pd

        x = place.to_numpy()
        at = np.searchsorted(cuts, x)
        inside = (own[at] > 0) & (np.append(cuts, 0)[at] == x)
        share = (h.to_numpy().astype(float) / 2.0**64 + 0.5).clip(0, 1 - 1e-9)
        return pd.Series((start[at] + np.where(inside, (share * own[at]).astype(np.int64), own[at])).astype("int32"))

    dealt = keyed.withColumn("part", part_of("place", "h") if len(cuts) else F.lit(0))
    heads = dealt.groupBy("part").agg(F.max(F.struct("place", (-F.col("h").cast("decimal(20,0)")).alias("minus"))).alias("head")).orderBy("part").select("part", "head.place", "head.minus").collect()
    to = [(int(x.place), int(-x.minus), int(heads[i - 1].part)) for i, x in enumerate(heads)]
    guests = spark.createDataFrame(to, "place long, h long, to int")
    # One row per range, hence the broadcast.
    sent = keyed.join(F.broadcast(guests), ["place", "h"]).select("doc_id", "text", "place", "h", F.col("to").alias("part"), F.lit(1).alias("guest"))
    every = dealt.select("doc_id", "text", "place", "h", "part", F.lit(0).alias("guest")).unionByName(sent)
    tasks = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return every.repartition(tasks, "part").sortWithinPartitions("part", "guest", F.desc("place"), "h").select("part", "guest", "doc_id", "text")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<long>"
_TYPES = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("positions", pa.list_(pa.int64())),
]


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document's fingerprint beside that of its edited text, whose last third is the beginning of the next document by descending doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the row that waits for its next document: part, doc_id, text, winnowed, sorted hashes

        def one(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal before
            out: dict[str, list] = {name: [] for name, _ in _TYPES}
            for part, guest, doc, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if guest and (before is None or before[0] != part):
                    continue  # a repeated guest
                own = winnow(body.encode(), k, window)
                hashes = np.unique(own[0])
                if before is not None and before[0] == part:
                    _, prior, old, (chosen, places), known = before
                    cut = len(old) // 3
                    edited = (old[: len(old) - cut] + body[:cut]).encode()
                    changed = winnow(edited, k, window)[0]
                    values = (prior, len(old), hashlib.sha256(edited).hexdigest(), as_text(chosen), as_text(changed), likeness(known, np.unique(changed)), likeness(known, hashes), places)
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
                before = None if guest else (part, doc, body, own, hashes)
            yield out

        yield from by_batch(one, _TYPES)(batches)

    return with_next(docs, doc_id, text, range_bytes).mapInArrow(run, _OUT)
