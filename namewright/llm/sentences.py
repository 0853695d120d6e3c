"""Substring dedup by sliding spans of sentences.

A sentence ends at a word that ends in . ! or ? (closing quotes or brackets may follow) or at a
line end, once it has ``least`` words; a sentence of more than ``longest`` words is cut after
words whose hash is divisible by ``cut``, which needs no knowledge of what stands before. From every
sentence the shortest run of at least ``run`` sentences with at least ``min_words`` words that begins
there is hashed (128 bits, white space ignored), with ``tails`` (both registered queries) also the
shortest that ends there: together they cover every longer run of the same sentences. All spans are
joined globally; every sentence covered by a span that also starts earlier, in the order of (doc_id,
position), is removed. Without ``tails`` the last sentences of a repeated run may stay.

Scale: pass one counts span hashes, summed per Arrow batch before the shuffle. Pass two keeps the
occurrences of repeated hashes, a small table. The aggregates that these joins meet are written first, so that adaptive
execution can split a hot span. First occurrences come from a partially aggregated minimum, never from a
collected group, so a passage in a third of all documents costs one row a task. The texts
are shuffled once, to meet their removed sentences.

Defined cases: null and empty texts have no sentences and stay as they are. Texts under ``min_words``
words or ``run`` sentences have no span. Spans repeated within one document lose the later ones too.
A null doc_id comes last in the order. Identical rows (same id, same text) count as one document:
both keep what a first occurrence keeps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, carried, whole_row, written
from namewright.llm.hashing import WHITE, Words, chunks, run_hashes

RUN, MIN_WORDS, LEAST, LONGEST, CUT = 3, 20, 4, 16, 6
_ENDS = np.isin(np.arange(256), list(b".!?"))
_CLOSERS = np.isin(np.arange(256), list(b"\"')]"))


def sentence_starts(w: Words, least: int = LEAST, longest: int = LONGEST, cut: int = CUT) -> np.ndarray:
    """Indexes of the words that begin a sentence; every text with words begins one."""
    n = len(w.start)
    if not n:
        return np.empty(0, np.int64)
    tail = w.stop - 1
    for _ in range(2):
        tail = np.where(_CLOSERS[w.data[tail]] & (tail > w.start), tail - 1, tail)
    lines = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
    new_doc = np.empty(n, bool)
    new_doc[0], new_doc[1:] = True, w.doc[1:] != w.doc[:-1]
    ends = _ENDS[w.data[tail]]  # a candidate end after this word
    ends[:-1] |= (lines[w.start[1:]] > lines[w.stop[:-1]]) | new_doc[1:]
    ends[-1] = True
    raw = np.concatenate([[0], np.flatnonzero(ends) + 1])  # bounds between candidate sentences
    short = np.diff(raw) < least
    bound = np.concatenate([raw[:1], raw[1:][~short]])
    starts = np.union1d(bound[bound < n], np.flatnonzero(new_doc))
    sizes = np.diff(np.append(starts, n))
    long_ = np.repeat(sizes > longest, sizes)
    after = np.flatnonzero(long_[:-1] & (w.h[:-1] % np.uint64(cut) == 0)) + 1
    return np.union1d(starts, after)


def spans(w: Words, starts: np.ndarray, run: int = RUN, min_words: int = MIN_WORDS, tails: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop) in sentences: from each sentence the shortest run that is long enough, within its text; with ``tails`` also up to each sentence. Every run once."""
    k = len(starts)
    word_stop = np.append(starts[1:], len(w.start))
    every = np.arange(k)
    stop = np.maximum(every + run, np.searchsorted(word_stop, starts + min_words) + 1)
    first = every
    if tails:
        head = np.minimum(every + 1 - run, np.searchsorted(starts, word_stop - min_words, "right") - 1)  # first of the run up to ``every``
        new = (head >= 0) & (stop[np.maximum(head, 0)] != every + 1)
        first, stop = np.concatenate([every, head[new]]), np.concatenate([stop, every[new] + 1])
    fits = stop <= k
    first, stop = first[fits], stop[fits]
    same = w.doc[starts[first]] == w.doc[starts[stop - 1]]
    return first[same], stop[same]


def _span_rows(texts: list[bytes | None], options: tuple[int, int, int, int, int, bool]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    run, min_words, least, longest, cut, tails = options
    for a, b in chunks(texts):
        w = Words(texts[a:b], WHITE)
        starts = sentence_starts(w, least, longest, cut)
        first, stop = spans(w, starts, run, min_words, tails)
        if not len(first):
            continue
        word_stop = np.append(starts[1:], len(w.start))
        i, j = starts[first], word_stop[stop - 1]
        doc = w.doc[i]
        begin = np.searchsorted(starts, w.first[doc])  # the text's first sentence
        yield a, doc, run_hashes(w.h, i, j, 1), run_hashes(w.h, i, j, 2), first - begin, stop - begin


def removed_sentences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN, min_words: int = MIN_WORDS, least: int = LEAST, longest: int = LONGEST, cut: int = CUT, tails: bool = False) -> DataFrame:
    """doc (doc_id, nulls as the largest long), body (hash of the text) and covered: the spans [first, stop) to remove, in sentences."""
    options = (run, min_words, least, longest, cut, tails)

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [x[2] for x in _span_rows(batch.column(0).to_pylist(), options)]
        if found:
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield {"h": pa.array(h.view(np.int64)), "n": pa.array(n)}

    def occur(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, body = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for a, doc, h, g, first, stop in _span_rows(batch.column(2).to_pylist(), options):
            yield {"h": pa.array(h.view(np.int64)), "g": pa.array(g.view(np.int64)), "doc": pa.array(ids[a + doc]), "body": pa.array(body[a + doc]), "at": pa.array((first << 32) | (stop - first))}

    bytes_ = F.col(text).cast("binary")
    repeated = (
        docs.select(bytes_)
        .mapInArrow(by_batch(count, [("h", pa.int64()), ("n", pa.int64())]), "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    )
    repeated = written(repeated, "repeated")
    longs = [(k, pa.int64()) for k in ("h", "g", "doc", "body", "at")]
    every = docs.select(_order(doc_id), F.xxhash64(bytes_), bytes_).mapInArrow(by_batch(occur, longs), ", ".join(f"{k} long" for k, _ in longs))
    found = written(every.join(repeated, "h", "left_semi"), "spans")
    firsts = written(found.groupBy("h", "g").agg(F.min(F.struct("doc", "body", "at")).alias("one")), "firsts")
    later = found.join(firsts, ["h", "g"]).where("one != struct(doc, body, at)")
    return written(later.groupBy("doc", "body").agg(F.collect_set("at").alias("covered")), "covered")


def _order(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("doc")


def without_sentences(text: bytes | None, covered: list[int] | None, least: int = LEAST, longest: int = LONGEST, cut: int = CUT) -> tuple[bytes | None, int, int]:
    """(what is left, sentences, removed sentences) of a text; a sentence goes with the white space after it."""
    if not text:
        return text, 0, 0
    w = Words([text], WHITE)
    starts = sentence_starts(w, least, longest, cut)
    if not covered:
        return text, len(starts), 0
    gone = np.zeros(len(starts) + 1, np.int64)
    for at in covered:
        gone[at >> 32] += 1
        gone[(at >> 32) + (at & 0xFFFFFFFF)] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    bounds = np.append(w.start[starts], len(text)).tolist()
    kept = text[: bounds[0]] + b"".join(text[bounds[k] : bounds[k + 1]] for k in np.flatnonzero(~gone).tolist())
    return kept, len(starts), int(gone.sum())


def remove_repeats(docs: DataFrame, keep: list[str | Column], doc_id: str = "doc_id", text: str = "text", run: int = RUN, min_words: int = MIN_WORDS, least: int = LEAST, longest: int = LONGEST, cut: int = CUT, tails: bool = False) -> DataFrame:
    """The ``keep`` columns of every row with kept_text, n_sentences and n_removed."""
    removed = removed_sentences(docs, doc_id, text, run, min_words, least, longest, cut, tails)
    bytes_ = F.col(text).cast("binary")
    arrow, schema = carried(docs, keep, "kept_text string, n_sentences long, n_removed long")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        n = batch.num_columns
        out = [without_sentences(t, c, least, longest, cut) for t, c in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True)]
        yield {f: batch.column(k) for k, (f, _) in enumerate(arrow)} | {"kept_text": [None if x[0] is None else x[0].decode("utf-8", "replace") for x in out], "n_sentences": [x[1] for x in out], "n_removed": [x[2] for x in out]}

    whole = docs.select(F.struct(*keep).alias("row"), bytes_.alias("t"), _order(doc_id), F.xxhash64(bytes_).alias("body"))
    met = whole.join(removed, ["doc", "body"], "left").select(*[F.col("row").getField(name).alias(name) for name, _ in arrow], F.col("t").alias("__text"), F.col("covered").alias("__covered"))
    return met.mapInArrow(by_batch(rows, [*arrow, ("kept_text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64())]), schema)


def dedup(docs: DataFrame, text: str = "text", length: str | None = "n_chars", tails: bool = True, **options) -> DataFrame:
    """``docs`` with repeated sentences taken out of ``text`` (and ``length`` counted anew). Rows of which nothing but white space is left are dropped; rows that had no text before stay."""
    cols = docs.columns
    found = remove_repeats(docs, [whole_row(docs)], text=text, tails=tails, **options).where("n_removed = 0 or n_removed < n_sentences")
    value = {text: F.col("kept_text")}
    if length in cols:
        value[length] = F.when(F.col("n_removed") == 0, F.col("row").getField(length)).otherwise(F.length("kept_text")).cast(docs.schema[length].dataType)
    return found.select(*[value.get(c, F.col("row").getField(c)).alias(c) for c in cols])
