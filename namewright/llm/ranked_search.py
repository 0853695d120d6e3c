"""Ranked lexical search by presence masks.

Every item ranks all documents by an integer form of a length-normalised term score (constants below). Terms' scores depend on
counts over all documents, so documents are read once for the terms that items ask for, and the statistics come from that.

Ranking, per block of documents and item: each distinct term of the item has a bitmap of the documents that hold it.
Put together they give each document its mask of matched terms, and documents of equal mask form a group. A mask's best
possible score is the sum of its terms' best scores in the block. Groups are scored exactly in descending order of that
bound, and the search ends before the first one below the k-th best score so far, which no document of the
remaining groups can reach. A task carries an item's best documents from block to block, and the k best of all tasks' are the result.

Scale: items reach the tasks in blocks of at most ``block_bytes`` of text (a broadcast of proven size), one after another.
A pass over the documents writes, per document, its length and the item terms in it with their counts; statistics are a
partially aggregated count over that. A task hands on at most k rows an item, whatever documents it holds, and the last
ranking keeps k rows an item before and after its shuffle.

Defined cases: null or term-free texts match nothing and count in no statistic; such items have no rows. Repeated documents
are ranked each on their own; rows without doc_id come after those of equal score. Repeated items (same id and text) are searched once; other
texts of one id are searches of their own under that id. Empty tables give no rows. Texts are read whole.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, carried, written

TOP = 10
BLOCK_BYTES = 4 << 20
#: Documents are ranked in blocks of about so many bytes of postings.
RANKED_BYTES = 32 << 20
# The score's fixed values: weight scale, term score scale, length share in percent, saturation.
WEIGHT, SCORE, SHARE, TIMES = 1000, 1_000_000_000, 75, 8

# A-Z become lower case; every byte that is no digit, letter or part of a non-ASCII character becomes a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Items:
    """The items of one block: distinct terms numbered, and per item its terms with their repeats."""

    def __init__(self, rows: list[tuple[object, bytes]]):
        self.ids, self.number, self.terms, self.repeats = [], {}, [], []
        for item, text in rows:
            found = Counter(terms(text))
            if found:
                self.ids.append(item)
                self.terms.append(np.array([self.number.setdefault(t, len(self.number)) for t in found]))
                self.repeats.append(np.array(list(found.values()), np.int64))


def item_blocks(items: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """The items with text, in blocks of at most ``block_bytes`` of text (one item at least); one block is held at a time."""
    block, size = [], 0
    for item_id, body in items.select(F.col(item), F.col(text).cast("binary")).where(F.col(text).isNotNull()).distinct().toLocalIterator():
        if block and size + len(body) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, bytes(body)))
        size += len(body)
    if block:
        yield block


_BUILT: dict[str, Items] = {}


def _items(shared: Broadcast) -> Items:
    """The items of a block; a worker keeps those of one block only."""
    key, rows = shared.value
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Items(rows)
    return _BUILT[key]


def postings(docs: DataFrame, shared: Broadcast, doc_id: str, text: str) -> DataFrame:
    """Per document with terms: doc_id, n (its terms), terms and tfs (numbers of the item terms in it, and how often)."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        number = _items(shared).number
        lengths, found, times, held = [], [], [], []
        for k, text in enumerate(batch.column(1).to_pylist()):
            own = terms(text)
            if own:
                of = Counter(filter(lambda x: x is not None, map(number.get, own)))
                held.append(k)
                lengths.append(len(own))
                found.append(list(of))
                times.append(list(of.values()))
        yield {"doc_id": batch.column(0).take(pa.array(held, pa.int64())), "n": lengths, "terms": found, "tfs": times}

    types = [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]
    found = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return found.mapInArrow(by_batch(rows, types), "doc_id long, n long, terms array<int>, tfs array<int>")


class Best:
    """The k highest-scoring documents so far; of equal scores those with the smallest id, unnumbered ones last."""

    def __init__(self, k: int):
        self.k, self.scores, self.docs, self.named = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A document has to reach this score to enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, docs: np.ndarray, named: np.ndarray) -> None:
        scores, docs, named = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs]), np.concatenate([self.named, named])
        order = np.lexsort((docs, ~named, -scores))[: self.k]
        self.scores, self.docs, self.named = scores[order], docs[order], named[order]


def rank_block(best: Best, own: np.ndarray, worth: np.ndarray, starts: np.ndarray, doc_of: np.ndarray, score_of: np.ndarray, docs: np.ndarray, named: np.ndarray) -> int:
    """Rank a block's documents for one item: ``own`` its terms, ``worth`` their weights times repeats.

    Postings lie by term: of term t, rows starts[t] to starts[t + 1] of doc_of (place in the block, ascending) and score_of. Returns the number of masks that were scored.
    """
    own, worth = own[worth > 0], worth[worth > 0]
    lists = [slice(starts[t], starts[t + 1]) for t in own]
    words = (len(own) + 63) // 64
    if not words:
        return 0
    masks = np.zeros((words, len(docs)), np.uint64)
    bound = np.zeros(len(own), np.int64)
    for k, of in enumerate(lists):
        masks[k // 64, doc_of[of]] |= np.uint64(1 << (k % 64))
        bound[k] = score_of[of].max(initial=0) * worth[k]
    matched = np.flatnonzero(masks.any(axis=0))
    if not len(matched):
        return 0
    # Documents in the order of their masks: groups of equal masks are stretches.
    masks = masks[:, matched]
    order = np.lexsort(masks)
    masks, matched = masks[:, order], matched[order]
    first = np.flatnonzero(np.concatenate([[True], (masks[:, 1:] != masks[:, :-1]).any(axis=0)]))
    stop = np.append(first[1:], len(matched))
    most = np.zeros(len(first), np.int64)
    for k in range(len(own)):
        most += ((masks[k // 64, first] >> np.uint64(k % 64)) & np.uint64(1)).astype(np.int64) * bound[k]
    descending = np.argsort(-most, kind="stable")
    done, step = 0, 1
    while done < len(descending) and most[descending[done]] >= best.least():
        some = descending[done : done + step]
        some = some[most[some] >= best.least()]
        done += len(some)
        step *= 2
        places = np.concatenate([np.arange(first[g], stop[g]) for g in some])
        rows, scores = matched[places], np.zeros(len(places), np.int64)
        for k, of in enumerate(lists):
            has = np.flatnonzero((masks[k // 64, places] >> np.uint64(k % 64)) & np.uint64(1))
            scores[has] += score_of[of][np.searchsorted(doc_of[of], rows[has])] * worth[k]
        best.add(scores, docs[rows], named[rows])
    return done


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, ranked_bytes: int = RANKED_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item."""
    spark = docs.sparkSession
    arrow, schema = carried(items, [F.col(item).alias("item_id")], "text_no long, doc_id long, score long")
    out = spark.createDataFrame([], schema)
    for number, block in enumerate(item_blocks(items, item, item_text, block_bytes)):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        found = written(postings(docs, shared, doc_id, text), "postings")
        ranked = by_batch(*_ranking(found, shared, number, top, ranked_bytes, arrow))
        out = out.unionByName(found.mapInArrow(ranked, schema))
    order = Window.partitionBy("item_id", "text_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _ranking(found: DataFrame, shared: Broadcast, number: int, top: int, ranked_bytes: int, arrow: list[tuple[str, pa.DataType]]) -> tuple:
    """The arguments of a pass over ``found`` in which each task hands on its ``top`` documents of each item of a block."""
    n_docs, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    dfs = [0] * len(Items(shared.value[1]).number)
    for term, df in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():  # a row per term of the block
        dfs[term] = df
    weights = found.sparkSession.sparkContext.broadcast(np.array([math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in dfs], np.int64))
    best: list[Best] = []
    held: list[pa.RecordBatch] = []

    def rank() -> None:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        items, weight = _items(shared), weights.value
        if not best:
            best.extend(Best(top) for _ in items.ids)
        ids, n, lists, times = (table.column(k).combine_chunks() for k in range(4))
        named, n = ids.is_valid().to_numpy(zero_copy_only=False), n.to_numpy()
        of, tf = lists.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n), dtype=np.int32), lists.value_lengths().to_numpy())
        m = (100 - SHARE) + SHARE * n * n_docs // length
        score = SCORE * tf // (1000 * tf + TIMES * m[doc])
        by_term = np.argsort(of, kind="stable")
        starts = np.searchsorted(of[by_term], np.arange(len(items.number) + 1))
        doc, score, docs = doc[by_term], score[by_term], ids.fill_null(0).to_numpy()
        for own, repeats, so_far in zip(items.terms, items.repeats, best, strict=True):
            rank_block(so_far, own, weight[own] * repeats, starts, doc, score, docs, named)

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        held.append(batch)
        if sum(b.nbytes for b in held) >= ranked_bytes:
            rank()
        return iter(())

    def last() -> Iterator[dict]:
        if held:
            rank()
        ids = _items(shared).ids
        of = [k for k, b in enumerate(best) for _ in b.scores]
        if of:
            yield {
                "item_id": [ids[k] for k in of],
                "text_no": [(number << 32) + k for k in of],
                "doc_id": pa.array(np.concatenate([b.docs for b in best]), mask=~np.concatenate([b.named for b in best])),
                "score": np.concatenate([b.scores for b in best]),
            }

    return rows, [*arrow, ("text_no", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())], last
