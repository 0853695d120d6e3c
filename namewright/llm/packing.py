"""Best-fit packing of tokenised documents into sequences, with vector-valued capacities.

A sequence holds at most ``max_tokens`` tokens, ``max_docs`` pieces and ``max_cost``
attention cost (the sum of squared piece lengths, as attention is masked by document). Pieces
are placed by decreasing length. Of the open sequences with room in every dimension the one
is taken that leaves the smallest weighted norm of relative residuals (``rule='norm'``), or
whose residual vector has the largest weighted dot product with the piece (``rule='dot'``).

Tokens: the tokenizer is applied to white-space separated chunks. A batch's texts are cut and its distinct
chunks found by Arrow; those are cut into the tokenizer's own pieces, of which each worker remembers the
ids (bounded, two generations). Chunks of other letters are remembered whole. Its pre-tokenizer never joins characters over
ASCII white space, so the ids are those of the whole text; a tokenizer file that prepares texts in any other way is
applied to whole texts.

Scale: documents are tokenised where they are read; only (id, piece, length, checksum) rows are
written and dealt out evenly, about ``per_task`` pieces a task, whatever their source or
length. Each task packs its share, which leaves one badly filled sequence a task, that is one in
thousands. Nothing is collected.

Defined cases: null or empty text is a document of only the end token. Rows are packed one by one,
repeated rows each on their own. Documents longer than a sequence are cut every ``max_tokens``.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, written

MAX_TOKENS = 4096
END_ID = 1
PER_TASK = 50_000
TOKENIZER = "word_bpe_49k.json"
#: Weights of the residual tokens, documents and attention cost.
WEIGHTS = (1.0, 0.3, 0.3)
REMEMBERED = 300_000
LONGEST_CHUNK = 64

# Characters for which lower case, NFC and the pre-tokenizer's classes need no tables: printable ASCII, Latin-1 and Latin Extended-A letters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ňŊ-ŷŹ-ž]+")
# .. and how it cuts such chunks, each a line of its own.
_PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž\n]+")


def _byte_letters() -> list[str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others as code points from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class _Remembered(dict):
    """Computes what it lacks; holds the keys used since one of the last two times it was full."""

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


# How the tokenizers that ``ChunkEncoder`` may cut into chunks prepare a text.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def cuts_at_white_space(path: str) -> bool:
    """Whether a tokenizer file prepares texts in the one way for which chunks have the ids of the whole text."""
    spec = json.loads(Path(path).read_text())
    return (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and (spec.get("pre_tokenizer") or {}).get("pretokenizers") == _SPLITTERS
        and spec.get("truncation") is None
        and all(t["content"].startswith("<|") and not t.get("lstrip") and not t.get("rstrip") and not t.get("normalized") for t in spec.get("added_tokens", []))
    )


class PlainEncoder:
    """Token ids of whole texts by any tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, text: bytes | None) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes() if text else b""

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of binary texts one after another, and where each text's ids end."""
        found = [self.encode(t) for t in texts.to_pylist()]
        return np.frombuffer(b"".join(found), "<u4"), np.cumsum([len(f) // 4 for f in found], dtype=np.int64)


class ChunkEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers, by a tokenizer that ``cuts_at_white_space``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.pieces = _Remembered(self._piece, REMEMBERED)
        self.chunks = _Remembered(self._chunk, REMEMBERED)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, chunks: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of plain chunks one after another, and how many each has. They are cut into pieces all at once, as lines of one text."""
        pieces = _PIECES.findall("".join([c + "\n" for c in chunks]).lower())
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, pieces), bool, len(pieces)))
        found = [b"" if p == "\n" else self.pieces[p] for p in pieces]
        before = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        return b"".join(found), np.diff(before[ends], prepend=0)

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A table of ids, and for each chunk the place and the number of its own there."""
        plain = np.array([_PLAIN.fullmatch(c) is not None and "<|" not in c for c in chunks], bool)
        own, sizes = self._plain([c for c, p in zip(chunks, plain, strict=True) if p])
        rest = [self.chunks[c] if len(c) <= LONGEST_CHUNK else self._chunk(c) for c, p in zip(chunks, plain, strict=True) if not p]
        sizes = np.concatenate([sizes, np.fromiter(map(len, rest), np.int64, len(rest)) // 4])
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        at, n = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        at[order], n[order] = np.cumsum(sizes) - sizes, sizes
        return np.frombuffer(own + b"".join(rest), "<u4"), at, n

    def encode(self, text: bytes | None) -> bytes:
        return self.encode_all(pa.array([text], pa.binary()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of binary texts one after another, and where each text's ids end. Every distinct chunk is looked at once."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, b"").view(pa.string()))
        of = words.flatten().dictionary_encode()
        distinct = b"\n".join(of.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False))
        table, at, n = self._chunks(distinct.decode("utf-8", "replace").split("\n") if len(of.dictionary) else [])
        chunk = of.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(n[chunk])])
        ids = table[np.repeat(at[chunk] - ends[:-1], n[chunk]) + np.arange(ends[-1])]
        return ids, ends[np.cumsum(pc.list_value_length(words).to_numpy())]


_ENCODERS: dict[str, ChunkEncoder | PlainEncoder] = {}


def encoder(path: str) -> ChunkEncoder | PlainEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path) if cuts_at_white_space(path) else PlainEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces, and dealt: a number
    that spreads rows evenly and is the same whenever the task is repeated."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(path or tokenizer_path()).encode_all
        end, task, seen = np.array([END_ID], "<u4").tobytes(), TaskContext.get().partitionId(), 0

        def one(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal seen
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "dealt")}
            tokens, ends = encode_all(batch.column(1))
            first = 0
            for i, last in zip(batch.column(0).to_pylist(), ends.tolist(), strict=True):
                ids, first = tokens[first:last].tobytes() + end, last
                for k, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at : at + 4 * max_tokens]
                    for name, value in zip(out, (i, k, at // 4, len(part) // 4, zlib.crc32(part), (task * 7919 + seen) & 0x7FFFFFFF), strict=True):
                        out[name].append(value)
                    seen += 1
            yield out

        yield from by_batch(one, [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("dealt", pa.int64())])(batches)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, dealt long")


def best_fit(lengths: np.ndarray, max_tokens: int, max_docs: int, max_cost: float, weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; items come by decreasing length. A piece that alone breaks the cost capacity gets a bin of its own."""
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.zeros(n, np.int64)
    caps = np.array([max_tokens, max_docs, max_cost], float)
    w = np.array(weights, float)
    left = np.empty((3, 1024))  # residual capacities of the open bins, relative to the caps
    names = np.empty(1024, np.int64)
    used = np.empty(1024, np.int64)
    open_, made = 0, 0
    least = int(lengths.min()) if n else 0
    eps = 1e-12
    for i, size in enumerate(lengths.tolist()):
        item = np.array([size, 1.0, float(size) * size]) / caps
        at = -1
        if open_ and size < max_tokens:
            room = left[:, :open_]
            after = room - item[:, None]
            fits = (after >= -eps).all(axis=0)
            if fits.any():
                score = (w[:, None] * np.square(after)).sum(axis=0) if rule == "norm" else -((w * item)[:, None] * room).sum(axis=0)
                score[~fits] = np.inf
                at = int(score.argmin())
        if at < 0:
            if open_ == left.shape[1]:
                left, names, used = np.concatenate([left, np.empty_like(left)], axis=1), np.concatenate([names, names]), np.concatenate([used, used])
            at, open_ = open_, open_ + 1
            left[:, at], names[at], used[at] = 1.0, made, 0
            made += 1
        bins[i], offsets[i] = names[at], used[at]
        left[:, at] -= item
        used[at] += size
        if used[at] + least > max_tokens:  # closed: the last open bin takes its place
            open_ -= 1
            left[:, at], names[at], used[at] = left[:, open_], names[open_], used[open_]
    return bins, offsets


def pack(
    pieces: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_docs: int | None = None,
    max_cost: float | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
    per_task: int = PER_TASK,
) -> DataFrame:
    """``pieces`` with sequence_id and offset. Without limits of their own, documents and cost have
    the bounds that follow from ``max_tokens``: as many one-token pieces, one piece of full length."""
    docs_cap, cost_cap = max_docs or max_tokens, max_cost or float(max_tokens) ** 2
    tasks = max(1, math.ceil(pieces.count() / per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(table.column("length").to_numpy(), max_tokens, docs_cap, cost_cap, weights, rule)
        bins += TaskContext.get().partitionId() << 40
        table = table.drop_columns(["dealt"]).append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))
        yield from table.to_batches(max_chunksize=10_000)

    return pieces.repartition(tasks, F.hash("dealt")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, max_tokens: int = MAX_TOKENS, **options) -> DataFrame:
    """Tokenise, cut and pack ``docs``."""
    pieces = written(token_pieces(docs, doc_id, text, path, max_tokens), "pieces")
    return pack(pieces, max_tokens, **options)
