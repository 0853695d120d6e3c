"""Token counts per section by offset-mapped attribution.

A document is encoded once, whole, so that merges over section borders count as in training. Byte
lengths of the tokens add up to each token's span, byte positions map to characters, and the spans are
interval-joined with the sections (sorted, without gaps): a token inside one section counts there, a
token that crosses a border goes by ``rule`` to the section with its first character (``first``),
its last one (``last``) or most of its characters, the earlier one on ties (``most``). Every token counts
exactly once, so a document's counts add up to its tokens.

Scale: one pass where documents are read, no shuffle; a task holds one Arrow batch.

Defined cases: null or empty text is one section without characters or tokens. Sections are lines with their
line ends; a line end as the last character opens no further section. Repeated rows repeat their rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, encode_text

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Texts longer than this are encoded in parts that end before a space that follows a letter or digit (``common.encode_text``).
PART = 1 << 20


@lru_cache(1)
def _encoding(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of each token of ``text``, by code points."""
    encoding, lengths = _encoding(path)
    ids = encode_text(encoding, text, PART)
    stop = lengths[ids].cumsum()
    character = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1  # of each byte
    return character[stop - lengths[ids]], character[stop - 1]


def line_starts(text: str) -> np.ndarray:
    at, out = 0, [0]
    while (at := text.find("\n", at) + 1) and at < len(text):
        out.append(at)
    return np.array(out, np.int64)


def attribute(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str = "most") -> np.ndarray:
    """The number of tokens that each of the sections beginning at ``starts`` gets."""
    a, b = (np.searchsorted(starts, x, "right") - 1 for x in (first, last))
    section = b if rule == "last" else a.copy()
    if rule == "most":
        for t in np.flatnonzero(a != b):
            borders = [first[t], *starts[a[t] + 1 : b[t] + 1], last[t] + 1]
            section[t] = a[t] + int(np.argmax(np.diff(borders)))
    return np.bincount(section, minlength=len(starts))


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: str = "most", path: str | None = None) -> DataFrame:
    """doc_id, section (from 0), start, n_chars (of the section), n_tokens; one row per section of each document."""
    if rule not in ("first", "last", "most"):
        raise ValueError(f"unknown rule {rule!r}")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, counts, starts, sizes, tokens = batch.column(0), [], [], [], []
        for text in batch.column(1).to_pylist():
            begin = line_starts(text or "")
            starts.append(begin)
            sizes.append(np.diff(np.append(begin, len(text or ""))))
            tokens.append(attribute(*token_spans(text, path), begin, rule) if text else np.zeros(1, np.int64))
            counts.append(len(begin))
        yield {
            "doc_id": ids.take(pa.array(np.repeat(np.arange(len(ids)), counts))),
            "section": pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in counts])),
            "start": pa.array(np.concatenate(starts)),
            "n_chars": pa.array(np.concatenate(sizes)),
            "n_tokens": pa.array(np.concatenate(tokens)),
        }

    types = [("doc_id", pa.int64()), ("section", pa.int32()), ("start", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64())]
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(by_batch(rows, types), "doc_id long, section int, start long, n_chars long, n_tokens long")
