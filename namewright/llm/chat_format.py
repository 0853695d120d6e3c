"""Chat formatting with loss masks, aligned by token offsets.

A conversation's rows, ordered by turn, are rendered as one text: ``<s>``, then each turn between the marks of its role
(``[INST]..[/INST]`` user, ``[SYS]..[/SYS]`` system, ``[ANS]..</s>`` assistant, ``[ROLE]role[TURN]..[/TURN]`` any other). The whole
text is encoded once. The tokens' byte lengths give their character spans, the turns' spans are known from rendering, and
a binary search of each token's start among the sorted assistant spans gives the loss mask: a token counts if it lies
within one assistant text. Marks are single tokens, so no token crosses from a mark into a text.

Escaping: a mark inside a text would end a turn early or forge one. Every mark, or mark with backslashes after its first
character, gets one more backslash there (``</s>`` becomes ``<\\/s>``, that ``<\\\\/s>``); reading removes one. Marks begin with
``<`` or ``[`` and hold these nowhere else, so no mark can arise across a border, and nothing else is changed.

Scale: one shuffle of the rows by conversation. A conversation is one row of the result, as a document is; a task holds
one Arrow slice.

Defined cases: a null text is empty, a null role is the role ''. Rows of equal turn are ordered by role and text, a null turn
comes first; repeated rows are turns of their own. A row without conversation id is a conversation of its own, so that
such rows make no group. An empty table gives no rows. Other columns are not read. Texts are any code points; the vocabulary is
byte-level, so no text is lost.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, carried, encode_text

VOCABULARY = "byte_bpe_50k.tiktoken"
BEGIN = "<s>"
ROLE, TURN = "[ROLE]", "[TURN]"
ANSWERS = "assistant"
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), ANSWERS: ("[ANS]", "</s>")}
OTHER_END = "[/TURN]"
CONTROLS = (BEGIN, *(m for pair in MARKS.values() for m in pair), ROLE, TURN, OTHER_END)
#: A mark after its first character, which any number of backslashes may precede.
TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_BARE = re.compile(rf"([<\[])(?=\\*(?:{TAILS}))")
_ESCAPED = re.compile(rf"([<\[])\\(?=\\*(?:{TAILS}))")
_CONTROL = re.compile("(" + "|".join(map(re.escape, CONTROLS)) + ")")


def escape(text: str) -> str:
    return _BARE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text of (role, text) turns, and (role, start, stop) of each turn's own text in it."""
    parts, spans, at = [BEGIN], [], len(BEGIN)
    for role, text in turns:
        before, after = MARKS[role] if role in MARKS else (f"{ROLE}{escape(role)}{TURN}", OTHER_END)
        text = escape(text)
        at += len(before)
        spans.append((role, at, at + len(text)))
        at += len(text) + len(after)
        parts += [before, text, after]
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered text."""
    start, *pieces = _CONTROL.split(formatted)[1:]
    if start != BEGIN:
        raise ValueError("not a rendered conversation")
    roles = {before: role for role, (before, _) in MARKS.items()}
    turns, role = [], ""
    for text, control in zip(pieces[::2], ["", *pieces[1::2]], strict=True):
        if control in roles:
            turns.append((roles[control], unescape(text)))
        elif control == ROLE:
            role = unescape(text)
        elif control == TURN:
            turns.append((role, unescape(text)))
    return turns


@lru_cache(1)
def _encoding(path: str | None):
    """The encoding with the marks as tokens of their own, each id's bytes, and their numbers."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    free = max(ranks.values()) + 1
    marks = {c: free + k for k, c in enumerate(CONTROLS)}
    pieces = [b""] * (free + len(marks))
    for token, rank in (ranks | {c.encode(): k for c, k in marks.items()}).items():
        pieces[rank] = token
    lengths = np.array([len(p) for p in pieces], np.int64)
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=marks), pieces, lengths


def encode(formatted: str, path: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, and the first and last character of each."""
    encoding, _, lengths = _encoding(path)
    ids = encode_text(encoding, formatted, border=_CONTROL)
    stop = lengths[ids].cumsum()
    character = np.cumsum((np.frombuffer(formatted.encode(), np.uint8) & 0xC0) != 0x80) - 1  # of each byte
    return ids, character[stop - lengths[ids]], character[stop - 1]


def loss_mask(first: np.ndarray, last: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie within one of the sorted, disjoint spans [start, stop)."""
    if not spans:
        return np.zeros(len(first), bool)
    start, stop = np.array(spans, np.int64).T
    k = np.searchsorted(start, first, "right") - 1
    # Of spans that begin at one place all but the last are empty, and the search gives the last.
    return (k >= 0) & (last < stop[np.maximum(k, 0)])


_SPANS = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = ANSWERS, path: str | None = None) -> DataFrame:
    """conv_id, formatted, ids, loss (by token), turns (role, start, stop of each text in ``formatted``); a row per conversation."""
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = F.when(F.col(conv_id).isNull(), F.monotonically_increasing_id())
    talks = rows.select(F.col(conv_id).alias("conv_id"), own.alias("own"), said.alias("said"))
    talks = talks.groupBy("conv_id", "own").agg(F.sort_array(F.collect_list("said")).alias("said"))
    arrow, schema = carried(talks, ["conv_id"], "formatted string, ids array<int>, loss array<boolean>, turns array<struct<role:string,start:long,stop:long>>")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts, ids, loss, turns = [], [], [], []
        for said in batch.column(1).to_pylist():
            formatted, spans = render([(s["role"], s["text"]) for s in said])
            tokens, first, last = encode(formatted, path)
            texts.append(formatted)
            ids.append(tokens.astype(np.int32))
            loss.append(loss_mask(first, last, [(a, b) for r, a, b in spans if r == learn]))
            turns.append([{"role": r, "start": a, "stop": b} for r, a, b in spans])
        yield {"conv_id": batch.column(0), "formatted": texts, "ids": ids, "loss": loss, "turns": turns}

    out = [("formatted", pa.string()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_())), ("turns", _SPANS)]
    return talks.select("conv_id", "said").mapInArrow(by_batch(run, [*arrow, *out]), schema)


def learnt_text(ids: np.ndarray, loss: np.ndarray, path: str | None = None) -> str:
    """The text under a loss mask, from the token ids alone: run by run, without escapes."""
    pieces = _encoding(path)[1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(loss, np.int8), [0]]))).tolist()
    return "".join(unescape(b"".join([pieces[i] for i in ids[a:z].tolist()]).decode()) for a, z in zip(edges[::2], edges[1::2], strict=True))


def digest(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """Per formatted conversation what can be read back from its text and its masked tokens."""
    arrow, schema = carried(formatted, ["conv_id"], "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(1).to_pylist()
        turns = [read_turns(t) for t in texts]
        ids, loss = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3))
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
        learnt = [learnt_text(ids[a:z], loss[a:z], path) for a, z in zip([0, *ends], ends, strict=False)]
        yield {
            "conv_id": batch.column(0),
            "n_turns": [len(t) for t in turns],
            "turns_sha256": [hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest() for t in turns],
            "loss_chars": [len(x) for x in learnt],
            "loss_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in learnt],
            "formatted_chars": [len(t) for t in texts],
        }

    out = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    return formatted.select("conv_id", "formatted", "ids", "loss").mapInArrow(by_batch(run, [*arrow, *out]), schema)
