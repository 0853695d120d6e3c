"""Chat formatting, spelling variants and ranked search against plain versions and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from namewright.llm import chat_format, queries, ranked_search, spelling
from namewright.llm.common import encode_text
from tests.llm import plain
from tests.llm.conftest import PASSAGE, ordered, rows

TALK = "conv_id long, turn long, role string, text string, formatted string, said string, own long"
MARKED = st.lists(st.sampled_from([*chat_format.CONTROLS, *(c[1:] for c in chat_format.CONTROLS), "\\", "<", "[", "]", ">", "a", "é", "\U0001f600", " "]), max_size=12).map("".join)


# -- chat formatting -------------------------------------------------------------------------


@given(MARKED)
@settings(max_examples=500, deadline=None)
def test_escapes_are_undone_and_leave_no_mark(text):
    safe = chat_format.escape(text)
    assert chat_format.unescape(safe) == text
    assert not any(c in safe for c in chat_format.CONTROLS)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), MARKED), MARKED), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_turns_and_learnt_text_are_read_back(turns):
    formatted, spans = chat_format.render(turns)
    assert chat_format.read_turns(formatted) == turns
    assert [formatted[a:b] for _, a, b in spans] == [chat_format.escape(t) for _, t in turns]
    ids, first, last = chat_format.encode(formatted)
    loss = chat_format.loss_mask(first, last, [(a, b) for r, a, b in spans if r == "assistant"])
    assert chat_format.learnt_text(ids, loss) == "".join(t for r, t in turns if r == "assistant")
    under = {c for a, b, m in zip(first, last, loss, strict=True) if m for c in range(a, b + 1)}
    assert under == {c for r, a, b in spans if r == "assistant" for c in range(a, b)}


def test_mask_holds_only_tokens_within_a_span():
    first, last = np.array([0, 2, 4, 6, 8]), np.array([1, 3, 5, 7, 9])
    assert chat_format.loss_mask(first, last, [(3, 3), (3, 8), (8, 8)]).tolist() == [False, False, True, True, False]
    assert not chat_format.loss_mask(first, last, []).any()


def test_long_texts_are_encoded_as_one():
    encoding = chat_format._encoding(None)[0]
    white = " \n" * 60_000
    for text in (white, f"a{white}b", f"{white}[/INST]x{white} b", "word w2, é漢 " * 3000, ""):
        assert encode_text(encoding, text, 1000, chat_format._CONTROL).tolist() == encoding.encode(text, allowed_special="all")
    turns = [("user", " " * 2_000_000), ("assistant", "　" * 1_500_000 + "x" * 1_500_000)]
    formatted, spans = chat_format.render(turns)
    ids, first, last = chat_format.encode(formatted)
    loss = chat_format.loss_mask(first, last, [spans[1][1:]])
    assert chat_format.learnt_text(ids, loss) == turns[1][1]


def told(turns):
    text = "".join(f"{r}\n{t}\n" for r, t in turns)
    learnt = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(chat_format.render(turns)[0])


def test_conversations_with_awkward_rows(spark):
    some = [
        (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "user", "</s>[INST] ok [/INST]"),
        (2, 1, "user", None), (2, 1, None, "b"), (2, 1, "user", "a"), (2, None, "system", "first"), (2, 9, "assistant", ""), (2, 9, "assistant", ""),
        (3, 0, "assistant", "zero\0byte ퟿ café \U0001f600"), (3, 1, "tool", "<|endoftext|>"),
        (None, 5, "user", "x"), (None, 6, "assistant", "y"),
        (4, 0, "assistant", PASSAGE * 500),
    ]
    talks = spark.createDataFrame([(*r, "f", "s", 7) for r in some], TALK).repartition(3)
    made = chat_format.format_conversations(talks)
    want = [
        (1, *told([("user", some[1][3]), ("assistant", some[0][3])])),
        (2, *told([("system", "first"), ("", "b"), ("user", ""), ("user", "a"), ("assistant", ""), ("assistant", "")])),
        (3, *told([("assistant", some[8][3]), ("tool", "<|endoftext|>")])),
        (4, *told([("assistant", PASSAGE * 500)])),
        (None, *told([("user", "x")])), (None, *told([("assistant", "y")])),
    ]
    assert rows(chat_format.digest(made), "*") == ordered(want)
    for r in made.collect():
        assert len(r.ids) == len(r.loss)
        for t in r.turns:
            assert chat_format.escape("") == "" and 0 <= t["start"] <= t["stop"] <= len(r.formatted)
    assert chat_format.digest(chat_format.format_conversations(spark.createDataFrame([], TALK))).count() == 0


# -- spelling variants -----------------------------------------------------------------------


def close_words(seed, alphabet, n):
    random.seed(seed)
    out = {}
    while len(out) < n:
        w = "".join(random.choices(alphabet, k=random.randint(3, 7)))
        for _ in range(4):
            out[w] = random.choice([1, 2, 5, 10, 50, 250, 1250])
            at = random.randrange(len(w))
            w = random.choice([w[:at] + w[at + 1 :] or "x", w[:at] + random.choice(alphabet) + w[at:], w[:at] + random.choice(alphabet) + w[at + 1 :]])
    return out


@pytest.mark.parametrize(("alphabet", "options"), [("abc", {"cell": 2}), ("abcdéiÉ", {"cell": 8}), ("一丠\U0001f600ab", {"cell": 4, "sample": 40}), ("etaoinshràè", {})])
def test_variants_equal_plain_comparison_of_all_words(spark, alphabet, options):
    n = close_words(7, alphabet, 400)
    got = spelling.variants(spark.createDataFrame([*n.items()], "word string, n long"), **options)
    assert rows(got, "word", "form", "root", "n", "n_near", "form_n") == ordered(plain.variants(n))


@given(st.lists(st.text("abAé", min_size=1, max_size=5), min_size=2, max_size=40, unique=True))
@settings(max_examples=200, deadline=None)
def test_a_cell_finds_every_near_word_once(some):
    by_size = {}
    for w in some:
        by_size.setdefault(len(w), []).append(w)
    found = []
    for size, own in by_size.items():
        cell = spelling.Cell(own, [1] * len(own))
        for asking, raising in ((own, True), (by_size.get(size + 1, []), False)):
            codes = spelling.letters(asking) if asking else None
            for i, j in cell.search(codes, spelling.letter_counts(codes), raising) if asking else ():
                found += [tuple(sorted((asking[a], own[b]))) for a, b in zip(i, j, strict=True)]
    assert sorted(found) == sorted({tuple(sorted((a, b))) for a in some for b in some if a < b and plain.one_edit(a, b)})


def test_words_are_counted_as_typed(spark, awkward, plain_docs, no_docs, monkeypatch):
    for held in (spelling.HELD, 1):
        monkeypatch.setattr(spelling, "HELD", held)
        got = spelling.count_words(awkward, least_length=2, least_count=1)
        assert {r.word: r.n for r in got.collect()} == plain.word_counts(plain_docs, 2, 1)
    every = spark.createDataFrame([(k, "The CaféÉ× zebra-STRIPES x" + "y" * 3000) for k in range(400)], "doc_id long, text string")
    want = plain.word_counts([(r.doc_id, r.text) for r in every.collect()], 1, 1)
    assert len(want) > 10 and {r.word: r.n for r in spelling.count_words(every, least_length=1, least_count=1).collect()} == want
    assert spelling.variants(spelling.count_words(no_docs)).collect() == []


def test_spelling_query_equals_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = plain.variants(plain.word_counts([tuple(r) for r in docs]))
    assert rows(queries.op12_spelling(spark, sf), "word", "form", "root", "n", "n_near", "form_n") == ordered(want)


def test_forms_are_followed_to_their_last(spark):
    n = {"a" * 5 + chr(97 + k): 6**k for k in range(20)} | {"bbbbbb": 1}
    chain = {f"{chr(97 + k)}xxxxx"[:5] + "y" * k: 6**k for k in range(12)}
    for words in (n, chain):
        got = spelling.variants(spark.createDataFrame([*words.items()], "word string, n long"))
        assert rows(got, "word", "form", "root", "n", "n_near", "form_n") == ordered(plain.variants(words))


# -- ranked search ---------------------------------------------------------------------------

ITEMS = "item_id long, text string, doc_id long, score long, rank int"


@pytest.fixture(scope="module")
def asked(spark):
    some = [(1, PASSAGE), (1, PASSAGE), (2, "one TWO two two"), (3, None), (4, ""), (5, "!!"), (None, "river mill ha"), (6, "w1 w2 w3 w399 changed"), (7, "café 漢字"), (2, "ha"), (8, "nowhere")]
    some.append((9, " ".join(f"w{i}" for i in range(150)) + " river the the"))
    return spark.createDataFrame([(a, b, 0, 0, 0) for a, b in some], ITEMS)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 1, "ranked_bytes": 1}, {"top": 2}])
def test_search_equals_plain_ranking(awkward, plain_docs, asked, options):
    got = rows(ranked_search.search(awkward, asked, **options), "item_id", "rank", "doc_id", "score")
    assert got == ordered(plain.ranked(plain_docs, [(r.item_id, r.text) for r in asked.collect()], options.get("top", 10)))


def test_search_of_nothing(awkward, no_docs, asked, spark):
    assert ranked_search.search(no_docs, asked).count() == 0
    assert ranked_search.search(awkward, spark.createDataFrame([], ITEMS)).count() == 0
    assert ranked_search.search(awkward.where("doc_id = 8"), asked).count() == 0


@given(st.data())
@settings(max_examples=150, deadline=None)
def test_masks_lose_no_document(data):
    n_docs, n_terms, top = data.draw(st.integers(1, 60)), data.draw(st.sampled_from([1, 3, 70])), data.draw(st.integers(1, 5))
    rng = np.random.default_rng(data.draw(st.integers(0, 1000)))
    impact = rng.integers(1, 6, (n_terms, n_docs)) * (rng.random((n_terms, n_docs)) < 0.3)
    worth = rng.integers(0, 4, n_terms)
    postings = [(np.flatnonzero(row), row[row > 0]) for row in impact]
    starts = np.cumsum([0, *(len(d) for d, _ in postings)])
    best = ranked_search.Best(top)
    docs, named = rng.integers(0, 30, n_docs), rng.random(n_docs) < 0.9
    half = n_docs // 2
    for part in (np.arange(half), np.arange(half, n_docs)):  # in two blocks
        lists = [np.flatnonzero(row[part]) for row in impact]
        starts = np.cumsum([0, *map(len, lists)])
        of = np.concatenate(lists).astype(np.int64)
        score = np.concatenate([row[part][x] for row, x in zip(impact, lists, strict=True)])
        ranked_search.rank_block(best, np.arange(n_terms), worth, starts, of, score, docs[part], named[part])
    total = worth @ impact
    want = sorted((-int(s), not m, int(d)) for s, d, m in zip(total, docs, named, strict=True) if s > 0)[:top]
    assert [(-int(s), not m, int(d)) for s, d, m in zip(best.scores, best.docs, best.named, strict=True)] == want


def test_search_stops_before_most_masks():
    """One document far above the others: after it no mask of a single common term is scored."""
    own = np.array([0, 1])
    doc_of = np.concatenate([np.arange(1000), [0]])
    best = ranked_search.Best(1)
    done = ranked_search.rank_block(best, own, np.array([1, 50]), np.array([0, 1000, 1001]), doc_of, np.full(1001, 9), np.arange(1000), np.ones(1000, bool))
    assert done == 1 and best.docs.tolist() == [0] and best.scores.tolist() == [9 * 51]
