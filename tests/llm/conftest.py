"""Small tables with every awkward case: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

import os

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, body string, key long, node long, t string"


def doc(i, text, extra="x"):
    return (i, text, "en", extra, len(text) if text is not None else None, extra, extra, 1, 2, extra)


PASSAGE = "The river turns north below the old mill and carries grain boats past the quiet towns. Nobody in the valley remembers when the bridge was built or who paid for its stones. Every spring the water climbs over the lower road and the ferry takes the children to school instead."
OTHER = "A printer in the harbour district keeps a ledger of every ship that ever asked for charts. Its pages list masters, cargoes and the weather they complained about while waiting for the ink to dry. Some names return each summer and others only once."


@pytest.fixture(scope="session")
def awkward(spark):
    words = " ".join(f"w{i}" for i in range(400))
    rows = [
        doc(1, f"Prelude alpha beta gamma delta. {PASSAGE} Coda one two three four."),
        doc(2, f"{OTHER} Something in between that is new. {PASSAGE}"),
        doc(3, OTHER),
        doc(4, OTHER),
        doc(4, OTHER),
        doc(5, words),
        doc(6, words.replace("w200 ", "changed ")),
        doc(7, words.replace("w200 ", "changed ").replace("w20 ", "other ")),
        doc(8, None),
        doc(9, ""),
        doc(10, " \n\t "),
        doc(None, "no id at all but some text here"),
        doc(None, None),
        doc(11, "one two"),
        doc(12, "One TWO"),
        doc(13, "ha " * 300),
        doc(14, "x" * 5000),
        doc(15, "caf\u00e9 na\u00efve \u6f22\u5b57 \U0001f600 text. " * 30),
        doc(16, " ".join(f"long{i} word{i % 97}." for i in range(20000))),
        doc(17, "zero\0byte and <|endoftext|> and \u00a0 spaces\u2003here"),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def plain_docs(awkward):
    return [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return SF


def rows(df, *cols):
    """The rows as sorted tuples (nulls first)."""
    return ordered(tuple(r) for r in df.select(*cols).collect())


def ordered(some):
    return sorted(some, key=lambda r: tuple((x is not None, str(type(x)), x) if not isinstance(x, list) else (True, "", str(x)) for x in r))
