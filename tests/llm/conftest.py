import hashlib
import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture
def docs(spark):
    """A frame of documents from (id, text) pairs, or (id, text, source)."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def awkward(docs):
    """Nulls, empty, blank and very long texts, a null id, repeated rows."""
    return docs(
        [
            (1, None),
            (2, ""),
            (3, " \n\t \n"),
            (4, "word " * 60_000 + "x" * 300_000),
            (5, "A repeated row of some length, with words enough for a shingle or two.\nAnd a line."),
            (5, "A repeated row of some length, with words enough for a shingle or two.\nAnd a line."),
            (None, "A text without an id, that is otherwise like the others are."),
            (7, "one"),
            (8, "zwei Wörter hier dort 日本語 🙂"),
        ]
    )


@pytest.fixture
def clashing(awkward):
    """Extra columns named as the operators name their own."""
    from pyspark.sql import functions as F

    names = ("n_lines n_dropped kept score key print bands bin part shard size target draws block _doc component "
             "hits body start stop n_words _words lead")
    return awkward.withColumns({name: F.lit("own") for name in names.split()})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
