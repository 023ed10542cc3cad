"""Line dedup and quality rules against plain Python and, over a whole table, against SQL."""

import collections
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LOWER, WORDS, sha
from tidelake.llm import line_dedup, quality_rules
from tidelake.llm.oracles import ORACLES
from tidelake.llm.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
LONG = "A line that is certainly long enough to be counted, number one."


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(map(str, cursor.fetchall()))
    got = REGISTRY[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(str(tuple(r)) for r in got) == expected


def python_line_dedup(rows):
    keys = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= 40:
                keys[key].add(doc)
    hot = {k: max(d for d in ids if d is not None) for k, ids in keys.items() if len(ids) >= 5}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if hot.get(x.strip(SPACES).translate(LOWER), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return collections.Counter(out)


def test_line_dedup(docs):
    rows = [(i, f"own line {i}\n  {LONG.upper() if i % 2 else LONG}\t\n{LONG}\nend") for i in range(6)]
    rows += [(6, None), (7, ""), (8, "short\nshort"), (9, LONG), (9, LONG), (None, f"{LONG}\nx")]
    rows += [(i, "shared, but by four documents only: not enough of them") for i in range(20, 24)]
    found = line_dedup.drop_repeated_lines(docs(rows))
    got = found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    assert collections.Counter(map(tuple, got.collect())) == python_line_dedup(rows)


def test_line_dedup_edges(awkward, clashing, nothing):
    assert line_dedup.drop_repeated_lines(nothing).collect() == []
    for df in (awkward, clashing):
        out = line_dedup.drop_repeated_lines(df)
        assert out.count() == df.count()
        assert out.where("n_dropped > 0").isEmpty()
        assert out.where("doc_id = 1").first().text is None
    assert line_dedup.drop_repeated_lines(clashing).first()["part"] == "own"


def python_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


def test_measures(docs, awkward):
    texts = ["a b c a b c a b c", "a b c d\na b c d\n\n", "x " * 70, "one two", "a b c", "## **  || <>"]
    rows = [*((i, t) for i, t in enumerate(texts)), *((r.doc_id, r.text) for r in awkward.collect())]
    out = quality_rules.clean_lines(docs(rows)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = collections.Counter((r.doc_id, *(r[f] for f in fields)) for r in out)
    assert got == collections.Counter((i, *python_measures(t)) for i, t in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_line_first_cleaning(docs):
    chance = random.Random(1)

    def line(form, n=8):
        return form.format(" ".join("".join(chance.choices("aeioulmnrst", k=6)) for _ in range(n)))

    prose = "\n".join(line("So {}.") for _ in range(12))
    menu = "\n".join(line("{}").replace(" ", " | ") for _ in range(12))
    shout = "\n".join(line("{}!").upper() for _ in range(12))
    out = quality_rules.clean_lines(docs([(1, prose), (2, menu), (3, f"{prose}\nAll rights reserved."), (4, shout)]))
    rows = {r.doc_id: r for r in out.collect()}
    assert [rows[i].kept for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert rows[1].clean_text == rows[3].clean_text == prose


def test_quality_edges(clashing, nothing):
    assert quality_rules.clean_lines(nothing).collect() == []
    out = quality_rules.clean_lines(clashing)
    assert out.count() == clashing.count() and out.first()["shard"] == "own"
    assert dict(out.dtypes)["kept"] == "boolean"
