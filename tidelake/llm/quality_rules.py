"""Line-first cleaning: rules per line, then a verdict on what is left.

A line fails if it does not end as a sentence does, if it reads like navigation
(mostly short pieces between separators), if it holds a boilerplate phrase, if it
is mostly symbols, or if it shouts.  Failing lines go; a document is rejected if
more than half of its characters go with them.  Repetition is measured on whole
texts before.  Only built-in expressions are used, and nothing is shuffled: each
row is judged alone.

Defined results: a null, empty or blank text has no words and fails the base
rules; ids may be null or repeat, each row is judged; an empty table gives an
empty table.  Columns of the result replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, strip_spaces, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_SHARE = 0.5
MAX_LOST_SHARE = 0.5
ENDS_AS_SENTENCE = r"""[.!?…。！？][\x22'”’»)\]]*$"""
BOILERPLATE = (
    r"(?i)(all rights reserved|privacy policy|terms of (use|service)|accept (all )?cookies|uses cookies"
    r"|javascript (is )?(disabled|required)|enable javascript|click here to|sign up for our newsletter"
    r"|subscribe to our|lorem ipsum)"
)
SEPARATORS = r"\s[|»›•·>]\s"


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _window_hashes(tokens: Column) -> Column:
    """A hash for each three-word window; none for texts with a single window."""
    n = F.size(tokens)
    hashes = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2))
    )
    return F.when(n >= 4, hashes).otherwise(F.array().cast("array<bigint>"))


def _placed(hashes: Column) -> Column:
    """Hashes with their places, sorted, so that equal ones are neighbours."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _covered(placed: Column) -> Column:
    """Number of words in windows whose hash is that of a neighbour."""
    here = F.transform(
        placed,
        lambda x, j: F.when(
            F.coalesce(F.get(placed, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(placed, j + 1)["h"] == x["h"], F.lit(False)),
            x["i"],
        ),
    )
    first = F.filter(here, lambda i: i.isNotNull())
    second, third = F.transform(first, lambda i: i + 1), F.transform(first, lambda i: i + 2)
    return F.size(F.array_union(F.array_union(first, second), third))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("__tl_words", words(body)).withColumn("__tl_hashes", _window_hashes(F.col("__tl_words")))
    # Texts without an equal pair, which a hash set tells, skip the sort.
    some = F.size(F.array_distinct("__tl_hashes")) < F.size("__tl_hashes")
    step = step.withColumn("__tl_placed", F.when(some, _placed(F.col("__tl_hashes"))))
    filled = F.filter(F.split(body, "\n", -1), lambda x: strip_spaces(x) != "")
    return step.withColumns(
        {
            "n_words": F.size("__tl_words").cast("long"),
            "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
            "n_symbols": _count_chars(body, SYMBOLS).cast("long"),
            "n_dup_lines": (F.size(filled) - F.size(F.array_distinct(filled))).cast("long"),
            "n_repeat_words": F.when(F.col("__tl_placed").isNull(), F.lit(0))
            .otherwise(_covered(F.col("__tl_placed")))
            .cast("long"),
        }
    ).drop("__tl_words", "__tl_hashes", "__tl_placed")


def line_passes(line: Column) -> Column:
    """True for a line that is kept; ``line`` has no spaces at its ends."""
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    pieces = F.size(F.split(line, SEPARATORS, -1))
    return (
        line.rlike(ENDS_AS_SENTENCE)
        & (pieces < 4)
        & ~line.rlike(BOILERPLATE)
        & (10 * _count_chars(line, SYMBOLS) <= F.length(line))
        & ((letters < 20) | (2 * capitals <= letters))
    )


def clean_lines(docs: DataFrame, max_lost_share: float = MAX_LOST_SHARE, text: str = "text") -> DataFrame:
    """All columns and the measures, clean_text, lost_chars, base_failed, kept.

    clean_text is the text without its failing lines; blank lines stay.
    """
    out = measure(docs, text)
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    out = out.withColumn("__tl_lines", F.transform(lines, lambda x: F.struct(x.alias("raw"), strip_spaces(x).alias("bare"))))
    out = out.withColumn("__tl_fine", F.filter("__tl_lines", lambda x: (x["bare"] == "") | line_passes(x["bare"])))

    def chars(column: str) -> Column:
        return F.length(F.array_join(F.transform(column, lambda x: x["bare"]), ""))

    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") > F.lit(MAX_REPEATED_SHARE) * F.col("n_words")
    )
    out = out.withColumns(
        {
            "clean_text": F.array_join(F.transform("__tl_fine", lambda x: x["raw"]), "\n"),
            "lost_chars": (chars("__tl_lines") - chars("__tl_fine")).cast("long"),
            "__tl_chars": chars("__tl_lines"),
            "base_failed": base_failed,
        }
    )
    lost_too_much = F.col("lost_chars") > F.lit(max_lost_share) * F.col("__tl_chars")
    return out.withColumn("kept", ~F.col("base_failed") & ~lost_too_much).drop("__tl_lines", "__tl_fine", "__tl_chars")
