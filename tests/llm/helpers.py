"""Plain-Python versions of the contracts, and awkward rows, for the corpus operators' tests."""

import re

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SF = "/root/testdata/sf0.001"


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def documents(spark, rows):
    """rows: (doc_id, text) pairs, with the other columns of documents."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


LONG = "lorem ipsum dolor sit amet " * 20_000

AWKWARD = [(1, None), (2, ""), (3, "  \n"), (4, "?!"), (5, "One"), (5, "One"), (None, "no id here"), (6, "é" * 3000),
           (7, "a" * 70_000), (8, LONG), (9, "\x00\x1c tab\tend"), (10, "日本語 テスト 🎉"), (11, "One"),
           (12, "The quick brown fox jumps over the lazy dog again and again until it is done")]


def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns named like results."""
    rows = [(i, t, None, None, None, "x", 7) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score string, spans int")


def empty(spark):
    return awkward(spark).where("false")
