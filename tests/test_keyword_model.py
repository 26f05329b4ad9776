"""The native keyword pipeline against a plain-Python model of the rules on random texts.

The model is written independently of the regular expressions in ``keywords.py``: character
classes are tested by code point ranges, the rest by plain string checks.
"""

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.functions.keywords import extract_keywords, keyword_array

# The lists and character ranges of the rules, as the job must apply them.
KEEP_SINGLE = set("亀長黒戸竜西青鬼")
STOP_SINGLE_EXTRA = set("のにはがとて年月日時分秒火水木金土様方\\*")
NOUN_STOP = {"こと", "もの", "www", "http", "https"}


def allowed_char(c):
    o = ord(c)
    return (c.isascii() and c.isalnum()) or 0x3041 <= o <= 0x3093 or o == 0x30FC or 0x30A1 <= o <= 0x30F6 \
        or 0xFF71 <= o <= 0xFF9D or c in "ﾞﾟ" or 0x4E00 <= o <= 0x9FA0


def single_stop(c):
    o = ord(c)
    in_class = (c.isascii() and c.isalnum()) or 0x3041 <= o <= 0x3093 or 0x30A1 <= o <= 0x30F6 \
        or 0xFF71 <= o <= 0xFF9D or c in "ﾞﾟ" or c in STOP_SINGLE_EXTRA or 0x30FC <= o <= 0x5341
    return in_class and c not in KEEP_SINGLE


def model(text):
    text = regex.sub(r"https://t.co/[0-9a-zA-Z]+", "", text)
    out = []
    for w in regex.findall(r"[\p{L}\p{N}]+", text):
        if len(w) > 32 or not all(allowed_char(c) for c in w):
            continue
        if len(w) == 1 and single_stop(w):
            continue
        if w in NOUN_STOP or (w.isascii() and w.isdigit()):
            continue
        out.append(w)
    return out


ALPHABET = list("abcXYZ019 ,.-/:\n") + list("あいのはー") + list("アヴヶｱﾝﾞ") + list("人水十海亀長犬々é")
texts = st.lists(st.one_of(st.text(alphabet=ALPHABET, max_size=12),
                           st.sampled_from(["https://t.co/Ab1", "https://t.co/", "www", "http", "こと", "123",
                                            "a" * 33, "b" * 32, " "])),
                 max_size=8).map("".join)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=15))
def test_pipeline_matches_model(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "i int, text string")
    got = {}
    for r in extract_keywords(df, "text", ["i"]).collect():
        got.setdefault(r["i"], []).append(r["keyword"])
    arrays = {r["i"]: r["k"] for r in df.select("i", keyword_array(F.col("text")).alias("k")).collect()}
    for i, text in enumerate(batch):
        expected = model(text)
        assert sorted(got.get(i, [])) == sorted(expected), text
        assert arrays[i] == expected, text
