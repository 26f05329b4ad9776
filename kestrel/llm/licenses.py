"""License scans by ordered signature rules, with DataFrame functions alone.

A text's lower-case words are written as `` w `` each (a space on both sides), so that a rule's words
stand side by side without sharing a space. ``RULES`` holds the hand-written signatures, one line per
license; a rule's pattern is a row of word patterns, where ``?`` makes a word optional.

Texts without any of the ``STEMS`` cannot match and are not looked at further. For the others, only
the rules whose keyword (the longest plain word of the pattern) is in the text are tried. All their
matches are put in order of place, and a sweep resolves overlaps: a match inside another one is
suppressed; of two that overlap in part the one of higher priority stays, the earlier one on a tie.

Defined cases: a null or empty text has no words and no labels; repeated rows give repeated results;
other columns of the input are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import named

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: numbers that are summed up at once
CHUNK = 256

#: phrases whose every place counts, and their labels
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: every pattern needs a word with one of these in it, or two words with them
STEMS = ("licen", "cc", "gpl", "copyright", "reserved", "copyleft", "spdx", "warrant", "creative", "domain", "permission", "redistribut", "copying")

# label | priority | confidence | pattern ; pattern ; ...
# Each alternative in parentheses stands for one word. "n" numbers such as 2.0 are the words "2" "0".
RULES_TEXT = """
gpl-1.0 | 70 | 0.9 | gnu general public license (version|v)? (1|v1) 0? ; spdx license identifier gpl 1 0 ; licensed under the? gpl (v1|1) 0?
gpl-2.0 | 80 | 0.95 | gnu general public license as published by the free software foundation either? version 2 ; gnu general public license (version|v)? (2|v2) 0? ; gpl (version|v)? 2 0? license ; licensed under the? (gpl|gplv2) (version|v)? (2|v2)? ; spdx license identifier gpl 2 0 (only)? ; gpl 2 0 only license ; under the terms of the gplv2 license
gpl-2.0-or-later | 85 | 0.95 | gnu general public license version 2 or at your option any later version ; either version 2 of the license or at your option any later version ; spdx license identifier gpl 2 0 or later ; gpl 2 0 or later license ; gnu general public license v2 or later
gpl-3.0 | 80 | 0.95 | gnu general public license as published by the free software foundation either? version 3 ; gnu general public license (version|v)? (3|v3) 0? ; gpl (version|v)? 3 0? license ; licensed under the? (gpl|gplv3) (version|v)? (3|v3) ; spdx license identifier gpl 3 0 (only)? ; gpl 3 0 only license ; under the terms of the gplv3 license
gpl-3.0-or-later | 85 | 0.95 | gnu general public license version 3 or at your option any later version ; either version 3 of the license or at your option any later version ; spdx license identifier gpl 3 0 or later ; gpl 3 0 or later license ; gnu general public license v3 or later
gpl | 40 | 0.6 | gnu general public license ; gnu gpl license ; gpl license ; licensed under the? gpl ; released under the? gpl license ; distributed under the? gpl license
lgpl-2.0 | 80 | 0.9 | gnu library general public license ; lgpl (version|v)? 2 0? license ; spdx license identifier lgpl 2 0 (only)?
lgpl-2.1 | 80 | 0.95 | gnu lesser general public license (version|v)? (2|v2) 1 ; lgpl (version|v)? 2 1 license ; spdx license identifier lgpl 2 1 (only)? ; licensed under the? lgpl (version|v)? (2|v2) 1 ; either version 2 1 of the license or at your option any later version
lgpl-3.0 | 80 | 0.95 | gnu lesser general public license (version|v)? (3|v3) 0? ; lgpl (version|v)? 3 0? license ; spdx license identifier lgpl 3 0 (only)? ; licensed under the? lgpl (version|v)? (3|v3)
lgpl | 45 | 0.65 | gnu lesser general public license ; lesser general public license ; gnu lgpl license ; lgpl license ; licensed under the? lgpl
agpl-3.0 | 82 | 0.95 | gnu affero general public license (version|v)? (3|v3) 0? ; agpl (version|v)? 3 0? license ; spdx license identifier agpl 3 0 (only)? ; licensed under the? (agpl|agplv3) ; agplv3 license
agpl | 46 | 0.65 | gnu affero general public license ; affero general public license ; agpl license
gfdl-1.3 | 70 | 0.9 | gnu free documentation license (version|v)? 1 (1|2|3) ; gnu free documentation license ; spdx license identifier gfdl 1 (1|2|3) ; gfdl license
apache-1.1 | 75 | 0.9 | apache software license (version|v)? 1 1 ; apache license (version|v)? 1 1 ; spdx license identifier apache 1 1
apache-2.0 | 80 | 0.95 | licensed under the apache license version 2 0 ; apache license (version|v)? (2|v2) 0? ; apache (version|v)? 2 0? license ; spdx license identifier apache 2 0 ; licensed under the? apache (2|v2) 0? ; www apache org licenses license 2 0 ; apache public license 2 0 ; apache software license (version|v)? 2 0?
apache | 40 | 0.6 | apache license ; apache software license ; licensed under the? apache ; apache public license
mit | 50 | 0.9 | permission is hereby granted free of charge to any person obtaining a copy ; spdx license identifier mit ; licensed under the? mit license ; the mit license mit ; opensource org licenses mit ; released under the? mit license ; distributed under the? mit license ; license mit
mit | 40 | 0.6 | mit license ; expat license ; mit x11 license ; mit expat license
mit-0 | 70 | 0.9 | mit no attribution license ; spdx license identifier mit 0 ; mit 0 license
x11 | 60 | 0.85 | x11 license ; x consortium license ; spdx license identifier x11
isc | 60 | 0.9 | permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted ; isc license ; spdx license identifier isc ; licensed under the? isc
bsd-2-clause | 75 | 0.95 | bsd 2 clause license ; 2 clause bsd license ; simplified bsd license ; freebsd license ; spdx license identifier bsd 2 clause ; two clause bsd license ; licensed under the? bsd 2 clause ; opensource org licenses bsd 2 clause
bsd-3-clause | 75 | 0.95 | bsd 3 clause license ; 3 clause bsd license ; new bsd license ; modified bsd license ; revised bsd license ; spdx license identifier bsd 3 clause ; three clause bsd license ; licensed under the? bsd 3 clause ; opensource org licenses bsd 3 clause
bsd-4-clause | 75 | 0.95 | bsd 4 clause license ; 4 clause bsd license ; original bsd license ; spdx license identifier bsd 4 clause ; four clause bsd license
bsd | 42 | 0.65 | bsd license ; bsd style license ; berkeley software distribution license ; licensed under the? bsd ; redistribution and use in source and binary forms with or without modification are permitted
0bsd | 70 | 0.9 | zero clause bsd license ; spdx license identifier 0bsd ; 0bsd license ; bsd zero clause license
mpl-1.1 | 78 | 0.95 | mozilla public license (version|v)? 1 1 ; mpl (version|v)? 1 1 license ; spdx license identifier mpl 1 1
mpl-2.0 | 80 | 0.95 | mozilla public license (version|v)? (2|v2) 0? ; mpl (version|v)? 2 0 license ; spdx license identifier mpl 2 0 ; subject to the terms of the mozilla public license ; licensed under the? mpl (2|v2) 0?
mpl | 44 | 0.65 | mozilla public license ; mpl license
epl-1.0 | 78 | 0.95 | eclipse public license (version|v)? (1|v1) 0? ; epl (version|v)? 1 0 license ; spdx license identifier epl 1 0 ; eclipse org legal epl v10 html license
epl-2.0 | 78 | 0.95 | eclipse public license (version|v)? (2|v2) 0? ; epl (version|v)? 2 0 license ; spdx license identifier epl 2 0
epl | 44 | 0.65 | eclipse public license ; epl license
cddl-1.0 | 76 | 0.9 | common development and distribution license (version|v)? 1 0 ; common development and distribution license ; cddl license ; spdx license identifier cddl 1 (0|1)
cpl-1.0 | 74 | 0.9 | common public license (version|v)? 1 0 ; common public license ; spdx license identifier cpl 1 0
eupl-1.2 | 74 | 0.9 | european union public licence (version|v)? 1 (1|2) ; european union public (licence|license) ; eupl (licence|license) ; spdx license identifier eupl 1 (1|2)
artistic-1.0 | 72 | 0.9 | artistic license (version|v)? 1 0 ; spdx license identifier artistic 1 0
artistic-2.0 | 74 | 0.95 | artistic license (version|v)? 2 0 ; spdx license identifier artistic 2 0 ; perl artistic license 2 0
artistic | 44 | 0.6 | artistic license ; same terms as perl itself license
zlib | 60 | 0.9 | zlib license ; zlib libpng license ; spdx license identifier zlib ; zlib acknowledgement license
libpng | 60 | 0.9 | libpng license ; png reference library license ; spdx license identifier libpng (2)?
bsl-1.0 | 64 | 0.95 | boost software license (version|v)? 1 0 ; boost software license ; spdx license identifier bsl 1 0 ; www boost org license 1 0 txt
busl-1.1 | 64 | 0.95 | business source license (version|v)? 1 1 ; business source license ; spdx license identifier busl 1 1
sspl-1.0 | 64 | 0.95 | server side public license (version|v)? 1? ; spdx license identifier sspl 1 0 ; sspl license
elastic-2.0 | 64 | 0.95 | elastic license (version|v)? 2 0? ; elastic license ; spdx license identifier elastic 2 0
unlicense | 64 | 0.95 | free and unencumbered software released into the public domain ; the unlicense ; spdx license identifier unlicense ; unlicense org license?
wtfpl | 60 | 0.9 | do what the fuck you want to public license ; wtfpl license ; spdx license identifier wtfpl
python-2.0 | 62 | 0.9 | python software foundation license (version|v)? 2? ; psf license ; python license 2 0 ; spdx license identifier (psf|python) 2 0
ruby | 58 | 0.85 | ruby license ; same license as ruby ; spdx license identifier ruby
php-3.01 | 62 | 0.9 | php license (version|v)? 3 (0|01) ; php license ; spdx license identifier php 3 (0|01)
postgresql | 62 | 0.9 | postgresql license ; spdx license identifier postgresql
openssl | 62 | 0.9 | openssl license ; openssl ssleay license ; spdx license identifier openssl
curl | 58 | 0.85 | curl license ; spdx license identifier curl
ncsa | 62 | 0.9 | university of illinois ncsa open source license ; ncsa open source license ; spdx license identifier ncsa
afl-3.0 | 62 | 0.9 | academic free license (version|v)? 3 0? ; academic free license ; spdx license identifier afl 3 0
osl-3.0 | 62 | 0.9 | open software license (version|v)? 3 0? ; open software license ; spdx license identifier osl 3 0
ms-pl | 62 | 0.9 | microsoft public license ; spdx license identifier ms pl ; ms pl license
ms-rl | 62 | 0.9 | microsoft reciprocal license ; spdx license identifier ms rl ; ms rl license
ecl-2.0 | 62 | 0.9 | educational community license (version|v)? 2 0? ; spdx license identifier ecl 2 0
upl-1.0 | 62 | 0.9 | universal permissive license (version|v)? 1 0? ; spdx license identifier upl 1 0
ofl-1.1 | 64 | 0.95 | sil open font license (version|v)? 1 1 ; open font license ; spdx license identifier ofl 1 1
odbl-1.0 | 64 | 0.9 | open database license (version|v)? 1 0? ; open data commons open database license ; odbl license ; spdx license identifier odbl 1 0
pddl-1.0 | 62 | 0.9 | public domain dedication and license ; pddl license ; spdx license identifier pddl 1 0
odc-by-1.0 | 62 | 0.9 | open data commons attribution license ; odc by license ; spdx license identifier odc by 1 0
cdla-permissive-2.0 | 62 | 0.9 | community data license agreement permissive ; spdx license identifier cdla permissive 2 0
cc0-1.0 | 72 | 0.95 | cc0 1 0 universal license? ; cc0 license ; creative commons zero license? ; creative commons cc0 ; spdx license identifier cc0 1 0 ; creativecommons org publicdomain zero 1 0
cc-by-1.0 | 73 | 0.9 | cc by 1 0 ; creative commons attribution 1 0 ; creativecommons org licenses by 1 0 ; spdx license identifier cc by 1 0
cc-by-2.0 | 73 | 0.9 | cc by 2 0 ; creative commons attribution 2 0 ; creativecommons org licenses by 2 0 ; spdx license identifier cc by 2 0
cc-by-2.5 | 73 | 0.9 | cc by 2 5 ; creative commons attribution 2 5 ; creativecommons org licenses by 2 5 ; spdx license identifier cc by 2 5
cc-by-3.0 | 73 | 0.9 | cc by 3 0 ; creative commons attribution 3 0 ; creativecommons org licenses by 3 0 ; spdx license identifier cc by 3 0
cc-by-4.0 | 73 | 0.95 | cc by 4 0 ; creative commons attribution 4 0 international? ; creativecommons org licenses by 4 0 ; spdx license identifier cc by 4 0
cc-by-sa-3.0 | 76 | 0.95 | cc by sa 3 0 ; creative commons attribution sharealike 3 0 ; creative commons attribution share alike 3 0 ; creativecommons org licenses by sa 3 0 ; spdx license identifier cc by sa 3 0
cc-by-sa-4.0 | 76 | 0.95 | cc by sa 4 0 ; creative commons attribution sharealike 4 0 international? ; creative commons attribution share alike 4 0 ; creativecommons org licenses by sa 4 0 ; spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | 76 | 0.95 | cc by nc 4 0 ; creative commons attribution noncommercial 4 0 international? ; creative commons attribution non commercial 4 0 ; creativecommons org licenses by nc 4 0 ; spdx license identifier cc by nc 4 0
cc-by-nc-3.0 | 76 | 0.95 | cc by nc 3 0 ; creative commons attribution noncommercial 3 0 ; creativecommons org licenses by nc 3 0
cc-by-nd-4.0 | 76 | 0.95 | cc by nd 4 0 ; creative commons attribution noderivatives 4 0 international? ; creativecommons org licenses by nd 4 0 ; spdx license identifier cc by nd 4 0
cc-by-nc-sa-4.0 | 78 | 0.95 | cc by nc sa 4 0 ; creative commons attribution noncommercial sharealike 4 0 international? ; creativecommons org licenses by nc sa 4 0 ; spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 | 78 | 0.95 | cc by nc nd 4 0 ; creative commons attribution noncommercial noderivatives 4 0 international? ; creativecommons org licenses by nc nd 4 0 ; spdx license identifier cc by nc nd 4 0
cc-by-sa | 52 | 0.7 | cc by sa ; creative commons attribution sharealike ; creative commons attribution share alike
cc-by-nc | 52 | 0.7 | cc by nc ; creative commons attribution noncommercial ; creative commons attribution non commercial
cc-by-nd | 52 | 0.7 | cc by nd ; creative commons attribution noderivatives ; creative commons attribution no derivatives
cc-by | 40 | 0.6 | cc by ; creative commons attribution license?
cc | 36 | 0.5 | creative commons license ; licensed under a? creative commons ; creativecommons org licenses
public-domain | 50 | 0.75 | released into the public domain ; dedicated to the public domain ; this work is in the public domain ; public domain dedication
proprietary | 34 | 0.5 | all rights reserved ; proprietary license ; confidential and proprietary all rights reserved ; commercial license agreement ; end user license agreement ; no license is granted
copyright-notice | 20 | 0.3 | copyright (c|19[0-9][0-9]|20[0-9][0-9]) ; copyright (c)? (19[0-9][0-9]|20[0-9][0-9]) ; copyright notice and this permission notice
no-warranty | 24 | 0.4 | provided as is without warranty of any kind ; without any warranty without even the implied warranty ; as is without warranty
"""


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


def word_pattern(words: str) -> str:
    """A row of word patterns as a regular expression over `` w `` words."""
    out = []
    for word in words.split():
        plain = word.removesuffix("?")
        group = plain if plain.startswith("(") else re.escape(plain)
        group = "(?:" + plain[1:] if plain.startswith("(") else group
        out.append(f"(?: {group} )?" if word != plain else f" {group} ")
    return "".join(out)


def keyword(words: str) -> str:
    """The longest plain word that the pattern cannot do without."""
    return max((w for w in words.split() if w.isalnum()), key=lambda w: (len(w), w))


def rules() -> list[Rule]:
    out = []
    for line in RULES_TEXT.strip().splitlines():
        label, priority, confidence, patterns = (x.strip() for x in line.split("|", 3))
        for words in patterns.split(";"):
            out.append(Rule(label, int(priority), float(confidence), keyword(words), word_pattern(words)))
    return out


def n_words_in(spaced: Column) -> Column:
    """Number of words in a piece of `` w `` words: half its spaces."""
    return ((F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" ")))) / 2).cast("long")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` refers to it (also inside a function
    that is applied to the elements of an array)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(lengths: Column) -> Column:
    """The sum of an array's numbers up to each place. Sums are taken in chunks and the chunks' sums are
    added afterwards, so no array grows by a number at a time and the work is linear in its size."""
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("sum"), none.alias("sums"))
    add = lambda made, x: F.struct((made["sum"] + x).alias("sum"), F.concat(made["sums"], F.array(made["sum"] + x)).alias("sums"))
    running = lambda numbers: F.aggregate(numbers, start, add, lambda made: made["sums"])

    def in_chunks(numbers: Column) -> Column:
        last = F.ceil(F.size(numbers) / CHUNK).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: running(F.slice(numbers, k * CHUNK + 1, CHUNK)))

    def moved(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.coalesce(F.try_element_at(c, F.lit(-1)), F.lit(0)))
        before = F.slice(running(F.concat(F.array(F.lit(0)), totals)), F.lit(1), F.size(chunks))
        return F.flatten(F.zip_with(chunks, before, lambda c, plus: F.transform(c, lambda x: x + plus)))

    return bound(lengths, lambda numbers: bound(in_chunks(numbers), moved))


def match_list(words: Column, rule: Column) -> Column:
    """All matches of a rule: (start, -end, -priority, label, confidence), the order of the sweep."""
    def listed(found: Column) -> Column:
        pieces = F.slice(F.split(words, rule["pattern"], -1), F.lit(1), F.size(found))
        lengths = F.zip_with(pieces, found, lambda p, m: F.length(p) + F.length(m))
        return F.zip_with(running_sums(lengths), found, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), (-end).alias("last"), (-rule["priority"]).alias("rank"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    return bound(F.regexp_extract_all(words, rule["pattern"], F.lit(0)), listed)


def swept(matches: Column) -> Column:
    """(labels, score) of the matches that no other one suppresses; ``matches`` in sweep order."""
    none = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("last"), F.lit(0).alias("rank"),
                    F.lit("").alias("label"), F.lit(0.0).alias("confidence"))
    start = F.struct(F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), none.alias("open"))

    def settle(made):
        """The open match is out of reach of all later ones: it stays."""
        return F.when(made["open"]["start"] < 0, made["labels"]).otherwise(
            F.array_union(made["labels"], F.array(made["open"]["label"]))), F.greatest(made["score"], made["open"]["confidence"])

    def step(made, m):
        labels, score = settle(made)
        apart = m["start"] >= -made["open"]["last"]
        wins = ~apart & (m["last"] < made["open"]["last"]) & (m["rank"] < made["open"]["rank"])
        return F.struct(F.when(apart, labels).otherwise(made["labels"]).alias("labels"),
                        F.when(apart, score).otherwise(made["score"]).alias("score"),
                        F.when(apart | wins, m).otherwise(made["open"]).alias("open"))

    def finish(made):
        labels, score = settle(made)
        return F.struct(labels.alias("labels"), score.alias("score"))

    return F.aggregate(matches, start, step, finish)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, n_words; n_base, first_word, last_word, base_labels of the base phrases;
    matches (all rules' matches in the order of the sweep); labels (array, base ones included); score."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = docs.select(named(id_col).alias("id"), text.alias("text"))
    low = F.lower("text")
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains(low, F.lit(stem))
    rows = rows.select("id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
                       F.when(gate, F.col("text")).otherwise("").alias("text"))
    spaced = F.regexp_replace(F.translate("text", UPPER, LOWER), NOT_WORD, "  ")
    rows = rows.select("id", "n_words", F.concat(F.lit(" "), F.trim(spaced), F.lit(" ")).alias("words"))

    base = "(?:" + "|".join(word_pattern(p) for p in BASE) + ")"
    rows = rows.select("id", "n_words", "words", F.regexp_extract_all("words", F.lit(base), F.lit(0)).alias("base"),
                       F.split("words", base, -1).alias("pieces"))
    labels = F.create_map(*[F.lit(x) for phrase, label in BASE.items() for x in (word_pattern(phrase), label)])

    listed = rules()
    table = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"),
                               F.lit(f" {r.keyword} ").alias("keyword"), F.lit(r.pattern).alias("pattern")) for r in listed])
    keywords = F.array(*[F.lit(k) for k in sorted({f" {r.keyword} " for r in listed})])
    rows = rows.withColumn("present", F.when(F.length("words") > 2, F.filter(keywords, lambda k: F.contains(F.col("words"), k))))
    tried = F.when(F.size("present") > 0, F.filter(table, lambda r: F.array_contains(F.col("present"), r["keyword"])))
    rows = rows.withColumn("tried", tried)
    matches = F.array_sort(F.flatten(F.transform("tried", lambda r: match_list(F.col("words"), r))))
    rows = rows.withColumn("matches", F.coalesce(matches, F.array().cast(
        "array<struct<start: int, last: int, rank: int, label: string, confidence: double>>")))
    rows = rows.withColumn("kept", swept(F.col("matches")))

    some = F.size("base") > 0
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: labels[b])))
    rows = rows.withColumn("base_labels", base_labels)
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
        F.when(some, n_words_in(F.element_at("pieces", 1))).alias("first_word"),
        F.when(some, F.col("n_words") - n_words_in(F.element_at("pieces", -1)) - n_words_in(F.element_at("base", -1))).alias("last_word"),
        "base_labels", "matches", F.array_sort(F.array_union("base_labels", "kept.labels")).alias("labels"), F.col("kept.score").alias("score"))
