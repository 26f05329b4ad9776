"""Spelling variants of words, by a dictionary of pairs of trie nodes.

The words of a vocabulary form two tries: one of the words read forwards, whose nodes are their
prefixes, and one of the words read backwards, whose nodes are their suffixes. Every node gets an
integer. A word of length L passes the forward nodes p(0) to p(L) and the backward nodes s(0) to
s(L), where p(i) and s(i) meet in front of letter i. The dictionary holds a pair of integers for each
place: (p(i), s(i)), where a letter may be inserted, and (p(i), s(i + 1)), where letter i is skipped.

* One letter replaced: both words skip it, so they share a pair (p(i), s(i + 1)).
* One letter more: the longer word's pair that skips it is the shorter one's pair (p(i), s(i)). The
  letters of a run of equal ones give the same word when skipped; only the first of them counts.

So equal pairs are exactly the neighbours at one inserted, deleted or replaced letter, and each two
neighbours meet once. A pair is shared by at most as many words as there are letters (90 here), and
one more, so no join key is hot, whatever the vocabulary. The tries' first two levels have at most
90 + 90 * 90 nodes each way; they are broadcast, since every word passes one of them.

Words are counted over whole texts, with sums per batch before the shuffle. Node and word numbers are
drawn once and written to the shared folder, so all later steps see the same ones.

Defined cases: a null text has no words; a null id counts as an empty one; rows that repeat count as
often as they occur; of near words equal in count the first in code-point order is taken; words of any
length take part (a node deeper than 64 letters goes by its SHA-256 digest while it is numbered); an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import named, ship_package, text_column
from kestrel.llm.graph import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: words of fewer letters or occurrences are not looked at
LETTERS, OCCURRENCES = 6, 5
#: a variant's main form occurs so many times as often at least
RATIO = 5
#: a batch's counts are handed on at so many words or letters
MEMO_WORDS, MEMO_LETTERS = 300_000, 10_000_000
#: a long text is scanned in parts of about so many characters, cut between runs
PART = 1 << 20
#: deeper nodes go by a digest; the nodes of so many levels are broadcast
PLAIN_DEPTH, BROADCAST_DEPTH = 64, 2


def parts(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of about PART characters that no run crosses."""
    start = 0
    while start < len(text):
        stop = min(start + PART, len(text))
        crossing = RUN.match(text, stop)
        stop = crossing.end() if crossing else stop
        yield start, stop
        start = stop


def misspelled(run: str, key: int, every: int | None) -> str:
    """The run without its letter number ``key`` modulo its length, if ``every`` divides ``key``."""
    if every and key % every == 0:
        at = key % len(run)
        return run[:at] + run[at + 1:]
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS,
               occurrences: int = OCCURRENCES, drop_every: int | None = None) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z in lower case, with ``letters`` letters and
    ``occurrences`` occurrences or more. With ``drop_every`` a run loses a letter in the rows where that
    number divides the CRC-32 of ``<id>:<run>`` (misspellings put in at a known rate)."""
    ship_package(docs.sparkSession)
    chosen = docs.select(F.coalesce(named(id_col).cast("string"), F.lit("")).alias("id"), named(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        size = 0

        def result():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            texts = pc.ascii_lower(text_column(batch, "text"))
            for name, value in zip(batch.column("id"), texts):
                text, start_crc = value.as_py(), crc32(f"{name.as_py()}:".encode())
                for start, stop in parts(text):
                    for run, n in Counter(RUN.findall(text, start, stop)).items():
                        if len(run) >= letters:
                            word = misspelled(run, crc32(run.encode(), start_crc), drop_every)
                            if len(word) >= letters:
                                if word not in counts:
                                    size += len(word)
                                counts[word] += n
                    if len(counts) >= MEMO_WORDS or size >= MEMO_LETTERS:
                        yield result()
                        counts, size = Counter(), 0
        if counts:
            yield result()

    sums = chosen.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= occurrences)


def numbered_words(words: DataFrame) -> DataFrame:
    """(id, word, n): the words with numbers that rise in code-point order, written to the shared folder."""
    return stored(words.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def node_name(part: Column) -> Column:
    return F.when(F.length(part) <= PLAIN_DEPTH, part).otherwise(F.concat(F.lit("#"), F.sha2(part.cast("binary"), 256)))


def paths(words: DataFrame) -> DataFrame:
    """(id, n, letters, p, s): the letters of each word and the numbers of its forward and backward
    trie nodes (arrays with a place more than letters; the roots have number -1)."""
    size = F.length("word")
    ahead = words.select("id", "n", "word", F.explode(F.sequence(F.lit(1), size)).alias("at")).select(
        "id", "n", "at", F.lit(0).alias("way"), F.substring("word", F.lit(1), F.col("at")).alias("part"),
        F.substring("word", F.col("at"), F.lit(1)).alias("letter"))
    back = words.select("id", "n", "word", F.explode(F.sequence(F.lit(0), size - 1)).alias("at")).select(
        "id", "n", "at", F.lit(1).alias("way"), F.substring("word", F.col("at") + 1, size).alias("part"), F.lit("").alias("letter"))
    steps = ahead.unionAll(back).select("id", "n", "way", "at", "letter", node_name(F.col("part")).alias("name"))
    nodes = stored(steps.select("way", "name").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    top = F.length("name") <= BROADCAST_DEPTH
    met = steps.where(top).join(F.broadcast(nodes.where(top)), ["way", "name"]).unionByName(
        steps.where(~top).join(nodes.where(~top), ["way", "name"]))
    each = met.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("way", "at", "node", "letter"))).alias("steps"))
    half = (F.size("steps") / 2).cast("int")
    root = F.array(F.lit(-1).cast("long"))
    ahead, back = F.slice("steps", F.lit(1), half), F.slice("steps", half + 1, half)
    return each.select("id", "n", ahead["letter"].alias("letters"), F.concat(root, ahead["node"]).alias("p"),
                       F.concat(back["node"], root).alias("s"))


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near, near_n): for numbered words, each word's neighbours at one inserted, deleted or
    replaced letter, every neighbour once (so a link gives two rows)."""
    way = stored(paths(words), "paths")
    whole = way.select("id", "n", F.explode(F.arrays_zip("p", "s")).alias("pair")).select(
        F.col("pair.p").alias("p"), F.col("pair.s").alias("s"), F.col("id").alias("near"), F.col("n").alias("near_n"))
    places = F.sequence(F.lit(0), F.size("letters") - 1)
    skips = F.transform(places, lambda i: F.struct(
        F.get("p", i).alias("p"), F.get("s", i + 1).alias("s"),
        ((i == 0) | (F.get("letters", i) != F.get("letters", i - 1))).alias("first")))
    skipped = way.select("id", "n", F.explode(skips).alias("pair")).select("id", "n", "pair.p", "pair.s", "pair.first")
    other = skipped.select("p", "s", F.col("id").alias("near"), F.col("n").alias("near_n"))
    replaced = skipped.join(other, ["p", "s"]).where("id <> near").select("id", "near", "near_n")
    longer = skipped.where("first").join(whole, ["p", "s"])
    return replaced.unionAll(longer.select("id", "near", "near_n")).unionAll(
        longer.select(F.col("near").alias("id"), F.col("id").alias("near"), F.col("n").alias("near_n")))


def group(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """For (word, n) rows, a word once: word, n, n_near, the word's main form (its most frequent near
    word, if that occurs ``ratio`` times as often at least) and form_n, and root, the last of its forms."""
    words = numbered_words(vocabulary)
    best = F.max_by(F.struct("near", "near_n"), F.struct("near_n", (-F.col("near")).alias("first"))).alias("best")
    near = neighbours(words).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    far_more = F.col("best.near_n") >= ratio * F.col("n")
    forms = stored(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(far_more, F.col("best.near")).alias("form"), F.when(far_more, F.col("best.near_n")).alias("form_n")), "forms")
    # each step along the forms multiplies the count, so chains are short; every round doubles the step
    roots = forms.where("form is not null").select("id", F.col("form").alias("root"))
    while True:
        steps = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        after = stored(roots.join(steps, "root", "left").select("id", F.coalesce("next", "root").alias("root"), "next"), "roots")
        roots = after.select("id", "root")
        if after.where("next is not null").isEmpty():
            break
    name = lambda key: words.select(F.col("id").alias(key), F.col("word").alias(f"{key}_word"))
    few = forms.where("form is not null").select("id", "form").join(roots, "id").join(name("form"), "form").join(name("root"), "root")
    return forms.join(few.select("id", "form_word", "root_word"), "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
