"""BPE encoding and decoding by forced-boundary splitting.

A merge can only join symbols that end up in one token, so two neighbouring bytes that no
vocabulary token holds side by side can never be joined: there the text may be cut, and the
fragments between cuts are encoded on their own and their ids put together. Words repeat far more
often than whole texts, so each worker keeps the ids of words and of white-space separated chunks it has
met in tables of bounded size.

The vocabulary file (a tokenizer in JSON with byte-level BPE and a word-end suffix) is read once
on the driver and broadcast; its size is checked against ``MAX_VOCABULARY_BYTES``.

Defined cases: a null or empty text has no ids and decodes to an empty string; the strings of
special tokens in a text become their ids; repeated rows give repeated results; other columns of
the input are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
import uuid
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kestrel.llm.arrow_text import map_texts, worker_memo

MAX_VOCABULARY_BYTES = 64 << 20
#: entries in either half of a worker's tables; what is forgotten is encoded again
MEMO_ENTRIES = 150_000
#: longer fragments and chunks are not kept, so that the tables' memory is bounded too
SHORT = 64
NEVER = 1 << 60

RESULT = "n_tokens long, ids binary, decoded string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the
    next free one from U+0100 on (the public byte-level convention)."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


# The library that defines the ids knows Unicode 16 (and case pairs of Unicode 17), this
# Python's tables end at 15.1. Letters and numbers added since then, and lower cases.
ADDED_LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E "
    "11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0")
ADDED_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
ADDED_LOWER = ("1C89:1C8A A7CB:0264 A7CC:A7CD A7CE:A7CF A7D2:A7D3 A7D4:A7D5 A7DA:A7DB A7DC:019B "
               "10D50-10D65:10D70 16EA0-16EB8:16EBB")


def code_points(ranges: str) -> list[int]:
    ends = [r.split("-") for r in ranges.split()]
    return [c for r in ends for c in range(int(r[0], 16), int(r[-1], 16) + 1)]


LATER_LOWER = {c: int(pair.split(":")[1], 16) + k for pair in ADDED_LOWER.split()
               for k, c in enumerate(code_points(pair.split(":")[0]))}
#: a known character of the same class in the place of a later one, for the word pattern
LATER_CLASS = dict.fromkeys(code_points(ADDED_LETTERS), "\u02B0") | dict.fromkeys(code_points(ADDED_NUMBERS), "\u0660")


def known_class(c: str) -> str:
    """The character itself if this Python's tables have it, else one of its class."""
    return c if unicodedata.category(c) != "Cn" else LATER_CLASS.get(ord(c), "\u2022")


class Recent(dict):
    """The entries met most recently: of two halves the older one goes when the newer is full."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def put(self, key, value) -> None:
        if len(self) >= MEMO_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def again(self, key):
        """An entry of the older half, which becomes a newer one; None if there is none."""
        if (value := self.older.get(key)) is not None:
            self.put(key, value)
        return value


class Vocabulary:
    """Encoder and decoder for one vocabulary file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        symbols = byte_symbols()
        self.inner_ids = [self.ids[s] for s in symbols]
        self.last_ids = [self.ids[s + self.suffix] for s in symbols]
        self.joined = self._joined_pairs(symbols)
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(splits[0])
        self.special_words = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = Recent()  # word -> ids
        self.chunks = Recent()  # chunk -> packed ids, decoded text

    def _joined_pairs(self, symbols: list[str]) -> frozenset[tuple[int, int]]:
        """Byte pairs that stand side by side inside some token."""
        of = {s: b for b, s in enumerate(symbols)}
        pairs = set()
        for token in self.ids:
            inner = token.removesuffix(self.suffix) if self.suffix else token
            data = bytes(of[c] for c in inner if c in of)
            pairs.update(zip(data, data[1:]))
        return frozenset(pairs)

    def cut(self, word: bytes) -> list[bytes]:
        """The fragments between forced boundaries."""
        joined = self.joined
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in joined]
        return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def encode_fragment(self, data: bytes, ends_word: bool) -> tuple[int, ...]:
        """Ids after all merges, lowest rank first and leftmost among equals."""
        ids = [self.inner_ids[b] for b in data]
        if ends_word:
            ids[-1] = self.last_ids[data[-1]]
        return tuple(self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids))

    def _merge_short(self, ids: list[int]) -> list[int]:
        """All merges of a few symbols: the list of pair ranks is searched again after each one."""
        rank_of = self.ranks.get
        ranks = [rank_of(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            made = ids[i] = self.made[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((made, ids[i + 1]), NEVER)
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], made), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a queue and links, in n log n steps for fragments of any length."""
        n, rank_of = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank_of(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of((ids[i], ids[k]))) is not None:
                    heapq.heappush(queue, (r, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (r := rank_of((ids[h], ids[i]))) is not None:
                heapq.heappush(queue, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one lower-case piece of the vocabulary's word pattern."""
        if known := self.words.get(word) or self.words.again(word):
            return known
        *inner, last = self.cut(word.encode("utf-8"))
        ids: tuple[int, ...] = ()
        for fragment in inner:
            ids += self.encode_fragment(fragment, False)
        ids += self.encode_fragment(last, True)
        if len(word) <= SHORT:
            self.words.put(word, ids)
        return ids

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text without white space and special tokens."""
        if not chunk.isascii():
            # lower case character by character: a word-final sigma is not treated on its own
            chunk = "".join(map(str.lower, unicodedata.normalize("NFC", chunk))).translate(LATER_LOWER)
        else:
            chunk = chunk.lower()
        if chunk.isalpha():
            return list(self.encode_word(chunk))
        known = chunk if chunk.isascii() else "".join(map(known_class, chunk))
        return [i for m in self.pattern.finditer(known) for i in self.encode_word(chunk[m.start():m.end()])]

    def chunk(self, chunk: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, their tokens joined by spaces)."""
        if made := self.chunks.again(chunk):
            return made
        ids: list[int] = []
        for part in self.special_words.split(chunk) if "<" in chunk else (chunk,):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self.encode_chunk(part)
        made = packed(ids), " ".join(map(self.names.__getitem__, ids))
        if len(chunk) <= SHORT:
            self.chunks.put(chunk, made)
        return made

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids and decoded text. White space ends every word and is dropped, so the ids of a text
        are those of its chunks in order."""
        known, encode = self.chunks.get, self.chunk
        chunks = text.split() if SEPARATORS.isdisjoint(text) else filter(None, SPACES.split(text))
        found = [known(chunk) or encode(chunk) for chunk in chunks]
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[1]])


#: U+001C to U+001F: str.split() takes them for white space, the vocabulary's patterns don't
SEPARATORS = frozenset("\x1c\x1d\x1e\x1f")
SPACES = regex.compile(r"\p{White_Space}+")


def packed(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


def read_vocabulary(path: str) -> str:
    """The file's content, for the driver; its size is the bound of what is broadcast."""
    with open(path, encoding="utf-8") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} characters")
    return content


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, n_tokens, ids (binary, little-endian unsigned 32-bit integers) and
    decoded (the decoder's text, special tokens included)."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    key = f"bpe-{uuid.uuid4()}"

    def make(texts: pa.Array):
        vocabulary = worker_memo(key, lambda: Vocabulary(shared.value))
        done = [vocabulary.encode(t) for t in texts.to_pylist()]
        return [len(ids) // 4 for ids, _ in done], [ids for ids, _ in done], [decoded for _, decoded in done]

    return map_texts(docs, text_col, [id_col], make, RESULT)
