"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Patterns find assignments of a secret, access keys and long hexadecimal strings. The method adds
strings that a byte-pair vocabulary can hardly shorten: ordinary words come out at three or more
characters per token, random letters and digits at about two or fewer. Runs of key-like characters
are tokenized, and those with a low ratio are reported as ``random``, unless they are known
digests (hexadecimal strings of a digest's length, which the ``hex`` pattern already reports) or
identifiers (UUIDs, numbers, dates and versions, words joined by punctuation). Where the whole run
passes, its stretches of parts that are no words are tested on their own, so that words in front do
not hide a key; a long one-case part is a word only if its ratio is that of words.

The ranks file of the vocabulary is read on the driver and broadcast; its size is checked.

Defined cases: a null or empty text has no spans; spans of different kinds may overlap; repeated
rows give repeated results; spans are in code points, end exclusive.
"""

from __future__ import annotations

import base64
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.arrow_text import map_texts, named, worker_memo

MAX_RANKS_BYTES = 64 << 20
#: the vocabulary's own way to split a text before merging (public pattern of this vocabulary)
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")

#: runs that may be keys: the shortest that can be told from a word by its tokens; those under
#: SHORT characters by a tighter ratio
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
MIN_CHARS, SHORT = 16, 20
MAX_CHARS_PER_TOKEN, SHORT_CHARS_PER_TOKEN = 2.2, 1.8
DIGEST_LENGTHS = frozenset({32, 40, 48, 56, 64, 96, 128})
DIGEST = re.compile(r"[0-9a-fA-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: words, numbers or one-letter parts joined by punctuation, as in file and variable names
PART = re.compile(r"[A-Za-z0-9]+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}")
#: a word this short between two parts that are none belongs to them
LINK_CHARS = 3
IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})(?:[-_/+=]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}))*[-_/+=]*")


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        content = file.read(MAX_RANKS_BYTES + 1)
    if len(content) > MAX_RANKS_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANKS_BYTES} bytes")
    return content


def encoding(ranks: bytes):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("secrets", pat_str=SPLIT, special_tokens={},
                             mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})


def few_chars_per_token(run: str, encoder) -> bool:
    most = MAX_CHARS_PER_TOKEN if len(run) >= SHORT else SHORT_CHARS_PER_TOKEN
    return len(run) >= MIN_CHARS and len(run) <= most * len(encoder.encode_ordinary(run))


def is_digest(run: str) -> bool:
    return bool(DIGEST.fullmatch(run)) and (len(run) in DIGEST_LENGTHS or run.isdigit())


def looks_random(run: str, encoder) -> bool:
    """Whether a run of key-like characters is neither a known digest nor an identifier, and its
    characters per token are few."""
    if is_digest(run) or UUID.fullmatch(run) or IDENTIFIER.fullmatch(run):
        return False
    return few_chars_per_token(run, encoder)


def random_stretches(run: str, encoder) -> list[tuple[int, int]]:
    """(start, end) of the run if it looks random, else of its stretches of parts that are neither
    words nor digests and whose characters per token are few."""
    if UUID.fullmatch(run):
        return []
    if looks_random(run, encoder):
        return [(0, len(run))]
    stretches: list[tuple[int, int]] = []
    joined = False  # whether only separators and short words lie behind the last stretch
    for m in PART.finditer(run):
        part = m[0]
        if is_digest(part) or WORD.fullmatch(part) and not few_chars_per_token(part, encoder):
            joined = joined and len(part) <= LINK_CHARS
        elif joined:
            stretches[-1] = (stretches[-1][0], m.end())
        else:
            stretches.append(m.span())
            joined = True
    return [(a, b) for a, b in stretches if not is_digest(run[a:b]) and few_chars_per_token(run[a:b], encoder)]


def find_spans(text: str, encoder) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then in the order of ``KINDS``."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_MIN]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    found += [("random", m.start() + a, m.start() + b) for m in CANDIDATE.finditer(text) for a, b in random_stretches(m[0], encoder)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """The text with every span, or union of overlapping ones, replaced by the mask."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column and spans, an array of (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    key = f"ranks-{uuid.uuid4()}"

    def make(texts: pa.Array):
        encoder = worker_memo(key, lambda: encoding(shared.value))
        return [[find_spans(t, encoder) for t in texts.to_pylist()]]

    return map_texts(docs, text_col, [id_col], make, "spans array<struct<kind: string, start: long, end: long>>")


def redact_secrets(docs: DataFrame, ranks_path: str, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns, with every secret in the text replaced by a mask; ``length_col``, if
    there is such a column, follows the new text. A null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    key = f"ranks-{uuid.uuid4()}"
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_col)]

    def make(texts: pa.Array):
        encoder = worker_memo(key, lambda: encoding(shared.value))
        out = [redact(t, s) if (s := find_spans(t, encoder)) else None for t in texts.to_pylist()]
        return [out]  # null: nothing to replace

    found = map_texts(plain, text, names, make, "redacted string")
    columns = []
    for name, original in zip(names, docs.columns):
        if original == text_col:
            columns.append(F.coalesce("redacted", name).alias(original))
        elif original == length_col:
            kind = plain.schema[name].dataType
            columns.append(F.when(F.col("redacted").isNotNull(), F.char_length("redacted").cast(kind))
                           .otherwise(F.col(name)).alias(original))
        else:
            columns.append(F.col(name).alias(original))
    return found.select(*columns)
