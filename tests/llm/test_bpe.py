import hashlib
from array import array

import public_tokenizers
import pytest
from helpers import SF, awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kestrel.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
REFERENCE = Tokenizer.from_file(PATH)
VOCABULARY = bpe.Vocabulary(bpe.read_vocabulary(PATH))


def expected(text):
    ids = REFERENCE.encode(text, add_special_tokens=False).ids
    return ids, REFERENCE.decode(ids, skip_special_tokens=False)


def same(text):
    ids, decoded = VOCABULARY.encode(text)
    return (array("I", ids).tolist(), decoded) == expected(text)


@pytest.mark.parametrize("text", [
    "", " ", "a\x1cb \x1d\x1e", "<|startoftext|>hi<|endoftext|> <|endoftext|>x<|ENDOFTEXT|>", "ΑΣ Σ ὈΔΥΣΣΕΎΣ",
    "İstanbul ıI", "dog's it'll 'sx ''re I'M", "a" * 5000, "é" * 3000, "½²Ⅷ٣ 12345", "日本語テスト🎉👩‍👩‍👧", "é ́x", "\x00\x7f"])
def test_odd_texts(text):
    assert same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n'<|>é́\x1c日Σ1"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    assert same(text)


@settings(max_examples=100, deadline=None)
@given(st.text("qxzjw19é", min_size=1, max_size=40))
def test_fragments_are_independent(word):
    """Cut words: no token crosses a cut, and long fragments merge as short ones do."""
    data = word.encode()
    assert b"".join(VOCABULARY.cut(data)) == data
    ids = [VOCABULARY.inner_ids[b] for b in data]
    assert VOCABULARY._merge_long(list(ids)) == VOCABULARY._merge_short(list(ids))


def test_forgotten_entries_are_encoded_again(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    small = bpe.Vocabulary(bpe.read_vocabulary(PATH))
    text = " ".join(f"word{i % 7}s number{i}" for i in range(60))
    assert array("I", small.encode(text)[0]).tolist() == expected(text)[0]


def test_query_on_whole_documents(spark):
    from kestrel.llm.queries import op8_bpe, table

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for r in op8_bpe(spark, SF).collect():
        ids, decoded = expected(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_awkward_rows(spark):
    rows = bpe.encode(awkward(spark), PATH).collect()
    assert len(rows) == awkward(spark).count()
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[1] == 0
    assert bpe.encode(empty(spark), PATH).count() == 0
