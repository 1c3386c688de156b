"""BPE against the tokenizers library and exact merging."""

from __future__ import annotations

import hashlib
import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from propspark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Encoder(json.load(f))


def ours(encoder, text):
    (entries,) = encoder.encode([text])
    return [i for e in entries for i in e[0]]


HARD = ["", " ", "Hello WORLD, it's we'll 123", "ΑΣ Σ σς", "İstanbul ﬁ ǅ", "á ë", "\x1c\x1d\x85​᠎ x",
        "<|startoftext|>a<|endoftext|>", "<|nope|>", "</w> a</w>b", "aaaaaaaaaaaaaaaaaaaaaa", "=" * 300, "日本語 text 漢字",
        "don't DON'T 'S", "🙂🙂x🙂", "²½ Ⅷ ٣", "x" * 5000, "the" * 700]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(library, encoder, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ours(encoder, text) == want
    (entries,) = encoder.encode([text])
    assert " ".join(e[2] for e in entries) == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(want, encoder.vocab) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, encoder, text):
    assert ours(encoder, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeghinorst", min_size=1, max_size=40))
def test_long_words_need_exact_merging_sometimes(library, encoder, text):
    assert ours(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_both_paths_are_used(encoder):
    words = {a + b + c for a in ("ththe", "inan", "rere", "onon") for b in ("tion", "sths", "ea") for c in ("ndst", "er")}
    encoder.learn(words)
    assert 0 < encoder.failed < encoder.proposed


def test_every_letter(library, encoder):
    for lo in range(0, 0x110000, 0x800):
        text = " ".join(chr(c) for c in range(lo, lo + 0x800) if not 0xD800 <= c < 0xE000)
        if text:
            want = library.encode(text, add_special_tokens=False).ids
            assert ours(encoder, text) == want, hex(lo)


def test_rows(spark, library):
    rows = [(1, None, "n"), (2, "", None), (None, "The THE the", "x"), (3, "a b " * 5000, "y"), (3, "a b " * 5000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    out = bpe.encode_texts(df, PATH, outputs=("ids", "n_tokens", "ids_sha256")).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["ids"], r["n_tokens"]) == (want, len(want))
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    assert bpe.encode_texts(df.limit(0), PATH).count() == 0


def test_words_met_again_outlive_a_full_table(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    encoder.kept, encoder.again = {}, set()
    common = " ".join(f"zq{c}word" for c in "abcdefghij")
    learnt = []
    for i in range(6):
        before = encoder.proposed
        list(encoder.encode([common, " ".join(f"x{i}y{k}" for k in "abcdefghijklmnopqrst")]))
        learnt.append(encoder.proposed - before)
        assert len(encoder.kept) <= 200
    # Digits are words of their own: the common words are proposed in the first round only.
    encoder.proposed = 0
    list(encoder.encode([common]))
    assert encoder.proposed == 0 and max(learnt[1:]) < learnt[0]


def test_one_object_per_identifier(encoder):
    encoder.kept, encoder.again = {}, set()
    one = {}
    for word, (ids, numbers, text) in encoder.learn({"ththetion", "inansths", "rererer", "zqzqzq", "bbbbbb", "ththerer"}).items():
        assert isinstance(ids, tuple) and numbers == " ".join(map(str, ids))
        for i in ids:
            assert one.setdefault(i, i) is i
