"""The cached encoder gives the library's ids for texts of any characters."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm import tokens

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [
    "don't we'll they've I'm he'd you're it's 'tis ''s 's' 'S 're've'll 'r 'l 'v '", "a　 b  c  d\x85e \x1c f",
    "<|endoftext|>a<|endoftext|> <|startoftext|><|ENDOFTEXT|> <|end", "  \n 's\n's \t're", "é café İstanbul ǅ ß ﬁ ①½²",
    "Привет мир, Ελλάδα 日本語 テキスト 한국어", "👍🏽 smile 😀😀 don't 👩‍👩‍👧", "", " ", "\n\n", "x" * 3000 + "é'" * 50, "\U0001fae8\U00016d40Ᲊ",
]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def want(name, texts):
    return [e.ids for e in library(name).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_odd_texts(name):
    assert [x.tolist() for x in tokens.CachedEncoder(name).encode_many(ODD)] == want(name, ODD)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_random_texts(name, monkeypatch):
    monkeypatch.setattr(tokens, "WIDE_CHARS", 500)
    rng = random.Random(5)
    alphabet = [*"aabcdelrstvmMS'''' ’\n\t10²٣.,-<|>", " ", "　", "é", "é", "Ж", "ж", "ω", "日", "が", "👍", "İ", "<|endoftext|>"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(6000)]
    assert [x.tolist() for x in tokens.CachedEncoder(name).encode_many(texts)] == want(name, texts)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_every_character(name):
    every = [chr(k) for k in [*range(0xD800), *range(0xE000, 0x30000)]]
    texts = [" ".join(f"a{c}1{c}'{c} {c}" for c in every[k : k + 512]) for k in range(0, len(every), 512)]
    differing = [k for k, (a, b) in enumerate(zip(tokens.CachedEncoder(name).encode_many(texts), want(name, texts), strict=True)) if a.tolist() != b]
    assert differing == []


@pytest.mark.parametrize("name", VOCABULARIES)
def test_long_texts_are_cut_where_nothing_changes(name, monkeypatch):
    monkeypatch.setattr(tokens, "WIDE_CHARS", 200)
    rng = random.Random(6)
    texts = ["".join(rng.choices([*"ab 's  \n", "ж", "　"], k=400_000)), "".join(rng.choices([*"ab  \n\n"], k=1_500_000))]
    got = tokens.CachedEncoder(name).encode_many(texts)
    assert [np.array_equal(a, b) for a, b in zip(got, want(name, texts), strict=True)] == [True, True]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_repeated_odd_words_come_from_the_cache(name, monkeypatch):
    used = tokens.CachedEncoder(name)
    text = "don't 👍 Привет 日本語 " * 200
    used.encode_many([text])
    calls = []
    monkeypatch.setattr(used, "one", lambda piece: calls.append(piece))
    assert used.encode_many([text])[0].tolist() == want(name, [text])[0]
    assert calls == []
