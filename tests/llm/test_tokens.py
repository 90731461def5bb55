"""Ids by merge ranks equal those of the JSON tokenizer on odd texts."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm import packing, queries

RANKS, PATH = queries.tokenizer_paths()
FAST, SPECIAL = packing.encoder(RANKS, PATH)
PLAIN = Tokenizer.from_file(PATH)
#: Parts at which tokenizers part ways: special tokens and pieces of them, contractions, spaces of many kinds, marks, numerals, surrogates' neighbours.
ODD = [*SPECIAL, "<|endof", "text|>", "<|", "a", "I'll", "'S", "ſ", " ", "  ", "\n", "\r\n", "\t", "\x00", "\x85", " ", " ", "　", "​", "́", "é", "ß", "İ", "中文", "\U0001f642", "\U0001f469‍\U0001f467", "퟿", "\U0010ffff", "0", "123", "٣", "Ⅷ", "_", "-", "..."]


def same_ids(text):
    assert FAST.encode(text, allowed_special=set(SPECIAL)) == PLAIN.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(ODD), max_size=14).map("".join))
@settings(max_examples=1500, deadline=None)
def test_odd_parts(text):
    same_ids(text)


@given(st.text(max_size=60))
@settings(max_examples=500, deadline=None)
def test_any_text(text):
    same_ids(text)


@pytest.mark.parametrize("text", ["", "a" * 100_000, " " * 100_000, "\n" * 50_000 + "x", "é" * 50_000, SPECIAL[0] * 3000, "ab " * 50_000])
def test_long_runs(text):
    same_ids(text)
