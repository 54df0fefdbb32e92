"""Cutting texts into remembered pieces never changes the ids."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from parley.llm import token_files
from parley.llm.common import tokenizer_path

ENCODER = token_files.Encoder(tokenizer_path("byte_bpe_50k.json"))
PARTS = [" ", "  ", "   ", "\n", "\t", "\r\n", "a", "word", "Word", "é", "ÉTÉ", ".", ",", "...", ",.", "!", "'s", "'", "12", "ñandú",
         " ", "　", "日本", "́", "<|endoftext|>", "_", "Ġ", "\x1c", "​", "😀", "\0", "x.y", "e.g."]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert ENCODER.encode(texts) == [ENCODER._alone(t) for t in texts]


@pytest.mark.parametrize("limit", [0, 3, 50])
def test_a_full_memory_changes_nothing(limit, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_PIECES", limit)
    encoder = token_files.Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = [f"some words, number {i} and more words. The  end {i % 3}" for i in range(40)]
    for i in range(0, 40, 5):
        assert encoder.encode(texts[i:i + 5]) == [encoder._alone(t) for t in texts[i:i + 5]]
