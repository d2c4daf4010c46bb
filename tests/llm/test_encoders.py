"""Chunked encoding against the tokenizers library over texts that fold, compose, mark and space in odd ways."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from flowtide.llm import bpe, common, tokens

PIECES = ["a", "E", "VI", "İ", "ı", "ß", "ẞ", "ﬁ", "Å", "Å", "é", "é", "Σ", "ς", "ǅ", "Ω", "К", "日本", "한", "́", "̇", "²",
          "½", "9", "10", " ", "  ", "\n", "\t", " ", " ", ".", ",", ";", ";", ":", "!", "?", "...", "'s", "'LL",
          "-", "_", "<|endoftext|>", "<|EndOfText|>", "<|", "|>", "</w>", "😀", "‍", "﻿", "\x00", "x" * 40]


def _texts(n, seed):
    rng = random.Random(seed)
    out = ["EVİ.", "Gel, EVİ! şimdi", "İ.", "xİ?", "ĞİŞİ; İİ:", "İ.", "ſ.", "ŉ!", "ǰ,", "ƀ.", ""]
    return out + ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("name, make", [("word_bpe_49k.json", tokens.library), ("byte_bpe_50k.json", tokens.library),
                                        ("word_bpe_49k.json", bpe.prefix_encoder)])
def test_chunks_equal_the_library(name, make):
    path = common.vocabulary(name)
    texts = _texts(20_000, 6)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    chunks = tokens.Chunks(make(path), tokens.spaced(path))
    wrong = [t for t, got, ids in zip(texts, chunks.ids(texts), want) if np.frombuffer(got, "<u4").tolist() != ids]
    assert wrong == []


def test_words_in_a_row_equal_the_library_one_by_one():
    """Words that the library parts at their blanks go to it without a special token between them."""
    path = common.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(2)
    parts = ["a", "É", "ñ", "ßen", "'", "'s", "'LL", "1", "23", "#", "***", "|>", ">", "endoftext", ".", "_", "-", "×", "<", "<|",
             "<|endoftext|>", "日", " ", "́", " ", "\n", "ɐ"]
    chunks = sorted({rng.choice([" ", " ", " ", "\n", ""]) + "".join(rng.choices(parts, k=rng.randint(1, 5)))
                     for _ in range(5_000)})
    rng.shuffle(chunks)
    assert 400 < sum(tokens._WORD.fullmatch(c) is not None for c in chunks) < len(chunks)
    assert not tokens._WORD.fullmatch(" a b") and not tokens._WORD.fullmatch(" <|endoftext|>")
    want = [library.encode(c, add_special_tokens=False).ids for c in chunks]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.library(path)(chunks)] == want
