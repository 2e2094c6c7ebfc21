"""What encoding costs: classes of Latin-1 texts as bitmaps, and frequent words that outlast a full cache."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snapstar.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_latin_texts_are_split_by_bitmaps(library):
    coder, pick = bpe.WordBpe(PATH), random.Random(3)
    coder.pattern = None  # for other texts
    texts = ["".join(pick.choices([*map(chr, range(256)), "'s", "'LL", " "], k=60)) for _ in range(500)]
    assert all(coder.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids for t in texts)


@pytest.mark.parametrize("pattern, known", [(r"'s|[\p{L}]+|[^\s\p{L}\p{N}]+", True), (r"\p{L}+", False), (r"[\p{Lu}\w]+", False)])
def test_only_known_classes_are_written_out(pattern, known):
    found = bpe.latin_pattern(pattern)
    assert (found is not None) == known
    for text in ["it's né\x1c!\xa0x1²", "", "A_b"] if known else []:
        assert found.findall(text) == bpe.regex.findall(pattern, text)


def test_frequent_words_outlast_a_full_cache(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 100)
    coder, encoded = bpe.WordBpe(PATH), []
    merge = coder.encode_word
    monkeypatch.setattr(coder, "encode_word", lambda word: encoded.append(word) or merge(word))
    letters = [chr(ord("a") + i) for i in range(20)]
    texts = [f"often {letters[i // 20]}{letters[i % 20]}q" for i in range(400)]
    assert all(coder.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids for t in texts)
    assert encoded.count("often") == 1
    assert len(coder.cache) + len(coder.cache.old) <= 100
